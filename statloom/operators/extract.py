"""Extraction of statistical-reporting strings and the rigor score: columns in, columns out, all inside the JVM."""

from __future__ import annotations

import datetime
import traceback
from collections.abc import Callable, Iterator, Mapping

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statloom.functions import dialect
from statloom.functions.patterns import CATALOGUES, CATEGORIES, WEIGHTS
from statloom.sources.readers import EXTRACTION, METADATA


def _guarded(patterns: list[str]) -> str:
    try:
        return dialect.guarded(patterns)
    except ValueError:
        return dialect.alternation(patterns)


def hits(text: Column | str, patterns: list[str], ignore_case: bool = True, dotall: bool = False) -> Column:
    """All matches in order, repeats included; null for a null text."""
    return F.regexp_extract_all(text, F.lit(dialect.java(_guarded(patterns), ignore_case, dotall)), F.lit(0))


def distinct_hits(text: Column | str, patterns: list[str], ignore_case: bool = True) -> Column:
    """Different matches, sorted; empty for a null text."""
    return F.array_sort(F.array_distinct(F.coalesce(hits(text, patterns, ignore_case), F.array().cast("array<string>"))))


def category_columns(text: str = "text", profile: str = "implemented") -> dict[str, Column]:
    catalogue, ignore = CATALOGUES[profile]
    return {c: distinct_hits(F.col(text), catalogue[c], ignore) for c in CATEGORIES}


def rigor_score(weights: Mapping[str, int]) -> Column:
    """Sum of the weights of the categories that have any match."""
    return sum((F.when(F.size(c) > 0, F.lit(w)).otherwise(F.lit(0)) for c, w in weights.items()), F.lit(0)).cast("int")


def category_flags(text: str = "text", profile: str = "implemented") -> dict[str, Column]:
    """Whether each category occurs: stops at the first match, where category_columns must find all."""
    catalogue, ignore = CATALOGUES[profile]
    return {c: F.coalesce(F.col(text).rlike(dialect.java(_guarded(catalogue[c]), ignore)), F.lit(False)) for c in CATEGORIES}


def scored(articles: DataFrame, profile: str = "implemented", weights: str | None = None) -> DataFrame:
    """articles with rigor_score alone; the same as extract gives, at a fraction of its work."""
    has = category_flags("text", profile)
    total = sum((F.when(has[c], F.lit(w)).otherwise(F.lit(0)) for c, w in WEIGHTS[weights or profile].items()), F.lit(0))
    return articles.withColumn("rigor_score", total.cast("int"))


def extract(articles: DataFrame, profile: str = "implemented", weights: str | None = None) -> DataFrame:
    """articles with the seven category arrays and rigor_score. One narrow projection: every text is read once, no
    shuffle. A text with nothing in it gives empty arrays and 0; rows of null text are expected to be gone."""
    with_hits = articles.withColumns(category_columns("text", profile))
    return with_hits.withColumn("rigor_score", rigor_score(WEIGHTS[weights or profile]))


def extract_long(extracted: DataFrame, key: str = "id") -> DataFrame:
    """(id, category, match): one row for each different match."""
    pairs = F.concat(*[_pairs(c) for c in CATEGORIES])
    return extracted.select(key, F.explode(pairs).alias("p")).select(key, "p.category", "p.match")


def _pairs(category: str) -> Column:
    return F.transform(category, lambda m: F.struct(F.lit(category).alias("category"), m.alias("match")))


def output_records(extracted: DataFrame) -> DataFrame:
    """Extraction lines: id, stats, metadata, timestamp; error and traceback stay null, as a null text is no failure here."""
    return extracted.select(
        "id",
        F.struct(*CATEGORIES, "rigor_score", F.lit(None).cast("string").alias("extraction_error")).alias("stats"),
        metadata().alias("metadata"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
        F.lit(None).cast("string").alias("error"),
        F.lit(None).cast("string").alias("traceback"),
    )


def isolated_records(articles: DataFrame, profile: str = "implemented", matchers: Mapping[str, Callable[[str], list[str]]] | None = None) -> DataFrame:
    """Extraction lines like output_records', where a failure costs as little as it can: one of a category leaves that category
    empty and is named in stats.extraction_error; one of the whole article makes its line an error line, with error and
    traceback. For matchers (category -> matches of a text) that may fail; those of the catalogues run in Python here, and a
    plan of expressions alone (output_records) is faster."""
    catalogue, ignore = CATALOGUES[profile]
    weights, schema = WEIGHTS[profile], EXTRACTION
    patterns = {c: dialect.alternation(catalogue[c]) for c in CATEGORIES}

    def record(text: str, find: Mapping[str, Callable[[str], list[str]]]) -> dict:
        stats, errors = {}, []
        if not isinstance(text, str):
            raise TypeError(f"no text: {type(text).__name__}")
        for c in CATEGORIES:
            try:
                stats[c] = sorted(set(find[c](text)))
            except Exception as e:  # a matcher may raise anything
                stats[c] = []
                errors.append(f"{c}: {type(e).__name__}: {e}")
        stats["rigor_score"] = sum(w for c, w in weights.items() if stats[c])
        stats["extraction_error"] = "; ".join(errors) or None
        return stats

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rx = {c: dialect.python(p, ignore) for c, p in patterns.items()}
        find = {c: (lambda t, r=r: [m.group() for m in r.finditer(t)]) for c, r in rx.items()} | dict(matchers or {})
        for pdf in batches:
            out = []
            for row in pdf.to_dict("records"):
                now = datetime.datetime.now(datetime.timezone.utc).strftime("%Y-%m-%dT%H:%M:%S.%f")
                meta = {m: None if row[m] is None or row[m] != row[m] else int(row[m]) if m == "pub_year" else row[m] for m in METADATA}
                line = {"id": row["id"], "stats": None, "metadata": meta, "timestamp": now, "error": None, "traceback": None}
                try:
                    line["stats"] = record(row["text"], find)
                except Exception as e:  # the article is named, the others go on
                    line |= {"error": f"{type(e).__name__}: {e}", "traceback": traceback.format_exc(), "metadata": None}
                out.append(line)
            yield pd.DataFrame(out, columns=[f.name for f in schema.fields])

    return articles.select(F.col("id").cast("long").alias("id"), "text", *METADATA).mapInPandas(run, schema)


def metadata() -> Column:
    return F.struct(*METADATA)


def unprocessed(articles: DataFrame, done: DataFrame, key: str = "id") -> DataFrame:
    """Rows whose key is not among those done. Null keys are never done."""
    return articles.join(done.select(key).where(F.col(key).isNotNull()).distinct(), key, "left_anti")

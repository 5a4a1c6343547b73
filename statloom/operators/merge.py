"""Merging of pattern and model findings with tolerance-based de-duplication.

Within an article the result depends on the order (a value kept may shut out later ones), so close values are found
by a fold over lists. Before it, values are made distinct by their key with a partial aggregation and cut into islands:
runs of sorted values with steps below the tolerance. Nothing in one island can be close to anything in another, so
each island is folded alone. A task gathers an island: at most as many different keys as fit into a run of such steps.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Decimals of a key and the difference below which two values are the same.
CI_DECIMALS, P_DECIMALS = 3, 6
CI_NEAR, P_NEAR, EFFECT_NEAR = 0.01, 0.0001, 0.01
REGEX_FACTOR = 0.8

#: Columns of merged findings, one row each.
MERGED = ("kind", "id", "extractor", "name", "lo", "hi", "level", "num")


def _distinct(f: DataFrame, kind: str, keys: Sequence[Column], by: str) -> DataFrame:
    """Different values of a kind by article and extractor, each as the first row that has it. Values without a key are
    dropped."""
    d = f.where(F.col("kind") == kind)
    names = [f"k{i}" for i in range(len(keys))]
    for n, k in zip(names, keys, strict=True):
        d = d.withColumn(n, k)
    first = F.min(F.struct("id", "lo", "hi", "level", "num")).alias("f")
    d = d.where(" and ".join(f"{n} is not null" for n in names)).groupBy(by, "extractor", "name", *names).agg(first)
    return d.select(by, "extractor", "name", *names, "f.*")


#: From this size on an island is folded by a grid, in time in proportion to it, and no longer by comparing all with all.
LARGE = 500


def _kept_of_large(step: float):
    """Which pattern values of a large island are kept: those whose key and neighbourhood are free. Cells are as wide as the
    tolerance, so what is close to a value stands in its cell or next to it; as keys are rounded a cell holds a bounded number."""

    @F.pandas_udf("array<boolean>")
    def kept(model: pd.Series, patterns: pd.Series) -> pd.Series:
        out = []
        for own, new in zip(model, patterns, strict=True):
            if new is None:
                out.append(None)
                continue
            cells: dict[tuple, list[tuple]] = {}
            taken = set()

            def put(a, b, k):
                taken.add(k)  # noqa: B023
                cells.setdefault((math.floor(a / step), math.floor(b / step)), []).append((a, b))  # noqa: B023

            for a, b, k0, k1 in (x for x in own):
                put(a, b, (k0, k1))
            flags = []
            for a, b, k0, k1 in (x for x in new):
                i, j = math.floor(a / step), math.floor(b / step)
                free = (k0, k1) not in taken and not any(abs(x - a) < step and abs(y - b) < step for u in (i - 1, i, i + 1) for v in (j - 1, j, j + 1) for x, y in cells.get((u, v), ()))
                flags.append(free)
                if free:
                    put(a, b, (k0, k1))
            out.append(flags)
        return pd.Series(out)

    return kept


def _folded(d: DataFrame, by: str, order: str, step: float, keys: Sequence[str], near) -> DataFrame:
    """MERGED rows of distinct values: an island's model values, and behind them, in order of id, every pattern value
    whose key is new and that is close to nothing kept so far."""
    w = Window.partitionBy(by, "name").orderBy(order, "id")
    apart = F.coalesce((F.col(order) - F.lag(order).over(w) >= step).cast("int"), F.lit(0))
    d = d.withColumn("_apart", apart).withColumn("_island", F.sum("_apart").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    entry = F.struct("id", "extractor", "lo", "hi", "level", "num", F.struct(*keys).alias("k"))
    pick = lambda e: F.array_sort(F.collect_list(F.when(F.col("extractor") == e, entry)))
    g = d.groupBy(by, "name", "_island").agg(pick("llm").alias("l"), pick("regex").alias("r"))
    fold = F.aggregate("r", F.col("l"), lambda acc, x: F.when(F.exists(acc, lambda y: (y["k"] == x["k"]) | near(x, y)), acc).otherwise(F.concat(acc, F.array(x))))
    large = F.size("l") + F.size("r") >= LARGE
    second = F.lit(0.0)
    numbers = lambda c: F.transform(c, lambda x: F.array(x[order].cast("double"), x["hi"].cast("double") if order == "lo" else second, x["k"][keys[0]].cast("double"), x["k"][keys[1]].cast("double") if len(keys) > 1 else second))
    flags = _kept_of_large(step)(F.when(large, numbers("l")), F.when(large, numbers("r")))
    g = g.withColumn("_flags", flags)
    some = F.concat("l", F.transform(F.filter(F.arrays_zip("r", "_flags"), lambda z: z["_flags"]), lambda z: z["r"]))
    return g.select(by, "name", F.explode(F.when(large, some).otherwise(fold)).alias("m")).select(by, "name", "m.id", "m.extractor", "m.lo", "m.hi", "m.level", "m.num")


def _rows(d: DataFrame, kind: str, by: str) -> DataFrame:
    return d.select(by, F.lit(kind).alias("kind"), *MERGED[1:])


def merge_intervals(f: DataFrame, by: str = "pmc_id") -> DataFrame:
    """Merged intervals. A pattern's interval without level has 95."""
    level = F.when((F.col("extractor") == "regex") & F.col("level").isNull(), F.lit(95.0)).otherwise(F.col("level"))
    d = _distinct(f.withColumn("level", level), "confidence_interval", [F.round("lo", CI_DECIMALS), F.round("hi", CI_DECIMALS)], by)
    near = lambda a, b: (F.abs(a["lo"] - b["lo"]) < CI_NEAR) & (F.abs(a["hi"] - b["hi"]) < CI_NEAR)
    return _rows(_folded(d, by, "lo", CI_NEAR, ["k0", "k1"], near), "confidence_interval", by)


def merge_p_values(f: DataFrame, by: str = "pmc_id") -> DataFrame:
    d = _distinct(f, "p_value", [F.round("num", P_DECIMALS)], by)
    return _rows(_folded(d, by, "num", P_NEAR, ["k0"], lambda a, b: F.abs(a["num"] - b["num"]) < P_NEAR), "p_value", by)


def merge_sample_sizes(f: DataFrame, by: str = "pmc_id") -> DataFrame:
    """By whole number, no tolerance: a model's before a pattern's. No fold is needed."""
    d = _distinct(f, "sample_size", [F.floor("num").cast("long")], by)
    rank = F.when(F.col("extractor") == "llm", 0).otherwise(1)
    one = d.groupBy(by, "k0").agg(F.min(F.struct(rank.alias("rank"), "id", "extractor", "name", "lo", "hi", "level", "num")).alias("m"))
    return _rows(one.select(by, "m.*"), "sample_size", by)


def merge_effects(f: DataFrame, by: str = "pmc_id") -> DataFrame:
    """All model effects as they are, repeats included; a pattern's effect only if none of the same name is close."""
    e = f.where((F.col("kind") == "effect_size") & F.col("num").isNotNull() & F.col("name").isNotNull())
    d = _distinct(e, "effect_size", [F.col("num")], by)
    kept = _folded(d, by, "num", EFFECT_NEAR, ["k0"], lambda a, b: F.abs(a["num"] - b["num"]) < EFFECT_NEAR).where("extractor = 'regex'")
    return _rows(e.where("extractor = 'llm'"), "effect_size", by).unionByName(_rows(kept, "effect_size", by))


MERGES = {"ci": ("confidence_interval", merge_intervals), "p": ("p_value", merge_p_values), "n": ("sample_size", merge_sample_sizes), "effect": ("effect_size", merge_effects)}


def usable(f: DataFrame) -> DataFrame:
    """Findings with a key."""
    k = F.col("kind")
    return f.where(F.when(k == "confidence_interval", F.col("lo").isNotNull() & F.col("hi").isNotNull()).when(k == "effect_size", F.col("num").isNotNull() & F.col("name").isNotNull()).otherwise(F.col("num").isNotNull()) & k.isin(*[n for n, _ in MERGES.values()]))


def merged_findings(f: DataFrame, by: str = "pmc_id") -> DataFrame:
    """MERGED rows of all kinds; articles of one extractor alone are kept."""
    out = None
    for _, op in MERGES.values():
        out = op(f, by) if out is None else out.unionByName(op(f, by))
    return out


def article_counts(f: DataFrame, by: str = "pmc_id") -> DataFrame:
    """Per article: merged findings by kind and in all, and whether patterns and model gave any interval, p-value or sample
    size (effects don't count)."""
    m = merged_findings(f, by).groupBy(by).agg(*[F.count_if(F.col("kind") == kind).alias(n) for n, (kind, _) in MERGES.items()], F.count(F.lit(1)).alias("merged_count"))
    gave = lambda e: F.coalesce(F.max((F.col("extractor") == e) & (F.col("kind") != "effect_size")), F.lit(False))
    s = usable(f).groupBy(by).agg(gave("regex").alias("regex"), gave("llm").alias("llm"))
    return m.join(s, by)


def sources() -> Column:
    return F.array_compact(F.array(F.when(F.col("regex"), F.lit("regex")), F.when(F.col("llm"), F.lit("llm"))))


def merge_summary(articles: DataFrame, by: str = "pmc_id") -> DataFrame:
    """regex_count and llm_count say whether the source took part."""
    return articles.select(by, F.col("regex").cast("int").alias("regex_count"), F.col("llm").cast("int").alias("llm_count"), *MERGES, "merged_count")


def merge_stats(articles: DataFrame) -> DataFrame:
    """Articles by the sources that took part, with their merged findings by kind."""
    label = F.when(F.col("regex") & F.col("llm"), "both").when(F.col("llm"), "llm_only").when(F.col("regex"), "regex_only").otherwise("none")
    return articles.groupBy(label.alias("joined")).agg(F.count(F.lit(1)).alias("articles"), *[F.sum(n).alias(n) for n in MERGES])


def source_matrix(f: DataFrame) -> DataFrame:
    """Findings by extractor and kind, with totals of either and of all (null: all)."""
    return f.cube("extractor", "kind").agg(F.count(F.lit(1)).alias("findings"))


def merge_findings(f: DataFrame, by: str = "pmc_id", text: str = "context") -> DataFrame:
    """One finding per article, kind and stated value (of one that can't be read: per whole text): a model's before a pattern's,
    the first of its extractor; findings only patterns have lose a fifth of their confidence."""
    rank = F.when(F.col("extractor") == "llm", 0).otherwise(1)
    first = F.min(F.struct(rank.alias("rank"), "id", "confidence")).alias("f")
    read = F.col("num").isNotNull() | F.col("lo").isNotNull() & F.col("hi").isNotNull()
    key = [F.when(read, F.col(c) + F.lit(0.0)).alias(c) for c in ("lo", "hi", "num")] + [F.when(read, F.col("name")).alias("name")]  # one zero
    g = f.groupBy(by, "kind", *key, F.when(~read, F.coalesce(text, F.lit(""))).alias("text_key")).agg(first)
    conf = F.when(F.col("f.rank") == 0, F.col("f.confidence")).otherwise(F.col("f.confidence") * REGEX_FACTOR)
    return g.select(by, "kind", "lo", "hi", "num", "name", "text_key", F.col("f.id").alias("id"), F.when(F.col("f.rank") == 0, "llm").otherwise("regex").alias("extractor"), F.round(conf, 6).alias("confidence"))


def join_kind(f: DataFrame, by: str = "pmc_id") -> DataFrame:
    """Per article whether patterns, the model or both have any finding (full outer join)."""
    side = lambda e: f.where(F.col("extractor") == e).groupBy(by).agg(F.count(F.lit(1)).alias(e))
    j = side("regex").join(side("llm"), by, "full_outer").na.fill(0, ["regex", "llm"])
    return j.withColumn("joined", F.when((F.col("regex") > 0) & (F.col("llm") > 0), "both").when(F.col("llm") > 0, "llm_only").otherwise("regex_only"))

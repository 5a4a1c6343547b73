"""Structured extraction: named patterns with groups, offsets and context; table and figure sections."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statloom.functions import dialect
from statloom.functions.patterns import COMPAT_TYPES, FIGURE_MARKS, STRUCTURED, TABLE_MARKS, TABLE_WINDOW
from statloom.operators.extract import hits

CONTEXT = 50
FINDING = "id long, pattern string, type string, pattern_pos int, match_pos int, start int, groups array<string>, raw_text string, context string, location string, confidence double"


def finding_type(name: str, compat: bool = False) -> str:
    """The statistic a pattern finds. compat: as decided by the name alone, where every name with 'ci' in it is an interval."""
    return COMPAT_TYPES.get(name, STRUCTURED[name][1]) if compat else STRUCTURED[name][1]


def whole_text() -> Column:
    """Title, abstract and body, each followed by the next after one blank; null counts as empty."""
    e = lambda c: F.coalesce(c, F.lit(""))
    return F.concat(e(F.col("title")), F.lit(" "), e(F.col("abstract")), F.lit(" "), e(F.col("body")))


def pattern_counts(text: Column) -> dict[str, Column]:
    """Matches of every named pattern, counted in the JVM (offsets are not needed for it)."""
    return {n: F.size(hits(text, [p])) for n, (p, _) in STRUCTURED.items()}


def findings(articles: DataFrame, compat: bool = False) -> DataFrame:
    """FINDING rows with exact offsets, 50 characters of context on either side, in the order pattern, then place.

    Offsets of regex matches have no JVM expression, so texts go to Python in Arrow batches; narrow, no shuffle. A
    text without matches gives no row.
    """
    compiled = [(n, finding_type(n, compat), p) for n, (p, _) in STRUCTURED.items()]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rx = [(n, t, dialect.python(p)) for n, t, p in compiled]
        for pdf in batches:
            out = []
            for rid, text in zip(pdf["id"].to_list(), pdf["txt"], strict=True):
                for k, (n, t, r) in enumerate(rx):
                    for j, m in enumerate(r.finditer(text)):
                        s, e = m.span()
                        out.append((rid, n, t, k, j, s, list(m.groups()), m.group(), text[max(0, s - CONTEXT) : e + CONTEXT], "text", 0.9))
            yield pd.DataFrame(out, columns=[c.split(" ")[0] for c in FINDING.split(", ")])

    return articles.select(F.col("id").cast("long").alias("id"), whole_text().alias("txt")).mapInPandas(run, FINDING)


def valid_findings(found: DataFrame, compat: bool = False) -> DataFrame:
    """Findings of at least 0.2 confidence that are possible: an interval's bounds in order, a p-value (last group) from 0 to 1,
    a sample size (first group) over 0; where no number can be read, p-values and sizes pass. compat: an interval's first two
    groups are its bounds, whatever they are (else the last two), and p-values and sizes are not looked at."""
    num = lambda c: F.expr(f"try_cast({c} AS DOUBLE)")
    lo, hi = (num("groups[0]"), num("groups[1]")) if compat else (num("element_at(groups, -2)"), num("element_at(groups, -1)"))
    ok = F.when(F.col("type") == "confidence_interval", F.coalesce((F.size("groups") >= 2) & (lo < hi), F.lit(False)))
    if not compat:
        ok = ok.when(F.col("type") == "p_value", F.coalesce(num("element_at(groups, -1)").between(0, 1), F.lit(True)))
        ok = ok.when(F.col("type") == "sample_size", F.coalesce(num("groups[0]") > 0, F.lit(True)))
    return found.where((F.col("confidence") >= 0.2) & ok.otherwise(F.lit(True)))


def table_mark_counts(text: Column) -> list[Column]:
    """Marks of each kind. They are not de-duplicated: 'Table 1.' counts as two kinds."""
    return [F.size(hits(F.coalesce(text, F.lit("")), [p], dotall=True)) for p in TABLE_MARKS]


def table_section_count(text: Column) -> Column:
    return sum(table_mark_counts(text), F.lit(0))


def figure_captions(text: Column) -> Column:
    """Captions of each kind, one after another: from a figure mark to the next figure or table, or the end."""
    return F.concat(*[hits(F.coalesce(text, F.lit("")), [p], dotall=True) for p in FIGURE_MARKS])


def table_windows(text: str, marks: Sequence[re.Pattern]) -> Iterator[tuple[int, int]]:
    """Bounds of every table section: a mark with the text around it, by pattern, then place."""
    for r in marks:
        for m in r.finditer(text):
            yield max(0, m.start() - TABLE_WINDOW[0]), min(len(text), m.end() + TABLE_WINDOW[1])


SECTION = "id long, kind string, start int, end int, section string"


def table_sections(articles: DataFrame, col: str = "body") -> DataFrame:
    """SECTION rows: every table mark with the text around it. Null and empty bodies give none."""

    def run(batches):
        rx = [dialect.python(p, dotall=True) for p in TABLE_MARKS]
        for pdf in batches:
            out = []
            for rid, text in zip(pdf["id"].to_list(), pdf["txt"], strict=True):
                for s, e in table_windows(text, rx):
                    out.append((rid, "table", s, e, text[s:e]))
            yield pd.DataFrame(out, columns=["id", "kind", "start", "end", "section"])

    return articles.select(F.col("id").cast("long").alias("id"), F.col(col).alias("txt")).where("txt <> ''").mapInPandas(run, SECTION)

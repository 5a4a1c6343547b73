"""Choice and order of articles for model-assisted extraction: column expressions and joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statloom.functions.patterns import RESEARCH_CHARS, RESEARCH_WORDS


def _has(col: str, *parts: str) -> Column:
    out = F.lit(False)
    for p in parts:
        out = out | F.coalesce(F.contains(F.col(col), F.lit(p)), F.lit(False))
    return out


def priority_rank(body: str = "body") -> Column:
    """1 tables, 2 figures, 3 intervals, 4 the rest; by what the body says, case counting."""
    return F.when(_has(body, "Table"), 1).when(_has(body, "Figure"), 2).when(_has(body, "CI", "confidence interval"), 3).otherwise(4)


def priority_page(articles: DataFrame, size: int, offset: int = 0, done: DataFrame | None = None, journals: Sequence[str] | None = None) -> DataFrame:
    """One page in order of priority, then year (latest first, unknown before), then id. Prefer leaving out what is done
    over advancing the offset; the limit is the feature."""
    a = articles if journals is None else articles.where(F.col("journal").isin(*journals))
    if done is not None:
        a = a.join(done.select("pmc_id").where("pmc_id is not null").distinct(), "pmc_id", "left_anti")
    p = a.withColumn("priority", priority_rank()).withColumn("body_length", F.length(F.coalesce("body", F.lit(""))))
    return p.orderBy("priority", F.desc_nulls_first("pub_year"), "id").offset(offset).limit(size)


def article_flags(articles: DataFrame, scores: DataFrame) -> DataFrame:
    """has_tables, has_figures, has_cis and current_score (0 if none): one left join; scores is unique by id and has
    rigor_score and confidence_intervals."""
    s = scores.select("id", F.col("rigor_score").alias("_s"), (F.size("confidence_intervals") > 0).alias("_c"))
    j = articles.join(s, "id", "left")
    return j.select(*articles.columns, _has("body", "Table").alias("has_tables"), _has("body", "Figure", "Fig").alias("has_figures"), F.coalesce("_c", F.lit(False)).alias("has_cis"), F.coalesce("_s", F.lit(0)).alias("current_score"))


def llm_priority() -> Column:
    marked = F.col("has_tables") | F.col("has_figures")
    return F.when((F.col("current_score") >= 50) & ~F.col("has_cis"), 0).when((F.col("current_score") >= 30) & ~F.col("has_cis") & marked, 1).when(marked, 2).otherwise(3)


def prompt_choice() -> Column:
    return F.when(F.col("has_tables"), "table_focused").when(F.col("has_figures"), "comprehensive").when((F.col("current_score") >= 50) & ~F.col("has_cis"), "ci_focused").otherwise("comprehensive")


def score_tier(score: str = "rigor_score") -> Column:
    s = F.col(score)
    return F.when(s == 0, "P1").when(s <= 20, "P2").when(s <= 30, "P3").otherwise("skip")


def is_research(text: str = "text") -> Column:
    head = F.lower(F.left(F.col(text), F.lit(RESEARCH_CHARS)))
    out = F.lit(False)
    for w in RESEARCH_WORDS:
        out = out | F.contains(head, F.lit(w))
    return F.coalesce(out, F.lit(False))


def low_score_candidates(articles: DataFrame, scores: DataFrame, most: int) -> DataFrame:
    """Articles of a score up to `most`, or without one (left join)."""
    return articles.join(scores.select("id", "rigor_score"), "id", "left").where((F.col("rigor_score") <= most) | F.col("rigor_score").isNull())


def unprocessed_not_in(articles: DataFrame, done: DataFrame) -> DataFrame:
    """NOT IN as SQL means it: with a null among the done there is no result at all, and nothing done leaves every row, those
    of null keys too. Done is held against its size by the planner; use extract.unprocessed for the plain anti join."""
    some = done.agg(F.count(F.lit(1)).alias("_n"), F.count("pmc_id").alias("_k"))  # one row
    left = articles.join(done.select("pmc_id").distinct(), "pmc_id", "left_anti").crossJoin(F.broadcast(some))
    return left.where((F.col("_n") == 0) | ((F.col("_n") == F.col("_k")) & F.col("pmc_id").isNotNull())).select(*articles.columns)

"""Audits of extraction quality on uniform, repeatable samples of score bands."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statloom.functions.patterns import AUDIT_A, AUDIT_B, AUDIT_C, AUDIT_CHARS, AUDIT_ITEMS
from statloom.operators.extract import distinct_hits, hits
from statloom.operators.prioritize import is_research

#: Score bands (lowest, highest) and grades (least percentage, name).
BANDS = {"above_50": (51, 100), "high": (60, 100), "low": (1, 30), "medium": (35, 50)}
GRADES = {"high": ((90, "EXCELLENT"), (80, "GOOD"), (70, "ACCEPTABLE"), (None, "NEEDS IMPROVEMENT")), "medium": ((90, "EXCELLENT"), (75, "GOOD"), (None, "NEEDS IMPROVEMENT")), "low": ((90, "EXCELLENT"), (80, "GOOD"), (70, "FAIR"), (None, "NEEDS REVIEW"))}


def in_band(band: str, score: str = "rigor_score") -> Column:
    return F.col(score).between(*BANDS[band])


def sample_key(key: str = "id", seed: int = 0) -> Column:
    """A hash that orders rows at random and equally on every run and engine."""
    return F.pmod((F.col(key) + F.lit(seed)) * F.lit(2654435761), F.lit(4294967296))


def sample_band(x: DataFrame, band: str, n: int = 20, seed: int = 0) -> DataFrame:
    """n rows of a band, uniform over all of it: the first in hash order. The limit is the feature (TakeOrdered: each
    task sends n rows)."""
    return x.where(in_band(band)).orderBy(sample_key(seed=seed), "id").limit(n)


def head(text: Column, audit: str, cuts: bool) -> Column:
    """The text, or with cuts its fixed first part."""
    return F.left(text, F.lit(AUDIT_CHARS[audit])) if cuts else text


def present(items: Column, text: Column, cuts: bool = False) -> Column:
    """How many of the items (with cuts: of the first ten) stand in the text as they are."""
    return F.size(F.filter(F.slice(items, 1, AUDIT_ITEMS) if cuts else items, lambda m: F.contains(text, F.trim(m))))


def checked(items: Column, cuts: bool = False) -> Column:
    return F.least(F.size(items), F.lit(AUDIT_ITEMS)) if cuts else F.size(items)


def grade(pct: Column, kind: str) -> Column:
    out = F.lit(GRADES[kind][-1][1])
    for least, name in reversed(GRADES[kind][:-1]):
        out = F.when(pct >= least, F.lit(name)).otherwise(out)
    return out


_FIVE = ("p_values", "sample_sizes", "confidence_intervals", "effect_sizes", "statistical_tests")


def audit_high(sample: DataFrame, cuts: bool = False) -> DataFrame:
    """Per article of the sample: extracted strings found in its text, of those checked; GOOD from 80 %. All of these audits
    hold all strings against the whole text; cuts: only so many strings and characters as the fixed limits say."""
    found = sum((present(F.col(c), F.col("text"), cuts) for c in _FIVE), F.lit(0))
    total = sum((checked(F.col(c), cuts) for c in _FIVE), F.lit(0))
    r = sample.select("id", "rigor_score", found.alias("found"), total.alias("checked"))
    return r.withColumn("status", F.when(F.col("checked") == 0, "GOOD").when(F.col("found") * 100 >= F.col("checked") * 80, "GOOD").otherwise("NEEDS REVIEW"))


def audit_count_match(sample: DataFrame, cuts: bool = False) -> DataFrame:
    """Per article and category: extracted against looser matches; equal within 2."""
    text = head(F.col("text"), "count_match", cuts)
    cats = [c for c in AUDIT_A if c != "t_tests"]
    manual = lambda c: F.least(F.size(hits(text, AUDIT_A[c])), F.lit(AUDIT_ITEMS)) if cuts else F.size(hits(text, AUDIT_A[c]))
    pairs = F.array(*[F.struct(F.lit(c).alias("category"), F.size(c).alias("extracted"), manual(c).alias("manual")) for c in cats])
    return sample.select("id", F.explode(pairs).alias("p")).select("id", "p.*").withColumn("match", F.abs(F.col("extracted") - F.col("manual")) <= 2)


def audit_low(sample: DataFrame, cuts: bool = False) -> DataFrame:
    """Per article and category: different matches of a wide catalogue beyond those extracted."""
    text = head(F.col("text"), "missed_low", cuts)
    wide = lambda c: F.size(F.array_distinct(F.flatten(F.array(*[hits(text, [p]) for p in AUDIT_B[c]]))))
    pairs = F.array(*[F.struct(F.lit(c).alias("category"), F.size(c).alias("extracted"), wide(c).alias("found")) for c in AUDIT_B])
    r = sample.select("id", F.explode(pairs).alias("p")).select("id", "p.*")
    return r.withColumn("missed", F.greatest(F.col("found") - F.col("extracted"), F.lit(0)))


def audit_low_summary(sample: DataFrame, cuts: bool = False) -> DataFrame:
    """One row: articles, those of research among them, those with anything missed, completeness in percent and its grade."""
    per = audit_low(sample, cuts).groupBy("id").agg((F.max("missed") > 0).alias("missed"))
    j = sample.select("id", is_research().alias("research")).join(per, "id")
    n, m = F.count(F.lit(1)), F.count_if("missed")
    pct = F.coalesce(F.round(100.0 * F.try_divide(n - m, n), 6), F.lit(0.0))
    r = j.agg(n.alias("articles"), F.count_if("research").alias("research"), m.alias("missed"), F.count_if(F.col("research") & F.col("missed")).alias("missed_research"), pct.alias("completeness"))
    return r.withColumn("grade", grade(F.col("completeness"), "low"))


def audit_medium(sample: DataFrame, cuts: bool = False) -> DataFrame:
    """Per article: are the extracted strings there, and does a quick search find half as many again?"""
    text, quick = head(F.col("text"), "presence", cuts), head(F.col("text"), "missed_medium", cuts)
    found, total, missed = F.lit(0), F.lit(0), F.lit(0)
    for c in _FIVE:
        found, total = found + present(F.col(c), text, cuts), total + checked(F.col(c), cuts)
        missed = missed + F.when(F.size(distinct_hits(quick, AUDIT_C[c])) > F.size(c) * 1.5, 1).otherwise(0)
    r = sample.select("id", "rigor_score", found.alias("_found"), total.alias("_total"), missed.cast("int").alias("missed"))
    ok = F.col("_found") == F.col("_total")
    status = F.when(ok & (F.col("missed") == 0), "PERFECT").when(ok, "GOOD").when(F.col("missed") == 0, "PARTIAL").otherwise("NEEDS REVIEW")
    accuracy = F.coalesce(F.round(100.0 * F.try_divide("_found", "_total"), 6), F.lit(100.0))
    return r.select("id", "rigor_score", ok.alias("verified"), "missed", status.alias("status"), accuracy.alias("accuracy"))


def audit_medium_summary(r: DataFrame) -> DataFrame:
    """One row: articles, how many of each status, the mean accuracy and its grade."""
    kinds = {"perfect": "PERFECT", "good": "GOOD", "partial": "PARTIAL", "needs_review": "NEEDS REVIEW"}
    one = r.agg(F.count(F.lit(1)).alias("articles"), *[F.count_if(F.col("status") == v).alias(k) for k, v in kinds.items()], F.coalesce(F.round(F.avg("accuracy"), 6), F.lit(0.0)).alias("accuracy"))
    return one.withColumn("grade", grade(F.col("accuracy"), "medium"))


def audit_summary(r: DataFrame, kind: str = "high") -> DataFrame:
    """Accuracy over the sample (ratio of sums) and its grade."""
    pct = F.coalesce(F.round(100.0 * F.try_divide(F.sum("found"), F.sum("checked")), 6), F.lit(0.0))
    return r.agg(F.count(F.lit(1)).alias("articles"), F.sum("found").alias("found"), F.sum("checked").alias("checked"), pct.alias("accuracy")).withColumn("grade", grade(F.col("accuracy"), kind))

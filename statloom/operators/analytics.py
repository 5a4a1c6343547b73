"""Analytics of rigor scores. Each is one aggregation with map-side partial results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statloom.functions.patterns import CATEGORIES

#: Buckets as (label, lowest, highest score).
BUCKETS = {
    "code": (("0", 0, 0), ("1-25", 1, 25), ("26-50", 26, 50), ("51-75", 51, 75), ("76-99", 76, 99), ("100", 100, 100)),
    "documented": (("0", 0, 0), ("1-30", 1, 30), ("31-50", 31, 50), ("51-70", 51, 70), ("71-100", 71, 100)),
}
YEARS = (1900, 2025)


def percent(part: Column, whole: Column, digits: int = 6) -> Column:
    """part of whole in percent, 0 where there is nothing."""
    return F.coalesce(F.round(100.0 * part / F.when(whole != 0, whole), digits), F.lit(0.0))


def score_totals(x: DataFrame) -> DataFrame:
    n, w = F.count(F.lit(1)), F.count_if(F.col("rigor_score") > 0)
    return x.agg(n.alias("articles"), w.alias("with_stats"), (n - w).alias("without_stats"), percent(w, n).alias("with_pct"))


def score_moments(x: DataFrame) -> DataFrame:
    s = F.col("rigor_score")
    return x.agg(F.round(F.avg(s), 6).alias("mean"), F.median(s).alias("median"), F.round(F.stddev_pop(s), 6).alias("std"), F.min(s).alias("min"), F.max(s).alias("max"))


def score_percentiles(x: DataFrame, ps: Sequence[int] = (10, 25, 50, 75, 90, 95, 99)) -> DataFrame:
    """Exact percentiles, linear between ranks, from counts by value: scores have few values, so what is gathered is small."""
    counts = x.groupBy("rigor_score").count()
    q = F.percentile("rigor_score", F.array(*[F.lit(p / 100) for p in ps]), F.col("count"))
    return counts.agg(q.alias("q")).select(F.posexplode("q")).select(F.element_at(F.array(*[F.lit(p) for p in ps]), F.col("pos") + 1).alias("percentile"), F.col("col").alias("score"))


def score_by_year(x: DataFrame, last: int = 10) -> DataFrame:
    """Mean and number by year, of the last years that occur."""
    per = x.where(F.col("pub_year").between(*YEARS)).groupBy("pub_year").agg(F.round(F.avg("rigor_score"), 6).alias("mean_score"), F.count(F.lit(1)).alias("articles"))
    return per.orderBy(F.desc("pub_year")).limit(last)


def top_journals(x: DataFrame, least: int = 1000, top: int = 10) -> DataFrame:
    """Journals of at least `least` articles with the highest mean; ties by name. The limit is the feature."""
    per = x.where(F.col("journal").isNotNull() & (F.col("journal") != "")).groupBy("journal").agg(F.round(F.avg("rigor_score"), 6).alias("mean_score"), F.count(F.lit(1)).alias("articles"))
    return per.where(F.col("articles") >= least).orderBy(F.desc("mean_score"), "journal").limit(top)


def category_coverage(flags: DataFrame) -> DataFrame:
    """Articles in which each category occurs (a boolean column each), and their share."""
    one = flags.agg(F.count(F.lit(1)).alias("n"), *[F.count_if(c).alias(c) for c in CATEGORIES])
    return one.unpivot(["n"], list(CATEGORIES), "category", "articles").select("category", "articles", percent(F.col("articles"), F.col("n")).alias("pct"))


def score_histogram(x: DataFrame) -> DataFrame:
    return x.groupBy("rigor_score").agg(F.count(F.lit(1)).alias("articles"))


def score_buckets(x: DataFrame, profile: str = "code") -> DataFrame:
    """Articles per bucket, with the running number; empty buckets are shown with 0. One aggregation to one row, which is
    then turned into the buckets' rows."""
    buckets = BUCKETS[profile]
    s = F.col("rigor_score")
    one = x.agg(*[F.count_if(s.between(lo, hi)).alias(f"b{i}") for i, (_, lo, hi) in enumerate(buckets)])
    n = [F.col(f"b{i}") for i in range(len(buckets))]
    total = sum(n[1:], n[0])
    rows = F.array(*[F.struct(F.lit(i).alias("pos"), F.lit(b[0]).alias("bucket"), n[i].alias("articles"), sum(n[1 : i + 1], n[0]).alias("upto"), total.alias("total")) for i, b in enumerate(buckets)])
    r = one.select(F.explode(rows).alias("r")).select("r.*")
    return r.select("pos", "bucket", "articles", percent(F.col("articles"), F.col("total")).alias("pct"), percent(F.col("upto"), F.col("total")).alias("cumulative_pct"))

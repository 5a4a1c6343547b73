"""Progress of runs: status counts, completion, throughput; choice of instances and workers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statloom.runtime import strip


def status_word(c: str = "status") -> Column:
    return F.lower(strip(F.col(c)))


def status_counts(log: DataFrame) -> DataFrame:
    return log.groupBy(status_word().alias("status")).agg(F.count(F.lit(1)).alias("rows"))


def extraction_counts(log: DataFrame) -> DataFrame:
    """Findings by kind over rows without an error."""
    ok = log.where("error_message is null")
    kinds = ["confidence_intervals", "p_values", "sample_sizes", "effect_sizes"]
    return ok.agg(*[F.coalesce(F.sum(k), F.lit(0)).alias(k) for k in kinds], F.count(F.lit(1)).alias("rows"))


def quality_averages(summary: DataFrame) -> DataFrame:
    return summary.agg(*[F.round(F.avg(c), 6).alias(f"avg_{c}") for c in ("confidence_intervals", "p_values", "sample_sizes")])


def percent_complete(articles: DataFrame, done: DataFrame, key: str = "pmc_id") -> DataFrame:
    """Two decimals; 0 without articles. Done counts different keys."""
    a = articles.agg(F.count(F.lit(1)).alias("total"))
    d = done.where(F.col(key).isNotNull()).agg(F.count_distinct(key).alias("processed"))
    return a.crossJoin(F.broadcast(d)).withColumn("pct", F.coalesce(F.round(100.0 * F.try_divide("processed", "total"), 2), F.lit(0.0)))  # one row each


def processing_stats(articles: DataFrame, done: DataFrame) -> DataFrame:
    marked = F.count_if(F.coalesce(F.contains("body", F.lit("Table")) | F.contains("body", F.lit("Figure")), F.lit(False)))
    a = articles.agg(F.count(F.lit(1)).alias("total"), marked.alias("with_tables_figures"))
    d = done.where("pmc_id is not null").agg(F.count_distinct("pmc_id").alias("processed"))
    j = a.crossJoin(F.broadcast(d))  # one row each
    return j.withColumns({"remaining": F.col("total") - F.col("processed"), "pct": F.coalesce(F.round(100.0 * F.try_divide("processed", "total"), 6), F.lit(0.0))})


def eta(batches: DataFrame, total: int, batch_size: int, last: int = 1000) -> DataFrame:
    """After each batch (run, seq, seconds): mean seconds of the last thousand batches of its run, rows done and seconds
    still to go."""
    w = Window.partitionBy("run").orderBy("seq")
    mean = F.avg("seconds").over(w.rowsBetween(-(last - 1), 0))
    done = F.row_number().over(w) * batch_size
    left = F.greatest(F.lit(total) - done, F.lit(0))
    return batches.select("run", "seq", F.round(mean, 9).alias("mean_seconds"), done.cast("long").alias("done"), F.round(F.ceil(left / batch_size) * mean, 7).alias("eta_seconds"))


def health_score() -> Column:
    """1, less 0.1 an error (0.5 at most) and 0.2 a running request; never below 0."""
    return F.greatest(F.lit(0.0), 1.0 - F.least(0.1 * F.col("errors"), F.lit(0.5)) - 0.2 * F.col("load"))


def worker_score() -> Column:
    """Free processor and memory, three tenths each, and rate, four tenths; unknown: 50, 50 and 1."""
    c = lambda n, d: F.coalesce(F.col(n), F.lit(float(d)))
    return 0.3 * (100 - c("cpu_percent", 50)) + 0.3 * (100 - c("memory_percent", 50)) + 0.4 * c("articles_per_minute", 1)


def best(df: DataFrame, score: Column, key: str) -> DataFrame:
    """The row of the highest score; ties by key."""
    return df.withColumn("score", F.round(score, 6)).orderBy(F.desc("score"), key).limit(1)


def fleet(calls: DataFrame, instance: str = "instance") -> DataFrame:
    """Per instance: calls, errors, mean seconds."""
    return calls.groupBy(instance).agg(F.count(F.lit(1)).alias("processed"), F.count_if("failed").alias("errors"), F.round(F.avg("seconds"), 6).alias("mean_seconds"))


def fleet_status(instances: DataFrame) -> DataFrame:
    """One row: calls processed, errors, instances, and how many of them are available (fewer errors than calls lately, or as
    is_available says where there is such a column)."""
    up = F.col("is_available") if "is_available" in instances.columns else F.col("errors") < F.col("processed")
    return instances.agg(F.coalesce(F.sum("processed"), F.lit(0)).alias("processed"), F.coalesce(F.sum("errors"), F.lit(0)).alias("errors"), F.count(F.lit(1)).alias("instances"), F.count_if(F.coalesce(up, F.lit(False))).alias("available"))


def all_processed(*logs: DataFrame, key: str = "pmc_id") -> DataFrame:
    """Different keys that any of several logs has."""
    out = logs[0].select(key)
    for log in logs[1:]:
        out = out.unionByName(log.select(key))
    return out.where(F.col(key).isNotNull()).distinct()


def log_rows(ids: DataFrame, batch_id: str, status: str, at: Column | None = None, key: str = "pmc_id") -> DataFrame:
    """Rows that mark ids as processed or failed, for appending to the log: pmc_id, processed_at, batch_id, status."""
    return ids.select(F.col(key).alias("pmc_id"), (F.current_timestamp() if at is None else at).alias("processed_at"), F.lit(batch_id).alias("batch_id"), F.lit(status).alias("status"))

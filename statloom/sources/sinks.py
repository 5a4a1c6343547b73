"""Writers: parts are written by the tasks that hold the rows; nothing passes through the driver."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_extraction(df: DataFrame, path: str, run_id: str, compression: str = "gzip") -> None:
    """Result and error lines as JSON, one folder per run."""
    df.withColumn("run_id", F.lit(run_id)).write.mode("append").partitionBy("run_id").option("compression", compression).json(path)


def write_summary(df: DataFrame, path: str) -> None:
    """A few rows (a run's configuration, a summary, a report) as one JSON file."""
    df.coalesce(1).write.mode("overwrite").json(path)


def append_by_day(df: DataFrame, path: str, day: Column | None = None) -> None:
    """Appends rows below a folder per day; day defaults to the current date."""
    df.withColumn("merge_date", F.current_date() if day is None else day).write.mode("append").partitionBy("merge_date").json(path)


def upsert(target: DataFrame, source: DataFrame, keys: list[str], update: list[str] | None = None) -> DataFrame:
    """The target after an upsert: rows of new keys are added; of known keys, the columns in update (default: all) take
    the source's value. Both must be unique by key; keys compare null-safe. One shuffle join, no row is collected."""
    cols = target.columns
    update = [c for c in cols if c not in keys] if update is None else update
    t, s = target.withColumn("_t", F.lit(True)).alias("t"), source.select(*cols).withColumn("_s", F.lit(True)).alias("s")
    on = F.lit(True)
    for k in keys:
        on = on & F.col(f"t.{k}").eqNullSafe(F.col(f"s.{k}"))
    j = t.join(s, on, "full_outer")
    known, new = F.col("_t").isNotNull(), F.col("_s").isNotNull()
    pick = lambda c: F.when(~known | new if c in update or c in keys else ~known, F.when(~known | (new & F.lit(c in update)), F.col(f"s.{c}")).otherwise(F.col(f"t.{c}"))).otherwise(F.col(f"t.{c}"))
    return j.select(*[pick(c).alias(c) for c in cols])


def foreach_batch_upsert(path: str, keys: list[str], update: list[str] | None = None, order: Sequence[str] = ()):
    """A foreachBatch function that keeps a table of versions below path: of several rows of a key in a batch the last by the
    columns in order (null first), then by the others, counts. Each batch writes the next version whole and then makes it valid in one step that
    also names the batch, so that a batch that is run again changes nothing."""
    from statloom.operators.incremental import StateStore
    from statloom.sources.readers import latest_by

    def run(batch: DataFrame, batch_id: int) -> None:
        store = StateStore(batch.sparkSession, path)
        n, entry = store.head()
        if entry is not None and batch_id <= entry.get("batch", -1):
            return
        latest = latest_by(batch, keys, order)
        if store.publish(latest if entry is None else upsert(store.read(entry), latest, keys, update), n, batch=batch_id) is None:
            raise RuntimeError(f"another stream writes to {path}")

    return run

"""Structured Streaming forms: the same column functions over a file source, with checkpoints, watermarks and sessions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from statloom.operators.extract import extract
from statloom.sources.readers import articles


def article_stream(spark: SparkSession, path: str, schema: StructType, files_per_trigger: int = 64) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def extraction_stream(stream: DataFrame, delay: str | None = None, time: str = "created_at") -> DataFrame:
    """Extraction of new articles; with a delay, an id that comes again within it is dropped."""
    s = articles(stream)
    if delay:
        s = s.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, delay).dropDuplicatesWithinWatermark(["id"])
    return extract(s)


def run_available(df: DataFrame, out: str, checkpoint: str, fmt: str = "parquet") -> StreamingQuery:
    """Processes what has come since the last run and ends; a run after a failure goes on where the last one was committed."""
    return df.writeStream.format(fmt).option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).outputMode("append").start()


def rates(events: DataFrame, ts: str = "ts", width: str = "1 minute", delay: str = "10 minutes") -> DataFrame:
    """Events and mean value by tumbling window and type. Late events within the delay count."""
    e = events.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)
    g = e.groupBy(F.window(ts, width), "event_type").agg(F.count(F.lit(1)).alias("events"), F.sum("value").alias("value"))
    return g.select(F.col("window.start").alias("start"), "event_type", "events", "value")


def heartbeat_sessions(events: DataFrame, ts: str = "ts", key: str = "user_id", gap: str = "60 seconds", delay: str = "10 minutes") -> DataFrame:
    """Spans in which a worker was heard at least once every gap."""
    e = events.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)
    g = e.groupBy(F.session_window(ts, gap), key).agg(F.count(F.lit(1)).alias("beats"))
    return g.select(key, F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), "beats")

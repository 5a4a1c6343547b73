"""Readers: every source is a DataFrame whose filters and columns reach the scan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statloom.functions.patterns import CATEGORIES

METADATA = ("pmc_id", "pmid", "doi", "title", "journal", "pub_year")

#: One extraction line: a result or an error, never both.
EXTRACTION = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("stats", T.StructType([*[T.StructField(c, T.ArrayType(T.StringType())) for c in CATEGORIES], T.StructField("rigor_score", T.IntegerType()), T.StructField("extraction_error", T.StringType())])),
        T.StructField("metadata", T.StructType([T.StructField(c, T.IntegerType() if c == "pub_year" else T.StringType()) for c in METADATA])),
        T.StructField("timestamp", T.StringType()),
        T.StructField("error", T.StringType()),
        T.StructField("traceback", T.StringType()),
    ]
)


def articles(raw: DataFrame, text: Column | None = None) -> DataFrame:
    """Articles with a text: full_text, or the body where there is none. Rows without either are left out, in no order
    (a sort would only serve paging)."""
    text = F.coalesce("full_text", "body") if text is None else text
    return raw.withColumn("text", text).where(F.col("text").isNotNull())


def jdbc(spark: SparkSession, dbtable: str, column: str, low: int, high: int, parts: int) -> DataFrame:
    """A relational table, read in parallel ranges of a numeric column. Connection options come from the Spark settings
    spark.statloom.jdbc.url, .user, .password and .driver; none is kept in code."""
    r = spark.read.format("jdbc").option("dbtable", dbtable).options(partitionColumn=column, lowerBound=low, upperBound=high, numPartitions=parts, fetchsize=10_000)
    for k in ("url", "user", "password", "driver"):
        v = spark.conf.get(f"spark.statloom.jdbc.{k}", None)
        r = r.option(k, v) if v else r
    return r.load()


def extraction_lines(spark: SparkSession, path: str) -> DataFrame:
    """A folder of .jsonl or .jsonl.gz extraction files; malformed lines are dropped, error lines are kept."""
    return spark.read.schema(EXTRACTION).option("mode", "DROPMALFORMED").json(path)


def extraction_from_lines(df: DataFrame, line: str) -> DataFrame:
    """The same of lines held in a text column; a line that is no JSON object gives no row."""
    parsed = df.withColumn("r", F.from_json(line, EXTRACTION, {"mode": "PERMISSIVE"}))
    return parsed.where(F.try_parse_json(line).isNotNull() & (F.schema_of_variant(F.try_parse_json(line)).startswith("OBJECT"))).select(*df.columns, "r.*")


def results_only(extraction: DataFrame) -> DataFrame:
    return extraction.where(F.col("error").isNull() & F.col("stats").isNotNull())


def model_results(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A folder of .json (one object or a list) and .jsonl results, with the file each row came from."""
    src = lambda r, glob: r.schema(schema).option("pathGlobFilter", glob).json(path).withColumn("file", F.input_file_name())
    return src(spark.read.option("multiLine", True), "*.json").unionByName(src(spark.read, "*.jsonl"))


def latest_per_key(df: DataFrame, key: str, *order: str) -> DataFrame:
    """The last row of every key by the given columns (null comes first), e.g. a later file over an earlier one."""
    return latest_by(df, [key], order)


def latest_by(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of every combination of keys. A maximum, not a window: partial aggregation keeps a key with a third of all
    rows small."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    m = df.groupBy(*keys).agg(F.max(F.struct(*order, *rest)).alias("_m"))
    return m.select(*keys, *[F.col(f"_m.{c}").alias(c) for c in (*order, *rest)]).select(*df.columns)


def inventory(spark: SparkSession, path: str, glob: str = "*.jsonl*") -> DataFrame:
    """Files and bytes of the newest run's folder below path; only names and sizes are read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(path).select("path", "length", F.regexp_extract("path", r"^(.*)/[^/]*$", 1).alias("folder"))
    per = files.groupBy("folder").agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))
    return per.orderBy(F.desc("folder")).limit(1)


def schema_rows(df: DataFrame) -> DataFrame:
    """Column name, type, nullability and position of a table."""
    rows = [(i + 1, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "position int, column_name string, data_type string, nullable boolean")

"""Session, table and shared-storage helpers used by every operator."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Java flags that give the meaning of \s \d \w and of letter case in Unicode.
UNI = "(?U)"
#: All characters of white space in Unicode.
WHITE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000" + "".join(map(chr, range(0x2000, 0x200B)))


def _half_memory(most_gb: int) -> str:
    """Half of the machine's memory, at most so many GB: the other half is for Python workers."""
    have = os.sysconf("SC_PAGE_SIZE") * os.sysconf("SC_PHYS_PAGES") / 2**30
    return f"{max(1, min(most_gb, int(have / 2)))}g"


def local_session(app: str = "statloom", cpus: int = 8, **conf: str) -> SparkSession:
    """A local session with the settings the tests and the bench use."""
    b = (
        SparkSession.builder.appName(app)
        .master(f"local[{cpus}]")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", conf.pop("driver_memory", None) or _half_memory(12))
    )
    for k, v in conf.items():
        b = b.config(k, v)
    return b.getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Bytes of a table that spread() may move, whatever the cluster's size.
SPREAD_BYTES = 256 << 20


def spread(df: DataFrame) -> DataFrame:
    """df over all cores, where it is small (by the planner's estimate) and its files make far fewer splits than there are
    cores (a few small or unsplittable files); otherwise df as it is. For work that costs more than moving the rows. A table
    beyond SPREAD_BYTES is never moved: its splits are set by spark.sql.files.maxPartitionBytes."""
    try:
        plan = df._jdf.queryExecution()
    except AttributeError:  # a remote session doesn't show its plans
        return df
    if int(str(plan.optimizedPlan().stats().sizeInBytes())) > SPREAD_BYTES:
        return df
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if plan.toRdd().getNumPartitions() * 2 <= cores else df


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as the session names it. Where it names none, a local one for a local session, which
    goes with the process; on a cluster that is an error, as every machine would write to a folder of its own."""
    set_dir = spark.conf.get("spark.checkpoint.dir", None)
    if set_dir:
        return set_dir.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    if not hasattr(shared_dir, "local"):
        folder = tempfile.mkdtemp(prefix="statloom-")
        atexit.register(shutil.rmtree, folder, True)
        shared_dir.local = "file://" + folder
    return shared_dir.local


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark)}/statloom/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows of df, written to the shared folder and read again: cuts the lineage and survives lost executors."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clear_scratch(spark: SparkSession) -> None:
    """Deletes what written() and the state of finished queries left in the shared folder; call it when their results
    have been stored."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/statloom")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def once(df: DataFrame, **exprs: Column) -> DataFrame:
    """df with further columns, in place of those of the same names, that are computed once a row, however often they are used:
    they come out of a generator, through which neither filters nor projections are copied down."""
    rows = F.explode(F.array(F.struct(*[c.alias(n) for n, c in exprs.items()]))).alias("__once")
    return df.select("*", rows).select(*[c for c in df.columns if c.lower() not in exprs], *[F.col(f"__once.{n}").alias(n) for n in exprs])


def blank(c: Column) -> Column:
    """True where the text is null or holds nothing but white space."""
    return c.isNull() | ~c.rlike(UNI + r"[^\s\p{Z}]")


def squeeze(c: Column) -> Column:
    """The text without any white space."""
    return F.regexp_replace(c, UNI + r"[\s\p{Z}]+", "")


def strip(c: Column) -> Column:
    """The text without outer white space."""
    return F.btrim(c, F.lit(WHITE))


def env_dir() -> str:
    return os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")

"""Processing only new or changed records.

The state of a consumer is a versioned table (key, content_hash, retry). A run freezes the hashes of the current rows,
joins them with the state of the last successful run and gets what is new or changed. When it has ended, the frozen
hashes of what it did, and nothing read later, become part of the state: a record that changes while the run is at work
comes again. A new state becomes valid by one exclusive creation of the next entry of a log, so a run that breaks off at
any point leaves the old state in force, and of two runs that end at a time the second one builds on the first one's state.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from statloom.runtime import blank, squeeze, strip, written


class StateStore:
    """Versions of a state table below one path in shared storage. The entries of its log are numbered from 0; the last one
    names the valid version. An entry is written aside and renamed to its number without overwriting, which the file
    system does for one writer alone. Versions before the last `keep` are removed."""

    def __init__(self, spark: SparkSession, path: str, keep: int = 3):
        self.spark, self.path, self.keep = spark, path.rstrip("/"), keep
        jvm = spark._jvm
        self._p = lambda s: jvm.org.apache.hadoop.fs.Path(s)
        self._conf = spark._jsc.hadoopConfiguration()
        self._fs = self._p(self.path).getFileSystem(self._conf)

    def _last(self) -> int:
        log = self._p(f"{self.path}/log")
        names = [f.getPath().getName() for f in self._fs.listStatus(log)] if self._fs.exists(log) else []
        return max((int(n) for n in names if n.isdigit()), default=-1)

    def _entry(self, n: int) -> dict:
        stream = self._fs.open(self._p(f"{self.path}/log/{n:010d}"))
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def head(self) -> tuple[int, dict | None]:
        """Number and content of the log's last entry; -1 and None before the first."""
        n = self._last()
        return n, None if n < 0 else self._entry(n)

    def version(self) -> str | None:
        entry = self.head()[1]
        return entry and entry["version"]

    def read(self, entry: dict | None = None) -> DataFrame | None:
        entry = entry or self.head()[1]
        return None if entry is None else self.spark.read.parquet(f"{self.path}/{entry['version']}")

    def publish(self, state: DataFrame, after: int | None = None, **note) -> str | None:
        """Write a complete new version, then make it the valid one in a single step. after: the entry that the state was
        made from; where another one has been added since, nothing is published and None returned. note goes into the entry."""
        after = self._last() if after is None else after
        new = f"v-{uuid.uuid4().hex}"
        state.write.parquet(f"{self.path}/{new}")
        if not self._add(after + 1, {"version": new, **note}):
            self._fs.delete(self._p(f"{self.path}/{new}"), True)
            return None
        gone = after + 1 - self.keep
        if gone >= 0 and self._fs.exists(self._p(f"{self.path}/log/{gone:010d}")):
            self._fs.delete(self._p(f"{self.path}/{self._entry(gone)['version']}"), True)
            self._fs.delete(self._p(f"{self.path}/log/{gone:010d}"), False)
        return new

    def _add(self, n: int, entry: dict) -> bool:
        jvm = self.spark._jvm
        temp = self._p(f"{self.path}/log/.{n}-{entry['version']}")
        out = self._fs.create(temp, True)
        out.write(bytearray(json.dumps(entry).encode()))
        out.close()
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), self._conf)
        options = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        options[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
        try:
            context.rename(temp, self._p(f"{self.path}/log/{n:010d}"), options)
            return True
        except Exception as e:
            self._fs.delete(temp, False)
            if "FileAlreadyExists" in str(e) or "already exists" in str(e):
                return False
            raise


def content_hash(*cols: str | Column) -> Column:
    """Hash of a row's content; a null differs from an empty text."""
    cs = [F.col(c) if isinstance(c, str) else c for c in cols]
    return F.xxhash64(*[x for c in cs for x in (c.isNull(), c.cast("string"))])


def row_versions(rows: DataFrame, key: str, content: Sequence[str], times: Sequence[str] = ()) -> DataFrame:
    """(key, row_hash, changed) of every different row: one delivered again is no other. Null and empty keys are left out;
    null times are passed over."""
    changed = F.greatest(*[F.col(t) for t in times]) if len(times) > 1 else F.col(times[0]) if times else F.lit(None).cast("timestamp")
    r = rows.where(F.col(key).isNotNull() & (F.col(key) != ""))
    return r.groupBy(F.col(key).alias("key"), content_hash(*content).alias("row_hash")).agg(F.max(changed).alias("changed"))


def _set_hash(picked: Column | None = None) -> Column:
    """Hash of a set of different rows, in no order; null of an empty one."""
    h = F.col("row_hash").cast("decimal(38,0)")
    return F.sum(h if picked is None else F.when(picked, h)).cast("string")


def current_rows(rows: DataFrame, key: str, content: Sequence[str], times: Sequence[str] = ()) -> DataFrame:
    """One row per key: (key, content_hash, changed). Partial aggregation keeps a key with a third of all rows small."""
    return keyed_hashes(row_versions(rows, key, content, times))


def keyed_hashes(versions: DataFrame) -> DataFrame:
    return versions.groupBy("key").agg(_set_hash().alias("content_hash"), F.max("changed").alias("changed"))


def changed_keys(current: DataFrame, state: DataFrame | None) -> DataFrame:
    """Rows of current that are new or whose hash differs from the state's; also those the state marks for another try.

    current: key, content_hash; state: key, content_hash (null: processed, but not in its present form), retry
    boolean. Both unique by key; extra columns of current stay. With no state every row is returned.
    """
    if state is None:
        return current
    s = state.select(F.col("key").alias("_k"), F.col("content_hash").alias("_seen"), F.coalesce("retry", F.lit(False)).alias("_retry"))
    return (
        current.join(s, F.col("key") == F.col("_k"), "left")
        .where(F.col("_k").isNull() | F.col("_retry") | ~F.col("content_hash").eqNullSafe(F.col("_seen")))
        .drop("_k", "_seen", "_retry")
    )


@dataclass
class Run:
    """One run of a consumer: the hashes it saw, frozen, and of these what is due."""

    store: StateStore
    current: DataFrame
    due: DataFrame

    def commit(self, done: DataFrame, failed: DataFrame | None = None) -> str:
        """Publish the next state: keys of done have the hash that this run saw, keys of failed are marked for another try, all
        others keep what the state says that is valid now, which another run may have published since this one began."""
        return commit(self.store, self.current, done, failed)


def begin(store: StateStore, current: DataFrame) -> Run:
    """current: (key, content_hash, ...); written to the shared folder, so that neither retries nor the commit see rows that
    came later."""
    frozen = written(current, "run-hashes")
    return Run(store, frozen, changed_keys(frozen, store.read()))


def commit(store: StateStore, current: DataFrame, done: DataFrame, failed: DataFrame | None = None) -> str:
    """See Run.commit. current must be frozen. Nothing is valid before the last step; keys of done come before those of
    failed. Tried again until no other run has published in between."""
    done_keys = done.select("key").distinct()
    new = current.join(done_keys, "key", "left_semi").select("key", "content_hash", F.lit(False).alias("retry"))
    if failed is not None:
        bad = failed.select("key").distinct()
        new = new.unionByName(current.join(bad, "key", "left_semi").join(done_keys, "key", "left_anti").select("key", "content_hash", F.lit(True).alias("retry")))
    new = written(new, "run-keys")
    while True:
        n, entry = store.head()
        old = store.read(entry) if entry else None
        state = new if old is None else new.unionByName(old.select("key", "content_hash", "retry").join(new.select("key"), "key", "left_anti"))
        if version := store.publish(state, n):
            return version


def spelled(c: Column) -> Column:
    """pmc_id in one spelling: no blanks, upper case."""
    return F.upper(squeeze(c))


def article_versions(articles: DataFrame) -> DataFrame:
    """Different versions of the rows that have a non-blank body, by pmc_id in one spelling. A row's times are part of its
    content: one that was changed at its source, or came again later, is another version."""
    a = articles.where(~blank(F.col("body"))).withColumn("pmc_id", spelled(F.col("pmc_id")))
    times = ["created_at", "updated_at"]
    return row_versions(a, "pmc_id", ["title", "abstract", "body", "full_text", *times], times)


def state_from_logs(versions: DataFrame, processing: DataFrame, status: DataFrame) -> DataFrame:
    """The state that the logs of earlier runs amount to: a key that was completed has the hash of the row versions that were
    there by then (null if there were none); one that failed at or after that is marked for another try. Null times and
    other statuses count for nothing; a key never completed has no state."""
    word = F.lower(strip(F.col("status")))
    key = spelled(F.col("pmc_id"))
    done = processing.where(word == "completed").groupBy(key.alias("key")).agg(F.max("processed_at").alias("done_at"))
    fail = status.where(word == "failed").groupBy(key.alias("key")).agg(F.max("processed_at").alias("failed_at"))
    done = done.where(F.col("done_at").isNotNull() & F.col("key").isNotNull()).join(fail, "key", "left")
    seen = F.coalesce(F.col("changed") <= F.col("done_at"), F.lit(True))  # a row without any time was there all along
    at_done = versions.join(done, "key").groupBy("key").agg(_set_hash(seen).alias("content_hash"), F.first("done_at").alias("done_at"), F.first("failed_at").alias("failed_at"))
    return at_done.select("key", "content_hash", F.coalesce(F.col("failed_at") >= F.col("done_at"), F.lit(False)).alias("retry"))


def due_run(spark: SparkSession, articles: DataFrame, processing: DataFrame, status: DataFrame, path: str) -> tuple[Run, DataFrame]:
    """A run over what the logs leave to do, and the row versions it saw: the logs' state is published at path and the
    articles' current hashes are held against it. Texts are read once."""
    versions = written(article_versions(articles), "article-versions")
    store = StateStore(spark, path)
    store.publish(state_from_logs(versions, processing, status))
    return begin(store, keyed_hashes(versions)), versions


def due_articles(spark: SparkSession, articles: DataFrame, processing: DataFrame, status: DataFrame, path: str) -> DataFrame:
    """pmc_id of the articles that need processing."""
    return due_run(spark, articles, processing, status, path)[0].due.select(F.col("key").alias("pmc_id"))

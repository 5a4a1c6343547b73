import json

import pytest
from pyspark.sql import functions as F

from statloom.operators import incremental as inc
from statloom.operators import nested as n
from statloom.runtime import scratch
from tests.helpers import rows


def stats(o):
    return sorted(x[:3] for x in n.stats_items(json.dumps(o) if not isinstance(o, str) else o))


def test_stats_shapes():
    assert stats({"id": 1, "stats": {"p_values": ["a", None, {"match": "b"}], "corrections": "lone", "rigor_score": 5}}) == [(-1, "corrections", 0), (-1, "p_values", 0), (-1, "p_values", 2)]
    assert stats({"run": {"result": {"stats": {"sections": [None, {"sample_sizes": ["n = 1"]}]}}}}) == [(1, "sample_sizes", 0)]
    assert stats({"stats": json.dumps({"p_values": ["x"]})}) == [(-1, "p_values", 0)]
    for none in ("", "[]", "null", '{"stats": {"p_values": ["a"', '{"stats": null}', '{"error": "x"}', '{"stats": {"p_values": ["a"]}} tail', '{"stats": NaN}'):
        assert stats(none) == []
    assert list(n.stats_items(None)) == []


def test_findings_shapes():
    f = lambda t: sorted(x[:3] for x in n.finding_items(t))
    assert f('text {"findings": [null, {"value": 1}]} tail') == [(-1, "finding", 1)]
    assert f('```json\n{"articles": [null, {"findings": null}, {"findings": [{}]}]}\n```') == [(2, "finding", 0)]
    assert f("ERROR") == f('{"findings": [') == f(None) == f("") == []


def test_interval_shapes():
    f = lambda o: sorted((x[0], x[2]) for x in n.interval_items(json.dumps(o)))
    assert f([{"lower": 1, "upper": 2}, None, [1, 2, 95], {"value": ["1", 2]}, {"type": "x", "value": {"lower": "1", "upper": "2"}}]) == [(-1, 0), (-1, 2), (-1, 3), (-1, 4)]
    assert f([{"table": "T1", "intervals": [{"lower": 1, "upper": 2}, None, [3, 4]]}, {"table": "T2"}]) == [(0, 0), (0, 2)]
    assert f([0.5, 1.5]) == f({"lower": 0, "upper": 1}) == [(-1, 0)]
    assert f([]) == f(None) == f("text") == []


def test_typed_tables(spark):
    items = [{"value": {"lower": "1.5", "upper": 2, "level": 95}}, {"value": {"value": {"value": 0.04}, "op": "<"}}, {"value": "0.5"}, {"value": {"type": "r", "value": 1}}, {"value": None}, 7]
    df = spark.createDataFrame([(1, json.dumps({"findings": items}), "x")], "response_id long, payload string, kind string")
    got = n.flatten(df, "response_id", "payload", n.finding_items)
    assert rows(n.variant_table(got, "intervals")) == [(1, -1, "finding", 0, 1.5, 2.0, 95.0)]
    assert rows(n.variant_table(got, "numbers").select("item_pos", "number")) == [(1, 0.04), (2, 0.5), (3, 1.0), (5, 7.0)]
    assert n.variant_table(got, "others").count() == 1
    assert n.flatten(df.limit(0), "response_id", "payload", n.finding_items).count() == 0


ARTICLES = "id long, pmc_id string, title string, abstract string, body string, full_text string, created_at timestamp_ntz, updated_at timestamp_ntz"


def arts(spark, data):
    df = spark.createDataFrame([(i, k, b, c, u) for i, k, b, c, u in data], "id long, pmc_id string, body string, c string, u string")
    cast = lambda c: F.col(c).cast("timestamp_ntz")
    null = lambda: F.lit(None).cast("string")
    return df.select("id", "pmc_id", null().alias("title"), null().alias("abstract"), "body", null().alias("full_text"), cast("c").alias("created_at"), cast("u").alias("updated_at"))


def log(spark, data):
    return spark.createDataFrame(data, "pmc_id string, t string, status string").select("pmc_id", F.col("t").cast("timestamp_ntz").alias("processed_at"), "status")


def test_due(spark):
    a = arts(
        spark,
        [
            (1, "PMC1", "x", "2025-01-01", "2025-01-05"),  # done later
            (2, "pmc 2", "x", "2025-01-01", "2025-03-01"),  # changed after done
            (3, "PMC3", "x", "2025-01-01", None),  # never done
            (4, "PMC4", " \n", "2025-01-01", None),  # no body
            (5, "PMC5", "x", "2025-01-01", "2025-01-01"),  # failed at the time it was done
            (6, None, "x", "2025-01-01", None),
            (7, "PMC1", None, "2025-09-01", None),  # a later row without body changes nothing
            (8, "PMC8", "x", "2025-01-01", "2025-01-01"),  # its only completion has no time
            (9, "PMC3", "x", "2025-01-01", None),
        ],
    )
    done = log(spark, [("PMC1", "2025-02-01", "completed"), ("PMC2", "2025-02-01", " Completed "), ("PMC5", "2025-02-01", "completed"), ("PMC8", None, "completed"), ("PMC3", "2025-02-01", "failed"), (None, "2025-02-01", "completed"), ("GONE", "2025-02-01", "completed")])
    failed = log(spark, [("pmc5", "2025-02-01", "FAILED "), ("PMC1", "2025-01-15", "failed"), ("PMC1", None, "failed")])
    got = inc.due_articles(spark, a, done, failed, scratch(spark, "t"))
    assert rows(got) == [("PMC2",), ("PMC3",), ("PMC5",), ("PMC8",)]
    assert inc.due_articles(spark, a.limit(0), done, failed, scratch(spark, "t")).count() == 0
    assert inc.due_articles(spark, a, done.limit(0), failed.limit(0), scratch(spark, "t")).count() == 5


def test_runs_survive_failure(spark):
    store = inc.StateStore(spark, scratch(spark, "runs"))
    v = lambda *d: inc.current_rows(spark.createDataFrame(d, "k string, text string"), "k", ["text"])
    keys = lambda df: [r["key"] for r in df.orderBy("key").collect()]
    one = v(("a", "1"), ("b", "2"), ("b", "2"))
    assert store.version() is None and keys(inc.changed_keys(one, store.read())) == ["a", "b"]
    inc.commit(store, one, one.where("key = 'a'"), one.where("key = 'b'"))
    assert keys(inc.changed_keys(one, store.read())) == ["b"]
    two = v(("a", "9"), ("b", "2"), ("c", None))
    before = store.version()
    # a run that breaks off after writing, before the swap
    two.select("key", "content_hash", F.lit(False).alias("retry")).write.parquet(f"{store.path}/v-broken")
    assert store.version() == before and keys(inc.changed_keys(two, store.read())) == ["a", "b", "c"]
    inc.commit(store, two, two)
    assert keys(inc.changed_keys(two, store.read())) == []
    # the order and number of a key's rows: same rows, same hash
    assert keys(inc.changed_keys(v(("c", None), ("b", "2"), ("a", "9")), store.read())) == []
    assert keys(inc.changed_keys(v(("a", "9"), ("b", "2"), ("c", "")), store.read())) == ["c"]


@pytest.mark.parametrize("a, b", [((None,), ("",)), (("ab", "c"), ("a", "bc"))])
def test_hash_tells_apart(spark, a, b):
    s = ", ".join(f"c{i} string" for i in range(len(a)))
    h = [spark.createDataFrame([x], s).select(inc.content_hash(*[f"c{i}" for i in range(len(a))])).first()[0] for x in (a, b)]
    assert h[0] != h[1]


KV = "k string, text string, t string"


def hashes(spark, *rows):
    return inc.current_rows(spark.createDataFrame(rows, KV).withColumn("t", F.col("t").cast("timestamp")), "k", ["text"], ["t"])


def keys(df):
    return [r["key"] for r in df.orderBy("key").collect()]


def test_hashes_decide(spark):
    """Equal times, other content: due. The same row delivered again: not due."""
    store = inc.StateStore(spark, scratch(spark, "runs"))
    one = inc.begin(store, hashes(spark, ("a", "1", "2025-01-01"), ("b", "2", "2025-01-01"), ("c", "3", None)))
    one.commit(one.due)
    two = inc.begin(store, hashes(spark, ("a", "9", "2025-01-01"), ("b", "2", "2025-01-01"), ("b", "2", "2025-01-01"), ("c", "3", None)))
    assert keys(two.due) == ["a"]


def test_a_change_during_a_run_comes_again(spark, tmp_path):
    store = inc.StateStore(spark, scratch(spark, "runs"))
    path = f"{tmp_path}/rows"
    write = lambda *rows: spark.createDataFrame(rows, KV).write.mode("overwrite").parquet(path)
    read = lambda: inc.current_rows(spark.read.schema(KV).parquet(path), "k", ["text"])
    write(("a", "1", None), ("b", "1", None))
    run = inc.begin(store, read())
    assert keys(run.due) == ["a", "b"]
    write(("a", "2", None), ("b", "1", None))  # between reading and the commit
    run.commit(run.due)
    assert keys(inc.begin(store, read()).due) == ["a"]


def test_overlapping_runs_lose_nothing(spark):
    store = inc.StateStore(spark, scratch(spark, "runs"), keep=2)
    current = hashes(spark, ("a", "1", None), ("b", "1", None), ("c", "1", None))
    one, two = inc.begin(store, current), inc.begin(store, current)
    one.commit(one.due.where("key = 'a'"))
    two.commit(two.due.where("key = 'b'"), two.due.where("key = 'c'"))
    assert keys(inc.begin(store, current).due) == ["c"]
    # a state made from an entry that isn't the last one any more is not published, and old versions go
    assert store.publish(current.select("key", "content_hash", F.lit(False).alias("retry")), 0) is None
    last = inc.begin(store, current)
    last.commit(last.due)
    assert keys(inc.begin(store, current).due) == []
    files = [f.getPath().getName() for f in store._fs.listStatus(store._p(store.path))]
    assert len([f for f in files if f.startswith("v-")]) == 2 and store.head()[0] == 2


def test_content_decides_for_articles(spark):
    """The state of the logs has the rows as they were then: one that came later makes the difference, by its hash."""
    a = arts(spark, [(1, "P1", "x", "2025-01-01", None), (2, "P1", "y", "2025-03-01", None), (3, "P2", "x", "2025-01-01", None), (4, "P2", "x", "2025-01-01", None)])
    done = log(spark, [("P1", "2025-02-01", "completed"), ("P2", "2025-02-01", "completed")])
    versions = inc.article_versions(a)
    state = {r["key"]: r["content_hash"] for r in inc.state_from_logs(versions, done, done.limit(0)).collect()}
    current = {r["key"]: r["content_hash"] for r in inc.keyed_hashes(versions).collect()}
    assert state["P2"] == current["P2"] and state["P1"] != current["P1"] and state["P1"] == state["P2"]


def test_upserts_of_a_stream(spark):
    from statloom.sources import sinks

    path = scratch(spark, "upserts")
    run = sinks.foreach_batch_upsert(path, ["k"], order=["t"])
    rows_ = lambda *r: spark.createDataFrame(r, "k string, v int, t int")
    run(rows_(("a", 1, 1), ("a", 2, 3), ("a", 3, 2), ("b", 1, None)), 0)
    run(rows_(("b", 5, 1), ("c", 6, 1)), 1)
    run(rows_(("a", 99, 99)), 1)  # run again
    assert rows(inc.StateStore(spark, path).read()) == [("a", 2, 3), ("b", 5, 1), ("c", 6, 1)]


def test_no_folder_of_one_machine_on_a_cluster(spark, monkeypatch):
    from statloom import runtime

    class Elsewhere:
        class conf:
            get = staticmethod(lambda k, d: None)

        class sparkContext:
            master = "spark://host:7077"

    with pytest.raises(RuntimeError, match="checkpoint"):
        runtime.shared_dir(Elsewhere)

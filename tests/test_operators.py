import json
import os
import random
import time

import pytest
from pyspark.sql import functions as F

from statloom.operators import analytics, audit, batching, extract, findings, merge, prioritize, progress, responses, validate
from statloom.runtime import scratch
from statloom.sources import readers, sinks
from statloom.streaming import streams
from tests.helpers import rows

F_SCHEMA = "id long, pmc_id string, statistic_type string, value string, context string, source string, confidence double"


def found(spark, data):
    """data: (pmc_id, type, value, source)"""
    return findings.typed(spark.createDataFrame([(i, p, t, v, f"c{i}", s, 0.5) for i, (p, t, v, s) in enumerate(data)], F_SCHEMA))


def test_invalid_article(spark):
    f = found(
        spark,
        [("A", "confidence_interval", '{"lower": 5.0, "upper": 2.0, "level": 95}', "llm"), ("A", "p_value", "1.5", "llm"), ("A", "p_value", "-0.1", "llm"), ("A", "sample_size", "-100", "llm"), ("A", "sample_size", "0", "llm"), ("B", "p_value", "0.03", "llm"), ("B", "confidence_interval", "[1.2, 3.4]", "llm"), ("B", "sample_size", '"100"', "llm"), ("C", "p_value", None, "llm"), ("D", "other thing", "1", "llm")],
    )
    v = {r["pmc_id"]: r for r in validate.article_validity(f).collect()}
    assert v["A"]["row_issues"] == 6 and not v["A"]["valid"]
    assert v["B"]["valid"] and v["B"]["issues"] == 0 and v["D"]["valid"]
    assert v["C"]["row_issues"] == 1
    labels = {r["issue"]: r["n"] for r in validate.common_issues(validate.validated(f)).collect()}
    assert labels == {"CI": 2, "P-value": 3, "Sample size": 2}
    r = validate.validation_report(validate.validated(f), validate.article_validity(f)).first()
    assert (r["validated"], r["valid"], r["recommendations"]) == (4, 2, "high error rate|review P-value extraction")
    s = {r["pmc_id"]: r["confidence_score"] for r in validate.confidence_score(validate.article_validity(f)).collect()}
    assert s["B"] == pytest.approx((1 + 1 + 3 / 20) / 3, abs=1e-6) and s["D"] == pytest.approx((1 + 0 + 0.2) / 3, abs=1e-6)
    assert validate.article_validity(f.limit(0)).count() == 0


def test_combinations(spark):
    f = found(spark, [("A", "p_value", "0.01", "llm"), ("A", "p_value", "0.02", "llm"), ("A", "p_value", "0.2", "llm"), ("A", "confidence_interval", '{"lower": -1, "upper": 1}', "llm"), ("D", "p_value", "0.01", "llm"), ("D", "confidence_interval", "[-1, 1]", "llm"), ("B", "sample_size", "10", "llm"), ("B", "sample_size", "20000", "llm"), ("C", "sample_size", "0", "llm"), ("C", "sample_size", "100", "llm")])
    assert rows(validate.combinations(f)) == [("A", 2, 0), ("B", 0, 1), ("C", 0, 0), ("D", 0, 0)]  # a pair without names is no interval here


def test_compare(spark):
    llm = [("A", "confidence_interval", v, "llm") for v in ("[1, 2]", "[2, 3]", "[4, 5]")] + [("A", "p_value", v, "llm") for v in ("0.01", "0.02", "0.03")] + [("A", "sample_size", str(v), "llm") for v in (1, 2, 3, 4)] + [("A", "effect_size", '{"type": "d", "value": 1}', "llm")]
    rx = [("A", "confidence_interval", "[1, 2]", "regex"), ("A", "p_value", "0.01", "regex"), ("A", "p_value", "0.020", "regex")]
    r = validate.compare_sets(findings.by_extractor(found(spark, llm + rx))).first()
    assert (r["ci_both"], r["ci_llm_only"], r["ci_regex_only"], r["p_both"], r["p_llm_only"], r["p_regex_only"]) == (1, 2, 0, 2, 1, 0)
    assert (r["llm_total"], r["regex_total"], round(r["improvement_pct"], 1)) == (11, 3, 266.7)


def merged(spark, data, kind):
    return merge.MERGES[kind][1](findings.by_extractor(found(spark, data)))


def test_merge_chain_needs_a_fold(spark):
    m = merged(spark, [("A", "p_value", v, "regex") for v in ("0.10", "0.10005", "0.1002", "0.5")], "p")
    assert sorted(r["num"] for r in m.collect()) == [0.10, 0.1002, 0.5]
    # another order, another result
    m = merged(spark, [("A", "p_value", v, "regex") for v in ("0.10005", "0.10", "0.1002")], "p")
    assert sorted(r["num"] for r in m.collect()) == [0.10005, 0.1002]


def test_merge_llm_first_and_tolerance(spark):
    m = merged(spark, [("A", "confidence_interval", "[1.0, 2.0]", "regex"), ("A", "confidence_interval", "[1.004, 2.004]", "llm"), ("A", "confidence_interval", "[1.5, 2.0]", "regex"), ("B", "confidence_interval", "[0, 1]", "regex"), ("B", "confidence_interval", '{"lower": "x", "upper": 1}', "regex")], "ci")
    assert rows(m.select("pmc_id", "id", "extractor", "level")) == [("A", 1, "llm", None), ("A", 2, "regex", 95.0), ("B", 3, "regex", 95.0)]
    m = merged(spark, [("A", "sample_size", "10", "regex"), ("A", "sample_size", "10.7", "both"), ("A", "sample_size", '"<5"', "llm")], "n")
    assert rows(m.select("id", "extractor")) == [(1, "llm")]
    m = merged(spark, [("A", "effect_size", '{"type": "d", "value": 1}', "llm")] * 2 + [("A", "effect_size", '{"type": "d", "value": 1.005}', "regex"), ("A", "effect_size", '{"type": "r", "value": 1.005}', "regex"), ("A", "effect_size", '{"type": "r", "value": 1.005}', "regex")], "effect")
    assert rows(m.select("id", "extractor")) == [(0, "llm"), (1, "llm"), (3, "regex")]


def test_merge_fixture(spark):
    rx = [("A", "confidence_interval", "[1, 2]", "regex"), ("A", "confidence_interval", "[0.5, 0.9]", "regex"), ("A", "p_value", "0.01", "regex"), ("A", "p_value", "0.04", "regex"), ("A", "sample_size", "100", "regex"), ("A", "sample_size", "50", "regex")]
    llm = [("A", "confidence_interval", "[1, 2]", "llm"), ("A", "confidence_interval", "[3, 4]", "llm"), ("A", "p_value", "0.01", "llm"), ("A", "p_value", "0.2", "llm"), ("A", "sample_size", "100", "llm"), ("A", "sample_size", "75", "llm"), ("A", "effect_size", '{"type": "cohens_d", "value": 0.5}', "llm")]
    f = findings.by_extractor(found(spark, rx + llm + [("B", "effect_size", '{"type": "d", "value": 1}', "llm"), ("C", "p_value", "0.5", None)]))
    assert rows(merge.merge_summary(merge.article_counts(f))) == [("A", 1, 1, 3, 3, 3, 1, 10), ("B", 0, 0, 0, 0, 0, 1, 1)]
    assert rows(merge.article_counts(f).select("pmc_id", merge.sources())) == [("A", ["regex", "llm"]), ("B", [])]
    assert merge.article_counts(f.limit(0)).count() == 0


def test_hot_article_is_cut(spark):
    n = 3000
    f = findings.by_extractor(found(spark, [("HOT", "p_value", f"{i / n:.6f}", "regex") for i in range(n)] * 2))
    assert merge.merge_p_values(f).count() == n


@pytest.mark.parametrize("kind", ["p_value", "confidence_interval", "effect_size"])
def test_large_islands_fold_as_small_ones(spark, kind, monkeypatch):
    rng = random.Random(3)
    near = {"p_value": 0.0001, "confidence_interval": 0.01, "effect_size": 0.01}[kind]
    data = []
    for i in range(1500):
        a = round(0.5 + rng.random() * near * 40, 6 if kind == "p_value" else 4)
        value = {"p_value": str(a), "confidence_interval": f"[{a}, {round(a + rng.choice([1, 1.004, 1.02]), 4)}]", "effect_size": json.dumps({"type": "d", "value": a})}[kind]
        data.append(("A" if i % 3 else "B", kind, value, "llm" if rng.random() < 0.1 else "regex"))
    f = findings.by_extractor(found(spark, data))
    op = {k: op for k, op in merge.MERGES.values()}[kind]
    grid = rows(op(f).select("pmc_id", "id", "extractor"))
    monkeypatch.setattr(merge, "LARGE", 10**9)
    assert rows(op(f).select("pmc_id", "id", "extractor")) == grid and len(grid) < 1400
    monkeypatch.setattr(merge, "LARGE", 0)
    assert rows(op(f).select("pmc_id", "id", "extractor")) == grid


def test_a_dense_island_of_100_000(spark):
    f = spark.range(100_000).select("id", F.lit("HOT").alias("pmc_id"), F.lit("p_value").alias("kind"), F.lit("regex").alias("extractor"), F.lit(None).cast("string").alias("name"), *[F.lit(None).cast("double").alias(c) for c in ("lo", "hi", "level")], (F.col("id") / 100_000).alias("num"))
    assert 9_000 < merge.merge_p_values(f).count() < 11_000


def test_upsert(spark):
    t = spark.createDataFrame([("a", 1, "x"), ("b", 2, None), (None, 9, "n")], "k string, v int, w string")
    s = spark.createDataFrame([("b", 5, "new"), ("c", 6, "y"), (None, None, "m"), ], "k string, v int, w string")
    key = lambda df: sorted((tuple(r) for r in df.collect()), key=str)
    assert key(sinks.upsert(t, s, ["k"])) == sorted([("a", 1, "x"), ("b", 5, "new"), ("c", 6, "y"), (None, None, "m")], key=str)
    assert key(sinks.upsert(t, s, ["k"], ["w"])) == sorted([("a", 1, "x"), ("b", 2, "new"), ("c", 6, "y"), (None, 9, "m")], key=str)
    assert key(sinks.upsert(t.limit(0), s, ["k"], ["w"])) == key(s)


def test_json_round_trip(spark, tmp_path):
    a = spark.createDataFrame([(1, "PMC1", "p", "d", "t", "j", 2000, "n = 5; p = 0.01"), (2, None, None, None, None, None, None, "nothing")], "id long, pmc_id string, pmid string, doi string, title string, journal string, pub_year int, text string")
    path = str(tmp_path / "out")
    sinks.write_extraction(extract.output_records(extract.extract(a)), path, "r1")
    with open(os.path.join(path, "run_id=r1", "part-x.json"), "w") as f:
        f.write('{"id": 3, "error": "boom"}\n{"id": 4, "stats"\n')
    back = readers.extraction_lines(spark, path)
    assert back.count() == 3
    got = readers.results_only(back).orderBy("id").collect()
    assert [(r["id"], r["stats"]["rigor_score"], r["stats"]["p_values"]) for r in got] == [(1, 50, ["p = 0.01"]), (2, 0, [])]
    inv = readers.inventory(spark, path, "*.json*").first()
    assert inv["files"] >= 2 and inv["bytes"] > 0
    sinks.append_by_day(a.select("id"), str(tmp_path / "day"))
    sinks.append_by_day(a.select("id"), str(tmp_path / "day"))
    assert spark.read.json(str(tmp_path / "day")).count() == 4
    sinks.write_summary(a.agg(F.count("id").alias("n")), str(tmp_path / "sum"))
    assert spark.read.json(str(tmp_path / "sum")).first()["n"] == 2


def test_model_results_and_latest(spark, tmp_path):
    for name, text in (("a.json", '[{"k": "x", "v": 1}, {"k": "y", "v": 2}]'), ("b.jsonl", '{"k": "x", "v": 3}\n{"k": "z", "v": 4}\n'), ("c.json", '{"k": "y", "v": 5}')):
        (tmp_path / name).write_text(text)
    r = readers.model_results(spark, str(tmp_path), spark.createDataFrame([], "k string, v int").schema)
    assert rows(readers.latest_per_key(r, "k", "file").select("k", "v")) == [("x", 3), ("y", 5), ("z", 4)]


def test_calls_retry_and_fail(spark):
    class Flaky:
        def __init__(self):
            self.n = 0

        def complete(self, prompt):
            self.n += 1
            if prompt == "bad" or self.n == 1:
                raise TimeoutError("slow")
            return prompt.upper()

    p = spark.createDataFrame([("1", "ok"), ("2", "bad"), ("3", None)], "batch_id string, prompt string").coalesce(1)
    got = {r["batch_id"]: (r["answer"], r["status"], r["attempts"]) for r in responses.call_model(p, Flaky, wait=lambda s: None).collect()}
    assert got == {"1": ("OK", "completed", 2), "2": (None, "failed", 3), "3": (None, "failed", 1)}


def test_zip_and_defaults(spark):
    r = spark.createDataFrame([(1, '{"articles": [{"findings": [{"value": 0.5}]}, {}]}'), (2, '{"findings": [{"type": "p_value", "confidence": 0.9}]}'), (3, "no object, 95% CI: 1, 2")], "response_id long, payload string")
    f = responses.parsed_findings(r)
    assert rows(f.select("response_id", "article_pos", "type", "location", "confidence")) == [(1, 0, "other", "unknown", 0.5), (2, -1, "p_value", "unknown", 0.9)]
    b = spark.createDataFrame([("1", 0, "A"), ("1", 1, "B"), ("2", 0, "C"), ("2", 1, "D")], "batch_id string, pos int, pmc_id string")
    z = responses.answers_to_articles(b, f.withColumn("batch_id", F.col("response_id").cast("string")).select("batch_id", "article_pos", "type"))
    assert sorted((r["pmc_id"], str(r["type"])) for r in z.collect()) == [("A", "other"), ("B", "None"), ("C", "p_value"), ("D", "p_value")]
    assert responses.raw_interval_hits(r).first()["intervals"] == ["95% CI: 1, 2"]


def test_scores_of_fleet(spark):
    i = spark.createDataFrame([("a", 0, 0), ("b", 3, 1), ("c", 10, 6)], "name string, errors int, load int")
    assert [r[0] for r in i.select(progress.health_score()).collect()] == pytest.approx([1.0, 0.5, 0.0])
    w = spark.createDataFrame([(None, None, None)], "cpu_percent double, memory_percent double, articles_per_minute double")
    assert w.select(progress.worker_score()).first()[0] == pytest.approx(30.4)
    b = spark.createDataFrame([(1, i, 15.5) for i in range(1, 6)], "run int, seq int, seconds double")
    last = progress.eta(b, 1000, 10).orderBy(F.desc("seq")).first()
    assert (last["mean_seconds"], last["done"], last["eta_seconds"]) == (15.5, 50, 1472.5)


def test_adapted_limits(spark):
    limits = spark.createDataFrame([("a", 50), ("b", 1), ("c", 95)], "name string, most int")
    f = lambda s: [r["most"] for r in batching.adapt_limits(limits, F.lit(s)).orderBy("name").collect()]
    assert f(61.0) == [40, 1, 76] and f(10.0) == [60, 1, 100] and f(30.0) == [50, 1, 95]


def test_not_in_with_null(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y"), (3, None)], "id long, pmc_id string")
    done = spark.createDataFrame([("x",)], "pmc_id string")
    assert rows(prioritize.unprocessed_not_in(a, done).select("id")) == [(2,)]
    assert prioritize.unprocessed_not_in(a, done.unionByName(spark.createDataFrame([(None,)], "pmc_id string"))).count() == 0
    assert rows(prioritize.unprocessed_not_in(a, done.limit(0)).select("id")) == [(1,), (2,), (3,)]
    assert rows(extract.unprocessed(a, done, "pmc_id").select("id")) == [(2,), (3,)]


def test_empty_analytics(spark):
    x = spark.createDataFrame([], "id long, journal string, pub_year int, rigor_score int")
    assert analytics.score_totals(x).first()["with_pct"] == 0.0
    assert [r["articles"] for r in analytics.score_buckets(x).collect()] == [0] * 6
    assert [r["cumulative_pct"] for r in analytics.score_buckets(x, "documented").collect()] == [0.0] * 5
    assert analytics.top_journals(x).count() == 0


def test_scored_as_extracted(spark):
    texts = ["p = 0.5", "n = 3 and r = 1", "95% CI: 1, 2; ANOVA", "power = 0.8", "", None, "FDR adjusted, t-test", "nothing"]
    a = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string")
    for profile in ("implemented", "documented"):
        assert rows(extract.scored(a, profile).select("id", "rigor_score")) == rows(extract.extract(a, profile).select("id", "rigor_score"))


def test_percentiles_are_linear(spark):
    x = spark.createDataFrame([(v,) for v in (0, 10, 25, 35)], "rigor_score int")
    assert {r["percentile"]: r["score"] for r in analytics.score_percentiles(x).collect()}[50] == 17.5


def test_sample_is_repeatable(spark):
    x = spark.range(1000).select("id", F.lit(70).alias("rigor_score"))
    a, b = audit.sample_band(x, "high"), audit.sample_band(x.repartition(7), "high")
    assert rows(a) == rows(b) and a.count() == 20
    assert rows(audit.sample_band(x, "high", seed=5)) != rows(a)


def test_grades(spark):
    g = lambda v, k: spark.range(1).select(audit.grade(F.lit(v), k)).first()[0]
    assert [g(v, "high") for v in (95, 85, 72, 10)] == ["EXCELLENT", "GOOD", "ACCEPTABLE", "NEEDS IMPROVEMENT"]
    assert [g(v, "medium") for v in (90, 75, 74)] == ["EXCELLENT", "GOOD", "NEEDS IMPROVEMENT"]


def test_stream_resumes(spark, tmp_path):
    src, out, cp = (str(tmp_path / n) for n in ("in", "out", "cp"))
    schema = "id long, full_text string, body string, created_at timestamp"
    put = lambda lo, hi: spark.range(lo, hi).select("id", F.concat(F.lit("p = 0."), F.col("id").cast("string")).alias("full_text"), F.lit(None).cast("string").alias("body"), F.timestamp_seconds(F.col("id")).alias("created_at")).coalesce(1).write.mode("append").parquet(src)
    put(1, 101)

    def run():
        s = streams.article_stream(spark, src, spark.createDataFrame([], schema).schema)
        streams.run_available(streams.extraction_stream(s, delay="1 day").select("id", "rigor_score"), out, cp).awaitTermination()
        return spark.read.parquet(out).count()

    assert run() == 100
    put(101, 151)
    put(50, 60)  # ids again within the delay
    assert run() == 150
    assert run() == 150
    assert spark.read.parquet(out).where("rigor_score = 25").count() == 150


def test_stream_upsert(spark, tmp_path):
    src, state, cp = (str(tmp_path / n) for n in ("in", "state", "cp"))
    schema = "k string, v int"
    put = lambda *d: spark.createDataFrame(d, schema).coalesce(1).write.mode("append").parquet(src)

    def run():
        q = spark.readStream.schema(schema).parquet(src).writeStream.foreachBatch(sinks.foreach_batch_upsert(state, ["k"])).option("checkpointLocation", cp).trigger(availableNow=True).start()
        q.awaitTermination()
        from statloom.operators.incremental import StateStore

        return rows(StateStore(spark, state).read())

    put(("a", 1), ("b", 2))
    assert run() == [("a", 1), ("b", 2)]
    time.sleep(0.01)
    put(("b", 3), ("c", 4))
    assert run() == [("a", 1), ("b", 3), ("c", 4)]
    assert run() == [("a", 1), ("b", 3), ("c", 4)]


def test_rate_and_session_streams(spark, tmp_path):
    src = str(tmp_path / "in")
    spark.range(100).select(F.col("id").alias("event_id"), F.timestamp_seconds(F.col("id") * 10 + (F.col("id") >= 50).cast("int") * 600).alias("ts"), (F.col("id") % 2).alias("user_id"), F.lit("x").alias("event_type"), F.lit(1.0).alias("value")).write.parquet(src)
    schema = spark.read.parquet(src).schema
    s = lambda: spark.readStream.schema(schema).parquet(src)
    for df, name in ((streams.rates(s()), "rates"), (streams.heartbeat_sessions(s()), "beats")):
        df.writeStream.format("memory").queryName(name).outputMode("complete").trigger(availableNow=True).start().awaitTermination()
    assert spark.table("rates").agg(F.sum("events")).first()[0] == 100
    assert rows(spark.table("rates")) == rows(streams.rates(spark.read.parquet(src)))
    assert rows(spark.table("beats").select("user_id", "beats")) == [(0, 25), (0, 25), (1, 25), (1, 25)]

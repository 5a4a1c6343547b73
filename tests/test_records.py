"""Records of extractors and models that are read, checked and merged; planted faults that the test tables don't have."""

import json

import duckdb
import pytest
from pyspark.sql import functions as F

from statloom.operators import audit, extract, findings, merge, responses
from statloom.plans import registry
from tests.helpers import rows, same
from tests.test_operators import F_SCHEMA, found

PLANTED = [
    ("confidence_interval", v)
    for v in ('{"lower": 5, "upper": 2}', '{"lower": 1}', "[1, 5000]", "[-2000, 3]", '{"lower": 1, "upper": 2, "level": 80}', '{"lower": 1, "upper": 2, "level": 95}', "[1, 2, 0]", "[3, 3]", "[1, 200]", "text", "null", '{"value": {"lower": "1", "upper": "0"}}')
] + [("sample_size", v) for v in ("0", "-5", "12.5", "10000000", "9999999", '{"value": 7.25}', '"x"', "40", "null")] + [("p_value", v) for v in ("0", "1", "1.5", "-0.1", "0.05", '{"value": "0.2"}', '"<0.05"')] + [
    ("effect_size", json.dumps({"type": t, "value": v})) for t, v in (("Cohens d", 6), ("correlation", 1.5), ("r-squared", -1), ("odds ratio", 0), ("odds ratio", 2))
]


@pytest.fixture(scope="module")
def planted(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("planted"))
    data = [(i, None if i % 11 == 0 else f"P{i % 4}", t, v, f"c{i}", ("llm", "regex", "both")[i % 3], 0.5) for i, (t, v) in enumerate(PLANTED * 3)]
    spark.createDataFrame(data, F_SCHEMA).withColumn("created_at", F.lit("2025-01-01").cast("timestamp_ntz")).coalesce(1).write.parquet(f"{d}/merged_statistics.parquet")
    c = duckdb.connect()
    c.execute(f"create view merged_statistics as select * from read_parquet('{d}/merged_statistics.parquet/*.parquet')")
    return d, c


@pytest.mark.parametrize("name", ["validate_ci", "validate_n", "validate_p", "validate_effect", "validate_combo", "validate_extraction", "confidence_score", "validation_report", "recent_errors", "issue_messages", "merge_findings"])
def test_planted_faults(spark, planted, name):
    df = registry.queries()[name](spark, planted[0])
    assert df.count() > 0
    same(df, planted[1], registry.oracle_sql()[name])


def test_each_rule_is_met(spark, planted):
    got = {r["issue"] for n in ("validate_ci", "validate_n") for r in registry.queries()[n](spark, planted[0]).collect()}
    assert got == {"CI: Invalid format", "CI: Lower bound >= upper bound", "CI: Unreasonable range", "CI: Unusual confidence level", "CI: Unusual width", "Sample size: Parsing error", "Sample size: Non-positive value", "Sample size: Unreasonable value", "Sample size: Non-integer value"}


def test_an_instance_that_fails_is_passed_over():
    class One:
        def __init__(self, name, bad=()):
            self.name, self.bad, self.calls = name, bad, 0

        def complete(self, prompt):
            self.calls += 1
            if prompt in self.bad:
                raise TimeoutError(self.name)
            return f"{self.name}:{prompt}"

    a, b = One("a", {"x", "y"}), One("b", {"y"})
    f = responses.Failover(a, b)
    assert f.complete("w") == "a:w" and f.complete("x") == "b:x"
    assert f.complete("w") == "b:w" and f.errors == [1, 0]  # the healthier first
    with pytest.raises(RuntimeError, match="all instances"):
        f.complete("y")


def test_cut_answers_are_searched_too(spark):
    r = spark.createDataFrame([(1, '{"findings": [ {"x": 95% CI: 1.2, 3.4 cut'), (2, '{"findings": []} 95% CI: 1, 2'), (3, "95% CI: 5, 6"), (4, None), (5, "")], "response_id long, payload string")
    got = {x["response_id"]: x["intervals"] for x in responses.raw_interval_hits(r).collect()}
    assert got == {1: ["95% CI: 1.2, 3.4"], 3: ["95% CI: 5, 6"], 5: []}


def test_model_findings_that_are_possible(spark):
    f = [("confidence_interval", {"lower": 1, "upper": 2}, 0.9, True), ("confidence_interval", [2, 1], 0.9, False), ("confidence_interval", "1 to 2", 0.9, True), ("p_value", 1.5, 0.9, False), ("p_value", "<0.05", 0.9, True), ("p_value", "p of 3", 0.9, False), ("p_value", "none", 0.9, True), ("sample_size", 0.5, 0.9, False), ("sample_size", "n = 12", 0.9, True), ("sample_size", -3, 0.9, False), ("other", {}, 0.9, True), ("p_value", 0.5, 0.1, False), ("p_value", None, None, True)]
    answer = json.dumps({"findings": [{"type": t, "value": v, "confidence": c} for t, v, c, _ in f]})
    df = responses.parsed_findings(spark.createDataFrame([(1, answer)], "response_id long, payload string"))
    assert [r["item_pos"] for r in responses.valid_model_findings(df).orderBy("item_pos").collect()] == [i for i, x in enumerate(f) if x[3]]


def test_failures_are_isolated(spark):
    cols = "id long, text string, pmc_id string, pmid string, doi string, title string, journal string, pub_year int"
    df = spark.createDataFrame([(1, "p = 0.04 and n = 20", "A", None, None, None, None, 2020), (2, "bad p = 0.5", "B", None, None, None, None, None), (3, None, "C", None, None, None, None, None)], cols)

    def broken(text):
        if "bad" in text:
            raise ValueError("no")
        return ["x"]

    got = {r["id"]: r for r in extract.isolated_records(df, matchers={"corrections": broken}).collect()}
    assert got[1]["stats"]["p_values"] == ["p = 0.04"] and got[1]["stats"]["corrections"] == ["x"] and got[1]["stats"]["extraction_error"] is None and got[1]["error"] is None
    assert got[2]["stats"]["p_values"] == ["p = 0.5"] and got[2]["stats"]["corrections"] == [] and got[2]["stats"]["extraction_error"] == "corrections: ValueError: no"
    assert got[3]["stats"] is None and got[3]["error"].startswith("TypeError") and "Traceback" in got[3]["traceback"]
    plain = extract.output_records(extract.extract(df.where("text is not null"))).select("id", "stats.p_values", "stats.rigor_score")
    assert rows(plain) == sorted((i, got[i]["stats"]["p_values"], got[i]["stats"]["rigor_score"]) for i in (1, 2))


def test_records_are_merged_end_to_end(spark):
    line = lambda i, pmc, **stats: (i, json.dumps({"id": i, "stats": stats, "metadata": {"pmc_id": pmc}}))
    lines = [
        line(1, "A", p_values=["p < 0.03", "P = 0.2", {"match": "p = 7e-7"}, "p = n.s."], sample_sizes=["n = 1,200", "40 patients"], confidence_intervals=["95% CI: 1.2, 3.4", "[0.14, 0.97] (95% CI)", "CI 90% = 0.97 to 1.91", "0.8-1.4"], effect_sizes=["d = 0.50", "OR = 1.95"]),
        (2, json.dumps({"run": {"result": {"stats": json.dumps({"sections": [{"p_values": ["p=0.5"]}]}), "metadata": {"pmc_id": "B"}}}})),
        (3, "broken {"),
        line(4, None, p_values=["p = 0.1"]),
    ]
    answer = {"articles": [{"pmc_id": "A", "findings": [{"type": "ci", "value": {"lower": "1.201", "upper": 3.401}}, {"type": "P-value", "value": {"value": 0.03}}, {"type": "p_value", "value": "<0.05"}, {"type": "effect_size", "value": {"type": "Cohens-d", "value": 0.505}}]}, {"pmc_id": "C", "findings": [{"type": "sample_size", "value": 7}]}, {"findings": [{"type": "sample_size", "value": 8}]}]}
    f = findings.of_both(spark.createDataFrame(lines, "line_id long, line_text string"), spark.createDataFrame([(1, json.dumps(answer))], "response_id long, payload string"))
    m = merge.merged_findings(f).select("pmc_id", "kind", "extractor", "name", "lo", "hi", "level", "num")
    assert rows(m.na.fill(-9).na.fill("")) == sorted(
        [
            ("A", "confidence_interval", "llm", "", 1.201, 3.401, -9.0, -9.0),
            ("A", "confidence_interval", "regex", "", 0.14, 0.97, 95.0, -9.0),
            ("A", "confidence_interval", "regex", "", 0.97, 1.91, 90.0, -9.0),
            ("A", "confidence_interval", "regex", "", 0.8, 1.4, 95.0, -9.0),
            ("A", "p_value", "llm", "", -9.0, -9.0, -9.0, 0.03),
            ("A", "p_value", "regex", "", -9.0, -9.0, -9.0, 0.2),
            ("A", "p_value", "regex", "", -9.0, -9.0, -9.0, 7e-7),
            ("A", "sample_size", "regex", "", -9.0, -9.0, -9.0, 1200.0),
            ("A", "sample_size", "regex", "", -9.0, -9.0, -9.0, 40.0),
            ("A", "effect_size", "llm", "cohens_d", -9.0, -9.0, -9.0, 0.505),
            ("A", "effect_size", "regex", "odds_ratio", -9.0, -9.0, -9.0, 1.95),
            ("B", "p_value", "regex", "", -9.0, -9.0, -9.0, 0.5),
            ("C", "sample_size", "llm", "", -9.0, -9.0, -9.0, 7.0),
        ]
    )


def test_different_values_of_one_context_stay(spark):
    f = findings.by_extractor(found(spark, [("A", "p_value", "0.1", "llm"), ("A", "p_value", "0.2", "llm"), ("A", "p_value", "0.10", "regex"), ("A", "p_value", "x", "llm")]).withColumn("context", F.lit(None).cast("string")))
    assert sorted((r["num"], r["text_key"], r["extractor"]) for r in merge.merge_findings(f).where("num is not null").collect()) == [(0.1, None, "llm"), (0.2, None, "llm")]
    assert merge.merge_findings(f).count() == 3


def test_audits_see_whole_texts(spark):
    text = "".join(f"p = 0.{k:03d} and words " for k in range(300)) + "w " * 60_000 + "95% CI [1, 2] n = 77"
    x = extract.extract(spark.createDataFrame([(1, text)], "id long, text string"))
    high = audit.audit_high(x).first()
    assert high["checked"] >= 302 and high["found"] == high["checked"]
    assert audit.audit_high(x, cuts=True).first()["checked"] < 50
    low = {r["category"]: r["found"] for r in audit.audit_low(x).collect()}
    assert low["confidence_intervals"] == 2 and {r["category"]: r["found"] for r in audit.audit_low(x, cuts=True).collect()}["confidence_intervals"] == 0

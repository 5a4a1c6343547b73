import random

import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from statloom.functions import dialect
from statloom.functions import patterns as P
from statloom.functions.patterns import SIZE_CLASSES
from statloom.operators import batching, extract, structured
from tests.helpers import rows

CASES = [
    ("p < 0.001 and P = 0.045", "p_values", ["P = 0.045", "p < 0.001"]),
    ("p = n.s.", "p_values", ["p = n.s."]),
    ("mean = 5", "sample_sizes", ["n = 5"]),
    ("n = 50, p", "sample_sizes", ["n = 50,"]),
    ("95% CI: 1.2, 3.4", "confidence_intervals", ["95% CI: 1.2, 3.4"]),
    ("95% CI: 1.2-3.4", "confidence_intervals", []),
    ("r = 1.25", "effect_sizes", ["r = 1"]),
    ("period = 5", "effect_sizes", ["d = 5"]),
    ("η² = 0.15", "effect_sizes", []),
    ("p=0.05; p=0.05", "p_values", ["p=0.05"]),
    ("statistical power = 0.8", "power_analysis", ["statistical power = 0.8"]),
    ("", "p_values", []),
    (None, "p_values", []),
]


def test_micro_cases(spark):
    for text, c, want in CASES:
        df = spark.createDataFrame([(text,)], "text string")
        got = df.select(extract.distinct_hits(F.col("text"), P.IMPLEMENTED[c])).first()[0]
        assert sorted(got) == sorted(want), (text, c)


@pytest.mark.parametrize(
    "cats, implemented, documented",
    [
        ([], 0, 0),
        (["p_values"], 25, 30),
        (["p_values", "statistical_tests"], 35, 40),
        (["p_values", "sample_sizes"], 50, 40),
        (["p_values", "sample_sizes", "confidence_intervals", "effect_sizes", "statistical_tests"], 100, 85),
        (["power_analysis", "corrections"], 0, 15),
        (list(P.CATEGORIES), 100, 100),
    ],
)
def test_scores(spark, cats, implemented, documented):
    df = spark.range(1).select(*[F.array(F.lit("x")).alias(c) if c in cats else F.array().cast("array<string>").alias(c) for c in P.CATEGORIES])
    got = df.select(extract.rigor_score(P.WEIGHTS["implemented"]), extract.rigor_score(P.WEIGHTS["documented"])).first()
    assert tuple(got) == (implemented, documented)


PIECES = ["p", "P", " ", "=", "<", "≤", "0", "5", ".", "05", "n", "N", ",", "CI", "95%", "[", "]", "to", "–", "-", "d", "r", "β", "OR", ":", "t", "(", ")", "test", "F", "value", "NS", "power", "q", "chi", "square", "Cohen's", " ", "participants", "FDR", "adjusted"]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.sampled_from(PIECES), max_size=40).map("".join), min_size=20, max_size=60))
def test_java_as_python(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string")
    for profile, (cat, ignore) in P.CATALOGUES.items():
        got = df.select("id", *[extract.hits("text", cat[c], ignore).alias(c) for c in P.CATEGORIES]).collect()
        for r in got:
            for c in P.CATEGORIES:
                want = [m.group() for m in re.finditer(dialect.alternation(cat[c]), texts[r["id"]], re.I if ignore else 0)]
                assert r[c] == want, (profile, c, texts[r["id"]])


def test_re2_classes():
    assert dialect.re2(r"a\s[\s:]\d") == r"(?i)a[\t\n\x0b\f\r \x{85}\p{Z}][\t\n\x0b\f\r \x{85}\p{Z}:][\p{Nd}]"
    assert dialect.re2("a.b", ignore_case=False, dotall=True) == "(?s)a.b"


def article(spark, **kw):
    base = {"id": 1, "pmc_id": "PMC1", "title": "T", "abstract": "", "body": ""} | kw
    return spark.createDataFrame([tuple(base.values())], "id long, pmc_id string, title string, abstract string, body string")


def test_structured_fixture(spark):
    a = article(
        spark,
        abstract="We found p = 0.03 among 120 participants.",
        body="Table 1. Results\n| a | 1.20 (1.00-1.40) |\n| b | 0.80 (0.60-0.95) |\nTable 2 shows n = 45. Cohen's d = 0.5 and an odds ratio of 1.5 (1.1-2.0).",
    )
    found = structured.findings(a)
    by = {r["type"]: r["count"] for r in found.groupBy("type").count().collect()}
    assert by == {"confidence_interval": 3, "p_value": 1, "sample_size": 2, "effect_size": 1}
    compat = structured.valid_findings(structured.findings(a, compat=True), compat=True)
    assert {r["pattern"] for r in compat.collect()} == {"p_value_exact", "sample_size", "cohens_d"}
    for r in found.collect():
        whole = a.select(structured.whole_text()).first()[0]
        assert whole[r["start"] : r["start"] + len(r["raw_text"])] == r["raw_text"]
        assert r["raw_text"] in r["context"] and len(r["context"]) <= len(r["raw_text"]) + 100


def test_table_marks_count_twice(spark):
    a = article(spark, body="Table 1. x and Figure 2: caption here. Figure 3: next")
    assert a.select(structured.table_section_count(F.col("body"))).first()[0] == 2
    caps = a.select(structured.figure_captions(F.col("body"))).first()[0]
    assert caps[:2] == ["Figure 2: caption here. ", "Figure 3: next"]
    assert structured.table_sections(a).count() == 2
    assert structured.table_sections(article(spark, body=None)).count() == 0


@pytest.mark.parametrize("n, name, most", [(9_999, "short", 50), (10_000, "medium", 25), (49_999, "medium", 25), (50_000, "long", 10), (99_999, "long", 10), (100_000, "very_long", 5)])
def test_size_classes(spark, n, name, most):
    r = spark.range(1).select(batching.size_class(F.lit(n)), batching.size_limit(F.lit(n))).first()
    assert tuple(r) == (name, most)


def test_packing_limits(spark):
    df = spark.createDataFrame([(i, f"PMC{i}", "t", "a", "x" * (i * 37 % 9000), "J One") for i in range(400)], "id long, pmc_id string, title string, abstract string, body string, journal string")
    df = df.unionByName(spark.createDataFrame([(1000, "PMC", None, None, None, None), (1001, "PMC", None, None, "y" * 40_000, " ")], df.schema))
    packed = batching.pack_batches(df).collect()
    assert sorted(r["id"] for r in packed) == [*range(400), 1000, 1001]
    groups = {}
    for r in packed:
        groups.setdefault((r["group_key"], r["batch_no"]), []).append(r)
    for g in groups.values():
        assert len(g) <= 50
        assert sum(r["tokens"] for r in g) <= 8000 or len(g) == 1
        assert sorted(r["pos_in_batch"] for r in g) == list(range(len(g)))
    assert batching.pack_batches(df.limit(0)).count() == 0


def test_cut_groups_pack_as_one(spark):
    """Groups packed in slots give what one pass over the group gives, whatever the slots."""
    rng = random.Random(2)
    df = spark.createDataFrame([(i, "P", "t", "a", None if rng.random() < 0.4 else "x" * rng.choice([5, 400, 9999, 10_001, 30_000]), rng.choice("JK")) for i in range(1500)], "id long, pmc_id string, title string, abstract string, body string, journal string")
    mixed = lambda i: (i % 2**31 * 2654435761 % 2**32) >> 22
    groups, want = {}, {}
    for r in df.select("id", batching.group_key().alias("g"), F.length(F.coalesce("body", F.lit(""))).alias("n"), batching.token_estimate().alias("t")).collect():
        groups.setdefault(r["g"], []).append((r["n"], mixed(r["id"]), r["id"], r["t"]))
    for g, members in groups.items():
        no = held = tokens = 0
        for n, _, i, t in sorted(members):
            most = next(m for below, _, m in SIZE_CLASSES if below is None or n < below)
            if held and (tokens + t > 8000 or held >= most):
                no, held, tokens = no + 1, 0, 0
            want[i] = (g, no, held)
            held, tokens = held + 1, tokens + t
    for slot_rows in (50, 130, 100_000):
        got = {r["id"]: (r["group_key"], r["batch_no"], r["pos_in_batch"]) for r in batching.pack_batches(df, slot_rows=slot_rows).collect()}
        assert got == want


def test_task_chunks(spark):
    df = spark.createDataFrame([(i * 70_000,) for i in range(130)], "id long")
    got = {r["id"]: r["task"] for r in batching.task_chunks(df).collect()}
    assert [got[i * 70_000] for i in range(130)] == [i // 50 for i in range(130)]


def test_clashing_columns_and_repeats(spark):
    df = spark.createDataFrame([(1, "p = 0.5", "x"), (1, "p = 0.5", "x")], "id long, text string, category string")
    assert rows(extract.extract_long(extract.extract(df))) == [(1, "p_values", "p = 0.5")] * 2
    assert extract.extract(df.limit(0)).count() == 0

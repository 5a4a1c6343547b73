import random

import pytest
from pyspark.sql import functions as F

from statloom.llm import survivors as s
from tests.helpers import rows

SCHEMA = "id long, pmc_id string, statistic_type string, value string, context string, location string, source string, confidence double, t string"


def table(spark, data):
    return spark.createDataFrame(data, SCHEMA).withColumn("created_at", F.col("t").cast("timestamp_ntz"))


def test_groups_and_fields(spark):
    df = table(
        spark,
        [
            (1, "P", "p_value", "0.50", "cut off ...", "n/a", "regex", 95.0, "2025-01-01"),
            (2, "P", "P-values", '{"value": "5e-1"}', "whole context", "text", " LLM", 0.4, "2025-01-01"),
            (3, "P", "p value", '{ "value" : 0.5 }', "cut [...]", "table", "Both", None, "2025-01-02"),
            (4, "P", "p_value", "0.51", "other value", "text", "llm", 0.4, None),
            (5, "Q", "confidence_interval", "[1, 2.0, 95]", None, None, None, None, None),
            (6, "Q", "Confidence Interval", '{"upper": 2, "lower": "1", "level": 90}', " ", "-", "unknown", -1.0, None),
            (7, "R", "effect_size", '{"type": "Odds-Ratio", "value": 2}', "x...", "text", "llm", 0.1, "2025-01-01"),
            (8, "R", "effect_sizes", '{"value": 2.0, "type": "odds ratio"}', "y…", "text", "llm", 0.1, "2025-01-01"),
            (9, "R", "effect_size", '{"type": "hazard_ratio", "value": 2}', "z", "text", "llm", 0.1, None),
            (10, "P", "p_value", None, "no value", "text", "llm", 0.1, None),
            (11, None, "p_value", "0.5", "no article", "text", "llm", 0.1, None),
            (12, None, "p_value", "0.5", "no article", "text", "llm", 0.1, None),
            (13, "S", "p_value", "broken {", "x", "text", "llm", 0.1, None),
            (14, "S", "p_value", "broken {", "x", "text", "llm", 0.1, None),
        ],
    ).withColumn("field", F.lit("clash"))
    assert rows(s.best_rows(df)) == sorted(
        [(1, "source", 3), (1, "context", 2), (1, "location", 3), (1, "confidence", 2), (7, "source", 8), (7, "context", 8), (7, "location", 8), (7, "confidence", 8)]
    )
    assert s.best_rows(df.limit(0)).count() == 0
    one = s.survivors(df).where("group_id = 1").first()
    assert (one["source"], one["context"], one["location"], one["confidence"]) == ("Both", "whole context", "table", 0.4)


def test_quality_model_finds_the_liar():
    rng = random.Random(1)
    sources = ("a", "b", "c")
    sens, spec = {"a": 0.95, "b": 0.9, "c": 0.6}, {"a": 0.95, "b": 0.9, "c": 0.5}
    counts = {}
    for _ in range(20_000):
        truth = rng.random() < 0.6
        stated = sum((rng.random() < (sens[x] if truth else 1 - spec[x])) << i for i, x in enumerate(sources))
        counts[7, stated] = counts.get((7, stated), 0) + 1
    prior, q = s.fit_quality([(p, st, n) for (p, st), n in counts.items()], sources, rounds=500)
    assert prior == pytest.approx(0.6, abs=0.05)
    for x in sources:
        assert q[x][0] == pytest.approx(sens[x], abs=0.06) and q[x][1] == pytest.approx(spec[x], abs=0.08)
    assert s.posterior(7, 3, prior, q, sources) > 0.9 > 0.2 > s.posterior(7, 4, prior, q, sources)


def test_several_values_can_be_true(spark):
    data = []
    for g in range(60):
        for k, (src, loc) in enumerate([("both", "text"), ("llm", "text"), ("regex", "text"), ("both", "table"), ("llm", "table"), (None, "figure")]):
            data.append((g * 10 + k, f"P{g}", "p_value", "0.5", None, loc, src, None, None))
    values, quality = s.judged(table(spark, data), ("location",))
    kept = {r["value"]: r["kept"] for r in values.where("group_id = 0").collect()}
    assert kept["text"] and set(kept) == {"text", "table", "figure"}
    assert quality.count() == 4 and values.count() == 180
    assert s.judged(table(spark, data).limit(0), ("location",))[0].count() == 0


def test_false_values_are_told_from_several_true_ones(spark):
    """Three sources of planted quality over 1,500 groups, a fifth of all values false, a third of the fields with two
    true values."""
    rng = random.Random(6)
    sens, lies = {"both": 0.95, "llm": 0.85, "regex": 0.85}, {"both": 0.02, "llm": 0.05, "regex": 0.35}
    places = ["text", "table", "figure", "abstract", "supplement", "appendix"]
    data, truth = [], {}
    for g in range(1500):
        mixed = rng.sample(places, 6)
        true, false = mixed[: 2 if rng.random() < 0.33 else 1], mixed[2:]
        truth[g * 100] = set(true)
        k = 0
        for src in sens:
            said = [v for v in true if rng.random() < sens[src]] + ([rng.choice(false)] if rng.random() < lies[src] else [])
            for v in said or [None]:  # a source that has the finding and names no place
                data.append((g * 100 + k, f"P{g}", "p_value", "0.5", None, v, src, None, None))
                k += 1
    values, _ = s.judged(table(spark, data), ("location",))
    got = [(r["group_id"], r["value"], r["kept"]) for r in values.collect()]
    right = [v in truth[g] for g, v, _ in got]
    assert 0.1 < 1 - sum(right) / len(got) < 0.35
    kept = [(g, v) for g, v, k in got if k]
    good = sum(v in truth[g] for g, v in kept)
    assert good >= 0.93 * len(kept) and good >= 0.95 * sum(right)
    stated = {}
    for g, v, _ in got:
        stated.setdefault(g, set()).add(v)
    held = set(kept)
    both = [g for g, v in truth.items() if len(v) == 2 and v <= stated.get(g, set())]
    assert len(both) > 300 and sum(all((g, v) in held for v in truth[g]) for g in both) >= 0.9 * len(both)

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from statloom.llm import quantiles as q
from tests.helpers import rows


def rank_interval(v, x):
    return np.searchsorted(v, x, "left") + 1, np.searchsorted(v, x, "right")


@pytest.mark.parametrize("high", [True, False])
@pytest.mark.parametrize("order", ["random", "up", "down", "ties"])
def test_bounds_hold(high, order):
    rng = np.random.default_rng(3)
    v = rng.lognormal(size=60_000)
    v = {"random": v, "up": np.sort(v), "down": np.sort(v)[::-1], "ties": np.floor(v * 3)}[order]
    parts = [q.RankSketch(16, high) for _ in range(7)]
    for i, s in enumerate(parts):
        s.add(v[i::7])
    whole = parts[0]
    for s in parts[1:]:
        whole.merge(s)
    assert whole.n == len(v) and sum(len(x) << h for h, x in enumerate(whole.levels)) == len(v)
    assert sum(map(len, whole.levels)) < len(v) / 8
    s = np.sort(v)
    for p in (0.0, 0.001, 0.01, 0.25, 0.5, 0.9, 0.99, 0.999, 1.0):
        lo, hi = whole.bounds(p)
        assert lo <= np.quantile(s, p) <= hi
        a, b = rank_interval(s, whole.at_rank(p * len(v)))
        assert a - whole.error <= p * len(v) + 1 and b + whole.error >= p * len(v)


def test_protected_tail_is_sharper():
    v = np.random.default_rng(1).random(200_000)
    s = q.RankSketch(16, True)
    s.add(v)
    err = lambda p: abs(np.searchsorted(np.sort(v), s.quantile(p)) - p * len(v))
    assert err(0.9999) <= 4 and err(0.999) <= 60


@settings(max_examples=40, deadline=None)
@given(st.lists(st.lists(st.integers(-50, 50), max_size=200), min_size=1, max_size=5))
def test_small_is_exact_and_survives_storage(parts):
    whole = q.RankSketch()
    for p in parts:
        s = q.RankSketch()
        s.add(np.array(p, dtype=float))
        whole.merge(q.RankSketch.loads(s.dumps())[0])
    v = [x for p in parts for x in p]
    if v and not whole.error:
        for p in (0, 0.3, 0.5, 1):
            assert whole.quantile(p) == pytest.approx(np.quantile(v, p))


def test_grouped_pieces(spark):
    rng = np.random.default_rng(0)
    data = [("hot" if i % 3 else f"g{i % 7}", int(i % 11), float(x)) for i, x in enumerate(rng.normal(size=30_000))] + [("g0", 1, None), ("g0", None, 1.0), (None, 1, 4.0), ("nan", 1, float("nan"))]
    df = spark.createDataFrame(data, "g string, day int, v double").repartition(6)
    sk = q.piece_sketches(df, ["g"], "v", "day", k=16)
    got = {r["g"]: r for r in q.percentiles(sk, ["g"], [0.5, 0.99], k=16).collect()}
    assert set(got) == {"hot", None, *(f"g{i}" for i in range(7))}
    for g, r in got.items():
        v = [x for a, d, x in data if a == g and x is not None and d is not None]
        assert r["n"] == len(v)
        for p, c in ((0.5, "p50"), (0.99, "p99")):
            assert r[f"{c}_low"] <= np.quantile(v, p) <= r[f"{c}_high"]
    days = q.merged(sk, ["g"], 16, keep_pieces=False)
    assert {r["g"]: r["n"] for r in q.percentiles(days, ["g"], [0.5], 16).collect()} == {g: r["n"] for g, r in got.items()}
    assert q.piece_sketches(df.limit(0), ["g"], "v", "day").count() == 0


def test_shifted_groups(spark):
    data = [(i, 1, f"2025-01-01 00:00:{i % 60:02d}", "J", 2000, 50) for i in range(200)] + [(1000 + i, 2, "2025-01-01", "J", 2001, 70 if i < 16 else 75) for i in range(31)] + [(2000 + i, 2, "2025-01-01", "J", 2002, 90) for i in range(29)]
    data += [(5000 + i, 3, "2025-01-01", "J", 2003, 71) for i in range(30)] + [(1000, 2, "2025-01-02", "J", 2001, 70)] * 40  # delivered again: counts once
    data += [(7000, 1, None, None, 2000, 5), (7001, 1, None, "J", 1899, 5), (7002, None, None, "J", 2000, 101), (None, 1, None, "J", 2000, 5), (7003, None, None, "J", 2000, 50)]
    df = spark.createDataFrame(data, "id long, run_day int, t string, journal string, pub_year int, rigor_score int").withColumn("scored_at", F.col("t").cast("timestamp"))
    assert rows(q.named(q.shifted_groups(q.valid_scores(df)), df)) == [("J", 2001), ("J", 2003)]
    # sketches that are thinned out leave groups open; the result is the same
    many = df.unionByName(spark.range(10_000, 14_000).select("id", F.lit(1).alias("run_day"), F.lit("2025-01-01").alias("t"), F.lit("J").alias("journal"), F.lit(2000).alias("pub_year"), F.lit(50).alias("rigor_score"), F.lit(None).cast("timestamp").alias("scored_at")))
    assert rows(q.named(q.shifted_groups(q.valid_scores(many), k=4), many)) == [("J", 2001), ("J", 2003)]
    assert q.shifted_groups(q.valid_scores(df.limit(0))).count() == 0


@pytest.mark.parametrize("high", [True, False])
@pytest.mark.parametrize("shape", ["lognormal", "pareto", "ties", "sorted"])
@pytest.mark.parametrize("n, parts", [(4629, 60), (400_000, 60), (400_000, 1)])
def test_the_protected_tail_has_a_multiplicative_error(n, parts, shape, high):
    """Proven and real errors are at most 5 % of the ranks beyond the percentile, in whatever order pieces are merged."""
    rng = np.random.default_rng(7)
    v = {"lognormal": rng.lognormal(sigma=3, size=n), "pareto": rng.pareto(0.7, size=n), "ties": np.floor(rng.lognormal(size=n) * 5), "sorted": np.sort(rng.lognormal(size=n))}[shape]
    s = np.sort(v)
    for seed in range(2):
        pieces = [q.RankSketch(high=high) for _ in range(parts)]
        for i, p in enumerate(pieces):
            p.add(v[i::parts])
        order = np.random.default_rng(seed).permutation(parts)
        whole = q.RankSketch(high=high)
        for i in order:
            whole.merge(q.RankSketch.loads(pieces[i].dumps())[0])
        assert whole.n == n
        for p in (0.5, 0.9, 0.99, 0.999) if high else (0.5, 0.1, 0.01, 0.001):
            error = whole.rank_error(p)
            answer = whole.quantile(p)
            a, b = np.searchsorted(s, answer, "left") + 1, np.searchsorted(s, answer, "right")
            # ranks beyond the answer, with those of the values that are equal to it
            assert error <= 0.05 * max(n * ((1 - p) if high else p), n - a + 1 if high else b)
            assert a - error - 1 <= p * (n - 1) + 1 <= b + error + 1
            low, high_ = whole.bounds(p)
            assert low <= np.quantile(s, p) <= high_

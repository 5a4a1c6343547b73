import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from statloom.llm import mixing, packing
from tests.helpers import rows


@given(st.lists(st.integers(0, 100), max_size=300), st.integers(1, 8))
def test_best_fit(sizes, k):
    bins = packing.BestFit(100, k)
    used = {}
    for s in sizes:
        b = bins.place(s)
        used[b] = used.get(b, 0) + s
        assert used[b] <= 100 and bins.open <= k
    assert sum(used.values()) == sum(sizes)


def test_fullest_that_fits_and_fullest_closes():
    b = packing.BestFit(10, 2)
    assert [b.place(7), b.place(4)] == [0, 1]
    assert b.place(3) == 0  # fits both; the fuller takes it, and is full
    assert b.place(5) == 1  # free 6 -> 1
    assert b.place(9) == 2
    assert b.place(8) == 3  # 1 and 2 are open with free 1 each; one of them closes
    assert b.open == 2


def test_pack_rows(spark):
    df = spark.createDataFrame([(1, 100), (2, 8000), (3, 8001), (4, 20_000), (5, None), (6, 0), (1, 100), (7, 16_000), (8, -5)], "id long, n int").coalesce(1)
    got = packing.pack(df, "id", F.col("n")).collect()
    by = {}
    for r in got:
        by.setdefault(r["id"], []).append(r)
        assert 0 <= r["tokens"] <= 8000
    assert {k: (len(v), sum(r["tokens"] for r in v)) for k, v in by.items()} == {1: (2, 200), 2: (1, 8000), 3: (2, 8001), 4: (3, 20_000), 5: (1, 0), 6: (1, 0), 7: (2, 16_000), 8: (1, 0)}
    assert sorted(r["piece"] for r in by[4]) == [0, 1, 2] and {r["pieces"] for r in by[4]} == {3}
    fill = {}
    for r in got:
        fill[r["batch"]] = fill.get(r["batch"], 0) + r["tokens"]
    assert max(fill.values()) <= 8000
    assert packing.pack(df.limit(0), "id", F.col("n")).count() == 0


def test_little_room_is_left(spark):
    df = spark.range(20_000).select("id", (F.pmod(F.xxhash64("id"), F.lit(2000)) + 50).alias("n"))
    r = packing.fill_report(packing.pack(df, "id", F.col("n"))).first()
    assert r["items"] == 20_000 and r["mean_fill"] > 0.97 and r["batches"] < 1.03 * r["least_batches"]


def tokens(spark, data):
    return spark.createDataFrame(data, "doc_id long, source string, text string")


def test_mix(spark):
    word = "alpha beta gamma delta "
    docs = tokens(spark, [(i, "Big-Source ", word * 5) for i in range(3000)] + [(5000 + i, "small source", word * 5) for i in range(30)] + [(9000, None, word), (9001, "other", word), (9002, "small_source", None), (9003, "big_source", "")])
    targets = spark.createDataFrame([("big-source", 0.5, 2), ("small-source", 0.49, 3), ("absent", 0.01, 1), (None, 0.0, 1)], "source_name string, weight double, max_repeats int")
    sized = mixing.sized_documents(docs, targets)
    assert sized.count() == 3032 and sized.select("source_name").distinct().count() == 2
    plan = mixing.budgets(sized, targets)
    mixed = mixing.mix(sized, plan)
    rep = {r["source_name"]: r for r in mixing.share_report(mixed, plan).collect()}
    assert {k for k, r in rep.items() if r["short"]} == {"small-source", "absent"}
    per = sized.where("source_name = 'small-source'").agg(F.sum("tokens")).first()[0]
    assert rep["small-source"]["mixed_tokens"] == 3 * per and rep["small-source"]["most_copies"] == 3
    one = sized.where("doc_id = 0").first()["tokens"]
    big = rep["big-source"]
    assert big["budget"] - one < big["mixed_tokens"] <= big["budget"]
    assert sum(r["share"] for r in rep.values()) == pytest.approx(1)
    assert rows(mixed) == rows(mixing.mix(sized, plan))  # the same again
    none = mixing.sized_documents(docs.limit(0), targets)
    assert mixing.mix(none, mixing.budgets(none, targets)).count() == 0
    assert {r["source_name"] for r in mixing.share_report(mixing.mix(none, mixing.budgets(none, targets)), mixing.budgets(none, targets)).where("short").collect()} == set()


def test_whole_epochs_then_a_cut(spark):
    docs = tokens(spark, [(i, "a", "x y z " * 10) for i in range(100)] + [(1000 + i, "b", "x y z " * 10) for i in range(900)])
    targets = spark.createDataFrame([("a", 0.35, 9), ("b", 0.65, 1)], "source_name string, weight double, max_repeats int")
    sized = mixing.sized_documents(docs, targets)
    plan = mixing.budgets(sized, targets)
    copies = mixing.mix(sized, plan).where("source_name = 'a'").groupBy("copies").count().collect()
    assert {r["copies"]: r["count"] for r in copies} == {3: 50, 4: 50}
    assert mixing.mix(sized, plan).where("source_name = 'b'").agg(F.sum("copies")).first()[0] == 650

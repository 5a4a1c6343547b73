"""A third of all rows in one key, source or text: the queries with SQL still give the same rows."""

import pytest

from statloom.llm import leakage, plans
from tests.helpers import same
from tests.test_hot import tables


@pytest.fixture(scope="module")
def hot(spark, tmp_path_factory):
    return tables(spark, tmp_path_factory)


@pytest.mark.parametrize("name", sorted(plans.ORACLES))
def test_hot_key(spark, hot, name):
    same(plans.QUERIES[name](spark, hot[0]), hot[1], plans.ORACLES[name])


def test_copies_all_leak(spark, hot):
    docs = spark.read.parquet(f"{hot[0]}/documents.parquet")
    got = plans.QUERIES["p8_found"](spark, hot[0]).groupBy("doc_id").count()
    for r in docs.where("text is not null").join(got, "doc_id").groupBy("text").agg({"doc_id": "count", "count": "max"}).collect():
        copies = docs.where(docs.text == r["text"]).count()
        assert r["count(doc_id)"] == copies
    assert leakage.WORDS == 13

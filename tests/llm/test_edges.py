"""Training-text queries on tables that are empty, of nulls, partly null, or have further columns."""

import pytest

from statloom.llm import plans
from tests.conftest import DATA
from tests.edge import make
from tests.helpers import norm

QUERIES = plans.QUERIES


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    return {k: make(spark, DATA, str(tmp_path_factory.mktemp(k)), k) for k in ("empty", "nulls", "some_nulls", "clash")}


@pytest.mark.parametrize("kind", ["empty", "nulls", "some_nulls"])
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_runs(spark, tables, name, kind):
    df = QUERIES[name](spark, tables[kind])
    rows = df.collect()
    assert df.columns
    if name.endswith("_found") and kind in ("empty", "nulls"):
        assert rows == []


SAME = sorted(n for n in QUERIES if n != "p3_percentiles")


@pytest.mark.parametrize("name", SAME)
def test_further_columns_change_nothing(spark, tables, name):
    a, b = QUERIES[name](spark, DATA), QUERIES[name](spark, tables["clash"])
    assert a.columns == b.columns
    key = lambda df: sorted(tuple(map(norm, r)) for r in df.collect())
    assert key(a) == key(b)

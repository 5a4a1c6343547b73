"""A third of all rows in one key: the queries with SQL still give the same rows."""

import glob
import os

import duckdb
import pytest

from statloom.plans import registry
from tests.conftest import DATA
from tests.edge import make
from tests.helpers import same

SQL = registry.oracle_sql()


def tables(spark, tmp_path_factory):
    d = make(spark, DATA, str(tmp_path_factory.mktemp("hot")), "hot")
    c = duckdb.connect()
    for p in glob.glob(f"{d}/*.parquet"):
        c.execute(f"create view {os.path.basename(p)[:-8]} as select * from read_parquet('{p}/*.parquet')")
    return d, c


@pytest.fixture(scope="module")
def hot(spark, tmp_path_factory):
    return tables(spark, tmp_path_factory)


KEYED = [n for n in SQL if n.startswith(("merge", "validate", "compare", "issue", "latest", "p", "eta", "group", "top", "score_by", "low", "anti", "upsert", "instance", "heartbeat", "confidence"))]


@pytest.mark.parametrize("name", sorted(KEYED))
def test_hot_key(spark, hot, name):
    same(registry.queries()[name](spark, hot[0]), hot[1], SQL[name])

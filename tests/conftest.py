import glob
import os

import duckdb
import pytest

from statloom.runtime import local_session

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    s = local_session("tests", 4, driver_memory="4g")
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture(scope="session")
def duck():
    c = duckdb.connect()
    for p in glob.glob(f"{DATA}/*.parquet"):
        q = p if os.path.isfile(p) else f"{p}/*.parquet"
        c.execute(f"create view {os.path.basename(p)[:-8]} as select * from read_parquet('{q}')")
    return c

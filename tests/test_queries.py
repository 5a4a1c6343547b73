"""Every registered core query runs; those with SQL give the same rows."""

import pytest

from statloom.plans import registry
from tests.conftest import DATA
from tests.helpers import same

SQL = registry.oracle_sql()


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, duck, name):
    df = registry.queries()[name](spark, DATA)
    if name in SQL:
        same(df, duck, SQL[name])
    else:
        assert df.columns and df.count() >= 0


def test_entry():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())

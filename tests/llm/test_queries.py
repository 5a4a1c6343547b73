"""Every registered query of the subpackage runs; those with SQL give the same rows."""

import pytest

from statloom.llm import plans
from tests.conftest import DATA
from tests.helpers import same


@pytest.mark.parametrize("name", sorted(plans.QUERIES))
def test_query(spark, duck, name):
    df = plans.QUERIES[name](spark, DATA)
    if name in plans.ORACLES:
        same(df, duck, plans.ORACLES[name])
    else:
        assert df.columns and df.count() >= 0

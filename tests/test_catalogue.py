"""Every catalogue query with SQL, against that SQL."""

import pytest
from compare import difference

from phenoloom.plans.catalogue import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equal_to_sql(spark, con, sf, name):
    assert difference(QUERIES[name](spark, sf), con, ORACLES[name]) is None


def test_every_sql_has_a_query():
    assert set(ORACLES) <= set(QUERIES)

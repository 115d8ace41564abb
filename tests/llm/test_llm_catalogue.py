import pytest
from compare import difference

from phenoloom.llm.catalogue import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equal_to_sql(spark, con, sf, name):
    assert difference(QUERIES[name](spark, sf), con, ORACLES[name]) is None


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14)) and set(ORACLES) <= set(QUERIES)

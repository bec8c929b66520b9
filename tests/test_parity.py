"""Every acceptance query against its SQL twin at the smallest scale."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.parity import difference, oracle

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle(SF)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, con, name):
    fn = queries()[name]
    if name in oracle_sql():
        assert difference(spark, con, fn, oracle_sql()[name], SF) is None
    else:
        assert fn(spark, SF).collect()


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["customer_id", "first_order", "most_recent_order", "number_of_orders"] and df.count() > 0

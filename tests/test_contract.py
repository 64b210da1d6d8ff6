import pytest

import __spark_entry__ as contract
from check_oracle import compare, duck

FOLDER = "/root/testdata/sf0.001"


def test_flagship(spark):
    rows = contract.entry(spark)
    assert rows.columns == ["symbol", "mean_price", "stddev_price", "cv_pct", "n_ticks"]
    assert rows.count() == 5


def test_every_sql_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", list(contract.queries()))
def test_query_agrees_with_sql(spark, name):
    verdict = compare(spark, duck(FOLDER), name, FOLDER)
    assert verdict.startswith("ok" if name in contract.oracle_sql() else "rows only"), verdict

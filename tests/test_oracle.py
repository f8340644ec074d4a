"""Every catalog query against its DuckDB SQL (sf 0.001), compared like the driver."""

import pytest

from lapse.plans.catalog import oracle_sql, queries
from tests.conftest import SF001
from tools.oracle_check import canon, duck


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_matches_oracle(spark, con, name):
    sql = oracle_sql().get(name)
    got = queries()[name](spark, SF001).toPandas()
    if sql is None:
        pytest.skip("no SQL form")
    exp = con.execute(sql).fetchdf()
    cs, rs = canon(got)
    ce, re_ = canon(exp)
    assert cs == ce
    assert len(rs) == len(re_)
    assert rs == re_


def test_entry_smoke(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.count() >= 0 and "inactive_next_60d" in df.columns
    assert set(e.oracle_sql()) <= set(e.queries())

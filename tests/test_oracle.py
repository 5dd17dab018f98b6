"""Every registered query against its SQL twin, on the small tables."""

import duckdb  # noqa: F401
import pytest
from oracle_compare import compare, connect

from agorakit.plans import registry

registry.load_all()


@pytest.fixture(scope="module")
def con(small):
    return connect(small)


@pytest.mark.parametrize("name", list(registry.QUERIES))
def test_query(name, spark, small, con):
    df = registry.QUERIES[name](spark, small)
    sql = registry.SQL.get(name)
    if sql is None:
        assert df.columns and df.count() > 0
    else:
        assert compare(df, con, sql) is None


def test_entry_contract(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.entry(spark).columns) == 9


def test_comparison_sees_differences(spark, small, con):
    df = registry.QUERIES["kpi_totals"](spark, small)
    sql = registry.SQL["kpi_totals"]
    assert compare(df, con, sql.replace("count(*) AS total_orders", "count(*) + 1 AS total_orders"))
    assert compare(df, con, sql.replace("count(*) AS total_orders", "count(*)::DOUBLE AS total_orders"))

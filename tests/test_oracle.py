"""Every registered query equals its DuckDB oracle on the sf0.001 tables,
and its executed plan holds no operator that cannot scale out."""

import pytest

from conftest import SF0001

from __spark_entry__ import oracle_sql, queries
from marquee.plans.verify import check, duck_connection, plan_findings

from marquee.plans.catalog import QUERIES

KEYS = sorted(QUERIES)


@pytest.fixture(scope="module")
def duck():
    return duck_connection(SF0001)


def test_every_query_has_oracle_sql():
    assert set(KEYS) <= set(oracle_sql()) & set(queries())


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, duck, key):
    built = {}

    def query(s, sf):
        built["df"] = queries()[key](s, sf)
        return built["df"]

    res = check(spark, duck, SF0001, key, query, oracle_sql()[key])
    assert res["status"] == "ok", res
    assert plan_findings(built["df"]) == [], key
    spark.catalog.clearCache()


def test_entry_runs(spark):
    from __spark_entry__ import entry
    df = entry(spark)
    assert df.columns == ["cohort_date"] + [f"day_{k}" for k in range(8)]
    assert df.count() >= 0

"""The llm queries that SQL can express equal their DuckDB SQL on a whole table."""

import pytest

from llm_cases import SF001, llm_spark  # noqa: F401
from marquee.llm.oracle import ORACLE
from marquee.llm.queries import QUERIES
from marquee.plans.verify import check, duck_connection


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_query_matches_oracle(llm_spark, key):
    res = check(llm_spark, duck_connection(SF001), SF001, key, QUERIES[key], ORACLE[key])
    assert res["status"] == "ok", res

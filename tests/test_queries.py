"""Every registered query against the same query in SQL, on the smallest tables."""

from __future__ import annotations

import compare
import pytest

from clearledger.workload.oracles import ORACLES
from clearledger.workload.queries import QUERIES


@pytest.fixture(scope="module")
def con(small):
    return compare.connect(small)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, small, con, name):
    assert compare.spark_result(QUERIES[name](spark, small)) == compare.sql_result(
        con, ORACLES[name]
    )

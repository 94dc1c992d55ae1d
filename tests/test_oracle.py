"""Every registered query with an oracle equals its DuckDB SQL (rows, column
names, multiset of values) on the small tables."""

import pytest

from inputs import SF_SMALL
from fmspark.plans.oracle_sql import ORACLES
from fmspark.plans.queries import QUERIES
from oracle_check import compare, duck


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(spark, name, SF_SMALL, con)
    assert ok, msg


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry_contract(spark):
    import importlib.util
    import os
    p = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "__spark_entry__.py")
    spec = importlib.util.spec_from_file_location("spark_entry", p)
    m = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(m)
    df = m.entry(spark)
    assert df.count() > 0
    assert df.columns == ["order_id", "pos", "idx", "val"]
    assert set(m.oracle_sql()) <= set(m.queries())

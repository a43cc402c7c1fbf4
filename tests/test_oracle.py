"""Every query with an oracle equals its DuckDB statement (sf0.01 by
default; RATINGFLOW_ORACLE_SF overrides)."""

import os

import pytest

import __spark_entry__ as entry
from ratingflow.plans.queries import ORACLE as RATING_ORACLE
from tests.conftest import duck
from tests.oracle_compare import compare

SF = os.environ.get("RATINGFLOW_ORACLE_SF", "/root/testdata/sf0.01")
QUERIES = entry.queries()
# the text operators' queries have tests of their own
ORACLE = {n: q for n, q in entry.oracle_sql().items() if n in RATING_ORACLE}


@pytest.fixture(scope="module")
def con():
    c = duck(SF)
    yield c
    c.close()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF)
    problems, n = compare(df, con, ORACLE[name])
    assert not problems, f"{name}: {problems}"


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)

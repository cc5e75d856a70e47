"""Every registered query against its DuckDB oracle on the sf0.001 tables."""
import os

import pytest

import __spark_entry__ as ent
from cabflow.plans.check import digest, oracle_rows
from cabflow.plans.driver import QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def test_entry_smoke(spark):
    df = ent.entry(spark)
    assert df.columns == ["window_start", "user_id", "tips"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, name):
    df = ent.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    ocols, orows = oracle_rows(SF, ent.oracle_sql()[name])
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows) == digest(ocols, orows)


def test_every_query_has_oracle():
    assert set(QUERIES) <= set(ent.oracle_sql())

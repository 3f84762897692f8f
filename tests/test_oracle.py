"""Every registered query against its DuckDB oracle on sf0.01 (the driver's correctness gate)."""

import pytest

import __spark_entry__ as E
from conftest import SF_ORACLE
from compare import assert_same
from fleetlens.plans.catalog import ORACLE, QUERIES


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    sdf = QUERIES[name](spark, SF_ORACLE).toPandas()
    assert name in ORACLE, "every query here has an oracle"
    odf = duck.execute(ORACLE[name]).df()
    assert_same(sdf, odf)


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert set(df.columns) == {"decision", "count"}

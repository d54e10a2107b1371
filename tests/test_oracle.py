"""Every registered query with a SQL twin equals DuckDB on sf0.001."""

import os
import sys

import pytest

from conftest import ROOT, SF_SMALL

sys.path.insert(0, os.path.join(ROOT, "tools"))

import __spark_entry__ as E  # noqa: E402
from oracle_check import compare  # noqa: E402

from orchard.catalog import QUERIES  # noqa: E402

# The training-data queries have their own tests in tests/llm.
EXACT = sorted(set(E.oracle_sql()) & set(QUERIES))


@pytest.mark.parametrize("name", EXACT)
def test_query_matches_sql(spark, duck, name):
    sdf = E.queries()[name](spark, SF_SMALL).toPandas()
    ddf = duck.execute(E.oracle_sql()[name]).df()
    sdf = sdf.astype(object).where(sdf.notna(), None)
    ddf = ddf.astype(object).where(ddf.notna(), None)
    assert compare(sdf, ddf) is None


def test_every_query_has_a_callable():
    qs = E.queries()
    assert set(E.oracle_sql()) <= set(qs)
    assert set(QUERIES) <= set(E.oracle_sql())  # every query has a twin


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 10
    assert set(df.columns) == {"model", "node_id", "n_rows", "rmse", "mae", "r2"}

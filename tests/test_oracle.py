"""Every registered query against its DuckDB oracle text (sf0.01)."""

import os
import re
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "scripts"))

import __spark_entry__ as se  # noqa: E402
from compare import canon, duck  # noqa: E402

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    """The library's own queries; those of the optional subpackage are tested beside it."""
    optional = {n for n in se.queries() if re.match(r"op\d+_|pipeline$", n)}
    assert set(se.queries()) - optional == set(se.oracle_sql()) - optional


@pytest.mark.parametrize("name", sorted(se.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = se.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    rel = con.sql(se.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert canon(df.columns, rows) == canon(rel.columns, rel.fetchall())


def test_entry_runs(spark):
    df = se.entry(spark)
    assert df.count() > 0

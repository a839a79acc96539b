"""Every checked query against its SQL twin on the smallest tables."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "scripts"))

import __spark_entry__ as E  # noqa: E402
from oracle_check import TABLES, digest  # noqa: E402
from type_check import SPARK_TO_DUCK  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return c


# Fingerprints, token ids and models can't be expressed in SQL: tests/llm has slow versions of these.
OWN = {n for n in E.queries() if n == "pipeline" or n.startswith("op")}


def test_every_query_has_sql():
    missing = set(E.queries()) - set(E.oracle_sql()) - OWN
    assert not missing, missing


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["product_id", "title", "frequency", "reason"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_sql(name, spark, con):
    df = E.queries()[name](spark, SF)
    rows, cols = [tuple(r) for r in df.collect()], df.columns
    rel = con.sql(E.oracle_sql()[name])
    types = {c.lower(): str(t) for c, t in zip(rel.columns, rel.types)}
    for f in df.schema:
        t = f.dataType.simpleString()
        assert SPARK_TO_DUCK.get(t, t) == types[f.name.lower()], (f.name, t, types[f.name.lower()])
    ocols, orows = rel.columns, rel.fetchall()
    assert sorted(cols) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(cols, rows) == digest(ocols, orows)

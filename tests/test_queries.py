"""Every registered query against its SQL on the same tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from rastertable import catalog

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()
QUERIES, SQL = catalog.queries(), catalog.oracle_sql()
TYPES = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


# The smallest scale at which no query is empty.
QUERY_DIR = os.environ.get("TEST_QUERY_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{QUERY_DIR}/{t}.parquet'")
    yield con
    con.close()


def key(row):
    return tuple((v is None, 0 if v is None else v) for v in row)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, QUERY_DIR)
    cols = sorted(df.columns)
    rel = duck.sql(SQL[name])
    assert cols == sorted(rel.columns)
    types = dict(zip(rel.columns, map(str, rel.types)))
    assert {c: TYPES[t] for c, t in df.dtypes} == types
    ours = sorted((tuple(r) for r in df.select(*cols).collect()), key=key)
    theirs = sorted(rel.select(*cols).fetchall(), key=key)
    assert len(ours) > 0
    assert ours == theirs


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert len(rows) == 46
    assert all(-1 <= r.mean_ndvi <= 1 and 0 <= r.masked_cells <= 64 for r in rows)


def test_fixture_checksums(spark, sf_dir):
    """Known sums of the two rasters at the smallest scale."""
    if not sf_dir.endswith("sf0.001"):
        pytest.skip("sums are for sf0.001")
    from pyspark.sql import functions as F

    from rastertable.catalog import fixtures as X

    px = X.px_pixels(spark, sf_dir).agg(F.count("*"), F.sum("dn")).first()
    assert tuple(px) == (31632, 3991710)
    lp = X.lp_pixels(spark, sf_dir).agg(F.count("*"), *[F.sum(f"b{k}") for k in range(4)]).first()
    assert tuple(lp) == (5906, 150487, 720060, 299490, 782622)

"""Queries against their SQL checks on the smallest data.

A quick selection runs by default; ``ALL_QUERIES=1`` runs every query.
"""

import os

import duckdb
import pytest

import __spark_entry__ as contract
from conftest import DATA
from workload.views import TABLES

QUICK = (
    "grid_hex tile_windows tile_mask crop_roi assign_square_x2 assign_circle per_spot contour_shape contour_raster "
    "stain_od lasso2 color_shift median_normalise read_class pileup snv_baf splice_counts matrix_ordinals knn hvg "
    "object_boxes neighbour_counts file_mtx file_fastq file_publish"
).split()


def canonical(value):
    if value is None or (isinstance(value, float) and value != value):
        return "NULL"
    return repr(value + 0.0) if isinstance(value, float) else repr(value)


def names():
    return sorted(contract.queries()) if os.environ.get("ALL_QUERIES") else QUICK


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", names())
def test_query(spark, duck, name):
    df = contract.queries()[name](spark, DATA)
    order = sorted(df.columns)
    rows = sorted(tuple(canonical(r[c]) for c in order) for r in df.collect())
    assert rows
    text = contract.oracle_sql().get(name)
    if text is None:
        return
    cur = duck.execute(text)
    cols = [c[0] for c in cur.description]
    assert sorted(cols) == order
    at = [cols.index(c) for c in order]
    assert rows == sorted(tuple(canonical(r[i]) for i in at) for r in cur.fetchall())


def test_entry(spark):
    df = contract.entry(spark)
    assert df.count() > 0 and "count_neoplasia" in df.columns


def test_checks_belong_to_queries():
    assert set(contract.oracle_sql()) <= set(contract.queries())

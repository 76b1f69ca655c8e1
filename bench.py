"""Headline queries, timed end to end; prints one JSON line.

``BENCH_SF_DIR`` names the data folder, ``BENCH_CPUS`` the local cores. With
``BENCH_SQL=1`` the SQL checks are timed as well and added as ``sql``.
"""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

HEADLINE = (
    "grid_hex",
    "tile_mask",
    "assign_square_x2",
    "per_spot",
    "contour_shape",
    "contour_raster",
    "stain_cov",
    "max_concentration",
    "median_normalise",
    "expand_labels",
    "kmer_index_documents",
    "read_class",
    "umi_counts",
    "pileup",
    "snv_baf",
    "splice_counts",
    "matrix_ordinals",
    "hvg",
    "knn",
    "object_rank",
    "neighbour_counts",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES", " ".join(HEADLINE)).split()
    os.environ.setdefault("PYSPARK_SUBMIT_ARGS", "--driver-memory 12g pyspark-shell")

    from tissueframe.session import build_session
    from workload import catalogue

    spark = build_session("bench", f"local[{cpus}]", int(cpus))
    spark.sparkContext.setLogLevel("ERROR")
    queries, checks = catalogue.queries(), catalogue.checks()
    spark.read.parquet(f"{folder}/region.parquet").count()

    seconds, sql = {}, {}
    for name in chosen:
        start = time.perf_counter()
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    if os.environ.get("BENCH_SQL"):
        import duckdb

        con = duckdb.connect()
        con.execute(f"SET threads = {cpus}")
        from workload.views import TABLES

        for t in TABLES:
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
        for name in chosen:
            if name in checks:
                start = time.perf_counter()
                con.execute(f"CREATE OR REPLACE TEMP TABLE out AS {checks[name]}")
                sql[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    line = {"metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": os.path.basename(folder.rstrip("/"))}
    if sql:
        line["sql"] = sql
    print(json.dumps(line))


if __name__ == "__main__":
    main()

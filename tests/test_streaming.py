import importlib

from tissueframe.streaming import MAP_ONLY

ROWS = {
    "pixels": ("sample string, x int, y int, r int, g int, b int", [("s", 4, 0, 150, 150, 150), ("s", 1, 1, 10, 10, 10)]),
    "grid": ("sample string, barcode string, in_tissue int", [("s", "a", 1), ("s", "b", 0)]),
    "nuclei": (
        "sample string, ids string, centroid array<double>, contour array<array<int>>, type int, type_prob double, cell_type int, cell_type_prob double",
        [("s", "1", [1.0, 1.0], [[0, 0], [2, 0], [2, 2]], 1, 0.9, 1, 0.5)],
    ),
}
ARGS = {"stride_downsample": (4,), "patch_index": (2,)}


def test_map_only_operators_run_on_a_stream(spark, tmp_path):
    for number, name in enumerate(MAP_ONLY):
        module, fn = name.split(".")
        kind = {"raster": "pixels", "grid": "grid", "nuclei": "nuclei"}[module]
        schema, rows = ROWS[kind]
        batch = spark.createDataFrame(rows, schema)
        if fn == "relabel_low_prob":
            batch = batch.withColumn("cell_type", batch.cell_type.cast("string"))
        folder = str(tmp_path / kind / fn)
        batch.write.parquet(folder)
        operator = getattr(importlib.import_module(f"tissueframe.operators.{module}"), fn)
        stream = operator(spark.readStream.schema(batch.schema).parquet(folder), *ARGS.get(fn, ()))
        query = stream.writeStream.format("memory").queryName(f"out{number}").trigger(availableNow=True).start()
        query.awaitTermination()
        expected = operator(batch, *ARGS.get(fn, ()))
        assert sorted(map(str, spark.table(f"out{number}").collect())) == sorted(map(str, expected.collect()))

"""Operators that may be applied to a streaming DataFrame.

There is no event time, window or state in this domain, so the package adds no
streaming operator of its own. The operators named below are map-only (no
shuffle, no second input) and therefore run unchanged on ``readStream`` input;
``tests/test_streaming.py`` drives each of them through a micro-batch.
"""

MAP_ONLY = (
    "raster.pixel_mask",
    "raster.stride_downsample",
    "raster.patch_index",
    "raster.foreground",
    "grid.in_tissue",
    "nuclei.label_cell_types",
    "nuclei.relabel_low_prob",
    "nuclei.measure_nuclei",
)

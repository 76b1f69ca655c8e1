"""Schemas of the tables and files, and the parameter defaults."""

from pyspark.sql import types as T

SAMPLESHEET = "sample STRING, fastq STRING, image STRING, grid STRING, roifile STRING, mpp DOUBLE"
POSITIONS = (
    "barcode STRING, in_tissue INT, array_row INT, array_col INT, "
    "pxl_row_in_fullres INT, pxl_col_in_fullres INT"
)
GRID_INFO = (
    "spot_diameter_fullres DOUBLE, x INT, y INT, tissue_lowres_scalef DOUBLE, grid_type STRING, "
    "factor DOUBLE, magnification DOUBLE, resolution DOUBLE, aspect_correction DOUBLE, "
    "spot_diamter DOUBLE, spot_horizontal_spacing DOUBLE"
)
ROI = T.MapType(
    T.StringType(),
    T.StructType([T.StructField("location", T.DoubleType()), T.StructField("size", T.DoubleType())]),
)
NUCLEUS = "centroid ARRAY<DOUBLE>, contour ARRAY<ARRAY<INT>>, type_prob DOUBLE, type INT"
NUCLEI_JSON = f"mag INT, nuc MAP<STRING, STRUCT<centroid: ARRAY<DOUBLE>, contour: ARRAY<ARRAY<INT>>, type_prob: DOUBLE, type: INT>>"
READS = "read_id STRING, seq STRING, qual STRING"
CONTIG_CHUNK = "name STRING, offset BIGINT, seq STRING"

OBS_COLUMNS = (
    "barcode",
    "in_tissue",
    "array_row",
    "array_col",
    "pxl_row_in_fullres",
    "pxl_col_in_fullres",
)

# Cell classes by code.
CELL_CLASSES = {
    0: "no_label",
    1: "neoplasia",
    2: "inflammatory",
    3: "connective",
    4: "necrosis",
    5: "no_neoplasia",
}
QUANTITIES = ("perimeter_length", "area", "orientation", "eccentricity", "cell_type_prob")

# Stain rows used when a patch has no stain of its own.
DEFAULT_STAIN = (
    (0.58698897, 0.4946145, 0.64093716),
    (0.54270283, 0.40882776, 0.73371214),
)

# Parameter defaults.
DEFAULTS = {
    "target_mpp": 0.25,
    "thumbnail_downsample_factor": 0.05,
    "mask_background_cutoff": 210.0,
    "pixel_mask_low": 100.0,
    "pixel_mask_high": 200.0,
    "use_provided_grid": True,
    "grid_type": "square",
    "grid_spot_diameter": 56.0,
    "grid_spot_horizontal_spacing": 56.0,
    "grid_aspect_correction": 0.95,
    "fraction_for_mask": 0.1,
    "expansion_factors": (1, 2, 3, 4),
    "stain_patch_size": 512,
    "assignment_factor": 1,
    "assignment_shape": "square",
    "min_cell_type_prob": 0.75,
    "superpixel_compactness": 1,
    "pixels_per_segment": 10000,
    "superpixel_patch_size": 2048,
    "superpixel_downsampling_factor": 4,
    "od_block_size": 4096,
    "expand_nuclei_distance": 15,
    "tiles_per_slide": 100,
    "kmer_size": 35,
    "min_mapping_quality": 50,
    "min_base_quality": 0,
    "min_coverage": 20,
    "min_minor_coverage": 4,
    "min_maf": 0.1,
}

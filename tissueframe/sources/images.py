"""Small images as slide properties, blocks and pixels."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tissueframe.functions.scalar import sample_of_path


def read_image_meta(spark: SparkSession, path: str) -> DataFrame:
    """Width, height and channels per image."""
    raw = spark.read.format("image").option("dropInvalid", True).load(path)
    return raw.select(
        sample_of_path(F.col("image.origin")).alias("sample"),
        F.col("image.width").alias("width"),
        F.col("image.height").alias("height"),
        F.col("image.nChannels").alias("channels"),
    )


def read_image_blocks(spark: SparkSession, path: str, size: int = 256) -> DataFrame:
    """RGB blocks ``sample, bx, by, x0, y0, w, h, data`` of thumbnails and small images."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import numpy as np

        for frame in batches:
            for im in frame.itertuples(index=False):
                raster = np.frombuffer(im.data, dtype=np.uint8).reshape(im.height, im.width, im.channels)
                # The image source stores blue first; one channel means grey.
                rgb = np.repeat(raster, 3, axis=2) if im.channels == 1 else raster[:, :, 2::-1]
                for y0 in range(0, im.height, size):
                    rows = []
                    for x0 in range(0, im.width, size):
                        piece = rgb[y0 : y0 + size, x0 : x0 + size]
                        rows.append(
                            (im.sample, x0 // size, y0 // size, x0, y0, piece.shape[1], piece.shape[0], piece.tobytes())
                        )
                    yield pd.DataFrame(rows, columns=["sample", "bx", "by", "x0", "y0", "w", "h", "data"])

    raw = spark.read.format("image").option("dropInvalid", True).load(path)
    flat = raw.select(
        sample_of_path(F.col("image.origin")).alias("sample"),
        F.col("image.width").alias("width"),
        F.col("image.height").alias("height"),
        F.col("image.nChannels").alias("channels"),
        F.col("image.data").alias("data"),
    )
    return flat.mapInPandas(cut, "sample string, bx int, by int, x0 int, y0 int, w int, h int, data binary")


def write_images(blocks: DataFrame, path: str) -> None:
    """One bitmap file per sample from its RGB blocks, in folders ``sample=..``.

    Cells that no block covers stay white. A file is one image, so one task puts
    it together: meant for thumbnails and small images, as the reader is. The
    bytes go through Spark's text sink, which writes a row as it is; the
    line end behind the image is not read by decoders.
    """

    def encode(frame: pd.DataFrame) -> pd.DataFrame:
        import struct

        import numpy as np

        width = int((frame["x0"] + frame["w"]).max())
        height = int((frame["y0"] + frame["h"]).max())
        raster = np.full((height, width, 3), 255, dtype=np.uint8)
        for b in frame.itertuples(index=False):
            raster[b.y0 : b.y0 + b.h, b.x0 : b.x0 + b.w] = np.frombuffer(b.data, dtype=np.uint8).reshape(b.h, b.w, 3)
        # Bitmaps hold blue first, the last row first, and rows padded to four bytes.
        rows = np.pad(raster[::-1, :, ::-1].reshape(height, -1), ((0, 0), (0, -3 * width % 4)))
        info = struct.pack("<IiiHHIIiiII", 40, width, height, 1, 24, 0, rows.size, 2835, 2835, 0, 0)
        head = struct.pack("<2sIHHI", b"BM", 14 + len(info) + rows.size, 0, 0, 14 + len(info))
        return pd.DataFrame({"sample": [frame["sample"].iloc[0]], "data": [head + info + rows.tobytes()]})

    parts = int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kind = dict(blocks.dtypes)["sample"]
    dealt = blocks.select("sample", "x0", "y0", "w", "h", "data").repartition(parts, "sample")
    files = dealt.groupBy("sample").applyInPandas(encode, f"sample {kind}, data binary")
    files.select("sample", F.col("data").cast("string").alias("value")).write.partitionBy("sample").mode("overwrite").text(path)

"""Pixel tables in Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumagrid.functions.pixel import change_extension

# What of one image is kept together when it is written: at most 8 million pixels.
BLOCK_LINES, BLOCK_COLUMNS = 2048, 4096

HDR_SCHEMA = T.StructType(
    [
        T.StructField("image_id", T.IntegerType()),
        T.StructField("y", T.IntegerType()),
        T.StructField("x", T.IntegerType()),
        T.StructField("b", T.FloatType()),
        T.StructField("g", T.FloatType()),
        T.StructField("r", T.FloatType()),
    ]
)


def load_hdr_pixels(
    spark: SparkSession, path: str, schema: T.StructType = HDR_SCHEMA
) -> DataFrame:
    """Float pixels with a declared schema, so that no file is read to infer one."""
    return spark.read.schema(schema).parquet(path)


def write_pixels(pixels: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Pixels in image order; row group statistics let readers skip other images."""
    _in_order(pixels, "image_id").write.mode(mode).parquet(path)


def write_ldr(
    pixels: DataFrame,
    path: str,
    name: str | None = None,
    extension: str = ".png",
    mode: str = "overwrite",
) -> None:
    """8-bit results with one folder per image, named after the image's new file name.

    ``name`` is the column with the source file's name; without it folders are
    named by ``image_id``.
    """
    if name is None:
        _in_order(pixels, "image_id").write.mode(mode).partitionBy("image_id").parquet(path)
        return
    named = pixels.withColumn("file", change_extension(F.col(name), extension))
    if name != "image_id":
        named = named.drop(name)
    _in_order(named, "file").write.mode(mode).partitionBy("file").parquet(path)


def _in_order(pixels: DataFrame, image: str) -> DataFrame:
    """Images sorted, an ordinary one in one place, a large one spread over blocks."""
    block = [F.floor(F.col("y") / BLOCK_LINES), F.floor(F.col("x") / BLOCK_COLUMNS)]
    return pixels.repartition(image, *block).sortWithinPartitions(image, "y", "x")

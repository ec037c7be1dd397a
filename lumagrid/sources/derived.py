"""Pixels, matrices and run tables derived from the given Parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumagrid.functions.pixel import bgr_to_gray, clamp8
from lumagrid.functions.timing import speedup
from lumagrid.operators.ordering import position_in_group

# Low bits of a key that a ranking block spans; a vector id occurs once.
_VECTOR_BITS = 16
_ORDER_BITS = 14


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def hdr_pixels(spark: SparkSession, sf_dir: str, placed: bool = True) -> DataFrame:
    """Float pixels: an image per label, a line per vector, a pixel per three elements.

    Channels that the last pixel of a line lacks are 0.

    Without ``placed`` the lines are not numbered (no ``y``), which statistics
    over an image do not need.
    """
    lines = table(spark, sf_dir, "embeddings").select(
        F.col("label").alias("image_id"), "vec_id", "embedding"
    )
    if placed:
        lines = position_in_group(
            lines, "image_id", F.shiftright("vec_id", _VECTOR_BITS), ["vec_id"], "y"
        )
    last = F.ceil(F.size("embedding") / 3).cast("int") - 1
    cells = lines.drop("vec_id").where(F.size("embedding") > 0)
    cells = cells.withColumn("x", F.explode(F.sequence(F.lit(0), last)))
    return cells.select(
        "image_id",
        *(["y"] if placed else []),
        "x",
        *[
            F.coalesce(F.abs(F.get("embedding", F.col("x") * 3 + k).cast("double")) * 10, F.lit(0.0)).alias(c)
            for k, c in enumerate("bgr")
        ],
    )


def big_pixels(spark: SparkSession, sf_dir: str, placed: bool = True) -> DataFrame:
    """Float pixels: an image per supplier, a pixel per line item, 25 pixels per line.

    Without ``placed`` the pixels have no ``y`` and ``x``.
    """
    items = table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").cast("int").alias("image_id"),
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        (F.col("l_quantity") / 10).alias("b"),
        (F.col("l_extendedprice") / 10000).alias("g"),
        (F.col("l_tax") * 100).alias("r"),
    )
    if not placed:
        return items.select("image_id", "b", "g", "r")
    order = ["l_orderkey", "l_linenumber", "l_partkey"]
    placed_items = position_in_group(
        items, "image_id", F.shiftright("l_orderkey", _ORDER_BITS), order, "i"
    )
    return placed_items.select(
        "image_id",
        F.floor(F.col("i") / 25).alias("y"),
        F.pmod("i", F.lit(25)).cast("int").alias("x"),
        "b",
        "g",
        "r",
    )


def ldr_pixels(pixels: DataFrame) -> DataFrame:
    """8-bit colour pixels made from float pixels."""
    return pixels.select(
        "image_id", "y", "x", *[clamp8(F.floor(F.col(c) * 40)).cast("int").alias(c) for c in "bgr"]
    )


def gray_pixels(pixels: DataFrame) -> DataFrame:
    """8-bit gray pixels made from float pixels."""
    return ldr_pixels(pixels).select("image_id", "y", "x", bgr_to_gray().alias("g"))


def entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The embeddings as a matrix: a row per vector."""
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("i"), F.posexplode("embedding").alias("j", "v")
    ).select("i", F.col("j").cast("bigint").alias("j"), F.col("v").cast("double").alias("v"))


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run table: a section per event type, a run per event."""
    factor = (F.col("user_id") % 7 + 1).cast("double")
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("section"),
        F.col("event_id").alias("iteration"),
        F.col("value").alias("serial"),
        (F.col("value") / factor).alias("variant"),
        factor.alias("factor"),
    ).withColumn("ratio", speedup(F.col("serial"), F.col("variant")))


def dispatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch log: operator, file, seconds and worker of every event."""
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("operator"),
        F.concat(F.lit("test"), F.col("event_id"), F.lit(".exr")).alias("file"),
        F.col("value").alias("seconds"),
        (F.col("user_id") % 3).cast("int").alias("worker"),
    )

"""Operators on pixel tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumagrid.functions.pixel import in_bounds, luminance
from lumagrid.operators.lookup import attach

IMAGE = "image_id"


def with_luminance(pixels: DataFrame, out: str = "lum") -> DataFrame:
    return pixels.withColumn(out, luminance())


def luminance_level(bins_per_unit: int | None = None) -> Column:
    """Luminance as a histogram key: the 32-bit value, or the nearest of the given bins."""
    if bins_per_unit is None:
        return luminance().cast("float").cast("double")
    return F.rint(luminance() * bins_per_unit) / bins_per_unit


def max_luminance(pixels: DataFrame) -> DataFrame:
    """One row per image: largest luminance (NaN pixels left out) and number of pixels."""
    lum = luminance()
    return pixels.groupBy(IMAGE).agg(
        F.max(F.when(~F.isnan(lum), lum)).alias("lum_max"),
        F.count(F.lit(1)).alias("n_pixels"),
    )


def dimensions(pixels: DataFrame) -> DataFrame:
    """One row per image: height, width and number of pixels."""
    return pixels.groupBy(IMAGE).agg(
        (F.max("y") + 1).alias("height"),
        (F.max("x") + 1).alias("width"),
        F.count(F.lit(1)).alias("n_pixels"),
    )


def with_dimensions(pixels: DataFrame) -> DataFrame:
    """Pixels with their image's height and width."""
    return attach(pixels, dimensions(pixels), [IMAGE], weight="n_pixels").drop("n_pixels")


def luminance_histogram(pixels: DataFrame, bins_per_unit: int | None = None) -> DataFrame:
    """Pixels per image and luminance level."""
    return (
        pixels.select(IMAGE, luminance_level(bins_per_unit).alias("lum"))
        .groupBy(IMAGE, "lum")
        .agg(F.count(F.lit(1)).alias("n_pixels"))
    )


def hist_lookup(pixels: DataFrame, hist: DataFrame) -> DataFrame:
    """Pixels (with a ``lum`` column) with their level's count; NULL where it is absent."""
    return attach(pixels, hist, [IMAGE, "lum"], weight="n_pixels", how="left")


def crop(pixels: DataFrame, height: int, width: int) -> DataFrame:
    return pixels.where(in_bounds("y", "x", F.lit(height), F.lit(width)))


def shift(pixels: DataFrame, dy: int, dx: int) -> DataFrame:
    """Pixels moved by (dy, dx); those that leave their image are dropped."""
    moved = (
        with_dimensions(pixels).withColumn("y", F.col("y") + dy).withColumn("x", F.col("x") + dx)
    )
    return moved.where(in_bounds("y", "x", F.col("height"), F.col("width"))).drop(
        "height", "width"
    )


def explode_raster(
    rasters: DataFrame, data: str, width: Column | int, channels: tuple[str, ...] = ("b", "g", "r")
) -> DataFrame:
    """Row-major, channel-interleaved arrays to one row per pixel.

    Other columns are kept; ``y0`` and ``x0``, if present, are where the array begins in its image,
    and ``offsets``, where it is not NULL, how far from there along the line each pixel
    lies (as ``pack_raster`` writes them). Channels that the last pixel of an array lacks
    are NULL; an empty or NULL array has no pixel.
    """
    n = len(channels)
    width = F.lit(width) if isinstance(width, int) else width
    keep = [c for c in rasters.columns if c not in (data, "y0", "x0", "offsets")]
    y0 = F.col("y0") if "y0" in rasters.columns else F.lit(0)
    x0 = F.col("x0") if "x0" in rasters.columns else F.lit(0)
    last = F.ceil(F.size(data) / n).cast("int") - 1
    cells = rasters.where(F.size(data) > 0).withColumn("_i", F.explode(F.sequence(F.lit(0), last)))
    at = F.col("_i")
    if "offsets" in rasters.columns:
        at = F.coalesce(F.get("offsets", F.col("_i")), at)
    cells = cells.withColumn("_at", at)
    row = F.floor(F.col("_at") / width).cast("int")
    return cells.select(
        *keep,
        (y0 + row).alias("y"),
        (x0 + F.col("_at") - row * width).alias("x"),
        *[F.get(data, F.col("_i") * n + k).alias(c) for k, c in enumerate(channels)],
    )


def pack_raster(
    pixels: DataFrame, channels: tuple[str, ...] = ("b", "g", "r"), run: int = 4096
) -> DataFrame:
    """Pixels to arrays: one row per image line, cut every ``run`` columns.

    ``x0`` is the first pixel of an array. ``offsets`` are the distances of its pixels from there, or
    NULL if they follow one another, so pixels that an image lacks cost nothing where there are none.
    An image is never gathered whole; an array holds at most ``run`` pixels.
    """
    packed = (
        pixels.withColumn("_part", F.floor(F.col("x") / run))
        .groupBy(IMAGE, F.col("y").alias("y0"), "_part")
        .agg(F.array_sort(F.collect_list(F.struct("x", *channels))).alias("_run"))
    )
    first, last = F.get("_run", F.lit(0))["x"], F.element_at("_run", -1)["x"]
    offsets = F.transform("_run", lambda p: (p["x"] - first).cast("int"))
    return packed.select(
        IMAGE,
        "y0",
        first.cast("int").alias("x0"),
        F.flatten(
            F.transform("_run", lambda p: F.array(*[p.getField(c) for c in channels]))
        ).alias("data"),
        F.when(last - first + 1 > F.size("_run"), offsets).alias("offsets"),
    )

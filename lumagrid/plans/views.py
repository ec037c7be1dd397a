"""Results as temporary views, for use from SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumagrid.functions import pixel
from lumagrid.operators import raster
from lumagrid.plans.edges import edge_map
from lumagrid.plans.tonemap import CURVES, gamma_image, tone_map


def register_float_views(pixels: DataFrame, prefix: str = "") -> list[str]:
    """Views over float pixels: luminance, maxima, and one per tone mapping operator."""
    at, lit = [raster.IMAGE, "y", "x"], raster.with_luminance(pixels)
    views = {
        "luminance": lit,
        "max_luminance": raster.max_luminance(pixels),
        "gamma_per_channel": gamma_image(pixels),
        "quantize_8bit": pixels.select(*at, *[pixel.quantize8(c).alias(c) for c in "bgr"]),
        # Channels scaled to the square root of the luminance.
        "luminance_rescale": lit.select(
            *at, *[pixel.rescale(c, "lum", F.sqrt("lum")).alias(c) for c in "bgr"]
        ),
        **{f"tonemap_{op}": tone_map(pixels, op) for op in CURVES},
    }
    return _register(views, prefix)


def register_colour_views(pixels: DataFrame, prefix: str = "") -> list[str]:
    """Views over 8-bit colour pixels: gray levels (cut off and rounded), doubled gray, edges."""
    at = [raster.IMAGE, "y", "x"]
    gray = pixels.select(*at, pixel.bgr_to_gray().alias("g"))
    views = {
        "gray": gray,
        "gray_round": pixels.select(*at, pixel.bgr_to_gray(mode="round").alias("g")),
        "times2": gray.select(*at, pixel.intensity_times("g").alias("g")),
        "edges": edge_map(pixels),
    }
    return _register(views, prefix)


def register_file_views(files: DataFrame, prefix: str = "") -> list[str]:
    """Views over a list of files ``(name, mode)``: names of type codes and of written files."""
    views = {
        "image_type_name": files.select("name", pixel.image_type_name("mode").alias("type_name")),
        "change_extension": files.select("name", pixel.change_extension("name").alias("new_name")),
    }
    return _register(views, prefix)


def _register(views: dict[str, DataFrame], prefix: str) -> list[str]:
    for name, df in views.items():
        df.createOrReplaceTempView(prefix + name)
    return [prefix + name for name in views]

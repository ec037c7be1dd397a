"""Tone mapping of whole image collections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumagrid.functions import pixel
from lumagrid.operators.lookup import attach
from lumagrid.operators.raster import IMAGE, max_luminance, with_luminance

_CHANNELS = ("b", "g", "r")


def _gamma(gamma=pixel.GAMMA, f_stop=pixel.F_STOP) -> Column:
    return pixel.gamma_curve("lum", gamma, f_stop)


def _log(k=pixel.LOG_K, q=pixel.LOG_Q) -> Column:
    return pixel.log_curve("lum", "lum_max", k, q)


def _adaptive_log(b=pixel.ADAPTIVE_B, ld_max=pixel.ADAPTIVE_LD_MAX) -> Column:
    return pixel.adaptive_log_curve("lum", "lum_max", b, ld_max)


CURVES = {"gamma": _gamma, "log": _log, "adap_log": _adaptive_log}
NEEDS_MAX = {"log", "adap_log"}


def new_luminance(op: str, **params) -> Column:
    """The compressed luminance of an operator, from columns ``lum`` and ``lum_max``."""
    if op not in CURVES:
        raise ValueError(f"unknown tone mapping operator: {op}")
    return CURVES[op](**params)


def with_max_luminance(pixels: DataFrame, stats: DataFrame | None = None) -> DataFrame:
    """Pixels with their luminance and their image's largest luminance."""
    stats = max_luminance(pixels) if stats is None else stats
    joined = attach(pixels, stats, [IMAGE], weight="n_pixels").drop("n_pixels")
    return with_luminance(joined)


def apply_luminance(mapped: DataFrame, quantize: bool = True, keep=()) -> DataFrame:
    """Channels rescaled from ``lum`` to ``new_lum``, as 8-bit levels unless told otherwise."""
    scaled = mapped.withColumn("scale", pixel.luminance_scale("lum", "new_lum"))
    channels = [F.col(c) * F.col("scale") for c in _CHANNELS]
    return scaled.select(
        IMAGE,
        "y",
        "x",
        *keep,
        *[
            (pixel.quantize8(v) if quantize else v).alias(c) for c, v in zip(_CHANNELS, channels)
        ],
    )


def tone_map(
    pixels: DataFrame,
    op: str,
    quantize: bool = True,
    stats: DataFrame | None = None,
    **params,
) -> DataFrame:
    """``(image_id, y, x, b, g, r)`` mapped by ``gamma``, ``log`` or ``adap_log``.

    ``gamma`` is a plain projection. The other two take one aggregation for the
    maximum of each image (or ``stats`` from ``max_luminance``), which is joined
    back without shuffling the pixels as long as it is small.
    """
    curve = new_luminance(op, **params)
    source = pixels.select(IMAGE, "y", "x", *_CHANNELS)
    source = with_max_luminance(source, stats) if op in NEEDS_MAX else with_luminance(source)
    return apply_luminance(source.withColumn("new_lum", curve), quantize)


def tone_map_all(
    pixels: DataFrame,
    quantize: bool = True,
    params: dict | None = None,
    stats: DataFrame | None = None,
) -> DataFrame:
    """All operators over one reading of the pixels, told apart by column ``op``."""
    params = params or {}
    curves = F.array(
        *[
            F.struct(F.lit(op).alias("op"), new_luminance(op, **params.get(op, {})).alias("new_lum"))
            for op in CURVES
        ]
    )
    source = with_max_luminance(pixels.select(IMAGE, "y", "x", *_CHANNELS), stats)
    return apply_luminance(source.select("*", F.inline(curves)), quantize, keep=("op",))


def gamma_image(
    pixels: DataFrame, gamma: float = pixel.GAMMA, f_stop: float = pixel.F_STOP, quantize: bool = True
) -> DataFrame:
    """The gamma curve on each channel by itself instead of on the luminance."""
    finish = pixel.quantize8 if quantize else (lambda c: c)
    return pixels.select(
        IMAGE,
        "y",
        "x",
        *[finish(pixel.gamma_curve(c, gamma, f_stop)).alias(c) for c in _CHANNELS],
    )

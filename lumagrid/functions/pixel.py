"""Per-pixel formulas as Column -> Column functions (all stay in generated code)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Luminance weights of blue, green and red for tone mapping.
LUMINANCE_WEIGHTS = (0.0722, 0.7152, 0.2126)

# Gray weights of blue, green and red for 8-bit images.
GRAY_WEIGHTS = (0.114, 0.587, 0.299)

# Default curve parameters.
GAMMA, F_STOP = 1.2, 0.4
LOG_K, LOG_Q = 1.0, 1.0
ADAPTIVE_B, ADAPTIVE_LD_MAX = 1.0, 150.0

# Element depth codes of an image type and their names.
DEPTH_NAMES = {0: "8U", 1: "8S", 2: "16U", 3: "16S", 4: "32S", 5: "32F", 6: "64F"}


def _double(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("double")


def _weighted(weights, b, g, r) -> Column:
    return _double(b) * weights[0] + _double(g) * weights[1] + _double(r) * weights[2]


def luminance(b="b", g="g", r="r") -> Column:
    return _weighted(LUMINANCE_WEIGHTS, b, g, r)


def bgr_to_gray(b="b", g="g", r="r", mode: str = "trunc") -> Column:
    """8-bit gray level: cut off (``trunc``) or rounded half to even (``round``)."""
    gray = _weighted(GRAY_WEIGHTS, b, g, r)
    if mode == "trunc":
        return F.floor(gray).cast("int")
    if mode == "round":
        return F.rint(gray).cast("int")
    raise ValueError(f"unknown gray mode: {mode}")


def gamma_curve(value, gamma: float = GAMMA, f_stop: float = F_STOP) -> Column:
    """Exposure by ``f_stop`` stops, then the gamma root; for channels or luminance alike."""
    return F.pow(_double(value) * F.lit(2.0**f_stop), F.lit(1.0 / gamma))


def _logarithm(log, value: Column) -> Column:
    """NaN, not NULL, where there is no logarithm, as for a pixel far below zero."""
    return F.coalesce(log(value), F.lit(float("nan")))


def log_curve(lum, lum_max, k: float = LOG_K, q: float = LOG_Q) -> Column:
    """Logarithmic curve; an all-black image has no range to map and stays 0."""
    span = _logarithm(F.log10, _double(lum_max) * F.lit(float(k)) + 1.0)
    value = _logarithm(F.log10, _double(lum) * F.lit(float(q)) + 1.0)
    return F.when(span == 0, F.lit(0.0)).otherwise(value / span)


def adaptive_log_curve(
    lum, lum_max, b: float = ADAPTIVE_B, ld_max: float = ADAPTIVE_LD_MAX
) -> Column:
    """Logarithmic curve whose base grows with the pixel's share of the maximum."""
    if b <= 0:
        raise ValueError("the bias b must be positive")
    bias = math.log(b) / math.log(0.5)
    lum, lum_max = _double(lum), _double(lum_max)
    scale = F.lit(float(ld_max)) / (_logarithm(F.log10, lum_max + 1.0) * 100.0)
    base = _logarithm(F.log, F.pow(lum / lum_max, F.lit(bias)) * 8.0 + 2.0)
    value = _logarithm(F.log, lum + 1.0)
    return F.when(lum_max == 0, F.lit(0.0)).otherwise(scale * (value / base))


def luminance_scale(lum, new_lum) -> Column:
    """New over old luminance; 0 for a black pixel, which stays black."""
    lum = _double(lum)
    return F.when(lum == 0, F.lit(0.0)).otherwise(_double(new_lum) / lum)


def rescale(channel, lum, new_lum) -> Column:
    """A channel scaled by new over old luminance."""
    return _double(channel) * luminance_scale(lum, new_lum)


def clamp8(value: Column) -> Column:
    return F.when(value < 0, F.lit(0)).when(value > 255, F.lit(255)).otherwise(value)


def quantize8(value) -> Column:
    """0..1 to an 8-bit level: times 255, rounded half to even, saturated; NaN is 0."""
    scaled = F.rint(_double(value) * 255.0)
    return F.when(F.isnan(scaled), F.lit(0)).otherwise(clamp8(scaled)).cast("int")


def intensity_times(gray, factor: int = 2, saturate: bool = False) -> Column:
    """Gray level times a whole factor; wraps modulo 256 unless it is told to saturate."""
    gray = F.col(gray) if isinstance(gray, str) else gray
    product = gray.cast("long") * factor
    return (clamp8(product) if saturate else product.bitwiseAND(255)).cast("int")


def image_type_name(mode) -> Column:
    """Name of an image type code, e.g. 16 -> ``8UC3``."""
    mode = F.col(mode) if isinstance(mode, str) else mode
    depth = mode.bitwiseAND(7)
    name = F.lit("User")
    for code, text in DEPTH_NAMES.items():
        name = F.when(depth == code, F.lit(text)).otherwise(name)
    channels = F.shiftright(mode, 3) + 1
    return F.concat(name, F.lit("C"), channels.cast("string"))


def change_extension(name, extension: str = ".png") -> Column:
    """The four characters from the last dot on replaced, so ``a.jpeg`` gives ``a.pngg``."""
    return F.regexp_replace(name, r"\.[^.]{0,3}([^.]*)$", extension + "$1")


def replace_extension(name, old: str = ".exr", new: str = ".png") -> Column:
    """Every ``old`` in a name replaced, wherever it stands; other names stay as they are."""
    name = F.col(name) if isinstance(name, str) else name
    return F.replace(name, F.lit(old), F.lit(new))


def in_bounds(y, x, height, width) -> Column:
    y, x = (F.col(c) if isinstance(c, str) else c for c in (y, x))
    return (y >= 0) & (y < height) & (x >= 0) & (x < width)

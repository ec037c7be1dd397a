import math

import pytest
from pyspark.sql import functions as F

from lumagrid.functions import pixel, timing


def values(spark, column, rows, schema):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(column).collect()]


def test_luminance_and_gray(spark):
    rows = [(10, 20, 30), (0, 0, 0), (255, 255, 255), (1, 2, 3)]
    lum = values(spark, pixel.luminance(), rows, "b int, g int, r int")
    assert lum == [b * 0.0722 + g * 0.7152 + r * 0.2126 for b, g, r in rows]
    exact = [b * 0.114 + g * 0.587 + r * 0.299 for b, g, r in rows]
    trunc = values(spark, pixel.bgr_to_gray(), rows, "b int, g int, r int")
    assert trunc == [math.floor(v) for v in exact]
    rounded = values(spark, pixel.bgr_to_gray(mode="round"), rows, "b int, g int, r int")
    assert rounded == [round(v) for v in exact]
    with pytest.raises(ValueError):
        pixel.bgr_to_gray(mode="ceil")


def test_quantize8_rounds_half_to_even_and_saturates(spark):
    levels = [0.5, 1.5, 2.5, 254.5, 255.0, 300.0, -4.0, 1e300]
    rows = [(v / 255.0,) for v in levels]
    rows += [(float("nan"),), (float("inf"),), (float("-inf"),), (None,)]
    got = values(spark, pixel.quantize8("v"), rows, "v double")
    want = [max(0, min(255, round(v / 255.0 * 255.0))) for v in levels] + [0, 255, 0, None]
    assert got == want


def test_intensity_times_wraps_or_saturates(spark):
    rows = [(127,), (128,), (255,), (0,)]
    assert values(spark, pixel.intensity_times("g"), rows, "g int") == [254, 0, 254, 0]
    saturated = pixel.intensity_times("g", saturate=True)
    assert values(spark, saturated, rows, "g int") == [254, 255, 255, 0]
    assert values(spark, pixel.intensity_times("g", 3), rows, "g int") == [125, 128, 253, 0]


def test_black_pixels_and_black_images_stay_zero(spark):
    rows = [(0.0, 0.0), (0.0, 5.0), (5.0, 5.0)]
    for curve in (pixel.log_curve, pixel.adaptive_log_curve):
        got = values(spark, curve("lum", "top"), rows, "lum double, top double")
        assert got[0] == 0 and got[1] == 0 and got[2] > 0
    scaled = pixel.rescale(F.lit(3.0), "lum", F.lit(1.0))
    assert values(spark, scaled, rows, "lum double, top double") == [0.0, 0.0, 3.0 * (1.0 / 5.0)]


def test_curves(spark):
    rows = [(0.7, 4.0)]
    schema = "lum double, top double"
    got = values(spark, pixel.gamma_curve("lum", 1.2, 0.4), rows, schema)[0]
    assert got == pytest.approx((0.7 * 2**0.4) ** (1 / 1.2))
    got = values(spark, pixel.log_curve("lum", "top", k=2, q=3), rows, schema)[0]
    assert got == pytest.approx(math.log10(1 + 3 * 0.7) / math.log10(1 + 2 * 4))
    got = values(spark, pixel.adaptive_log_curve("lum", "top", 0.85, 100), rows, schema)[0]
    power = (0.7 / 4) ** (math.log(0.85) / math.log(0.5))
    want = 100 / (100 * math.log10(5)) * math.log(1.7) / math.log(2 + 8 * power)
    assert got == pytest.approx(want)
    with pytest.raises(ValueError):
        pixel.adaptive_log_curve("lum", "top", b=0)


def test_image_type_name(spark):
    rows = [(0,), (16,), (21,), (24,), (7,), (6,)]
    got = values(spark, pixel.image_type_name("mode"), rows, "mode int")
    assert got == ["8UC1", "8UC3", "32FC3", "8UC4", "UserC1", "64FC1"]


def test_change_extension(spark):
    names = ["a.exr", "a.b.exr", "a.jpeg", "none", "x.h", "dir.v2/a.exr", "end."]
    got = values(spark, pixel.change_extension("n"), [(n,) for n in names], "n string")
    assert got == ["a.png", "a.b.png", "a.pngg", "none", "x.png", "dir.v2/a.png", "end.png"]


def test_timing(spark):
    rows = [("0.5", 2.0, 0.5), ("-", 2.0, 0.0), (None, None, 1.0), ("x", 1.0, None)]
    schema = "t string, base double, variant double"
    assert values(spark, timing.seconds("t"), rows, schema) == [0.5, None, None, None]
    ratio = timing.speedup(F.col("base"), F.col("variant"))
    assert values(spark, ratio, rows, schema) == [4.0, None, None, None]


def test_published_bandwidth_and_throughput(spark):
    one = spark.range(1)
    size = 2560 * 1600
    bandwidth = timing.effective_bandwidth(F.lit(size * 3.0 + 9), F.lit(float(size)), F.lit(0.0058559500))
    assert one.select(bandwidth).first()[0] == pytest.approx(2.8, abs=0.005)
    flops = timing.throughput(F.lit(5), F.lit(float(size)), F.lit(498.524e-6))
    assert one.select(flops).first()[0] == pytest.approx(41.08, abs=0.005)
    flops = timing.throughput(F.lit(18), F.lit(float(size)), F.lit(1.225e-3))
    assert one.select(flops).first()[0] == pytest.approx(60.19, abs=0.01)


def test_replace_extension(spark):
    names = {"a.exr": "a.png", "a.exr.exr": "a.png.png", "b.exrx": "b.pngx", "c.jpg": "c.jpg", "": ""}
    df = spark.createDataFrame([(n,) for n in names], "name string")
    got = df.select("name", pixel.replace_extension("name").alias("new")).collect()
    assert {r.name: r.new for r in got} == names

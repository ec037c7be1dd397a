import math

import pytest

from lumagrid.operators import raster
from lumagrid.plans import tonemap, views

SCHEMA = "image_id int, y int, x int, b double, g double, r double"


def image(image_id, pixels, width=2):
    return [(image_id, i // width, i % width, *map(float, p)) for i, p in enumerate(pixels)]


def plain(pixels, op, gamma=1.2, f_stop=0.4, k=1.0, q=1.0, b=1.0, ld_max=150.0):
    lums = [0.0722 * p[0] + 0.7152 * p[1] + 0.2126 * p[2] for p in pixels]
    top = max(lums)
    out = []
    for p, lum in zip(pixels, lums):
        if op == "gamma":
            new = (lum * 2**f_stop) ** (1 / gamma)
        elif top == 0:
            new = 0.0
        elif op == "log":
            new = math.log10(1 + q * lum) / math.log10(1 + k * top)
        else:
            base = math.log(2 + 8 * (lum / top) ** (math.log(b) / math.log(0.5)))
            new = ld_max / (100 * math.log10(1 + top)) * math.log(1 + lum) / base
        scale = new / lum if lum else 0.0
        out.append([max(0, min(255, round(c * scale * 255))) for c in p])
    return out


IMAGES = {
    1: [(0.1, 0.2, 0.3), (1.0, 2.0, 3.0), (0, 0, 0), (9.0, 0.5, 0.1), (0.01, 0.02, 0.01)],
    2: [(0, 0, 0)] * 4,
    3: [(5.0, 5.0, 5.0)],
}


@pytest.fixture
def pixels(spark):
    rows = [row for i, p in IMAGES.items() for row in image(i, p)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def by_image(df, **where):
    got = {}
    for r in df.orderBy("image_id", "y", "x").collect():
        if all(r[k] == v for k, v in where.items()):
            got.setdefault(r.image_id, []).append([r.b, r.g, r.r])
    return got


@pytest.mark.parametrize(
    "op,params",
    [
        ("gamma", {}),
        ("gamma", {"gamma": 2.2, "f_stop": 1.0}),
        ("log", {}),
        ("log", {"k": 5.0, "q": 20.0}),
        ("adap_log", {}),
        ("adap_log", {"b": 0.85, "ld_max": 100.0}),
    ],
)
def test_tone_map(pixels, op, params):
    got = by_image(tonemap.tone_map(pixels, op, **params))
    assert got == {i: plain(p, op, **params) for i, p in IMAGES.items()}


def test_tone_map_all_is_each_operator(pixels):
    every = tonemap.tone_map_all(pixels)
    for op in tonemap.CURVES:
        assert by_image(every, op=op) == by_image(tonemap.tone_map(pixels, op))


def test_given_maxima_are_used(pixels):
    stats = raster.max_luminance(pixels)
    assert by_image(tonemap.tone_map(pixels, "log", stats=stats)) == by_image(
        tonemap.tone_map(pixels, "log")
    )


def test_many_images_beyond_the_broadcast_bound(spark, pixels):
    want = by_image(tonemap.tone_map(pixels, "log"))
    spark.conf.set("spark.lumagrid.broadcastBytes", "64")
    try:
        assert by_image(tonemap.tone_map(pixels, "log")) == want
    finally:
        spark.conf.unset("spark.lumagrid.broadcastBytes")


def test_unknown_operator_is_refused(pixels):
    with pytest.raises(ValueError):
        tonemap.tone_map(pixels, "linear")


def test_maximum_ignores_nan(spark):
    rows = [(1, 0, 0, float("nan"), 1.0, 1.0), (1, 0, 1, 1.0, 1.0, 1.0)]
    top = raster.max_luminance(spark.createDataFrame(rows, SCHEMA)).first()
    assert top.lum_max == pytest.approx(1.0) and top.n_pixels == 2


@pytest.mark.parametrize("op", list(tonemap.CURVES))
def test_pixels_without_a_luminance_become_black(spark, op):
    nan = float("nan")
    rows = image(1, [(nan, nan, nan), (-5.0, -5.0, -5.0), (2.0, 2.0, 2.0)])
    rows += image(2, [(nan, nan, nan)])
    got = by_image(tonemap.tone_map(spark.createDataFrame(rows, SCHEMA), op))
    assert got[1][:2] == [[0, 0, 0], [0, 0, 0]] and got[1][2][0] > 0
    assert got[2] == [[0, 0, 0]]


def test_gamma_image_maps_each_channel(pixels):
    got = by_image(tonemap.gamma_image(pixels))
    curve = lambda v: max(0, min(255, round((v * 2**0.4) ** (1 / 1.2) * 255)))
    assert got == {i: [[curve(c) for c in p] for p in ps] for i, ps in IMAGES.items()}


def test_raw_result_is_not_quantized(pixels):
    raw = tonemap.tone_map(pixels, "log", quantize=False)
    assert dict(raw.dtypes)["b"] == "double"
    top = raster.max_luminance(raw).where("image_id = 3").first()
    assert top.lum_max == pytest.approx(1.0)


def test_pack_and_explode_are_inverse(spark):
    rows = [row for i in (1, 2) for row in image(i, [(k, k + 1, k + 2) for k in range(60)], 10)]
    pixels = spark.createDataFrame(rows, SCHEMA).repartition(4)
    packed = raster.pack_raster(pixels, run=4)
    assert packed.count() == 2 * 6 * 3
    assert max(len(r.data) for r in packed.collect()) == 4 * 3
    back = raster.explode_raster(packed, "data", width=10).select(pixels.columns)
    assert back.exceptAll(pixels).isEmpty() and back.count() == 120


def test_pack_keeps_gaps_late_starts_and_missing_channels(spark):
    at = [(0, x) for x in (2, 3, 7, 9, 10, 11)] + [(1, x) for x in (0, 1, 2)] + [(3, 5), (4, 1), (4, 6)]
    rows = [(1, y, x, 10 * y + x if x % 3 else None, x, None if x == 9 else y) for y, x in at]
    pixels = spark.createDataFrame(rows, "image_id int, y int, x int, b int, g int, r int")
    for run in (4, 8, 100):
        packed = raster.pack_raster(pixels, run=run)
        back = raster.explode_raster(packed, "data", width=100).select(pixels.columns)
        assert sorted(map(tuple, back.collect()), key=str) == sorted(rows, key=str)
    whole = {(r.y0, r.x0): r.offsets for r in raster.pack_raster(pixels, run=100).collect()}
    assert whole == {(0, 2): [0, 1, 5, 7, 8, 9], (1, 0): None, (3, 5): None, (4, 1): [0, 5]}


def test_explode_whole_array(spark):
    whole = spark.createDataFrame([(7, [float(v) for v in range(24)])], "image_id int, data array<double>")
    got = raster.explode_raster(whole, "data", width=4).orderBy("y", "x").collect()
    assert [(r.y, r.x, r.b, r.r) for r in got] == [
        (i // 4, i % 4, 3.0 * i, 3.0 * i + 2) for i in range(8)
    ]


def test_crop_and_shift(spark):
    rows = [(1, y, x, 10 * y + x) for y in range(4) for x in range(5)]
    gray = spark.createDataFrame(rows, "image_id int, y int, x int, g int")
    assert raster.crop(gray, 2, 3).count() == 6
    moved = {(r.y, r.x): r.g for r in raster.shift(gray, 1, -2).collect()}
    assert moved == {(y + 1, x - 2): 10 * y + x for y in range(3) for x in range(2, 5)}


def test_views_answer_sql(spark, pixels):
    names = views.register_float_views(pixels, "demo_")
    assert "demo_tonemap_log" in names
    top = spark.sql("select max(g) as top from demo_tonemap_log where image_id = 3").first().top
    assert top == 255
    colour = tonemap.tone_map(pixels, "gamma")
    views.register_colour_views(colour, "demo_")
    joined = spark.sql(
        "select count(*) as n from demo_gray join demo_edges using (image_id, y, x) where edge >= 0"
    )
    assert joined.first().n == pixels.count()

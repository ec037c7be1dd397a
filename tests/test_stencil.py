import random

import pytest

from lumagrid.operators import stencil
from lumagrid.operators.stencil import sobel
from lumagrid.plans.edges import edge_map

MASK = [[-1, 0, 1], [-2, 0, 2], [-1, 0, 1]]


def mirrored(i, n):
    if n == 1:
        return 0
    return -i if i < 0 else 2 * (n - 1) - i if i >= n else i


def expected(image, border):
    h, w = len(image), len(image[0])
    out = {}
    for y in range(h):
        for x in range(w):
            total = 0
            for i in range(3):
                for j in range(3):
                    ny, nx = y + i - 1, x + j - 1
                    if border == "reflect101":
                        ny, nx = mirrored(ny, h), mirrored(nx, w)
                    if 0 <= ny < h and 0 <= nx < w:
                        total += image[ny][nx] * MASK[i][j]
            out[y, x] = max(0, min(255, total))
    return out


def noise(h, w):
    rng = random.Random(h * 100 + w)
    return [[rng.randrange(256) for _ in range(w)] for _ in range(h)]


IMAGES = {
    "one": [[9]],
    "line": noise(1, 9),
    "column": noise(9, 1),
    "two": noise(2, 2),
    "square": noise(3, 3),
    "odd": noise(17, 23),
    "exact_tiles": noise(16, 16),
    "black": [[0] * 5] * 5,
    "step_right": [[0] * 4 + [255] * 4] * 8,
    "step_left": [[255] * 4 + [0] * 4] * 8,
    "step_down": [[0] * 8] * 4 + [[255] * 8] * 4,
}


@pytest.mark.parametrize("border", ["zero", "reflect101"])
@pytest.mark.parametrize("strategy,tile", [("scatter", 4), ("scatter", 7), ("scatter", 0), ("halo", 4), ("halo", 8), ("halo", 512)])
def test_sobel_matches_plain_loops(spark, monkeypatch, border, strategy, tile):
    if strategy == "scatter":
        monkeypatch.setattr(stencil, "_LINE", tile or 512)
        tile = 0
    rows = [
        (name, y, x, g)
        for name, image in IMAGES.items()
        for y, line in enumerate(image)
        for x, g in enumerate(line)
    ]
    random.Random(0).shuffle(rows)
    gray = spark.createDataFrame(rows, "image_id string, y int, x int, g int").repartition(5)
    options = {"tile": tile} if tile else {}
    result = sobel(gray, border, strategy, **options)
    assert result.dtypes == [("image_id", "string"), ("y", "int"), ("x", "int"), ("edge", "int")]
    got = result.collect()
    assert len(got) == len(rows)
    want = {(n, *at): e for n, image in IMAGES.items() for at, e in expected(image, border).items()}
    assert {(r.image_id, r.y, r.x): r.edge for r in got} == want


def test_missing_pixels_count_as_zero(spark):
    rows = [(1, 0, 0, 10), (1, 0, 2, 30), (1, 5, 5, 7)]
    gray = spark.createDataFrame(rows, "image_id int, y int, x int, g int")
    halo = {tuple(r) for r in sobel(gray, tile=4).collect()}
    assert halo == {tuple(r) for r in sobel(gray, strategy="scatter").collect()}
    assert len(halo) == 3


def test_positions_beyond_32_bits(spark):
    far = 5_000_000_000
    rows = [("a", far + y, far + x, 10 * y + 3 * x) for y in range(3) for x in range(4)]
    gray = spark.createDataFrame(rows, "image_id string, y bigint, x bigint, g int")
    halo = sobel(gray, tile=64)
    assert halo.dtypes == [("image_id", "string"), ("y", "bigint"), ("x", "bigint"), ("edge", "int")]
    scatter = sobel(gray, strategy="scatter")
    assert halo.exceptAll(scatter).isEmpty() and halo.count() == 12


def test_edge_map_takes_the_gray_mode(spark):
    rows = [(1, y, x, 50 * x, 13 * y, 7) for y in range(4) for x in range(5)]
    colour = spark.createDataFrame(rows, "image_id int, y int, x int, b int, g int, r int")
    for mode in ("trunc", "round"):
        a = edge_map(colour, mode=mode, tile=4)
        b = edge_map(colour, mode=mode, strategy="scatter")
        assert a.exceptAll(b).isEmpty() and a.count() == 20


def test_unknown_options_are_refused(spark):
    gray = spark.createDataFrame([(1, 0, 0, 1)], "image_id int, y int, x int, g int")
    with pytest.raises(ValueError):
        sobel(gray, border="wrap")
    with pytest.raises(ValueError):
        sobel(gray, strategy="fast")
    with pytest.raises(ValueError):
        sobel(gray, tile=1)

import random

import numpy as np
import pyarrow as pa
import pytest

from lumagrid.operators import packing, tiles
from lumagrid.plans.edges import edge_map

SIZES = {"one": (1, 1), "line": (1, 9), "column": (9, 1), "two": (2, 2), "odd": (9, 13), "even": (8, 8)}


@pytest.fixture(scope="module")
def colour(spark):
    rng = random.Random(4)
    rows = [
        (name, y, x, rng.randrange(256), rng.randrange(256), rng.randrange(256))
        for name, (h, w) in SIZES.items()
        for y in range(h)
        for x in range(w)
    ]
    rng.shuffle(rows)
    return spark.createDataFrame(
        rows, "image_id string, y bigint, x bigint, b int, g int, r int"
    ).repartition(4)


@pytest.mark.parametrize("tile", [4, 8, 512])
def test_pixels_to_tiles_and_back(colour, tile):
    packed = tiles.tiles_from_pixels(colour, tile=tile)
    back = tiles.pixels_from_tiles(packed, tile=tile)
    assert back.count() == colour.count()
    assert back.exceptAll(colour).isEmpty()


@pytest.mark.parametrize("border", ["zero", "reflect101"])
@pytest.mark.parametrize("tile", [4, 8, 512])
def test_edges_of_tiles_are_edges_of_pixels(colour, tile, border):
    packed = tiles.tiles_from_pixels(colour, tile=tile)
    mode = "round" if tile == 8 else "trunc"
    got = tiles.pixels_from_tiles(
        tiles.edge_map_tiles(packed, mode, border, tile), ("edge",), tile=tile
    )
    want = edge_map(colour, mode, border, strategy="scatter")
    assert got.count() == colour.count()
    assert got.exceptAll(want.select(got.columns)).isEmpty()


def test_unknown_options_are_refused(colour):
    packed = tiles.tiles_from_pixels(colour)
    with pytest.raises(ValueError):
        tiles.edge_map_tiles(packed, border="wrap")
    with pytest.raises(ValueError):
        tiles.edge_map_tiles(packed, mode="ceil")


@pytest.mark.parametrize("border", ["zero", "reflect101"])
@pytest.mark.parametrize("tile", [3, 4, 7, 512])
def test_edges_of_images_that_lack_pixels(spark, tile, border):
    rng = random.Random(tile)
    rows = [("ragged", y, x, *[rng.randrange(256)] * 3) for y in range(6) for x in range(3 if y == 5 else 10)]
    rows += [("holes", y, x, *[rng.randrange(256)] * 3) for y in range(9) for x in range(9) if rng.random() < 0.6]
    rows += [("gap", y, x, 200, 10, 30) for y in range(5) for x in range(12) if x != tile - 1]
    pixels = spark.createDataFrame(rows, "image_id string, y bigint, x bigint, b int, g int, r int")
    packed = tiles.tiles_from_pixels(pixels, tile=tile)
    assert tiles.pixels_from_tiles(packed, tile=tile).exceptAll(pixels).isEmpty()
    got = tiles.pixels_from_tiles(tiles.edge_map_tiles(packed, border=border, tile=tile), ("edge",), tile=tile)
    assert got.count() == len(rows)
    for strategy in ("scatter", "halo"):
        want = edge_map(pixels, border=border, strategy=strategy)
        assert got.exceptAll(want.select(got.columns)).isEmpty(), strategy


def test_values_beyond_a_byte_are_saturated(spark):
    pixels = spark.createDataFrame([("a", 0, 0, 256, -1, 300)], "image_id string, y int, x int, b int, g int, r int")
    back = tiles.pixels_from_tiles(tiles.tiles_from_pixels(pixels)).first()
    assert (back.b, back.g, back.r) == (255, 0, 255)


def test_what_small_keys_give_is_handed_on_soon():
    """Keys of one row each, whose batches of one row must not pile up."""

    class Steps:
        def repartition(self, *keys):
            return self

        sortWithinPartitions = repartition

        def mapInArrow(self, run, schema):
            return run

    made = []

    def work(key, cells):
        made.append(key[0])
        return pa.record_batch({"k": pa.array([key[0]]), "n": pa.array([len(cells)])})

    def batches():
        for start in range(0, 9000, 3000):
            yield pa.record_batch({"k": pa.array(range(start, start + 3000)), "cells": pa.array([b"ab"] * 3000)})

    run = packing.for_each_key(Steps(), ["k"], np.dtype("u1"), work, "k bigint, n bigint")
    done = []
    for batch in run(batches()):
        done += batch.column("k").to_pylist()
        assert set(batch.column("n").to_pylist()) == {2}
        assert len(made) == len(done)
        assert batch.num_rows <= 1024
    assert done == made == list(range(9000))

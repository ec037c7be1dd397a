"""8-bit images as tiles: one row holds a square of pixels as bytes.

A tile table is ``(image_id, ty, tx, height, width, data BINARY, present BINARY)``,
``data`` being row-major with interleaved channels. ``present`` has a byte per pixel that
tells whether the image has it; it is NULL where it has all. It serves images that are
handled whole: a row costs as much as in a pixel table, but holds up to 262,144 pixels.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from lumagrid.functions.pixel import GRAY_WEIGHTS
from lumagrid.operators.lookup import attach
from lumagrid.operators.packing import for_each_key, pack
from lumagrid.operators.raster import IMAGE
from lumagrid.operators.stencil import BORDERS, SOBEL_MASK, TILE

TILE_COLUMNS = "ty bigint, tx bigint, height int, width int, data binary, present binary"
# Where a part lies relative to its tile, and its size.
_PART = np.dtype([("dy", "<i4"), ("dx", "<i4"), ("height", "<i4"), ("width", "<i4")])
_EXTENT = (2, 2)  # in place of sides, the part that tells how far the image goes
_SIDES = [(dy, dx) for dy in (-1, 0, 1) for dx in (-1, 0, 1) if dy or dx]


def tiles_from_pixels(
    pixels: DataFrame, channels: tuple[str, ...] = ("b", "g", "r"), tile: int = TILE
) -> DataFrame:
    """Pixel rows to tiles; channel values beyond a byte are saturated."""
    n = len(channels)
    cell = np.dtype([("y", "<i2"), ("x", "<i2"), ("v", "u1", (n,))])
    source = pixels.select(IMAGE, "y", "x", *channels)
    kind, image_type = _image_types(source)

    def locate(table: pa.Table):
        y, x = (table[c].to_numpy() for c in "yx")
        ty, tx = y // tile, x // tile
        cells = np.empty(len(y), cell)
        cells["y"], cells["x"] = y - ty * tile, x - tx * tile
        for at, c in enumerate(channels):
            cells["v"][:, at] = np.clip(table[c].to_numpy(), 0, 255)
        image = table[IMAGE].combine_chunks().dictionary_encode()
        return {IMAGE: image, "ty": ty.astype(np.int64), "tx": tx.astype(np.int64)}, cells

    def assemble(key: tuple, cells: np.ndarray) -> pa.RecordBatch:
        data = np.zeros((int(cells["y"].max()) + 1, int(cells["x"].max()) + 1, n), np.uint8)
        data[cells["y"], cells["x"]] = cells["v"]
        present = np.zeros(data.shape[:2], np.uint8)
        present[cells["y"], cells["x"]] = 1
        return tile_row(key, data, image_type, None if present.all() else present)

    packed = pack(source, locate, f"{IMAGE} {kind}, ty bigint, tx bigint")
    return for_each_key(packed, [IMAGE, "ty", "tx"], cell, assemble, f"{IMAGE} {kind}, {TILE_COLUMNS}")


def pixels_from_tiles(
    tiles: DataFrame, channels: tuple[str, ...] = ("b", "g", "r"), tile: int = TILE
) -> DataFrame:
    """Tiles to one row per pixel."""
    kind, _ = _image_types(tiles)

    def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                ty, tx, data, present = _read_tile(batch, row)
                width = data.shape[1]
                at = np.flatnonzero(present)
                yield pa.record_batch(
                    {
                        IMAGE: pa.repeat(batch.column(IMAGE)[row], len(at)),
                        "y": pa.array(at // width + ty * tile),
                        "x": pa.array(at % width + tx * tile),
                        **{
                            c: pa.array(data[:, :, k].ravel()[at].astype(np.int32))
                            for k, c in enumerate(channels)
                        },
                    }
                )

    columns = ", ".join(f"{c} int" for c in channels)
    return _columns(tiles).mapInArrow(unpacked, f"{IMAGE} {kind}, y bigint, x bigint, {columns}")


def edge_map_tiles(
    tiles: DataFrame, mode: str = "trunc", border: str = "zero", tile: int = TILE
) -> DataFrame:
    """Edge strengths of colour or gray tiles of ``tile`` lines and columns, as tiles of one channel.

    Tiles travel as gray bytes, and to each neighbour only the line they share. Pixels that an
    image lacks count as 0. A mirrored border lies around the smallest rectangle from the origin
    that holds the image; tiles are then read once more for their sizes alone.
    """
    if border not in BORDERS:
        raise ValueError(f"unknown border: {border}")
    if mode not in ("trunc", "round"):
        raise ValueError(f"unknown gray mode: {mode}")
    kind, image_type = _image_types(tiles)
    mirrored = border == "reflect101"
    source = _columns(tiles)
    if mirrored:
        sizes = tiles.groupBy(IMAGE).agg(
            F.max(F.col("ty") * tile + F.col("height")).alias("lines"),
            F.max(F.col("tx") * tile + F.col("width")).alias("columns"),
            F.count(F.lit(1)).alias("n"),
        )
        source = attach(source, sizes, [IMAGE], weight="n").drop("n")

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                ty, tx, data, present = _read_tile(batch, row)
                gray = _gray(data, mode) * present
                # The tile's own part has its pixels, then which of them it has.
                made = [(ty, tx, _part(0, 0, np.vstack([gray, present])))]
                if mirrored:  # what its image holds from the tile's corner on, within the tile and after
                    rest = [batch.column(c)[row].as_py() - t * tile for c, t in (("lines", ty), ("columns", tx))]
                    reach = np.array([min(r, tile + 1) for r in rest], "<i4").view(np.uint8)
                    made.append((ty, tx, _part(*_EXTENT, reach[None, :])))
                for dy, dx in _SIDES:
                    # A tile that ends early does not reach the next one.
                    if (dy > 0 and gray.shape[0] < tile) or (dx > 0 and gray.shape[1] < tile):
                        continue
                    # The neighbour on a side sees this tile on its other side.
                    line = gray[_facing(dy), _facing(dx)]
                    made.append((ty + dy, tx + dx, _part(-dy, -dx, line)))
                yield pa.record_batch(
                    {
                        IMAGE: pa.repeat(batch.column(IMAGE)[row], len(made)),
                        "ty": pa.array([m[0] for m in made], pa.int64()),
                        "tx": pa.array([m[1] for m in made], pa.int64()),
                        "cells": pa.array([m[2] for m in made], pa.binary()),
                    }
                )

    def edges(key: tuple, cells: np.ndarray) -> pa.RecordBatch:
        found = dict(_read_parts(cells))
        if (0, 0) not in found:
            return tile_row(key, None, image_type)
        own, present = np.vsplit(found.pop((0, 0)), 2)
        found[0, 0] = own
        if mirrored:
            lines, columns = found.pop(_EXTENT).copy().view("<i4")[0].tolist()
            height, width = min(lines, tile), min(columns, tile)
        else:  # where a tile follows, this one counts in full
            height = tile if any(dy > 0 for dy, _ in found) else own.shape[0]
            width = tile if any(dx > 0 for _, dx in found) else own.shape[1]
        padded = np.zeros((height + 2, width + 2), np.int32)
        for (dy, dx), part in found.items():
            top, left = ({-1: 0, 0: 1, 1: n + 1}[d] for d, n in ((dy, height), (dx, width)))
            # Lines of a longer neighbour are cut to those that meet this tile, and one more.
            part = part[: height + 2 - top, : width + 2 - left]
            padded[top : top + part.shape[0], left : left + part.shape[1]] = part
        if mirrored:
            for image, at, n, rest in ((padded, key[1], height, lines), (padded.T, key[2], width, columns)):
                begins, ends = at == 0, rest <= tile
                if begins and ends and n == 1:
                    image[0] = image[2] = image[1]
                    continue
                if begins:
                    image[0] = image[2]
                if ends:
                    image[n + 1] = image[n - 1]
        total = np.zeros((height, width), np.int32)
        for dy in range(3):
            for dx in range(3):
                if SOBEL_MASK[dy][dx]:
                    total += SOBEL_MASK[dy][dx] * padded[dy : dy + height, dx : dx + width]
        edge = np.clip(total, 0, 255).astype(np.uint8)[: own.shape[0], : own.shape[1]]
        return tile_row(key, edge, image_type, None if present.all() else present)

    packed = source.mapInArrow(parts, f"{IMAGE} {kind}, ty bigint, tx bigint, cells binary")
    return for_each_key(
        packed, [IMAGE, "ty", "tx"], np.dtype("u1"), edges, f"{IMAGE} {kind}, {TILE_COLUMNS}"
    )


def _columns(tiles: DataFrame) -> DataFrame:
    return tiles.select(
        IMAGE,
        *[F.col(c).cast("bigint").alias(c) for c in ("ty", "tx")],
        *[F.col(c).cast("int").alias(c) for c in ("height", "width")],
        "data",
        "present",
    )


def _image_types(df: DataFrame) -> tuple[str, pa.DataType]:
    one = df.select(IMAGE)
    return dict(one.dtypes)[IMAGE], to_arrow_schema(one.schema).field(0).type


def _read_tile(batch: pa.RecordBatch, row: int) -> tuple[int, int, np.ndarray, np.ndarray]:
    ty, tx, height, width = (
        batch.column(c)[row].as_py() for c in ("ty", "tx", "height", "width")
    )
    data = np.frombuffer(batch.column("data")[row].as_buffer(), np.uint8)
    present = batch.column("present")[row].as_buffer()
    present = np.ones((height, width), np.uint8) if present is None else np.frombuffer(present, np.uint8)
    return ty, tx, data.reshape(height, width, -1), present.reshape(height, width)


def tile_row(
    key: tuple, data: np.ndarray | None, image_type: pa.DataType, present: np.ndarray | None = None
) -> pa.RecordBatch:
    mask = None if present is None else present.tobytes()
    rows = [] if data is None else [(*key, *data.shape[:2], data.tobytes(), mask)]
    types = [image_type, pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
    names = [IMAGE, "ty", "tx", "height", "width", "data", "present"]
    return pa.record_batch(
        [pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], names=names
    )


def _gray(data: np.ndarray, mode: str) -> np.ndarray:
    if data.shape[2] == 1:
        return data[:, :, 0]
    b, g, r = (data[:, :, c] * w for c, w in enumerate(GRAY_WEIGHTS))
    gray = b + g + r
    return (np.floor(gray) if mode == "trunc" else np.rint(gray)).astype(np.uint8)


def _facing(side: int) -> slice:
    return {-1: slice(0, 1), 0: slice(None), 1: slice(-1, None)}[side]


def _part(dy: int, dx: int, gray: np.ndarray) -> bytes:
    return np.array([(dy, dx, *gray.shape)], _PART).tobytes() + gray.tobytes()


def _read_parts(cells: np.ndarray) -> Iterator[tuple[tuple[int, int], np.ndarray]]:
    raw, at = cells.tobytes(), 0
    while at < len(raw):
        dy, dx, height, width = np.frombuffer(raw, _PART, 1, at)[0].tolist()
        at += _PART.itemsize
        part = np.frombuffer(raw, np.uint8, height * width, at).reshape(height, width)
        at += height * width
        yield (dy, dx), part

"""3x3 edge filter on gray pixel tables."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from lumagrid.functions.pixel import clamp8
from lumagrid.operators.lookup import attach
from lumagrid.operators.packing import for_each_key, pack
from lumagrid.operators.raster import IMAGE, with_dimensions
from lumagrid.settings import store

# The edge mask, row by row.
SOBEL_MASK = ((-1, 0, 1), (-2, 0, 2), (-1, 0, 1))

TILE = 512
_LINE = 512  # columns of a line in one array
BORDERS = ("zero", "reflect101")

# A pixel inside its tile: line and column from -1 to the tile's size, gray level,
# and whether it is a pixel of the image that belongs to this tile.
_CELL = np.dtype([("y", "<i2"), ("x", "<i2"), ("g", "<i4"), ("own", "?")])


def sobel(
    gray: DataFrame, border: str = "zero", strategy: str = "halo", tile: int = TILE
) -> DataFrame:
    """Edge strength 0..255 of every pixel of ``(image_id, y, x, g)``.

    border: outside the image lies ``zero``, or the mirrored image without its
    edge line (``reflect101``). strategy: ``halo`` shuffles packed pixels once,
    to square tiles with a one-pixel rim; ``scatter`` adds arrays of pixels to the lines
    around them, without Python.
    """
    if border not in BORDERS:
        raise ValueError(f"unknown border: {border}")
    source = gray.select(IMAGE, "y", "x", "g")
    if strategy == "halo":
        return _halo(source, border, tile)
    if strategy == "scatter":
        return _scatter(source, border)
    raise ValueError(f"unknown strategy: {strategy}")


def _scatter(source: DataFrame, border: str) -> DataFrame:
    """Sums over lines: what a line adds to the one above it, to itself and to the one below.

    Pixels become arrays of a line's next _LINE columns. The mask is a difference along the line
    times 1, 2, 1 across lines, so an array is turned into differences once and meets the
    arrays of two lines; only differences at its ends go to the arrays next to it.
    """
    kinds = dict(source.dtypes)
    part = F.floor(F.col("x") / _LINE).alias("part")
    cells = F.sort_array(F.collect_list(F.struct("x", "g"))).alias("cells")
    lines = source.groupBy(IMAGE, "y", part).agg(cells)
    first, last = F.get("cells", F.lit(0))["x"], F.element_at("cells", -1)["x"]
    # NULL stands for pixels that the image lacks.
    gap = F.array_repeat(F.lit(None).cast(kinds["g"]), 1)

    def padded(cell, at):
        following = F.coalesce(F.get("cells", at + 1)["x"], cell["x"] + 1)
        missing = (following - cell["x"] - 1).cast("int")
        return F.concat(F.array(cell["g"]), F.flatten(F.array_repeat(gap, missing)))

    whole = last - first + 1 == F.size("cells")
    values = F.when(whole, F.col("cells.g")).otherwise(F.flatten(F.transform("cells", padded)))
    lines = lines.select(IMAGE, "y", "part", first.alias("x0"), values.alias("g"))
    if border == "reflect101":
        lines, _ = store(lines)
        sizes = lines.groupBy(IMAGE).agg(
            (F.max("y") + 1).alias("height"),
            (F.max(F.col("x0") + F.size("g")) - 1).alias("right"),
            F.count(F.lit(1)).alias("n"),
        )
        lines = attach(lines, sizes, [IMAGE], weight="n").drop("n")
    else:
        lines = lines.withColumns({"height": F.lit(None).cast("bigint"), "right": F.lit(None).cast("bigint")})
    none = F.array(F.lit(0), F.lit(0)).cast(f"array<{kinds['g']}>")
    # From the pixel before the first to the one after the last.
    steps = F.zip_with(
        F.concat("g", none), F.concat(none, "g"), lambda a, b: F.coalesce(a, F.lit(0)) - F.coalesce(b, F.lit(0))
    )
    lines = lines.withColumn("steps", steps)
    nothing, zero = F.lit(None), F.lit(0).cast(kinds["g"])

    def to_line(dy: int):
        y, role = (F.col("y") + dy).alias("y"), F.lit(dy).alias("role")
        left = F.get("steps", F.lit(0))
        right = F.element_at("steps", -1)
        kept = [F.col(c) if dy == 0 else nothing.cast(dict(lines.dtypes)[c]) for c in ("x0", "g", "height", "right")]
        names = ("x0", "g", "height", "right")
        own = [y, F.col("part").alias("part"), role, (F.col("x0") - 1).alias("from"), F.col("steps").alias("steps")]
        own += [zero.alias("at_start"), zero.alias("at_end"), *[k.alias(n) for k, n in zip(kept, names)]]
        blank = [nothing.cast(dict(lines.dtypes)["x0"]).alias("from"), nothing.cast(dict(lines.dtypes)["steps"]).alias("steps")]
        rest = [nothing.cast(dict(lines.dtypes)[n]).alias(n) for n in names]
        before = [y, (F.col("part") - 1).alias("part"), role, *blank, zero.alias("at_start"), left.alias("at_end"), *rest]
        after = [y, (F.col("part") + 1).alias("part"), role, *blank, right.alias("at_start"), zero.alias("at_end"), *rest]
        starts = F.col("x0") == F.col("part") * _LINE
        ends = F.col("x0") + F.size("g") == (F.col("part") + 1) * _LINE
        return [F.struct(*own), F.when(starts, F.struct(*before)), F.when(ends, F.struct(*after))]

    sent = F.array(*[row for dy in (-1, 0, 1) for row in to_line(dy)])
    met = lines.select(IMAGE, F.inline(F.filter(sent, lambda row: row.isNotNull())))
    sums = []
    for name, role in (("above", 1), ("here", 0), ("below", -1)):
        of_role = F.col("role") == role
        line = F.struct("from", "steps")
        sums += [
            F.first(F.when(of_role & F.col("steps").isNotNull(), line), ignorenulls=True).alias(name),
            F.sum(F.when(of_role, F.col("at_start")).otherwise(0)).alias(f"{name}_start"),
            F.sum(F.when(of_role, F.col("at_end")).otherwise(0)).alias(f"{name}_end"),
        ]
    own = F.struct("x0", "g", "height", "right")
    sums.append(F.first(F.when(F.col("g").isNotNull(), own), ignorenulls=True).alias("own"))
    met = met.groupBy(IMAGE, "y", "part").agg(*sums).where(F.col("own").isNotNull())
    # The line outside a mirrored border is the one inside; that of a single line is itself.
    top, bottom = F.col("y") == 0, F.col("y") == F.col("own.height") - 1
    single = F.coalesce(F.col("own.height") == 1, F.lit(False))
    mirrored = F.col("own.height").isNotNull()
    weights = {
        "above": F.when(single | (mirrored & top), 0).when(mirrored & bottom, 2).otherwise(1),
        "here": F.when(single, 4).otherwise(2),
        "below": F.when(single | (mirrored & bottom), 0).when(mirrored & top, 2).otherwise(1),
    }
    met = met.withColumns({f"{name}_weight": weight for name, weight in weights.items()})

    n = F.size("own.g")

    def aligned(name: str):
        """A line's differences at the pixels of this one: a slice, unless the lines differ in extent."""
        steps, begin = F.col(name)["steps"], F.col(name)["from"]
        alike = (begin == F.col("own.x0") - 1) & (F.size(steps) == n + 2)
        shift = (F.col("own.x0") - begin).cast("int")
        looked_up = F.transform("own.g", lambda _, at: F.coalesce(F.get(steps, at + shift), F.lit(0)))
        nothing = F.array_repeat(F.lit(0).cast(kinds["g"]), n)
        return F.when(begin.isNull(), nothing).when(alike, F.slice(steps, F.lit(2), n)).otherwise(looked_up)

    met = met.withColumns({f"{name}_line": aligned(name) for name in weights})
    rim = F.zip_with(
        "above_line", "below_line", lambda a, b: a * F.col("above_weight") + b * F.col("below_weight")
    )
    totals = F.zip_with(rim, "here_line", lambda r, h: r + h * F.col("here_weight"))
    met = met.withColumn("totals", totals)
    # What the arrays before and after add to the first and the last column.
    ends = {
        side: sum((F.col(f"{name}_{side}") * F.col(f"{name}_weight") for name in weights), F.lit(0))
        for side in ("start", "end")
    }
    at_start = F.when(F.col("own.x0") == F.col("part") * _LINE, ends["start"]).otherwise(0)
    at_end = F.when(F.col("own.x0") + n == (F.col("part") + 1) * _LINE, ends["end"]).otherwise(0)
    met = met.withColumns({"at_start": at_start, "at_end": at_end})
    # Across a mirrored border a line is even.
    left_edge = mirrored & (F.col("own.x0") == 0)
    right_edge = mirrored & (F.col("own.x0") + n - 1 == F.col("own.right"))
    met = met.withColumns({"left_edge": left_edge, "right_edge": right_edge})

    def edge(total, at):
        first, last = at == 0, at == n - 1
        total = total + F.when(first, F.col("at_start")).otherwise(0) + F.when(last, F.col("at_end")).otherwise(0)
        none = (first & F.col("left_edge")) | (last & F.col("right_edge"))
        return F.when(none, 0).otherwise(clamp8(total)).cast("int")

    lines = met.select(
        IMAGE, F.col("y").cast(kinds["y"]).alias("y"), F.col("own.x0").alias("x0"), F.col("own.g").alias("g"), "totals",
        "at_start", "at_end", "left_edge", "right_edge",
    )
    rough = (F.col("at_start") != 0) | (F.col("at_end") != 0) | F.col("left_edge") | F.col("right_edge")
    n = F.size("totals")
    edges = F.when(rough, F.transform("totals", edge)).otherwise(
        F.transform("totals", lambda t: clamp8(t).cast("int"))
    )
    lines = lines.select(IMAGE, "y", "x0", F.posexplode(F.arrays_zip(edges.alias("edge"), F.col("g"))).alias("at", "p"))
    return lines.where(F.col("p.g").isNotNull()).select(
        IMAGE, "y", (F.col("x0") + F.col("at")).cast(kinds["x"]).alias("x"), F.col("p.edge").alias("edge")
    )


def _halo(source: DataFrame, border: str, tile: int) -> DataFrame:
    if not 2 <= tile < 1 << 15:
        raise ValueError("a tile must have 2 to 32767 lines")
    kinds = dict(source.dtypes)
    types = {f.name: f.type for f in to_arrow_schema(source.schema)}
    if border == "reflect101":
        source = with_dimensions(source).select(IMAGE, "y", "x", "g", "height", "width")
    tiles = pack(source, _locate(tile), f"{IMAGE} {kinds[IMAGE]}, ty bigint, tx bigint")
    return for_each_key(
        tiles,
        [IMAGE, "ty", "tx"],
        _CELL,
        _tile_edges(tile, types),
        f"{IMAGE} {kinds[IMAGE]}, y {kinds['y']}, x {kinds['x']}, edge int",
    )


def _locate(tile: int):
    """Where pixels lie: in their own tile and, at its rim, in the tiles next to it."""

    def locate(table: pa.Table):
        y, x = (table[c].to_numpy() for c in "yx")
        row = np.arange(len(y))
        inside = np.ones(len(y), bool)
        if "height" in table.column_names:
            row, y, x, inside = _with_mirror_images(
                row, y, x, inside, table["height"].to_numpy(), table["width"].to_numpy()
            )
        ty, tx = y // tile, x // tile
        ly, lx = y - ty * tile, x - tx * tile
        near_y = (ly == tile - 1).astype(np.int8) - (ly == 0)
        near_x = (lx == tile - 1).astype(np.int8) - (lx == 0)
        parts = [(np.flatnonzero(inside), 0, 0), (np.flatnonzero(~inside), 0, 0)]
        rim = np.flatnonzero((near_y != 0) | (near_x != 0))
        for dy in (-1, 0, 1):
            for dx in (-1, 0, 1):
                if dy or dx:
                    touches = (dy == 0) | (near_y[rim] == dy)
                    touches &= (dx == 0) | (near_x[rim] == dx)
                    parts.append((rim[touches], dy, dx))
        at = np.concatenate([p for p, _, _ in parts])
        dy, dx = (
            np.concatenate([np.full(len(part[0]), part[k], np.int32) for part in parts])
            for k in (1, 2)
        )
        cells = np.empty(len(at), _CELL)
        cells["y"] = ly[at] - dy * tile
        cells["x"] = lx[at] - dx * tile
        cells["g"] = table["g"].to_numpy()[row[at]]
        cells["own"] = False
        cells["own"][: len(parts[0][0])] = True
        image = table[IMAGE].combine_chunks().dictionary_encode().take(pa.array(row[at]))
        where = ((ty[at] + dy).astype(np.int64), (tx[at] + dx).astype(np.int64))
        return {IMAGE: image, "ty": where[0], "tx": where[1]}, cells

    return locate


def _with_mirror_images(row, y, x, inside, height, width):
    """Pixels plus the copies that a mirrored border puts one step outside their image."""
    for axis, sizes in ((0, height), (1, width)):
        at, size = (y, x)[axis], sizes[row]
        before = np.flatnonzero(at == np.minimum(1, size - 1))
        after = np.flatnonzero(at == np.maximum(0, size - 2))
        copied = np.concatenate([before, after])
        moved = np.concatenate([np.full(len(before), -1), size[after]]).astype(at.dtype)
        row = np.append(row, row[copied])
        y = np.append(y, y[copied] if axis else moved)
        x = np.append(x, moved if axis else x[copied])
        inside = np.append(inside, np.zeros(len(copied), bool))
    return row, y, x, inside


def _tile_edges(tile: int, types: dict[str, pa.DataType]):
    mask = np.array(SOBEL_MASK, dtype=np.int32)

    def edges(key: tuple, cells: np.ndarray) -> pa.RecordBatch:
        image, ty, tx = key
        own = cells[cells["own"]]
        y, x = own["y"].astype(np.int64), own["x"].astype(np.int64)
        # A small image fills only a corner of its tile.
        height, width = (int(cells[c].max(initial=-1)) + 1 for c in "yx")
        padded = np.zeros((height + 2, width + 2), dtype=np.int32)
        padded[cells["y"] + 1, cells["x"] + 1] = cells["g"]
        total = np.zeros((height, width), dtype=np.int32)
        for dy in range(3):
            for dx in range(3):
                if mask[dy, dx]:
                    total += mask[dy, dx] * padded[dy : dy + height, dx : dx + width]
        return pa.record_batch(
            {
                IMAGE: pa.repeat(pa.scalar(image, types[IMAGE]), len(own)),
                "y": pa.array(y + ty * tile).cast(types["y"]),
                "x": pa.array(x + tx * tile).cast(types["x"]),
                "edge": pa.array(np.clip(total[y, x], 0, 255)),
            }
        )

    return edges

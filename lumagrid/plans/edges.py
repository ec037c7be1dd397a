"""Edge maps of colour images."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumagrid.functions.pixel import bgr_to_gray
from lumagrid.operators.raster import IMAGE
from lumagrid.operators.stencil import TILE, sobel
from lumagrid.operators.tiles import edge_map_tiles, pixels_from_tiles, tiles_from_pixels
from lumagrid.settings import cut_lineage


def edge_map(
    pixels: DataFrame,
    mode: str = "trunc",
    border: str = "zero",
    strategy: str | None = None,
    tile: int = TILE,
) -> DataFrame:
    """8-bit colour pixels to gray, then through the edge filter.

    Gray levels travel as tiles of bytes (``tiles``), packed chunks (``halo``) or arrays of lines
    (``scatter``, without Python); all give the same. From pixel rows chunks are fastest, and
    tiles where the border is mirrored, as these need no sizes before they are made.
    """
    strategy = strategy or ("halo" if border == "zero" else "tiles")
    gray = pixels.select(IMAGE, "y", "x", bgr_to_gray(mode=mode).alias("g"))
    if strategy != "tiles":
        return sobel(gray, border, strategy, tile)
    packed = tiles_from_pixels(gray, ("g",), tile)
    if border == "reflect101":  # sizes of images are looked up in the tiles
        packed = cut_lineage(packed)
    edges = pixels_from_tiles(edge_map_tiles(packed, mode, border, tile), ("edge",), tile)
    kinds = dict(pixels.dtypes)
    return edges.select(IMAGE, *[F.col(c).cast(kinds[c]).alias(c) for c in "yx"], "edge")

"""Two Bloom filters over all rows: hashes seen once or more, hashes seen twice or more.

Every task sets bits in filters of its own; those of all tasks are merged block by block,
where a bit that two of them set counts as set twice. A hash that occurs twice has all
its bits in the second filter; a few others have so too, more of them the fuller it is.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lumagrid.settings import sized

FILTER_BITS = 1 << 28  # 32 MB a filter, room for some 40 million different hashes
_HASHES = 3
_BLOCK_BITS = 1 << 16
_PART_BITS = 1 << 23  # bits that one partition merges
_FLUSH = 200_000  # hashes that are set in the filters at once
_SCHEMA = pa.schema([("block", pa.int32()), ("once", pa.binary()), ("twice", pa.binary())])
_SPARK_SCHEMA = "block int, once binary, twice binary"


def _bits(hashes: np.ndarray, n_bits: int) -> np.ndarray:
    """A row of bit positions for each hash."""
    step = (hashes >> np.uint64(32)) | np.uint64(1)
    steps = np.arange(_HASHES, dtype=np.uint64)
    return (hashes[:, None] + step[:, None] * steps) % np.uint64(n_bits)


def _places(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return (at >> np.uint64(3)).astype(np.int64), np.uint8(1) << (at & np.uint64(7)).astype(np.uint8)


def bits_for(n_hashes: int, most: int = FILTER_BITS) -> int:
    """Bits of a filter with room for so many different hashes, but at most ``most``."""
    return min(most, max(_BLOCK_BITS, 1 << (8 * n_hashes).bit_length()))


class TwoFilters:
    def __init__(self, n_bits: int):
        self.n_bits = n_bits
        self.once = np.zeros(n_bits // 8, np.uint8)
        self.twice = np.zeros(n_bits // 8, np.uint8)

    def add(self, hashes: np.ndarray) -> None:
        """Each hash stands for one occurrence that counts."""
        rows = np.sort(_bits(hashes, self.n_bits), axis=1)
        repeated = np.zeros(rows.shape, bool)
        repeated[:, 1:] = rows[:, 1:] == rows[:, :-1]  # bits that a hash has twice count once
        at, n = np.unique(rows[~repeated], return_counts=True)
        byte, bit = _places(at)
        again = (n > 1) | ((self.once[byte] & bit) != 0)
        np.bitwise_or.at(self.twice, byte[again], bit[again])
        np.bitwise_or.at(self.once, byte, bit)

    def blocks(self) -> Iterator[tuple[int, bytes, bytes]]:
        size = _BLOCK_BITS // 8
        for block in np.flatnonzero(self.once.reshape(-1, size).any(axis=1)):
            part = slice(block * size, (block + 1) * size)
            yield int(block), _pack(self.once[part]), _pack(self.twice[part])

    def merge(self, once: bytes, twice: bytes) -> None:
        bits = _unpack(once)
        self.twice |= _unpack(twice) | (self.once & bits)
        self.once |= bits


def _pack(bits: np.ndarray) -> bytes:
    """Positions of 2 bytes while they take less room than the bits themselves."""
    at = np.flatnonzero(np.unpackbits(bits, bitorder="little"))
    return at.astype("<u2").tobytes() if len(at) * 2 < len(bits) else bits.tobytes()


def _unpack(packed: bytes) -> np.ndarray:
    if len(packed) == _BLOCK_BITS // 8:
        return np.frombuffer(packed, np.uint8)
    bits = np.zeros(_BLOCK_BITS, np.uint8)
    bits[np.frombuffer(packed, "<u2")] = 1
    return np.packbits(bits, bitorder="little")


def held(filter_bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which hashes have all their bits in the filter."""
    byte, bit = _places(_bits(hashes, len(filter_bits) * 8))
    return ((filter_bits[byte] & bit) != 0).all(axis=1)


def seen_twice(
    df: DataFrame, hashes_of: Callable[[bytes | None], np.ndarray], n_bits: int = FILTER_BITS
) -> bytes:
    """The filter of hashes that occur twice among ``hashes_of`` of the one binary column of ``df``.

    Its size is fixed by ``n_bits`` (a multiple of 65,536), also on the driver.
    """
    return _filter_of(df, hashes_of, n_bits, "twice")


def seen(df: DataFrame, hashes_of: Callable[[bytes | None], np.ndarray], n_bits: int = FILTER_BITS) -> bytes:
    """The filter of all hashes, else like ``seen_twice``."""
    return _filter_of(df, hashes_of, n_bits, "once")


def _filter_of(df: DataFrame, hashes_of: Callable, n_bits: int, which: str) -> bytes:
    spark = df.sparkSession

    def set_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters, waiting, n = TwoFilters(n_bits), [], 0
        for batch in batches:
            for value in batch.column(0):
                waiting.append(hashes_of(value.as_py()))
                n += len(waiting[-1])
                if n > _FLUSH:
                    filters.add(np.concatenate(waiting))
                    waiting, n = [], 0
        if n:
            filters.add(np.concatenate(waiting))
        yield from _in_batches(filters.blocks())

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merged: dict[int, TwoFilters] = {}
        for batch in batches:
            for row in batch.to_pylist():
                if row["block"] not in merged:
                    merged[row["block"]] = TwoFilters(_BLOCK_BITS)
                merged[row["block"]].merge(row["once"], row["twice"])
        kept = ((b, getattr(m, which)) for b, m in merged.items())
        yield from _in_batches((b, b"", _pack(bits)) for b, bits in kept if bits.any())

    blocks = df.mapInArrow(set_bits, _SPARK_SCHEMA)
    parts = min(int(spark.conf.get("spark.sql.shuffle.partitions")), n_bits // _BLOCK_BITS)
    whole, size = np.zeros(n_bits // 8, np.uint8), _BLOCK_BITS // 8
    dealt = sized(blocks.repartition(parts, "block"), n_bits, _PART_BITS)
    for row in dealt.mapInArrow(merge, _SPARK_SCHEMA).toLocalIterator():
        whole[row.block * size : (row.block + 1) * size] = _unpack(bytes(row.twice))
    return whole.tobytes()


def _in_batches(rows: Iterator[tuple], per_batch: int = 256) -> Iterator[pa.RecordBatch]:
    found: list[tuple] = []
    for row in rows:
        found.append(row)
        if len(found) == per_batch:
            yield _batch(found)
            found = []
    if found:
        yield _batch(found)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _SCHEMA.types, strict=True)]
    return pa.RecordBatch.from_arrays(columns, schema=_SCHEMA)

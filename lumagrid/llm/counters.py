"""Sums of a fixed number of counters over all rows."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lumagrid.settings import sized

_BLOCK = 1 << 12
_FLUSH = 1 << 20
_SPARK_SCHEMA = "block int, places binary, counts binary"
_SCHEMA = pa.schema([("block", pa.int32()), ("places", pa.binary()), ("counts", pa.binary())])


def count_places(
    df: DataFrame, places_of: Callable[[pa.RecordBatch], Iterable[np.ndarray]], size: int
) -> np.ndarray:
    """How often each place from 0 to ``size - 1`` is among ``places_of`` the batches of ``df``.

    A task holds ``size`` counters and sends those that are not 0, block by block; the sums,
    whose number does not depend on the rows, come to the driver.
    """
    n_blocks = -(-size // _BLOCK)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, waiting, n = np.zeros(n_blocks * _BLOCK, np.int64), [], 0
        for batch in batches:
            for places in places_of(batch):
                waiting.append(places)
                n += len(places)
                if n > _FLUSH:
                    counts += np.bincount(np.concatenate(waiting), minlength=len(counts))
                    waiting, n = [], 0
        if n:
            counts += np.bincount(np.concatenate(waiting), minlength=len(counts))
        for block, part in enumerate(counts.reshape(n_blocks, _BLOCK)):
            at = np.flatnonzero(part)
            if len(at):
                yield _row(block, at.astype("<u2").tobytes(), part[at].tobytes())

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for row in batch.to_pylist():
                if row["block"] not in sums:
                    sums[row["block"]] = np.zeros(_BLOCK, np.int64)
                sums[row["block"]][np.frombuffer(row["places"], "<u2")] += np.frombuffer(row["counts"], np.int64)
        for block, total in sums.items():
            yield _row(block, b"", total.tobytes())

    parts = min(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), n_blocks)
    dealt = sized(df.mapInArrow(count, _SPARK_SCHEMA).repartition(parts, "block"), size)
    summed = dealt.mapInArrow(add, _SPARK_SCHEMA)
    whole = np.zeros((n_blocks, _BLOCK), np.int64)
    for row in summed.toLocalIterator():
        whole[row.block] = np.frombuffer(bytes(row.counts), np.int64)
    return whole.ravel()[:size]


def _row(block: int, places: bytes, counts: bytes) -> pa.RecordBatch:
    columns = [pa.array([v], t) for v, t in zip((block, places, counts), _SCHEMA.types, strict=True)]
    return pa.RecordBatch.from_arrays(columns, schema=_SCHEMA)

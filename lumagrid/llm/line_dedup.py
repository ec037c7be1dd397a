"""Line dedup with a filter of hashes seen once and one of those seen twice.

A line of two documents has all its bits in the second Bloom filter (see ``bloom``), so only
lines that it holds are shuffled, as digests, to confirm a repeat and to choose the first
document. The filters never change the result: with more lines than they have room for,
more lines are shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumagrid.llm.bloom import FILTER_BITS, held, seen_twice
from lumagrid.llm.common import LOWER_BYTES, free_name, hands_back
from lumagrid.operators.lookup import attach
from lumagrid.settings import store

_PART_ROWS = 256  # texts that are rebuilt together


def line_keys(text: bytes | None, min_chars: int) -> list[bytes | None]:
    """The key of each line; None where it is shorter than ``min_chars`` code points."""
    keys = []
    for line in (text or b"").translate(LOWER_BYTES).split(b"\n"):
        key = line.strip()
        if len(key) < 4 * min_chars and len(key.decode("utf-8", "replace")) < min_chars:
            key = None
        keys.append(key)
    return keys


def key_hashes(text: bytes | None, min_chars: int) -> np.ndarray:
    """A 64-bit hash for each different key of a document."""
    keys = {k for k in line_keys(text, min_chars) if k is not None}
    return np.fromiter(map(xxhash.xxh3_64_intdigest, keys), np.uint64, len(keys))


def repeated_lines(
    docs: DataFrame, key: str, text: str, n_bits: int = FILTER_BITS, min_chars: int = 10
) -> DataFrame:
    """``(id, digest)``: what documents lose, a line's key by its SHA-256 digest."""
    spark = docs.sparkSession
    named = docs.where(F.col(key).isNotNull()).select(
        F.col(key).alias("id"), F.col(text).cast("binary").alias("text")
    )
    twice = spark.sparkContext.broadcast(
        seen_twice(named.select("text"), lambda value: key_hashes(value, min_chars), n_bits)
    )

    id_type = named.schema["id"].dataType

    def suspects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(twice.value, np.uint8)
        for batch in batches:
            rows, digests = [], []
            for row, value in enumerate(batch.column(1)):
                keys = sorted({k for k in line_keys(value.as_py(), min_chars) if k is not None})
                if keys:
                    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, keys), np.uint64, len(keys))
                    found = [
                        hashlib.sha256(k).digest()
                        for k, h in zip(keys, held(bits, hashes), strict=True)
                        if h
                    ]
                    rows += [row] * len(found)
                    digests += found
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(digests, pa.binary())],
                names=["id", "digest"],
            )

    found, _ = store(named.mapInArrow(hands_back(suspects), f"id {id_type.simpleString()}, digest binary"))
    firsts = (
        found.groupBy("digest")
        .agg(F.min("id").alias("first"), F.max("id").alias("last"), F.count(F.lit(1)).alias("n"))
        .where(F.col("first") < F.col("last"))
        .drop("last")
    )
    judged = attach(found, firsts, ["digest"], weight="n", row_bytes=96)
    return judged.where(F.col("id") != F.col("first")).select("id", "digest")


def kept_lines(texts: pa.Array, digests: pa.Array, min_chars: int) -> Iterator[pa.Array]:
    """``kept``, ``n_lines`` and ``n_dropped`` of each text, some hundred at a time; it loses lines of its ``digests``."""
    for start in range(0, len(texts), _PART_ROWS):
        kept, n_lines, n_dropped = [], [], []
        part = slice(start, start + _PART_ROWS)
        for value, gone in zip(texts[part].to_pylist(), digests[part].to_pylist(), strict=True):
            lines = stay = (value or b"").split(b"\n")
            if gone:
                gone, keys = set(gone), line_keys(value, min_chars)
                stay = [
                    line
                    for line, k in zip(lines, keys, strict=True)
                    if k is None or hashlib.sha256(k).digest() not in gone
                ]
            kept.append(b"\n".join(stay))
            n_lines.append(len(lines))
            n_dropped.append(len(lines) - len(stay))
        columns = pa.array(kept, pa.binary()), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())
        yield pa.StructArray.from_arrays(columns, names=["kept", "n_lines", "n_dropped"])


def dedup_lines(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    n_bits: int = FILTER_BITS,
    min_chars: int = 10,
) -> DataFrame:
    """``docs`` with the kept lines as text, and ``n_lines`` and ``n_dropped`` (long).

    A line's key is the line without white space at both ends and with A-Z lower-cased. A
    key of at least ``min_chars`` code points in at least two documents stays only in the
    document of the smallest id, in all its lines there.

    A null or empty text is one empty line and becomes empty. Rows without an id are left
    whole and compared with none; rows of one id count as one document. Columns of ``docs``
    that are called ``n_lines`` or ``n_dropped`` are replaced, others stay. An empty table
    gives an empty result. Lines of any length are compared whole.
    """
    lost = free_name(docs, "lost")
    drops = (
        repeated_lines(docs, key, text, n_bits, min_chars)
        .groupBy(F.col("id").alias(lost + "id"))
        .agg(F.collect_list("digest").alias(lost))
    )

    # Arrow and small parts: copies of a whole batch as Python objects would take most of a worker's memory.
    @F.arrow_udf("kept binary, n_lines long, n_dropped long")
    def rebuild(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, digests in batches:
            yield from kept_lines(texts, digests, min_chars)

    others = [c for c in docs.columns if c.lower() not in ("n_lines", "n_dropped", text.lower(), key.lower())]
    docs = docs.select(key, text, *others)
    with_id = docs.where(F.col(key).isNotNull()).join(drops, F.col(key) == F.col(lost + "id"), "left")
    without = docs.where(F.col(key).isNull()).withColumn(lost, F.lit(None).cast("array<binary>"))
    rows = with_id.drop(lost + "id").unionByName(without)
    done = rows.withColumn(lost, rebuild(F.col(text).cast("binary"), F.col(lost)))
    return done.select(
        key,
        F.col(lost)["kept"].cast("string").alias(text),
        *others,
        F.col(lost)["n_lines"].alias("n_lines"),
        F.col(lost)["n_dropped"].alias("n_dropped"),
    )

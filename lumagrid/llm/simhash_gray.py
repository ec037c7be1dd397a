"""SimHash near duplicates by a hierarchical index over fingerprints in Gray order.

Distinct fingerprints are sorted by their rank in the Gray code, where neighbours have
many bits in common, and cut into blocks. A node of the index stands for a run of
that order: its mask holds the bits that all of the run agree on, its pattern their values.
Nodes are grouped by eight up to one root, and two trees are walked at once: a pair of
nodes adds the differences in the bits that became common at its level to those found
above it, and is dropped with everything below it once there are too many.

The same walk serves twice. The blocks themselves, of which there are at most twice
MAX_BLOCKS, make the upper tree, which tells every run of 256 fingerprints the blocks that
it may have links with; a task then walks the trees of a pair of blocks. It returns the
components that it finds, not the pairs, so a group of near copies costs a row or two for
each of its fingerprints.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumagrid.llm.common import groups, words_of
from lumagrid.llm.components import components
from lumagrid.operators.lookup import attach
from lumagrid.settings import store

SEED = 42
# Blocks of about this many fingerprints, unless that made more than MAX_BLOCKS of them.
BLOCK = 4096
MAX_BLOCKS = 1 << 16
_RUN = 256  # fingerprints that are sent together
_FAN = 8
_SLICE = 4096  # pairs of nodes that are opened at once
_HASHES = 1 << 16  # shingles whose bits are counted at once
_ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def fingerprint(text: bytes | None, k: int) -> int:
    """Per bit, whether more than half of the shingles' hashes have it; 0 without words."""
    words = words_of(text)
    if not words:
        return 0
    joined, k = b" ".join(words), min(k, len(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    digest = xxhash.xxh64_intdigest
    count, n = np.zeros(64, np.int64), len(words) - k + 1
    for at in range(0, n, _HASHES):
        till = min(n, at + _HASHES)
        spans = zip(starts[at:till].tolist(), ends[at + k - 1 : till + k - 1].tolist(), strict=True)
        hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in spans), np.uint64, till - at)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        count += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * count > n, bitorder="little").view(np.uint64)[0])


def gray_rank(code: Column) -> Column:
    """The place of a 64-bit code in Gray order, as a long that sorts like it."""
    for shift in (1, 2, 4, 8, 16, 32):
        code = code.bitwiseXOR(F.shiftrightunsigned(code, shift))
    return code.bitwiseXOR(F.lit(-(1 << 63)))


class Tree:
    """Levels of masks and patterns over runs in Gray order; level 0 are the runs given."""

    def __init__(self, masks: np.ndarray, patterns: np.ndarray):
        self.levels = [(masks, patterns & masks)]
        while len(masks) > 1:
            at = np.arange(0, len(masks), _FAN)
            same = ~(np.bitwise_and.reduceat(patterns, at) ^ np.bitwise_or.reduceat(patterns, at))
            masks = np.bitwise_and.reduceat(masks, at) & same
            patterns = patterns[at] & masks
            self.levels.append((masks, patterns))

    @classmethod
    def of(cls, codes: np.ndarray) -> Tree:
        return cls(np.full(len(codes), _ALL), codes)

    def level(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        return self.levels[min(i, len(self.levels) - 1)]


def meetings(a: Tree, b: Tree, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of runs of ``a`` and ``b`` that differ in at most ``radius`` of their common bits.

    With ``a is b``, each pair of different runs comes once.
    """
    top = max(len(a.levels), len(b.levels)) - 1
    one = np.zeros(1, np.int64)
    none = np.zeros(1, np.uint64)
    # The root is opened like any node, from a parent that has no bits in common.
    waiting = [(top + 1, one, one, none, np.zeros(1, np.int64))]
    steps = np.arange(_FAN)
    while waiting:
        level, x, y, known, apart = waiting.pop()
        if len(x) > _SLICE:
            for at in range(0, len(x), _SLICE):
                waiting.append((level, *(v[at : at + _SLICE] for v in (x, y, known, apart))))
            continue
        level -= 1
        (mask_a, code_a), (mask_b, code_b) = a.level(level), b.level(level)
        # A tree that is lower than the other stays at its root.
        xs = x[:, None] * _FAN + steps if level < len(a.levels) - 1 else x[:, None]
        ys = y[:, None] * _FAN + steps if level < len(b.levels) - 1 else y[:, None]
        fits = (xs < len(mask_a))[:, :, None] & (ys < len(mask_b))[:, None, :]
        if a is b:
            below = ys[:, None, :] > xs[:, :, None]
            fits &= below if level == 0 else below | (ys[:, None, :] == xs[:, :, None])
        pair, i, j = np.nonzero(fits)
        x, y = xs[pair, i], ys[pair, j]
        both = mask_a[x] & mask_b[y]
        apart = apart[pair] + np.bitwise_count((code_a[x] ^ code_b[y]) & both & ~known[pair])
        near = np.flatnonzero(apart <= radius)
        if not len(near):
            continue
        if level == 0:
            yield x[near], y[near]
        else:
            waiting.append((level, x[near], y[near], both[near], apart[near]))


def unite(labels: np.ndarray, x: np.ndarray, y: np.ndarray) -> None:
    """Gives both ends of every link the label of the lower one, and all that have theirs."""
    while True:
        a, b = labels[x], labels[y]
        open_ = a != b
        if not open_.any():
            return
        x, y, a, b = x[open_], y[open_], a[open_], b[open_]
        np.minimum.at(labels, np.maximum(a, b), np.minimum(a, b))
        while True:
            further = labels[labels]
            if (further == labels).all():
                break
            labels[:] = further


def _summary(codes: np.ndarray) -> tuple[int, int]:
    """Mask and pattern of a run, as signed longs."""
    mask = ~(np.bitwise_and.reduce(codes) ^ np.bitwise_or.reduce(codes))
    return int(mask.view(np.int64)), int((codes[0] & mask).view(np.int64))


_RUNS = "block long, first boolean, block_mask long, block_pattern long, mask long, pattern long, codes binary"


def _blocks(nodes: DataFrame, n: int) -> DataFrame:
    """Runs of fingerprints in Gray order with the block they belong to."""
    n_blocks = min(MAX_BLOCKS, max(1, n // BLOCK))
    size = 2 * max(BLOCK, -(-n // n_blocks))
    names = [f.split()[0] for f in _RUNS.split(", ")]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def block(codes: np.ndarray, first: int) -> pa.RecordBatch:
            whole = _summary(codes)
            runs = [codes[i : i + _RUN] for i in range(0, len(codes), _RUN)]
            rows = [(first, i == 0, *whole, *_summary(r), r.tobytes()) for i, r in enumerate(runs)]
            return pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names=names)

        codes, ranks = np.empty(0, np.uint64), np.empty(0, np.int64)
        for batch in batches:
            codes = np.concatenate([codes, batch.column(0).to_numpy().view(np.uint64)])
            ranks = np.concatenate([ranks, batch.column(1).to_numpy()])
            while len(codes) > size:
                yield block(codes[: size // 2], int(ranks[0]))
                codes, ranks = codes[size // 2 :], ranks[size // 2 :]
        if len(codes):
            yield block(codes, int(ranks[0]))

    ranked = nodes.select("code", gray_rank(F.col("code")).alias("rank"))
    dealt = ranked.repartitionByRange(n_blocks, "rank").sortWithinPartitions("rank")
    return dealt.mapInArrow(cut, _RUNS)


def _unsigned(column: pa.Array) -> np.ndarray:
    return column.to_numpy().view(np.uint64)


def near_codes(nodes: DataFrame, n: int, radius: int) -> DataFrame:
    """Links ``(a, b)`` that join the stored ``code``s of ``nodes`` as all links of ``radius`` bits do."""
    spark = nodes.sparkSession
    runs, _ = store(_blocks(nodes, n))
    # At most 2 * MAX_BLOCKS rows of 24 bytes, as a block but the last of a partition is full.
    upper = runs.where("first").select("block", "block_mask", "block_pattern").orderBy("block").toArrow()
    upper = upper.combine_chunks()
    ids, masks, patterns = (c.to_numpy() for c in upper.columns)
    index = spark.sparkContext.broadcast((ids, masks.view(np.uint64), patterns.view(np.uint64)))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, masks, patterns = index.value
        blocks = Tree(masks, patterns)
        for whole in batches:
            for at in range(0, whole.num_rows, _RUN):
                batch = whole.slice(at, _RUN)
                own = batch.column("block").to_numpy()
                here = Tree(_unsigned(batch.column("mask")), _unsigned(batch.column("pattern")))
                for runs_met, blocks_met in meetings(here, blocks, radius):
                    for i in range(0, len(runs_met), _RUN):  # a row has up to 8 * _RUN bytes
                        run, other = runs_met[i : i + _RUN], ids[blocks_met[i : i + _RUN]]
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(np.minimum(own[run], other)),
                                pa.array(np.maximum(own[run], other)),
                                pa.array(own[run]),
                                batch.column("codes").take(pa.array(run)),
                            ],
                            names=["low", "high", "own", "codes"],
                        )

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for pair in groups(batches, ["low", "high"]):
            own = pair.column("own").to_numpy()
            codes = [np.frombuffer(c, np.uint64) for c in pair.column("codes").to_pylist()]
            sides = [_in_gray_order([codes[i] for i in np.flatnonzero(own == side)]) for side in np.unique(own)]
            if len(sides) == 2:
                a, b, shift = Tree.of(sides[0]), Tree.of(sides[1]), len(sides[0])
            elif pair.column("low")[0] == pair.column("high")[0]:
                a = b = Tree.of(sides[0])
                shift = 0
            else:
                continue  # nothing of the other block may be near
            codes = np.concatenate(sides)
            labels = np.arange(len(codes))
            for x, y in meetings(a, b, radius):
                unite(labels, x, y + shift)
            linked = np.flatnonzero(labels != np.arange(len(codes)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(codes[linked].view(np.int64)), pa.array(codes[labels[linked]].view(np.int64))],
                names=["a", "b"],
            )

    dealt = runs.mapInArrow(deal, "low long, high long, own long, codes binary")
    pairs = dealt.repartition("low", "high").sortWithinPartitions("low", "high")
    return store(pairs.mapInArrow(link, "a long, b long").distinct())[0]


def _in_gray_order(runs: list[np.ndarray]) -> np.ndarray:
    codes = np.concatenate(runs)
    ranks = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        ranks ^= ranks >> np.uint64(shift)
    return codes[np.argsort(ranks, kind="stable")]


def simhash_components(
    docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = 3, radius: int = 2
) -> DataFrame:
    """``(key, fingerprint, component_id)`` for each row of ``docs``.

    Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased, shingles ``k`` words in a row joined by
    a space, repeats included (with fewer words, all of them as one). A bit of the
    fingerprint, 16 hexadecimal digits, is set if more than half of the shingles' XXH64
    hashes (seed 42) have it. Documents are linked if their fingerprints differ in at most
    ``radius`` bits; ``component_id`` is the smallest id reachable.

    A text that is null, empty or without words has the fingerprint zero and is linked like any
    other. A row without an id has a fingerprint, is linked with nothing and has a null
    component. Rows of one id are documents of their own. Other columns are not read; an
    empty table gives an empty result. Texts of any length are taken whole.
    """
    docs = docs.select(F.col(key).alias("id"), F.col(text).cast("binary").alias("text"))
    kind = docs.schema["id"].dataType.simpleString()

    def codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(v.as_py(), k) for v in batch.column(1)], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], names=["id", "code"])

    index, _ = store(docs.mapInArrow(codes, f"id {kind}, code long"))
    by_code = index.where(F.col("id").isNotNull()).groupBy("code")
    nodes, n = store(by_code.agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("copies")))
    roots, n_roots = store(components(near_codes(nodes, n, radius)).withColumnRenamed("node", "code"))
    named = attach(nodes, roots, ["code"], how="left", n_rows=n_roots)
    named, _ = store(named.withColumn("root", F.coalesce("root", "code")))
    lowest = named.groupBy("root").agg(F.min("id").alias("component"), F.count(F.lit(1)).alias("codes"))
    classes = attach(named.select("code", "root", "copies"), lowest, ["root"], weight="codes")
    marked = attach(index, classes.select("code", "component", "copies"), ["code"], weight="copies", how="left")
    return marked.select(
        F.col("id").alias(key),
        F.lower(F.lpad(F.hex("code"), 16, "0")).alias("fingerprint"),
        F.when(F.col("id").isNotNull(), F.col("component")).alias("component_id"),
    )

"""N-gram Jaccard join: token-combination prefixes, then verification.

The tokens of a document are its word shingles, put in one order for all documents: by
frequency class, then by hash. Two sets of similarity ``t`` share at least two tokens
within their prefixes extended by one. Either one of these is of the rare class, and rare
tokens are indexed one by one; or both are frequent, and frequent tokens are indexed as
combinations of two (large sets, which would have too many, index them one by one within
their size class).

What lies in one bucket of the index is not paired with all of it. Every set is tried
against the hub of each of its buckets, links make components, and only buckets that then
hold several components compare the sets of different ones. A bit sketch bounds the
difference of two sets from below, so most pairs end there; the others are verified on
the sets themselves. No link between sets of different components is lost.
"""

from __future__ import annotations

import math
import os
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumagrid.llm.bloom import bits_for, held, seen, seen_twice
from lumagrid.llm.common import (
    WordHashes,
    free_name,
    hands_back,
    index_pairs,
    mix,
    run_starts,
    shingle_hashes,
    whole_parts,
    word_hashes,
    words_of,
)
from lumagrid.llm.components import components
from lumagrid.llm.counters import count_places
from lumagrid.operators.lookup import attach
from lumagrid.settings import sized, store

# Counters of the frequency table; its size is fixed, so it is gathered and broadcast.
_COUNTERS = 1 << 20
# Documents that make a token frequent, if the counters can tell.
FREQUENT = 256
# Sets above this size index frequent tokens one by one within their size class.
COMBINED_SIZE = 192
_GRID = 2048  # sets in one part of a bucket
_NEAREST = 4  # sets of a part that a set is first compared with
_LOW_KEYS = 4
_PAIRS = 1 << 19  # pairs that are looked at together
_PER_HUB = 2048  # sets that are compared with another one in one part
_SENT = 4 << 20  # bytes of sets that leave a task together
_SKETCH_BITS = 4  # for each token at least, so that few of the tokens in which sets differ meet in one bit
_SHORT = 4  # words of a sketch that are folded into one where sketches are sent to many buckets
_PART_ROWS = 1024  # documents that are indexed together
_SALT = np.uint64(0x5851F42D4C957F2D)


def token_set(text: bytes | None, k: int, cache: WordHashes) -> np.ndarray:
    """The distinct shingles of a text as ascending 64-bit hashes; empty without words."""
    return np.unique(shingle_hashes(word_hashes(words_of(text), cache), k))


def set_digest(tokens: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(tokens.tobytes())


# --- frequency classes ------------------------------------------------------------------


def class_table(docs: DataFrame, k: int) -> np.ndarray:
    """A frequency class for each value of a token's low bits; 0 is the rare class.

    Documents are counted for every token, in counters that several tokens share. A
    counter that exceeds the usual load by FREQUENT documents has a frequent token; its
    class is the power of two of that excess.
    """

    cache = WordHashes()

    def places(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        for value in batch.column(0):
            yield _counter_of(token_set(value.as_py(), k, cache))

    loads = count_places(docs.select("text"), places, _COUNTERS)
    usual = float(np.median(loads))
    excess = (loads - usual - 8 * math.sqrt(usual)) / FREQUENT
    return np.where(excess >= 1, 1 + np.floor(np.log2(np.maximum(excess, 1))), 0).astype(np.uint8)


def _counter_of(tokens: np.ndarray) -> np.ndarray:
    return (tokens & np.uint64(_COUNTERS - 1)).astype(np.int64)


# --- the index --------------------------------------------------------------------------


def index_keys(tokens: np.ndarray, classes: np.ndarray, num: int, den: int) -> np.ndarray:
    """The buckets of a set: two sets of similarity num / den or more, if not equal, share one."""
    n = len(tokens)
    if n < 2:
        return np.empty(0, np.uint64)  # linked with nothing but an equal set
    kinds = classes[_counter_of(tokens)]
    shared = -(-num * n // den)  # tokens that it shares with a linked set, at least
    prefix = np.lexsort((tokens, kinds))[: min(n, n - shared + 2)]
    rare, often = tokens[prefix][kinds[prefix] == 0], np.sort(tokens[prefix][kinds[prefix] > 0])
    keys = [rare]
    if len(often):
        base = den / num
        size_class = int(math.log(n) / math.log(base))
        for c in (size_class, size_class + 1):  # as the smaller and as the larger set of a pair
            salt = mix(np.array([c], np.uint64) + _SALT)
            if base ** (c + 1) <= COMBINED_SIZE:
                i, j = np.triu_indices(len(often), 1)
                keys.append(mix(mix(often[i] ^ salt) + often[j]))
            else:
                keys.append(mix(often ^ ~salt))
    return np.unique(np.concatenate(keys))


def sketch_of(tokens: np.ndarray) -> bytes:
    """A bit for each residue of the tokens' hashes: whether an odd number of them has it."""
    bits = max(64, _SKETCH_BITS << (len(tokens) - 1).bit_length()) if len(tokens) else 64
    at = (mix(tokens ^ _SALT) & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=bits) & 1).astype(np.uint8), bitorder="little").tobytes()


def fold(sketch: np.ndarray, words: int) -> np.ndarray:
    """Rows of 64-bit words as the sketches of ``words`` words that the same sets have."""
    while sketch.shape[-1] > words:
        half = sketch.shape[-1] // 2
        sketch = sketch[..., :half] ^ sketch[..., half:]
    return sketch


def short_of(sketch: bytes) -> bytes:
    """A sketch with a bit for each token at least. It tells unlike sets as well and is sent in their place."""
    words = np.frombuffer(sketch, np.uint64)
    return fold(words, max(1, len(words) // _SHORT)).tobytes()


class Sketches:
    """A column of sketches, of which pairs are compared many at a time."""

    _WORDS = 1 << 21  # of the pairs that are compared at once

    def __init__(self, column: pa.Array):
        column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
        ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
        data = column.buffers()[2]
        self.data = np.frombuffer(data, np.uint64, len(data) // 8) if len(column) else np.empty(0, np.uint64)
        self.starts, self.words = ends[:-1] // 8, np.diff(ends) // 8

    def _rows(self, at: np.ndarray, words: int) -> np.ndarray:
        out = np.empty((len(at), words), np.uint64)
        for own in np.unique(self.words[at]):
            which = self.words[at] == own
            out[which] = fold(self.data[self.starts[at[which]][:, None] + np.arange(own)], words)
        return out

    def apart(self, x: np.ndarray, other: Sketches, y: np.ndarray) -> np.ndarray:
        """For each pair, how many tokens its sets differ in at least."""
        out = np.empty(len(x), np.int64)
        words = np.minimum(self.words[x], other.words[y])
        for w in np.unique(words):
            at = np.flatnonzero(words == w)
            step = max(1, self._WORDS // int(w))
            for i in range(0, len(at), step):
                part = at[i : i + step]
                bits = self._rows(x[part], int(w)) ^ other._rows(y[part], int(w))
                out[part] = np.bitwise_count(bits).sum(axis=1)
        return out


def may_link(difference, total, num: int, den: int):
    """Whether sets that differ in ``difference`` tokens, of ``total`` tokens, can be linked."""
    return (den - num) * total >= (den + num) * difference


def _build_index(docs: DataFrame, k: int, num: int, den: int, classes) -> DataFrame:
    """``row`` is drawn for each row, and ``text`` is a digest of its text."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, kinds = WordHashes(), np.frombuffer(classes.value, np.uint8)
        # A worker keeps the memory that it once took, so few sets are held at a time.
        for batch in (b.slice(i, _PART_ROWS) for b in batches for i in range(0, b.num_rows, _PART_ROWS)):
            sets = [token_set(v.as_py(), k, cache) for v in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(np.frombuffer(os.urandom(8 * len(sets)), np.int64)),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([set_digest(s) for s in sets], pa.binary()),
                    pa.array([sketch_of(s) for s in sets], pa.binary()),
                    pa.array([index_keys(s, kinds, num, den).tobytes() for s in sets], pa.binary()),
                    pa.array([xxhash.xxh3_128_digest(v.as_py() or b"") for v in batch.column(1)], pa.binary()),
                ],
                names=["id", "row", "n", "digest", "sketch", "keys", "text"],
            )

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(
        hands_back(build), f"id {kind}, row long, n long, digest binary, sketch binary, keys binary, text binary"
    )


# --- pairs ------------------------------------------------------------------------------


def _passing(pairs: DataFrame, num: int, den: int) -> DataFrame:
    """Of pairs with sizes and sketches ``(a, b, share)``, without those that the sketches rule out."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            na, nb = (batch.column(c).to_numpy() for c in ("na", "nb"))
            rows = np.arange(len(na))
            apart = Sketches(batch.column("sa")).apart(rows, Sketches(batch.column("sb")), rows)
            kept = may_link(np.maximum(apart, np.abs(na - nb)), na + nb, num, den)
            yield batch.select(["a", "b", "share"]).filter(pa.array(kept))

    return pairs.mapInArrow(keep, "a long, b long, share float")


def id_hash(value) -> int:
    return xxhash.xxh3_64_intdigest(str(value))


def _wanted(pairs: DataFrame, n_pairs: int, reps: DataFrame, n_reps: int) -> tuple[DataFrame, int]:
    """``(digest, id, node, targets)``: which sets are sent where to be compared.

    The pairs ``(a, b)`` of one ``b`` meet in parts of about _PER_HUB of them; ``b`` itself goes to all of its parts.
    """
    hubs = pairs.groupBy("b").agg(F.ceil(F.count(F.lit(1)) / _PER_HUB).cast("int").alias("parts"))
    hubs, n_hubs = store(sized(hubs, n_pairs))
    spread = attach(pairs, hubs, ["b"], n_rows=n_hubs)
    target = F.struct("b", F.pmod(F.xxhash64("a"), F.col("parts")).cast("int").alias("part"), F.lit(1).alias("side"))
    sent = spread.select(F.col("a").alias("node"), F.array(target).alias("targets"))
    own = F.transform(
        F.sequence(F.lit(0), F.col("parts") - 1),
        lambda p: F.struct(F.col("b"), p.alias("part"), F.lit(0).alias("side")),
    )
    sent = sent.unionByName(hubs.select(F.col("b").alias("node"), own.alias("targets")))
    sent = sent.groupBy("node").agg(F.flatten(F.collect_list("targets")).alias("targets"))
    return store(sized(attach(sent, reps.select("node", "digest", "id"), ["node"], n_rows=n_reps), n_pairs + n_hubs))


def _verified(
    pairs: DataFrame, n_pairs: int, docs: DataFrame, reps: DataFrame, n_reps: int, k: int, num: int, den: int
) -> DataFrame:
    """The stored pairs ``(a, b)`` that are linked by the sets themselves, stored.

    The sets are built where the texts lie, of those documents that a filter of the wanted ids lets
    pass, and meet where ``b`` is. Only the set of ``b`` is held there; those of ``a`` pass by.
    """
    spark = docs.sparkSession
    if not n_pairs:
        return pairs
    wanted, n_wanted = _wanted(pairs, n_pairs, reps, n_reps)
    of_id = lambda value: np.array([id_hash(value.decode())], np.uint64)
    ids = wanted.select(F.col("id").cast("string").cast("binary"))
    known = spark.sparkContext.broadcast(seen(ids, of_id, bits_for(n_wanted)))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, bits = WordHashes(), np.frombuffer(known.value, np.uint8)
        for batch in batches:
            hashes = np.array([id_hash(v) for v in batch.column("name").to_pylist()], np.uint64)
            digests, tokens, size = [], [], 0
            for row in np.flatnonzero(held(bits, hashes)).tolist() if len(hashes) else ():
                own = token_set(batch.column("text")[row].as_py(), k, cache)
                digests.append(set_digest(own))
                tokens.append(own.tobytes())
                size += len(tokens[-1])
                if size > _SENT:
                    yield _binary({"digest": digests, "tokens": tokens})
                    digests, tokens, size = [], [], 0
            yield _binary({"digest": digests, "tokens": tokens})

    named = docs.where(F.col("id").isNotNull()).select(F.col("id").cast("string").alias("name"), "text")
    built = named.mapInArrow(hands_back(sets), "digest binary, tokens binary")
    sent = attach(built, wanted.select("digest", "node", "targets"), ["digest"], row_bytes=128, n_rows=n_wanted)
    sent = sent.select(F.explode("targets").alias("to"), "node", "tokens")
    met = sent.select("to.b", "to.part", "to.side", "node", "tokens").repartition("b", "part")
    met = sized(met, 2 * n_pairs, _PER_HUB)

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub, held_tokens = None, None
        for batch in batches:
            found_a, found_b = [], []
            columns = (batch.column(c).to_pylist() for c in ("side", "b", "node"))
            for side, b, node, tokens in zip(*columns, batch.column("tokens"), strict=True):
                x = np.frombuffer(tokens.as_buffer(), np.uint64)
                if not side:  # sorted before those that are compared with it
                    hub, held_tokens = b, x.copy()
                elif hub == b and _similar(x, held_tokens, num, den):
                    found_a.append(node)
                    found_b.append(hub)
            yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in (found_a, found_b)], names=["a", "b"])

    links = met.sortWithinPartitions("b", "part", "side").mapInArrow(hands_back(linked), "a long, b long")
    found, _ = store(sized(links.distinct(), n_pairs))
    known.destroy()
    return found


def _similar(x: np.ndarray, y: np.ndarray, num: int, den: int) -> bool:
    if not may_link(abs(len(x) - len(y)), len(x) + len(y), num, den):
        return False
    at = np.searchsorted(y, x)
    both = int((y[np.minimum(at, len(y) - 1)] == x).sum())
    return den * both >= num * (len(x) + len(y) - both)


def _binary(columns: dict[str, list[bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in columns.values()], names=list(columns))


def _with_sketches(rays: DataFrame, nodes: DataFrame, hubs: DataFrame) -> DataFrame:
    """Different pairs ``(a, b, share)`` of a set and a hub, with sizes and short sketches of both.

    The hubs of a set are gathered before it gets its sketch; hubs are far fewer than sets.
    """
    side = nodes.select("node", "n", F.col("short").alias("sketch"))
    near = rays.groupBy("a").agg(F.collect_set(F.struct("b", "share")).alias("hubs"))
    own = near.join(side.toDF("a", "na", "sa"), "a").select("a", "na", "sa", F.inline("hubs"))
    chosen, n_chosen = store(side.join(hubs.select(F.col("hub").alias("node")).distinct(), "node"))
    return attach(
        own, chosen.toDF("b", "nb", "sb"), ["b"], row_bytes=_mean_bytes(chosen, "sketch"), n_rows=n_chosen
    )


def _mean_bytes(rows: DataFrame, *columns: str) -> int:
    """Bytes of a row of two numbers and some binary columns."""
    size = sum((F.octet_length(c) for c in columns), F.lit(40))
    return int(rows.agg(F.avg(size)).first()[0] or 0) + 1


def _apart(pairs: DataFrame, roots: DataFrame, n_roots: int) -> DataFrame:
    """Pairs ``(a, b)`` of different components; a set without a root is one by itself."""
    for end in "ab":
        side = roots.select(F.col("node").alias(end), F.col("root").alias(f"root_{end}"))
        pairs = attach(pairs, side, [end], how="left", n_rows=n_roots)
    alike = F.coalesce("root_a", "a") == F.coalesce("root_b", "b")
    return pairs.where(~alike).select("a", "b")


def _across(rows: DataFrame, num: int, den: int, nearest: int | None = None) -> DataFrame:
    """Pairs ``(a, b, more, key, level)`` from one part of the grid of a bucket, of different components, that may be linked.

    With ``nearest`` a set is paired with so many of the larger sets of a part at most, those that differ
    least; ``more`` holds for pairs of sets that have others.

    Each set names its first few buckets; two that have one of these in common, before
    the bucket at hand, are compared there.
    """

    part = ["key", "level", "i", "j"]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_parts(batches, part):
            yield from _compare(rows, part, num, den, nearest)

    pairs = rows.mapInArrow(hands_back(compare), "a long, b long, more boolean, key long, level int")
    return pairs.withColumns({"a": F.least("a", "b"), "b": F.greatest("a", "b")})


def _compare(
    rows: pa.Table, part: list[str], num: int, den: int, nearest: int | None
) -> Iterator[pa.RecordBatch]:
    """The pairs of whole parts, some thousand parts at a time, with the key of their part.

    In parts of a level one set of a pair at least is of it (``top``).
    """
    runs = np.zeros(rows.num_rows, np.int64)
    runs[run_starts([rows.column(c).to_numpy() for c in part])] = 1
    runs = np.cumsum(runs)
    # Sets of a part ascend in size, so partners of x lie between x and the last that is not too large.
    order = np.lexsort((rows.column("n").to_numpy(), runs))
    rows, runs = rows.take(pa.array(order)).combine_chunks(), runs[order]
    n, own, key, i, j, node, root = (rows.column(c).to_numpy() for c in ("n", "own", "key", "i", "j", "node", "root"))
    top = rows.column("top").to_numpy() if "top" in rows.column_names else np.ones(len(n), bool)
    low = np.full((len(n), _LOW_KEYS), np.iinfo(np.int64).max)
    for row, keys in enumerate(rows.column("low").to_pylist()):
        low[row, : len(keys) // 8] = np.frombuffer(keys, np.int64)
    low[low >= key[:, None]] = np.iinfo(np.int64).max  # only buckets that come before this one
    sketches = Sketches(rows.column("sketch"))
    width = int(n.max()) + 1
    ends = np.searchsorted(runs * width + n, runs * width + np.minimum(n * den // num, width - 1), side="right")
    for x, y in index_pairs(ends, _PAIRS):
        ok = (root[x] != root[y]) & ((i[x] == j[x]) | (own[x] != own[y])) & (top[x] | top[y])
        x, y = x[ok], y[ok]
        apart = sketches.apart(x, sketches, y)
        ok = may_link(apart, n[x] + n[y], num, den)
        x, y, apart = x[ok], y[ok], apart[ok]
        before = (low[x][:, :, None] == low[y][:, None, :]) & (low[x] < np.iinfo(np.int64).max)[:, :, None]
        ok = ~before.any(axis=(1, 2))
        x, y, apart = x[ok], y[ok], apart[ok]
        more = np.zeros(len(x), bool)
        if nearest is not None and len(x):
            order = np.lexsort((apart, x))
            x, y = x[order], y[order]
            starts = run_starts([x])
            sizes = np.diff(starts, append=len(x))
            kept = np.arange(len(x)) - np.repeat(starts, sizes) < nearest
            x, y, more = x[kept], y[kept], np.repeat(sizes > nearest, sizes)[kept]
        if len(x):
            place = {c: rows.column(c).take(pa.array(x)).combine_chunks() for c in part if c not in ("i", "j")}
            columns = [pa.array(node[x]), pa.array(node[y]), pa.array(more), *place.values()]
            yield pa.RecordBatch.from_arrays(columns, names=["a", "b", "more", *place])


def _with_shared_keys(sets: DataFrame) -> DataFrame:
    """Stored sets with those of their keys that other sets may have, and their sketches.

    The filter that tells these keys is released as soon as they are stored.
    """
    n_keys = int(sets.agg(F.sum(F.octet_length("keys"))).first()[0] or 0) // 8
    found = seen_twice(sets.select("keys"), lambda b: np.frombuffer(b, np.uint64), bits_for(n_keys))
    twice = sets.sparkSession.sparkContext.broadcast(found)

    def shared_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(twice.value, np.uint8)
        for batch in batches:
            keys, shares = [], []
            for value in batch.column("keys"):
                own = np.frombuffer(value.as_py(), np.uint64)
                found = np.sort(own[held(bits, own)].view(np.int64))
                keys.append(found)
                shares.append(len(found) / max(1, len(own)))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("node"),
                    batch.column("n"),
                    batch.column("sketch"),
                    pa.array([short_of(v.as_py()) for v in batch.column("sketch")], pa.binary()),
                    pa.array(keys, pa.list_(pa.int64())),
                    pa.array([k[:_LOW_KEYS].tobytes() for k in keys], pa.binary()),
                    pa.array(shares, pa.float32()),
                ],
                names=["node", "n", "sketch", "short", "keys", "low", "share"],
            )

    schema = "node long, n long, sketch binary, short binary, keys array<long>, low binary, share float"
    nodes, _ = store(sets.select("node", "n", "sketch", "keys").mapInArrow(hands_back(shared_keys), schema))
    twice.destroy()
    return nodes


def _levels(rows: DataFrame, num: int, den: int) -> DataFrame:
    """Rows of sets in buckets, once in the level of their size (``top``) and once in the next one.

    Sizes of two linked sets are of one level or of neighbouring ones, so they meet in the higher level.
    """
    # Levels are a little wider than the ratio of linked sizes, which is safe from rounding.
    level = F.floor(F.log("n") / F.lit(math.log(den / num) * (1 + 1e-9))).cast("int")
    own = F.struct(level.alias("level"), F.lit(True).alias("top"))
    return rows.select("*", F.inline(F.array(own, F.struct((level + 1).alias("level"), F.lit(False).alias("top")))))


def _open_parts(
    placed: DataFrame,
    roots: DataFrame,
    n_roots: int,
    nodes: DataFrame,
    num: int,
    den: int,
    sketch: str,
    among: tuple[DataFrame, int] | None = None,
) -> DataFrame:
    """Sets in the grids of those levels of their buckets that hold several components, part by part.

    Buckets are divided by size first, so that sets go nowhere with a sketch but where others of about their size
    are. ``among`` names the levels of buckets that are looked at, and their number; without it all are.
    """
    placed = attach(placed, roots, ["node"], how="left", n_rows=n_roots)
    placed, _ = store(placed.select("key", "node", "n", F.coalesce("root", "node").alias("root")))
    placed = _levels(placed, num, den)
    if among is not None:
        placed = attach(placed, among[0], ["key", "level"], n_rows=among[1])
    open_keys, n_open = store(
        placed.groupBy("key", "level")
        .agg(
            F.min("root").alias("low"),
            F.max("root").alias("high"),
            F.bool_or("top").alias("top"),
            F.count(F.lit(1)).alias("size"),
        )
        .where((F.col("low") != F.col("high")) & F.col("top"))
        .select("key", "level", "size")
    )
    rows = attach(placed.drop("n"), open_keys, ["key", "level"], weight="size", n_rows=n_open)
    rows = rows.join(nodes.select("node", "n", F.col(sketch).alias("sketch"), "low"), "node")
    parts = F.ceil(F.col("size") / _GRID).cast("int")
    rows = rows.withColumn("own", F.pmod(F.xxhash64("node"), parts).cast("int")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), parts - 1))
    )
    rows = rows.withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other"))
    part = ["key", "level", "i", "j"]
    dealt = rows.select(*part, "own", "top", "node", "root", "n", "sketch", "low").repartition(*part)
    return dealt.sortWithinPartitions(*part)


def _named(links: DataFrame) -> DataFrame:
    return components(links)


def _components(docs: DataFrame, key: str, text: str, k: int, num: int, den: int) -> DataFrame:
    """``(id, text, n, component, stays)`` for each row, with a digest of its text and the size of its set.

    ``stays`` holds for the smallest id and then text of a component, and for rows that have none.
    """
    if not 0.5 <= num / den < 1:
        raise ValueError("similarities from 0.5 to below 1 are supported")
    spark = docs.sparkSession
    docs = docs.select(F.col(key).alias("id"), F.col(text).cast("binary").alias("text"))
    classes = spark.sparkContext.broadcast(class_table(docs, k).tobytes())
    index, n_docs = store(_build_index(docs, k, num, den, classes))

    # One set for all documents that have it; ``same`` rows have its smallest id.
    members = index.where((F.col("n") > 0) & F.col("id").isNotNull())
    by_id = members.groupBy("digest", "id").agg(
        F.min("text").alias("text"), F.min("row").alias("row"), F.count(F.lit(1)).alias("same")
    )
    firsts = by_id.groupBy("digest").agg(F.min(F.struct("id", "text", "row")).alias("m"), F.sum("same").alias("copies"))
    firsts = sized(firsts.select("digest", "m.id", "m.text", "m.row", "copies"), n_docs)
    reps, n_reps = store(firsts.withColumn("node", F.monotonically_increasing_id()))
    sets = attach(index.drop("id", "digest", "text"), reps.select("row", "node"), ["row"], n_rows=n_reps)

    nodes = _with_shared_keys(sets)
    entries = nodes.select("node", "n", "share", F.explode("keys").alias("key"))
    # The hub of a bucket is the set that shares most of its own keys.
    hubs, n_hubs = store(
        entries.groupBy("key")
        .agg(F.max(F.struct("share", "node")).alias("hub"), F.count(F.lit(1)).alias("members"))
        .where(F.col("members") > 1)
        .select("key", F.col("hub.node").alias("hub"), F.col("hub.share").alias("hub_share"), "members")
    )
    rays = attach(entries.select("key", "node"), hubs, ["key"], weight="members", n_rows=n_hubs)
    rays = rays.where(F.col("node") != F.col("hub")).select(
        F.col("node").alias("a"), F.col("hub").alias("b"), F.col("hub_share").alias("share")
    )
    tried, n_tried = store(_passing(_with_sketches(rays, nodes, hubs), num, den))
    verified = {"docs": docs, "reps": reps, "n_reps": n_reps, "k": k, "num": num, "den": den}

    # First the best hub of each set, then the other hubs that it is not connected with.
    best = tried.groupBy("a").agg(F.max(F.struct("share", "b")).alias("best")).select("a", "best.b")
    best, n_best = store(sized(best, n_tried))
    links = _verified(best, n_best, **verified)
    roots, n_roots = store(_named(links))
    # Most pairs of a large group are connected by now, so these go first.
    others, n_others = store(sized(_apart(tried.select("a", "b"), roots, n_roots), n_tried))
    others, n_others = store(sized(others.join(best, ["a", "b"], "left_anti"), n_others))
    if n_others:
        links = links.unionByName(_verified(others, n_others, **verified))
        roots, n_roots = store(_named(links))

    # Buckets of three sets or more that still hold several components.
    wide = hubs.where(F.col("members") > 2).select("key", "members")
    placed = attach(entries.drop("share"), wide, ["key"], weight="members", n_rows=wide.count())
    known = tried.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    # Near copies that no hub connects are first compared with their nearest ones, so that most are of
    # one component before all others are; only buckets in which sets had more partners need a second round.
    sketch, among = "short", None
    for nearest in (_NEAREST, None):
        dealt = _open_parts(placed, roots, n_roots, nodes, num, den, sketch, among)
        found = _across(dealt, num, den, nearest)
        if nearest is not None:
            found, _ = store(found)
        rest, n_rest = store(found.select("a", "b").distinct().join(known, ["a", "b"], "left_anti"))
        if n_rest:
            links = links.unionByName(_verified(rest, n_rest, **verified))
            roots, n_roots = store(_named(links))
        if nearest is None or found.where("more").isEmpty():
            break
        known = known.unionByName(rest)
        sketch, among = "sketch", store(found.where("more").select("key", "level").distinct())

    # The smallest id of a component, back to all its documents.
    named = attach(reps.drop("row"), roots, ["node"], how="left", n_rows=n_roots)
    named = named.withColumn("root", F.coalesce("root", "node"))
    lowest = named.groupBy("root").agg(F.min(F.struct("id", "text")).alias("first"), F.count(F.lit(1)).alias("sets"))
    classes_of = attach(named.drop("id", "text", "node"), lowest, ["root"], weight="sets", row_bytes=96)
    classes_of = classes_of.select("digest", "first", "copies")
    found = index.select("id", "n", "text", "digest")
    found = attach(found, classes_of, ["digest"], weight="copies", how="left", row_bytes=96)
    alone = (F.col("n") == 0) | F.col("id").isNull()
    return found.select(
        "id",
        "text",
        "n",
        F.when(alone, F.col("id")).otherwise(F.col("first.id")).alias("component"),
        (alone | (F.struct("id", "text") == F.col("first"))).alias("stays"),
    )


def jaccard_components(
    docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = 5, num: int = 80, den: int = 100
) -> DataFrame:
    """``(key, n_shingles, component_id)`` for each row of ``docs``.

    Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased, a document's set its distinct
    shingles of ``k`` words (with fewer words, all of them as one). Documents are linked when
    ``den * intersection >= num * union``; ``component_id`` is the smallest id reachable.

    A text that is null, empty or without words has an empty set and is linked with nothing.
    A row without an id is linked with nothing and has a null component. Rows with one id
    are documents of their own, so equal rows are linked. Other columns are not read; an
    empty table gives an empty result. Texts of any length are taken whole.
    """
    found = _components(docs, key, text, k, num, den)
    return found.select(
        F.col("id").alias(key), F.col("n").alias("n_shingles"), F.col("component").alias("component_id")
    )


def keep_one(
    docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = 5, num: int = 80, den: int = 100
) -> DataFrame:
    """The rows of ``docs``, with their columns, but of each component only one document.

    It is that of the smallest id, and if several texts of the component have this id, that of the
    smallest digest; of its equal rows one stays. An id's texts of other components are judged
    by these. Rows without an id and rows with an empty set all stay. An empty table gives an empty
    result.
    """
    found, _ = store(_components(docs, key, text, k, num, den).where(F.col("id").isNotNull()))
    several, own, said = (free_name(docs, stem) for stem in ("several", "own", "said"))
    ids = found.groupBy("id").agg(F.count(F.lit(1)).alias("rows"), F.bool_and("stays").alias("stays"))
    marks = ids.where((F.col("rows") > 1) | ~F.col("stays"))
    marks, n_marks = store(marks.select(F.col("id").alias(own), (F.col("rows") > 1).alias(several)))
    marked = attach(docs.withColumn(own, F.col(key)), marks, [own], how="left", row_bytes=24, n_rows=n_marks)
    single = marked.where(F.col(several).isNull()).select(*docs.columns)
    texts = found.where("stays").select(F.col("id").alias(own), F.col("text").alias(said)).distinct()
    repeated = _with_digest(marked.where(several), text, said).join(texts, [own, said])
    worded = F.coalesce(F.col(text).rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    once = repeated.where(worded).dropDuplicates([own, said]).unionByName(repeated.where(~worded))
    return single.unionByName(once.select(*docs.columns))


def _with_digest(docs: DataFrame, text: str, out: str) -> DataFrame:
    """``docs`` with the digest of their texts that ``_components`` has."""

    @F.pandas_udf("binary")
    def digest(texts: pd.Series) -> pd.Series:
        return texts.map(lambda v: xxhash.xxh3_128_digest(v or b""))

    return docs.withColumn(out, digest(F.col(text).cast("binary")))

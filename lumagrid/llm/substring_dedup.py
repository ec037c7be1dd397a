"""Substring dedup: shared seeds, chained by a Fenwick tree, aligned to fuzzy passages.

Seeds are runs of ``K`` words. Of each ``W`` successive ones that of the smallest hash is taken, so
two texts that share ``W + K - 1`` words in a row share a seed there. The documents of a seed
are not paired with each other: every place of a seed meets the first document that has it,
for seeds one by one and for runs of successive seeds, so matches grow with the seeds. The matches of two documents
are chained in the order of both texts, where gaps cost; the best chain before a match
comes from a Fenwick tree of prefix maxima. Chains are aligned in their gaps and extended
to both sides; of a chain that is not alike enough as a whole the parts that are stay.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumagrid.llm.bloom import held, seen_twice
from lumagrid.llm.common import WordHashes, groups, shingle_hashes, word_hashes, words_of
from lumagrid.operators.lookup import attach
from lumagrid.settings import store

K, W = 8, 10
MIN_WORDS = 50
MIN_IDENTITY = 0.8
GAP_COST = 0.1  # of each word of both texts between two matches
MAX_GAP = 64  # words of either text between two matches of a chain
_RUN = 4  # successive seeds that are also looked up together
_DROP = 12  # an extension ends where its score has fallen so far below its best
_PAD = 128  # words around a chain that are compared first; all are where an extension gets so far
_LOOK = 8  # words ahead of a run that decide how an extension goes on
_ROWS = 4096  # chains that leave a task at once
_PER_TEXT = 2048  # chains that meet one copy of a text
_CORNERS = ("x0", "x1", "y0", "y1")
# Words skipped in both texts at an edit, the fewest first.
_EDITS = sorted(((i, j) for i in range(7) for j in range(7) if i + j), key=lambda e: (max(e), sum(e), e))


def seeds_of(text: bytes | None, cache: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """The smallest of every ``W`` successive seeds of a text: hashes and places in words."""
    hashes = word_hashes(words_of(text), cache)
    if len(hashes) < K:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    seeds = shingle_hashes(hashes, K)
    width = min(W, len(seeds))
    windows = np.lib.stride_tricks.sliding_window_view(seeds, width)
    at = np.unique(np.arange(len(windows)) + windows.argmin(axis=1))
    return seeds[at], at


def _places(seeds: np.ndarray, places: np.ndarray, shared: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ``shared`` seeds and the runs of them in the order of their hashes, and their places."""
    found, at = [seeds[shared]], [places[shared]]
    if len(seeds) >= _RUN:
        whole = np.lib.stride_tricks.sliding_window_view(shared, _RUN).all(axis=1)
        found.append(shingle_hashes(seeds, _RUN)[whole])
        at.append(places[: len(whole)][whole])
    found, at = np.concatenate(found), np.concatenate(at).astype(np.int32)
    order = np.lexsort((at, found))
    found, at = found[order], at[order]
    new = np.ones(len(found), bool)
    new[1:] = (found[1:] != found[:-1]) | (np.diff(at) > W)
    return found[new], at[new]


class Fenwick:
    """Maxima over prefixes of places, with what they belong to."""

    def __init__(self, n: int):
        self.best = [(-1.0, -1)] * (n + 1)

    def put(self, place: int, value: tuple[float, int]) -> None:
        place += 1
        while place < len(self.best):
            if value > self.best[place]:
                self.best[place] = value
            place += place & -place

    def most(self, places: int) -> tuple[float, int]:
        """The maximum over the first ``places`` places."""
        found = (-1.0, -1)
        while places:
            if self.best[places] > found:
                found = self.best[places]
            places -= places & -places
        return found


def segments(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Matches as rows ``(x0, x1, y0, y1)`` of words, those that overlap on a diagonal as one."""
    order = np.lexsort((x, y - x))
    x, y = x[order], y[order]
    new = np.ones(len(x), bool)
    new[1:] = (np.diff(y - x) != 0) | (np.diff(x) > K)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(x)) - 1
    return np.stack([x[first], x[last] + K, y[first], y[last] + K], axis=1)


def chains(matches: np.ndarray) -> list[np.ndarray]:
    """The rows ``(x0, x1, y0, y1)`` as disjoint chains in the order of both texts, best first.

    A chain scores its words in ``x`` less GAP_COST for every word of both texts between its
    rows. That cost is a sum over both ends of a gap, so what a row adds at its end is kept
    by ``y1`` in a Fenwick tree, and the best row before another is a prefix maximum. Where that
    lies farther than MAX_GAP, the best of the rows that end within MAX_GAP is looked for.
    """
    rows = matches[np.lexsort((matches[:, 2], matches[:, 0]))].tolist()
    ends = sorted(range(len(rows)), key=lambda i: rows[i][1])
    places = {y: i for i, y in enumerate(sorted({r[3] for r in rows}))}
    ordered = list(places)
    tree, done = Fenwick(len(places)), 0
    score, back = [0.0] * len(rows), [-1] * len(rows)
    ended: dict[int, list[tuple[int, float, int]]] = {}

    def nearby(x0: int, y0: int) -> tuple[float, int]:
        found = (-1.0, -1)
        for y in ordered[bisect_left(ordered, y0 - MAX_GAP) : bisect_right(ordered, y0)]:
            for x, value, j in reversed(ended.get(y, ())):
                if x < x0 - MAX_GAP:
                    break
                found = max(found, (value, j))
        return found

    for i, (x0, x1, y0, _) in enumerate(rows):
        while done < len(ends) and rows[ends[done]][1] <= x0:
            j = ends[done]
            value = score[j] + GAP_COST * (rows[j][1] + rows[j][3])
            tree.put(places[rows[j][3]], (value, j))
            ended.setdefault(rows[j][3], []).append((rows[j][1], value, j))
            done += 1
        score[i] = float(x1 - x0)
        value, j = tree.most(bisect_right(ordered, y0))
        if j >= 0 and max(x0 - rows[j][1], y0 - rows[j][3]) > MAX_GAP:
            value, j = nearby(x0, y0)
        if j >= 0:
            gain = value - GAP_COST * (x0 + y0)
            if gain > 0:
                score[i], back[i] = score[i] + gain, j
    found, used = [], [False] * len(rows)
    for i in sorted(range(len(rows)), key=lambda i: (-score[i], i)):
        chain = []
        while i >= 0 and not used[i]:
            used[i] = True
            chain.append(rows[i])
            i = back[i]
        if chain:
            found.append(np.array(chain[::-1], np.int32))
    return found


def _extend(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, tuple[bool, bool]]:
    """Where a passage may end that continues from the starts of ``a`` and ``b``.

    Rows ``(words of a, words of b, how many agree)``, one for each run of words that agree. A
    word that agrees counts 1, one that is skipped or replaced -2, up to the best total. Also
    whether more words of ``a``, or of ``b``, could change that.
    """
    i = j = score = same = 0
    best, stops, n_best = 0, [(0, 0, 0)], 1
    while i < len(a) and j < len(b) and score > best - _DROP:
        run, step = 0, 64
        while True:
            reach = min(step, len(a) - i - run, len(b) - j - run)
            differ = np.flatnonzero(a[i + run : i + run + reach] != b[j + run : j + run + reach])
            run += int(differ[0]) if len(differ) else reach
            if len(differ) or reach < step:
                break
            step *= 2
        i, j, score, same = i + run, j + run, score + run, same + run
        stops.append((i, j, same))
        if score > best:
            best, n_best = score, len(stops)
        for skip_a, skip_b in _EDITS:
            p, q = i + skip_a, j + skip_b
            if p + 1 < len(a) and q + 1 < len(b) and a[p] == b[q] and a[p + 1] == b[q + 1]:
                i, j, score = p, q, score - 2 * max(skip_a, skip_b)
                break
        else:
            break
    return np.array(stops[:n_best], np.int64), (i + _LOOK >= len(a), j + _LOOK >= len(b))


def common_words(a: np.ndarray, b: np.ndarray) -> int:
    """The length of the longest common subsequence."""
    if not len(a) or not len(b):
        return 0
    row = np.zeros(len(b) + 1, np.int64)
    for word in a:
        with_word = row[:-1] + (b == word)
        row[1:] = np.maximum.accumulate(np.maximum(row[1:], with_word))
    return int(row[-1])


def align(
    a: np.ndarray, b: np.ndarray, chain: np.ndarray, same: int, min_identity: float, cut: tuple[bool, ...] = (False,) * 4
) -> tuple[int, int, int, int, float] | None:
    """The passage of a chain: words ``a0`` to ``a1`` and ``b0`` to ``b1`` (ends excluded), identity.

    ``same`` is how many words agree from its first row to its last. The identity is the share
    of words that agree in the longer of both. The chain is extended as far as that stays at
    ``min_identity``. ``cut`` tells whether there are words before ``a``, after it, before ``b`` and after
    it: None if they could matter.
    """
    a0, a1, b0, b1 = int(chain[0, 0]), int(chain[-1, 1]), int(chain[0, 2]), int(chain[-1, 3])
    (back, low), (on, high) = _extend(a[:a0][::-1], b[:b0][::-1]), _extend(a[a1:], b[b1:])
    if any(end and near for end, near in zip(cut, (low[0], high[0], low[1], high[1]), strict=True)):
        return None

    def alike(before: np.ndarray, after: np.ndarray) -> np.ndarray:
        longer = np.maximum(a1 - a0 + before[..., 0] + after[..., 0], b1 - b0 + before[..., 1] + after[..., 1])
        return (same + before[..., 2] + after[..., 2]) / np.maximum(1, longer)

    before, after = back[-1], on[-1]
    if alike(before, after) < min_identity:
        best = -1
        for stop in back:
            fit = np.flatnonzero(alike(stop, on) >= min_identity)
            if len(fit) and stop[0] + on[fit[-1], 0] > best:
                before, after, best = stop, on[fit[-1]], stop[0] + on[fit[-1], 0]
    identity = float(alike(before, after))
    return a0 - int(before[0]), a1 + int(after[0]), b0 - int(before[1]), b1 + int(after[1]), identity


def _alike_part(starts: np.ndarray, ends: np.ndarray, same: np.ndarray, min_identity: float) -> tuple[int, int]:
    """Of all parts of a chain, from a row to before a row, the one with most alike words that is at ``min_identity``.

    ``starts`` and ``ends`` are the rows in both texts, ``same`` the words that agree from the first
    row to the start and to the end of each.
    """
    best, found = -1, (0, 1)
    for i in range(len(starts)):
        alike = same[i:, 1] - same[i, 0]
        if alike[-1] <= best:
            break
        fit = np.flatnonzero(alike / (ends[i:] - starts[i]).max(axis=1) >= min_identity)
        if len(fit) and alike[fit[-1]] > best:
            best, found = alike[fit[-1]], (i, i + int(fit[-1]) + 1)
    return found


def passages_of(
    a: np.ndarray,
    b: np.ndarray,
    chain: np.ndarray,
    min_words: int,
    min_identity: float,
    cut: tuple[bool, ...] = (False,) * 4,
) -> list[tuple[int, int, int, int, float]] | None:
    """The passages of a chain: all of it, or where that is not alike enough the parts that are.

    Of a chain below ``min_identity`` the largest part that is not below is taken, and what lies
    before and after it is judged again, so a gap or a stray seed costs nothing but itself.
    None if words could matter that are ``cut`` off ``a`` or ``b``.
    """
    chain = chain.astype(np.int64)
    same = np.zeros((len(chain), 2), np.int64)
    for i, (x0, x1, y0, y1) in enumerate(chain.tolist()):
        if i:
            same[i, 0] = same[i - 1, 1] + common_words(a[chain[i - 1, 1] : x0], b[chain[i - 1, 3] : y0])
        same[i, 1] = same[i, 0] + np.count_nonzero(a[x0:x1] == b[y0:y1])
    found: list[tuple[int, int, int, int, float]] = []
    waiting = [(0, len(chain))]
    while waiting:
        start, end = waiting.pop()
        passage = align(a, b, chain[start:end], int(same[end - 1, 1] - same[start, 0]), min_identity, cut)
        if passage is None:
            return None
        if passage[4] < min_identity:
            if end - start == 1:
                continue  # seeds of another text of the same id
            part = slice(start, end)
            p, q = _alike_part(chain[part][:, [0, 2]], chain[part][:, [1, 3]], same[part], min_identity)
            p, q = p + start, q + start
            if (p, q) == (start, end):
                continue
            waiting += [(i, j) for i, j in ((q, end), (start, p), (p, q)) if i < j]
        elif passage[1] - passage[0] >= min_words:
            found.append(passage)
    found.sort(key=lambda f: (f[0] - f[1], f))
    whole: list[tuple[int, int, int, int, float]] = []
    for f in found:
        if not any(w[0] <= f[0] and f[1] <= w[1] and w[2] <= f[2] and f[3] <= w[3] for w in whole):
            whole.append(f)
    return whole


def repeated_passages(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    min_words: int = MIN_WORDS,
    min_identity: float = MIN_IDENTITY,
    inside: bool = False,
) -> DataFrame:
    """``(key, start, end, other_id, other_start, other_end, identity)``: passages of two documents.

    A passage of at least ``min_words`` words, from word ``start`` to before word ``end``, that an
    earlier document, of a smaller id, has with at least ``min_identity`` of the words alike.
    Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased. Every place of a passage in a document
    has a row, with the first document that has its seeds, not with all of a group. Places of one
    seed that are no more than ``W`` words apart, as in a text of one word, are one place. With
    ``inside`` a document's own passages that it repeats later on are given too, the
    document being its own other.

    Null and short texts repeat nothing; rows without an id are left out. Several texts of one id are
    documents of their own, in the order of a hash of them; equal rows are one. Other columns
    are not read; an empty table gives an empty result. Texts of any length are searched whole.
    """
    spark = docs.sparkSession
    named = docs.where(F.col(key).isNotNull()).select(F.col(key).alias("id"), F.col(text).cast("binary").alias("text"))
    several = named.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    several, n_several = store(several)
    if n_several:  # then a text is called by its id and, where it has others, a hash of it
        marked = attach(named, several, ["id"], how="left", row_bytes=24, n_rows=n_several)
        which = F.when(F.col("n").isNotNull(), F.xxhash64("text")).otherwise(F.lit(0).cast("long"))
        marked = marked.select(F.struct("id", which.alias("text")).alias("id"), "text", "n")
        repeated = marked.where(F.col("n").isNotNull()).dropDuplicates(["id"])
        named = marked.where(F.col("n").isNull()).unionByName(repeated).drop("n")
        named, _ = store(named)
    kind = named.schema["id"].dataType.simpleString()

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordHashes()
        for batch in batches:
            found = [seeds_of(t, cache) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([h.tobytes() for h, _ in found], pa.binary()),
                    pa.array([p.astype("<u4").tobytes() for _, p in found], pa.binary()),
                ],
                names=["id", "seeds", "places"],
            )

    picked, _ = store(named.mapInArrow(pick, f"id {kind}, seeds binary, places binary"))
    twice = spark.sparkContext.broadcast(
        seen_twice(picked.select("seeds"), lambda b: np.unique(np.frombuffer(b, np.uint64)))
    )

    def suspects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(twice.value, np.uint8)
        for batch in batches:
            rows, keys, places = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0, np.int32)]
            pairs = zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)
            for row, (s, p) in enumerate(pairs):
                s, p = np.frombuffer(s, np.uint64), np.frombuffer(p, "<u4")
                found, at = _places(s, p, held(bits, s))
                rows.append(np.full(len(found), row))
                keys.append(found.view(np.int64))
                places.append(at)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate(keys)),
                    batch.column(0).take(pa.array(np.concatenate(rows))),
                    pa.array(np.concatenate(places)),
                ],
                names=["seed", "id", "place"],
            )

    def own_matches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, late, early = [np.empty(0, np.int64)], [np.empty(0, np.int32)], [np.empty(0, np.int32)]
            pairs = zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)
            for row, (s, p) in enumerate(pairs):
                s, p = np.frombuffer(s, np.uint64), np.frombuffer(p, "<u4")
                seeds, at = _places(s, p, np.ones(len(s), bool))
                first = np.flatnonzero(np.append(True, seeds[1:] != seeds[:-1])) if len(seeds) else np.empty(0, np.int64)
                origin = np.repeat(at[first], np.diff(np.append(first, len(at))))
                again = at > origin
                rows.append(np.full(int(again.sum()), row))
                late.append(at[again])
                early.append(origin[again])
            ids = batch.column(0).take(pa.array(np.concatenate(rows)))
            yield pa.RecordBatch.from_arrays(
                [ids, ids, pa.array(np.concatenate(late)), pa.array(np.concatenate(early))],
                names=["id", "other", "place", "other_place"],
            )

    entries, _ = store(picked.mapInArrow(suspects, f"seed long, id {kind}, place int"))
    firsts, _ = store(
        entries.groupBy("seed")
        .agg(F.min(F.struct("id", "place")).alias("f"), F.max("id").alias("last"))
        .where(F.col("f.id") < F.col("last"))
        .select("seed", F.col("f.id").alias("other"), F.col("f.place").alias("other_place"))
    )
    # Both grow with the input; both lie stored, so Spark can split what is skewed.
    matches = entries.join(firsts, "seed").where(F.col("id") != F.col("other"))
    matches = matches.select("id", "other", "place", "other_place")
    if inside:
        own = picked.mapInArrow(own_matches, f"id {kind}, other {kind}, place int, other_place int")
        matches = matches.unionByName(own)
    dealt = matches.repartition("id", "other")

    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A passage may show by a single seed: what is long enough is decided by the words.
        ends, rows = [], []
        for pair in groups(batches, ["id", "other"]):
            x, y = pair.column("place").to_numpy(), pair.column("other_place").to_numpy()
            if len(x) == 1:
                found = [np.array([[x[0], x[0] + K, y[0], y[0] + K]], np.int32)]
            else:
                both = np.unique(np.stack([x, y], axis=1), axis=0).astype(np.int64)
                found = chains(segments(both[:, 0], both[:, 1]))
            rows += found
            ends += [(pair.column("id")[0].as_py(), pair.column("other")[0].as_py())] * len(found)
            if len(rows) >= _ROWS:
                yield chain_batch(ends, rows, pair.schema)
                ends, rows = [], []
        if rows:
            yield chain_batch(ends, rows, pair.schema)

    def chain_batch(ends: list[tuple], rows: list[np.ndarray], schema: pa.Schema) -> pa.RecordBatch:
        columns = [pa.array([e[i] for e in ends], schema.field(c).type) for i, c in enumerate(("id", "other"))]
        columns.append(pa.array([c.astype("<i4").tobytes() for c in rows], pa.binary()))
        corners = np.array([(c[0, 0], c[-1, 1], c[0, 2], c[-1, 3]) for c in rows], np.int32)
        return pa.RecordBatch.from_arrays(
            [*columns, *(pa.array(corners[:, i]) for i in range(4))], names=["id", "other", "chain", *_CORNERS]
        )

    sorted_pairs = dealt.sortWithinPartitions("id", "other")
    corners = "x0 int, x1 int, y0 int, y1 int"
    found, _ = store(sorted_pairs.mapInArrow(chain, f"id {kind}, other {kind}, chain binary, {corners}"))

    # The words of both documents meet where chains are.
    def as_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordHashes()
        for batch in batches:
            words = [
                (word_hashes(words_of(t), cache) >> np.uint64(32)).astype("<u4").tobytes()
                for t in batch.column(1).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(words, pa.binary())], names=["id", "words"])

    def texts_of(chained: DataFrame, end: str) -> DataFrame:
        ids, n_ids = store(chained.select(F.col(end).alias("id")).distinct())
        return attach(named, ids, ["id"], n_rows=n_ids).mapInArrow(as_words, f"id {kind}, words binary")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("chain", "words", "other_words", "a0", "b0", "n_a", "n_b")
        for batch in batches:
            kept, passages, open_at, open_chains = [], [], [], []
            for row, (rows, a, b, a0, b0, n_a, n_b) in enumerate(
                zip(*(batch.column(c).to_pylist() for c in names), strict=True)
            ):
                spans = np.frombuffer(rows, "<i4").reshape(-1, 4)
                a, b = np.frombuffer(a, "<u4"), np.frombuffer(b, "<u4")
                cut = (a0 > 0, a0 + len(a) < n_a, b0 > 0, b0 + len(b) < n_b)
                own = passages_of(a, b, spans - np.array([a0, a0, b0, b0]), min_words, min_identity, cut)
                if own is None:
                    open_at.append(row)
                    open_chains.append(rows)
                    continue
                kept += [row] * len(own)
                passages += [(p[0] + a0, p[1] + a0, p[2] + b0, p[3] + b0, p[4]) for p in own]
            at, none = pa.array(kept + open_at, pa.int64()), [None] * len(open_at)
            numbers = [pa.array([p[i] for p in passages] + none, pa.int64()) for i in range(4)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id").take(at),
                    numbers[0],
                    numbers[1],
                    batch.column("other").take(at),
                    numbers[2],
                    numbers[3],
                    pa.array([p[4] for p in passages] + none, pa.float64()),
                    pa.array([None] * len(kept) + open_chains, pa.binary()),
                    *(batch.column(c).take(at) for c in _CORNERS),
                ],
                names=["id", "start", "end", "other_id", "other_start", "other_end", "identity", "chain", *_CORNERS],
            )

    def around(words: str, low: str, high: str, pad: int | None, names: tuple[str, str, str]) -> list[Column]:
        """The words around a chain, the place of the first of them and the length of the text."""
        n = F.octet_length(words) / 4
        start = F.lit(0) if pad is None else F.greatest(F.col(low) - pad, F.lit(0))
        part = F.col(words) if pad is None else F.substring(words, start * 4 + 1, (F.col(high) + pad - start) * 4)
        return [part.alias(names[0]), start.alias(names[1]), n.cast("int").alias(names[2])]

    def compared(chained: DataFrame, pad: int | None) -> DataFrame:
        """The passages of chains; with a null start those that need more than ``pad`` words around them.

        Words come to the chains that need them; those of a document that many repeat have a copy
        for each _PER_TEXT of the chains.
        """
        left = chained.join(texts_of(chained, "id"), "id")
        own = around("words", "x0", "x1", pad, ("words", "a0", "n_a"))
        left = left.select("id", "other", "chain", *_CORNERS, *own)
        parts = chained.groupBy("other").agg(F.ceil(F.count(F.lit(1)) / _PER_TEXT).cast("int").alias("parts"))
        parts, n_parts = store(parts)
        left = attach(left, parts, ["other"], n_rows=n_parts)
        left = left.withColumn("part", F.pmod(F.xxhash64("id", "chain"), F.col("parts")).cast("int"))
        right = attach(texts_of(chained, "other").toDF("other", "other_words"), parts, ["other"], n_rows=n_parts)
        right = right.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
        others = around("other_words", "y0", "y1", pad, ("other_words", "b0", "n_b"))
        met = left.join(right, ["other", "part"]).select("id", "other", "chain", *_CORNERS, "words", "a0", "n_a", *others)
        return met.mapInArrow(
            compare,
            f"id {kind}, start long, end long, other_id {kind}, other_start long, other_end long, identity double,"
            f" chain binary, {corners}",
        )

    first, _ = store(compared(found, _PAD))
    rest = first.where(F.col("start").isNull()).select("id", F.col("other_id").alias("other"), "chain", *_CORNERS)
    passages = first.where(F.col("start").isNotNull()).unionByName(compared(rest, None))
    passages = passages.drop("chain", *_CORNERS).distinct()
    if n_several:
        passages = passages.withColumn("id", F.col("id.id")).withColumn("other_id", F.col("other_id.id"))
    return passages.withColumnRenamed("id", key)

"""Groups of spelling variants: dense tiles of padded code points, compared from both ends.

Two different words are one edit apart if their common prefix and their common suffix
together reach the longer length less one. The place of the edit, which is the length of the common
prefix, lies in one third of the longer word, so the words agree in the other two. They
meet under the key of those two thirds, and only there, once. Words of a key are rows of
a matrix of code points, padded at the end for prefixes and at the start for suffixes; blocks
of a large key meet in a grid. A task returns sums of each word, not the pairs.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumagrid.llm.common import LOWER, UPPER, index_pairs, run_starts, whole_parts
from lumagrid.operators.lookup import attach
from lumagrid.settings import store

# Every letter of a run is one byte in Latin-1.
_LETTERS = "A-Za-zÀ-ÿ"
_THIRDS = 3
_BLOCK = 1024  # words of a key in one block
_FLUSH = 200_000  # different words that a task holds while it counts
_CELLS = 1 << 22  # code points of the pairs that are compared at once
_ROUNDS = 64


def spelled(run: str, doc: str, every: int) -> str:
    """A lower-cased run, without one letter where the hash of it and its document says so."""
    h = zlib.crc32(f"{doc}:{run}".encode())
    if h % every:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def count_words(docs: DataFrame, least: int, every: int) -> DataFrame:
    """``(word, n)`` for each different word of ``docs(id string, text)`` of at least ``least`` letters."""
    lower = str.maketrans(UPPER, LOWER)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = re.compile(f"[{_LETTERS}]{{{least},}}")  # shorter ones give no word
        counts: Counter[str] = Counter()

        def out() -> pa.RecordBatch:
            columns = [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())]
            return pa.RecordBatch.from_arrays(columns, names=["word", "n"])

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for run, n in Counter(runs.findall((text or "").translate(lower))).items():
                    word = spelled(run, doc, every)
                    if len(word) >= least:
                        counts[word] += n
                if len(counts) > _FLUSH:
                    yield out()
                    counts.clear()
        yield out()

    return docs.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _placed(words: DataFrame) -> DataFrame:
    """``(key, longer, low, high, word, n)``: where a word meets those that an edit from ``low`` to before
    ``high`` makes of it, ``longer`` being the length of the longer of the two."""
    size = F.length("word")
    places = []
    for more in (0, 1):
        longer = size + more
        for third in range(_THIRDS):
            low, high = (F.floor(longer * t / _THIRDS).cast("int") for t in (third, third + 1))
            places.append(F.struct(longer.cast("int").alias("longer"), low.alias("low"), high.alias("high")))
    placed = words.withColumn("at", F.explode(F.array(*places))).select("at.*", "word", "n")
    head = F.col("word").substr(F.lit(1), F.col("low"))
    tail = F.col("word").substr(F.length("word") - (F.col("longer") - F.col("high")) + 1, F.col("longer"))
    return placed.withColumn("key", F.xxhash64("longer", "low", head, tail))


def matrices(words: list[str], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of code points, of ``width`` or one less, padded at the end and at the start."""
    encoded = [w.encode("latin-1") for w in words]
    left = np.array(encoded, f"S{width}").view(np.uint8).reshape(-1, width)
    right = left.copy()
    short = np.fromiter(map(len, encoded), np.int64, len(words)) < width
    right[short, 1:], right[short, 0] = left[short, :-1], 0
    return left, right


def near(left: np.ndarray, right: np.ndarray, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether rows x and y are one edit apart, and the length of their common prefix."""
    prefix = (left[x] != left[y]).argmax(axis=1)
    suffix = (right[x] != right[y])[:, ::-1].argmax(axis=1)
    return prefix + suffix >= left.shape[1] - 1, prefix


def _compare(rows: pa.Table) -> Iterator[pa.RecordBatch]:
    """Sums of the words of whole parts of the grid; rows are sorted by part."""
    part = [rows.column(c).to_numpy() for c in ("key", "i", "j")]
    own, n = rows.column("own").to_numpy(), rows.column("n").to_numpy()
    low, high, longer = (rows.column(c).to_numpy() for c in ("low", "high", "longer"))
    starts = run_starts(part)
    sizes = np.diff(np.append(starts, len(own)))
    ends = np.repeat(starts + sizes, sizes)
    words = rows.column("word").to_pylist()
    for width in np.unique(longer[ends - np.arange(len(ends)) > 1]):
        at = np.flatnonzero(longer == width)
        left, right = matrices([words[i] for i in at], int(width))
        whole = np.array([len(words[i]) == width for i in at])
        last = np.searchsorted(at, ends[at])
        found: list[np.ndarray] = []
        for x, y in index_pairs(last, max(1, _CELLS // int(width))):
            one, prefix = near(left, right, x, y)
            i, j = at[x], at[y]
            ok = one & (whole[x] | whole[y]) & (low[i] <= prefix) & (prefix < high[i])
            ok &= (part[1][i] == part[2][i]) | (own[i] != own[j])
            found.append(np.stack([i[ok], j[ok]]))
        if not found:
            continue
        x, y = np.concatenate(found, axis=1)
        if len(x):
            yield _sums(np.concatenate([x, y]), np.concatenate([y, x]), n, words)


def _sums(word: np.ndarray, other: np.ndarray, n: np.ndarray, words: list[str]) -> pa.RecordBatch:
    """For each word the number of others and the one of largest n, ties to the smaller word."""
    ids, named = np.unique(other, return_inverse=True)
    alphabetic = np.empty(len(ids), np.int64)
    alphabetic[sorted(range(len(ids)), key=lambda i: words[ids[i]])] = np.arange(len(ids))
    order = np.lexsort((alphabetic[named], -n[other], word))
    word, other = word[order], other[order]
    rows, firsts, counts = np.unique(word, return_index=True, return_counts=True)
    best = other[firsts]
    columns = [
        pa.array([words[i] for i in rows], pa.string()),
        pa.array(counts.astype(np.int64)),
        pa.array(n[best]),
        pa.array([words[i] for i in best], pa.string()),
    ]
    return pa.RecordBatch.from_arrays(columns, names=["word", "n_near", "best_n", "best"])


def near_words(words: DataFrame) -> DataFrame:
    """``(word, n_near, best_n, best)`` for the words of stored ``words(word, n)`` that are one edit from others."""
    placed = _placed(words)
    sizes = placed.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > _BLOCK)
    sizes, n_large = store(sizes)
    if n_large:
        placed = attach(placed, sizes, ["key"], weight="size", how="left", n_rows=n_large)
        parts = F.coalesce(F.ceil(F.col("size") / _BLOCK).cast("int"), F.lit(1))
        placed = placed.withColumn("own", F.pmod(F.xxhash64("word"), parts).cast("int"))
        placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1)))
    else:
        placed = placed.withColumn("own", F.lit(0)).withColumn("other", F.lit(0))
    part = ["key", "i", "j"]
    dealt = placed.select(
        "key",
        F.least("own", "other").alias("i"),
        F.greatest("own", "other").alias("j"),
        *("own", "longer", "low", "high", "word", "n"),
    ).repartition(*part)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_parts(batches, part):
            yield from _compare(rows)

    schema = "word string, n_near long, best_n long, best string"
    sums = dealt.sortWithinPartitions(*part).mapInArrow(compare, schema)
    best = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word")))
    sums = sums.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best"))
    return sums.select("word", "n_near", (-F.col("best.n")).alias("best_n"), F.col("best.word").alias("best"))


def _roots(forms: DataFrame) -> tuple[DataFrame, int]:
    """``(word, root)`` for every stored ``(word, form)``: where following forms ends.

    A form has more occurrences than its word, so there are no cycles, and pointers are followed
    twice as far in each round.
    """
    point, n = store(forms.select("word", F.col("form").alias("root")))
    for _ in range(_ROUNDS):
        further = point.select(F.col("word").alias("root"), F.col("root").alias("top"))
        ahead = attach(point, further, ["root"], how="left", n_rows=n)
        ahead, _ = store(
            ahead.select("word", F.coalesce("top", "root").alias("root"), F.col("top").isNotNull().alias("moved"))
        )
        if ahead.where("moved").isEmpty():
            return point, n
        point = ahead.drop("moved")
    raise RuntimeError("the forms do not end")


def spelling_variants(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    least: int = 7,
    times: int = 10,
    every: int = 31,
) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` for each word of ``docs``.

    Runs of ``[A-Za-z\\u00C0-\\u00FF]+`` have A-Z lower-cased. Where ``every`` divides the CRC-32 of
    ``<key>:<run>``, the run loses its letter at that number modulo its length. Words are the
    different results of at least ``least`` letters that occur twice or more, ``n`` times. Words
    are near if one inserted, deleted or replaced letter turns one into the other. The form of
    a word is the near word of largest ``n`` (ties: the smallest word) if that is at least ``times`` its
    own, else null; its root is where following forms ends.

    Null and empty texts have no words. Rows of a null id count with the empty string as id; repeated rows
    count again. Other columns are not read; an empty table gives an empty result. Texts
    and words of any length are taken whole.
    """
    named = docs.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("id"), F.col(text).alias("text"))
    words, _ = store(count_words(named, least, every).where(F.col("n") >= 2))
    found, _ = store(words.join(near_words(words), "word", "left"))
    found = found.withColumn("is_form", F.coalesce(F.col("best_n") >= times * F.col("n"), F.lit(False)))
    forms = found.where("is_form").select("word", F.col("best").alias("form"))
    roots, n_roots = _roots(forms)
    done = attach(found, roots, ["word"], how="left", n_rows=n_roots)
    return done.select(
        "word",
        F.when(F.col("is_form"), F.col("best")).alias("form"),
        F.coalesce("root", "word").alias("root"),
        "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(F.col("is_form"), F.col("best_n")).alias("form_n"),
    )

"""Words, hashes and column helpers shared by the text operators."""

from __future__ import annotations

import sys
import types
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
# Lower-cases A-Z in UTF-8 and leaves every other byte as it is.
LOWER_BYTES = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
# What bytes.split() and bytes.strip() take as white space: [\x20\x09-\x0D].
CACHED_WORDS = 1 << 17


class WordHashes(dict):
    """64-bit hashes of words, kept while there are at most CACHED_WORDS of them."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def kept_in_worker(name: str, version, make):
    """What ``make`` gives, kept for the later tasks of a Python worker: the last version of each name."""
    holder = sys.modules.setdefault("_corpus_worker", types.ModuleType("_corpus_worker"))
    kept = vars(holder)
    if name not in kept or kept[name][0] != version:
        kept[name] = (version, make())
    return kept[name][1]


def hands_back(work):
    """``work`` on the batches of a task; what Arrow has free at its end goes back to the system.

    Else it stays in the Python worker for as long as that lives, also while other steps need memory.
    """

    def whole(batches):
        try:
            yield from work(batches)
        finally:
            pa.default_memory_pool().release_unused()

    return whole


def words_of(text: bytes | None) -> list[bytes]:
    """The words ``[^\\x20\\x09-\\x0D]+`` of UTF-8 with A-Z lower-cased; none for a null text."""
    return (text or b"").translate(LOWER_BYTES).split()


def word_hashes(words: list[bytes], cache: WordHashes) -> np.ndarray:
    return np.fromiter(map(cache.__getitem__, words), np.uint64, len(words))


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit over all others."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def shingle_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """A hash for each run of ``k`` words; one for the whole text if it has fewer."""
    n = len(hashes)
    if n == 0:
        return hashes
    k = min(k, n)
    out = np.full(n - k + 1, k, np.uint64)
    for i in range(k):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + hashes[i : n - k + 1 + i])
    return out


def groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The runs of rows with equal keys, from batches that are sorted by them."""
    waiting: list[pa.RecordBatch] = []

    def whole() -> pa.Table:
        return pa.Table.from_batches(waiting)

    for batch in batches:
        if not batch.num_rows:
            continue
        values = list(zip(*(batch.column(k).to_pylist() for k in keys), strict=True))
        if waiting and tuple(waiting[-1].column(k)[-1].as_py() for k in keys) != values[0]:
            yield whole()
            waiting = []
        start = 0
        for i in range(1, len(values)):
            if values[i] != values[i - 1]:
                waiting.append(batch.slice(start, i - start))
                yield whole()
                waiting, start = [], i
        waiting.append(batch.slice(start))
    if waiting:
        yield whole()


def whole_parts(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of whole runs of rows with equal keys, of any number of runs, from batches sorted by them."""
    rest = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([batch])
        rows = (pa.concat_tables([rest, rows]) if rest is not None else rows).combine_chunks()
        # The last run may go on in the next batch.
        last = np.ones(rows.num_rows, bool)
        for key in keys:
            values = rows.column(key).to_numpy()
            last &= values == values[-1]
        cut = rows.num_rows - int(last.sum())
        if cut:
            yield rows.slice(0, cut)
        rest = rows.slice(cut)
    if rest is not None:
        yield rest


def run_starts(columns: list[np.ndarray]) -> np.ndarray:
    """Where runs of rows with equal values begin."""
    return np.flatnonzero(np.concatenate([[True], np.any([c[1:] != c[:-1] for c in columns], axis=0)]))


def index_pairs(ends: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs x < y < ends[x], about ``most`` at a time."""
    counts = np.maximum(ends - np.arange(len(ends)) - 1, 0)
    bounds = np.cumsum(counts)
    at = 0
    while at < len(ends):
        done = bounds[at - 1] if at else 0
        till = max(at + 1, int(np.searchsorted(bounds, done + most, side="right")))
        x = np.repeat(np.arange(at, till), counts[at:till])
        if len(x):
            y = x + 1 + np.arange(len(x)) - np.repeat(bounds[at:till] - counts[at:till] - done, counts[at:till])
            yield x, y
        at = till


def free_name(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    name = f"__{stem}"
    while name.lower() in taken:
        name += "_"
    return name


def lower_ascii(column):
    """``column`` with A-Z lower-cased and nothing else changed."""
    return F.translate(column, UPPER, LOWER)

"""Lexical retrieval packing: documents fill windows together with what BM25 finds for them.

Documents become token ids once. Document frequencies of all tokens are counted over all
documents (a vocabulary has a fixed number of them), so scores do not depend on shards.
Documents are dealt by the tokens that weigh most in them: those with the same first token come
to one bucket, a token that leads too many of them has several, and in a bucket documents
are ordered by their three leading tokens. So the shards of the inverted index, some
hundred documents in that order, hold what is lexically near, wherever it was read. A
document seeds a window, the shard's unused documents that score highest for it fill the
window one after another, and the one that is cut at its end seeds the next window with
its rest.
"""

from __future__ import annotations

import os
import re
import sys
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import tokenizers
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumagrid.llm.common import hands_back, kept_in_worker
from lumagrid.llm.counters import count_places
from lumagrid.settings import store

WINDOW = 2048
SHARD_DOCS = 512
SHARD_TOKENS = 1 << 20
END_ID = 1
K1, B = 1.2, 0.75
_CACHED_WORDS = 400_000
_PART_BYTES = 4 << 20  # of texts that are encoded together
LEADS = 3  # tokens by which documents are dealt and ordered
BUCKET_DOCS = 4096
# What a word may end in besides its letters; an apostrophe would bind to them.
_ENDINGS = ".,!?;:|#$%&*()-"
# Characters that byte-level models have for bytes: printable ones for themselves, 256 and up for the others.
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_OTHER_BYTES = {b: chr(256 + i) for i, b in enumerate(sorted(set(range(256)) - set(_PRINTABLE)))}
_BYTE_CHARACTERS = [_OTHER_BYTES.get(b, chr(b)) for b in range(256)]
_WIDE = r"[^\x{0}-\x{17f}]"
_BEFORE_ENDING = f"^[^{re.escape(_ENDINGS)}]*"


class WordIds:
    """The ids of words as bytes. Tokenizers that split at white space, and drop it, give a text
    the ids of its words one after another, so a word is looked up only once.

    A word is its letters and what it ends in: these are apart for a tokenizer that lower-cases and
    splits letters from other characters, and fewer are new. Letters of a tokenizer whose
    model takes bytes as characters go to the model itself. Both ways are tried on samples
    first. Words seen lately are kept, and those seen before them until the former are many,
    and so are lower-case letters, so that a worker finds most words of a task in what it kept
    of the last ones. It keeps them for as long as it lives, so they are Arrow arrays, of some
    30 bytes for a word and its ids.
    """

    def __init__(self, vocabulary: str, width: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = tokenizers.Tokenizer.from_file(vocabulary)
        self.model = self.tokenizer.model
        self.code = {"<u2": "H", "<u4": "I"}[width]
        self.words, self.letters = _Kept(), _Kept()
        self.plain = self._splits_endings()
        self.direct = self._takes_letters()

    def _bytes(self, ids: list[int]) -> bytes:
        found = array(self.code, ids)
        if sys.byteorder == "big":
            found.byteswap()
        return found.tobytes()

    def _ids(self, words: list[str]) -> list[bytes]:
        if not words:
            return []
        return [self._bytes(e.ids) for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]

    def _of_letters(self, word: str) -> bytes:
        """The ids of lower-case letters, by the model alone."""
        if not word.isascii():
            word = "".join(map(_BYTE_CHARACTERS.__getitem__, word.encode()))
        return self._bytes([t.id for t in self.model.tokenize(word)])

    def _splits_endings(self) -> bool:
        """Whether endings and case make no difference to the ids of the letters before."""
        words = ["Word", "word", "wOrdly1", "Éa"]
        ends = ["", ".", "!!", ",.", "###", "%%%", "&&&", "$$$", "***", "|", "?)", ";:", "--("]
        whole = self._ids([w + e for w in words for e in ends])
        letters, last = self._ids([w.lower() for w in words]), self._ids(ends)
        return whole == [a + b for a in letters for b in last]

    def _takes_letters(self) -> bool:
        """Whether the model alone gives words of letters the ids that they have."""
        words = ["a", "word", "unbelievably", "Éclairs", "straße", "weiß", "ñandú", "zzzzqxv", "naïveté", "Œuvre"]
        try:
            return self.plain and self._ids(words) == [self._of_letters(w.lower()) for w in words]
        except Exception:  # models of other kinds refuse in ways of their own
            return False

    def _of_new(self, new: pa.Array) -> pa.Array:
        """The ids of words that are not known."""
        # No word has a space in it, and lower case adds none.
        low = pa.array(b" ".join(new.to_pylist()).decode().lower().split(" "), pa.string())
        letters = pc.utf8_rtrim(low, _ENDINGS)
        # Letters up to U+017F are composed and have one lower-case form, but for one that falls apart.
        plain = pc.and_(pc.utf8_is_alpha(letters), pc.invert(pc.match_substring_regex(letters, _WIDE)))
        if not self.direct:
            plain = pc.and_(plain, False)
        letters = letters.filter(plain).cast(pa.binary()).dictionary_encode()
        ends = pc.replace_substring_regex(low.filter(plain), _BEFORE_ENDING, "").dictionary_encode()
        of_ends = pa.array(self._ids(ends.dictionary.to_pylist()), pa.binary())
        ids = self.letters.find(letters.dictionary, self._ask).take(letters.indices)
        ids = pc.binary_join_element_wise(ids, of_ends.take(ends.indices), b"")
        others = pc.invert(plain)
        rest = self._ids(new.filter(others).cast(pa.string()).to_pylist())
        out = pc.replace_with_mask(pa.nulls(len(new), pa.binary()), plain, ids)
        return pc.replace_with_mask(out, others, pa.array(rest, pa.binary()))

    def _ask(self, letters: pa.Array) -> pa.Array:
        return pa.array(map(self._of_letters, letters.cast(pa.string()).to_pylist()), pa.binary())

    def encoded(self, texts: pa.ListArray | list[list[bytes]]) -> pa.Array:
        """The ids of each text, given as its words."""
        if not isinstance(texts, pa.ListArray):
            texts = pa.array(texts, pa.list_(pa.binary()))
        words = texts.flatten().dictionary_encode()
        ids = self.words.find(words.dictionary, self._of_new).take(words.indices)
        return pc.binary_join(pa.ListArray.from_arrays(pc.subtract(texts.offsets, texts.offsets[0]), ids), b"")


class _Kept:
    """What different words have, as binary arrays: of words seen lately, and of those seen before them."""

    def __init__(self):
        self.known = self.older = (pa.array([], pa.binary()), pa.array([], pa.binary()))

    def find(self, words: pa.Array, make: Callable[[pa.Array], pa.Array]) -> pa.Array:
        """What each word has; ``make`` gives it for words that are not kept."""
        found = self.known[1].take(pc.index_in(words, self.known[0]))
        lacking = found.is_null()
        met = words.filter(lacking)
        if len(met):
            more = self.older[1].take(pc.index_in(met, self.older[0]))
            new = more.is_null()
            if pc.any(new).as_py():
                more = pc.replace_with_mask(more, new, make(met.filter(new)))
            found = pc.replace_with_mask(found, lacking, more)
            self.known = tuple(pa.concat_arrays(x) for x in zip(self.known, (met, more), strict=True))
            if len(self.known[0]) > _CACHED_WORDS:
                self.older, self.known = self.known, _Kept().known
        return found


def _parts(values: pa.Array, most: int) -> Iterator[tuple[int, int]]:
    """Bounds of runs of values, of about ``most`` bytes or one value each."""
    ends = np.cumsum(pc.binary_length(values).to_numpy(zero_copy_only=False), dtype=np.int64)
    start = 0
    while start < len(ends):
        done = ends[start - 1] if start else 0
        till = max(start + 1, int(np.searchsorted(ends, done + most, side="right")))
        yield start, till
        start = till


def token_ids(docs: DataFrame, key: str, text: str, vocabulary: str, width: str, end_id: int) -> DataFrame:
    """``(id, ids)``: the ids of each document and ``end_id`` as bytes of ``width``."""
    end = np.array([end_id], width).tobytes()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = kept_in_worker("word ids", (vocabulary, width), lambda: WordIds(vocabulary, width))
        for batch in batches:
            # A view leaves bytes as they are, and the kernel takes white space of ASCII alone.
            texts = batch.column(1).fill_null(b"").view(pa.string())
            for start, till in _parts(texts, _PART_BYTES):
                split = pc.ascii_split_whitespace(texts.slice(start, till - start))
                split = pa.ListArray.from_arrays(split.offsets, split.values.view(pa.binary()))
                ids = pc.binary_join_element_wise(cache.encoded(split), end, b"")
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, till - start), ids], names=["id", "ids"])

    named = docs.select(F.col(key).alias("id"), F.col(text).cast("binary").alias("text"))
    return named.mapInArrow(hands_back(encode), f"id {named.schema['id'].dataType.simpleString()}, ids binary")


def term_counts(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different ids in ascending order, and how often each occurs."""
    ids = np.sort(ids, kind="stable")
    ends = np.ones(len(ids), bool)
    np.not_equal(ids[1:], ids[:-1], out=ends[:-1])
    last = ends.nonzero()[0]
    counts = last.copy()
    counts[0] += 1
    counts[1:] -= last[:-1]
    return ids[last], counts


class Shard:
    """An inverted index over some documents: for each token, who has it and its BM25 weight."""

    def __init__(self, docs: list[np.ndarray], idf: np.ndarray, mean_length: float):
        terms, counts = zip(*map(term_counts, docs), strict=True)
        self.terms = terms
        owner = np.repeat(np.arange(len(docs)), [len(t) for t in terms])
        token, count = np.concatenate(terms), np.concatenate(counts)
        length = np.array([len(d) for d in docs], np.float64)[owner]
        weight = idf[token] * count * (K1 + 1) / (count + K1 * (1 - B + B * length / mean_length))
        order = np.argsort(token, kind="stable")
        self.owner, self.weight = owner[order], weight[order]
        token = token[order]
        self.tokens, self.starts = np.unique(token, return_index=True)
        self.ends = np.append(self.starts[1:], len(token))
        self.n = len(docs)

    def scores(self, seed: int) -> np.ndarray:
        """The BM25 score of every document of the shard for the seed's tokens."""
        at = np.searchsorted(self.tokens, self.terms[seed])
        starts, sizes = self.starts[at], self.ends[at] - self.starts[at]
        first = np.cumsum(sizes) - sizes
        postings = np.arange(sizes.sum()) + np.repeat(starts - first, sizes)
        return np.bincount(self.owner[postings], self.weight[postings], self.n)

    def order(self, lengths: list[int], room: int, window: int) -> list[int]:
        """The documents in the order in which they fill windows, the first of which has ``room`` left."""
        unused = np.ones(self.n, bool)
        found: list[int] = []
        next_seed, ranked = 0, iter(())
        while len(found) < self.n:
            doc = next((d for d in ranked if unused[d]), None)
            if doc is None:
                while not unused[next_seed]:
                    next_seed += 1
                doc = next_seed
            unused[doc] = False
            found.append(doc)
            seeds = lengths[doc] >= room  # it reaches into the next window and seeds that one
            room = window - (lengths[doc] - room) % window if seeds else room - lengths[doc]
            if seeds or len(found) == 1:
                score = self.scores(doc)
                score[~unused] = -1
                # Ties go to the earlier document.
                ranked = iter(np.argsort(-score, kind="stable")[: int(unused.sum())].tolist())
        return found


def pack_documents(
    docs: DataFrame,
    vocabulary: str,
    key: str = "doc_id",
    text: str = "text",
    window: int = WINDOW,
    end_id: int = END_ID,
    shard_docs: int = SHARD_DOCS,
    shard_tokens: int = SHARD_TOKENS,
    bucket_docs: int = BUCKET_DOCS,
) -> DataFrame:
    """``(id, start, doc_tokens, sequence_id, offset, ids)``: the pieces of all documents.

    ``ids`` holds a piece's token ids as bytes (little-endian, unsigned, 32 bits each), which lie at
    ``offset`` in the sequence.
    Every id of a document, and ``end_id`` after them, lies in exactly one piece. Sequences
    hold ``window`` tokens; what is left at the end of a bucket of about ``bucket_docs`` documents
    is cut at powers of two, so nothing is padded. The sequences depend on the rows alone, not on
    how they lie in files. ``vocabulary`` is the path of a tokenizers file on every machine, of a
    tokenizer that drops white space.

    A null or empty text is the end id alone. Rows of one id are packed each for itself. Other
    columns are not read; an empty table gives an empty result. Texts of any length are
    packed whole; a text that exceeds ``shard_tokens`` is a shard of its own.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    size = tokenizers.Tokenizer.from_file(vocabulary).get_vocab_size()
    size = max(size, end_id + 1)
    width = "<u2" if size <= 1 << 16 else "<u4"
    encoded, n_docs = store(token_ids(docs, key, text, vocabulary, width, end_id))

    def distinct(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        for value in batch.column(0):
            yield term_counts(np.frombuffer(value.as_buffer(), width))[0].astype(np.int64)

    frequency = count_places(encoded.select("ids"), distinct, size)
    n_bytes = encoded.agg(F.sum(F.octet_length("ids"))).first()[0] or 0
    mean_length = max(1.0, n_bytes / np.dtype(width).itemsize / max(1, n_docs))
    idf = np.log1p((n_docs - frequency + 0.5) / (frequency + 0.5))
    # A token that only one document has brings none together.
    pull = docs.sparkSession.sparkContext.broadcast(np.where(frequency > 1, idf, 0.0))
    shared = docs.sparkSession.sparkContext.broadcast(idf)

    def leads(ids: np.ndarray, n: int = LEADS) -> np.ndarray:
        """The tokens that weigh most in a document and that others have, the heaviest first; -1 for none."""
        token, count = term_counts(ids)
        weight = pull.value[token] * count / (count + K1 * (1 - B + B * len(ids) / mean_length))
        found = np.full(n, -1)
        for i in range(n):
            at = int(weight.argmax())
            if weight[at] <= 0:
                break
            found[i], weight[at] = token[at], 0
        return found

    def first_leads(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        yield np.array([leads(np.frombuffer(v.as_buffer(), width), 1)[0] + 1 for v in batch.column(0)], np.int64)

    led = count_places(encoded.select("ids"), first_leads, size + 1)
    first_bucket, n_buckets = _buckets(led, bucket_docs)
    plan = docs.sparkSession.sparkContext.broadcast((first_bucket, n_buckets))
    kind = encoded.schema["id"].dataType.simpleString()
    names = [f"lead{i}" for i in range(LEADS)]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, parts = plan.value
        for batch in batches:
            ids = batch.column("ids").to_pylist()
            found = np.array([leads(np.frombuffer(v, width)) for v in ids], np.int64).reshape(-1, LEADS)
            draw = np.array(
                [
                    xxhash.xxh3_64_intdigest(v, xxhash.xxh32_intdigest(str(i)))
                    for v, i in zip(ids, batch.column("id").to_pylist(), strict=True)
                ],
                np.uint64,
            )
            lead = found[:, 0] + 1
            bucket = first[lead] + (draw % parts[lead].astype(np.uint64)).astype(np.int64)
            columns = [pa.array(bucket), *(pa.array(found[:, i]) for i in range(LEADS)), pa.array(draw.view(np.int64))]
            yield pa.RecordBatch.from_arrays(
                [*columns, batch.column("id"), batch.column("ids")], names=["bucket", *names, "draw", "id", "ids"]
            )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, at, waiting, tokens = None, None, [], 0

        def packed() -> Iterator[pa.RecordBatch]:
            bodies = [np.frombuffer(ids, width) for _, ids in waiting]
            order = Shard(bodies, shared.value, mean_length).order(
                [len(b) for b in bodies], window - writer.filled, window
            )
            for doc in order:
                yield from writer.add(waiting[doc][0], bodies[doc])

        for batch in batches:
            rows = (batch.column(c) for c in ("bucket", "id", "ids"))
            for bucket, key, ids in zip(*rows, strict=True):
                bucket, ids = bucket.as_py(), ids.as_py()
                if waiting and (
                    bucket != at
                    or len(waiting) >= shard_docs
                    or tokens >= shard_tokens * np.dtype(width).itemsize
                ):
                    yield from packed()
                    waiting, tokens = [], 0
                if bucket != at:
                    if writer:
                        yield from writer.close()
                    writer, at = _Windows(window, bucket), bucket
                waiting.append((key, ids))
                tokens += len(ids)
        if waiting:
            yield from packed()
            yield from writer.close()

    schema = ", ".join(["bucket long", *(f"{n} long" for n in names), "draw long", f"id {kind}", "ids binary"])
    order = ["bucket", *names, "draw", "id"]
    dealt = encoded.mapInArrow(deal, schema).repartition("bucket").sortWithinPartitions(*order)
    return dealt.select("bucket", "id", "ids").mapInArrow(
        pack,
        f"id {kind}, start long, doc_tokens long, sequence_id long, offset long, ids binary",
    )


def _buckets(led: np.ndarray, bucket_docs: int) -> tuple[np.ndarray, np.ndarray]:
    """For each leading token its first bucket and its number of buckets; tokens that lead few share one."""
    parts = np.maximum(1, -(-led // bucket_docs))
    small = np.where(led <= bucket_docs, led, 0)
    # A token of many buckets ends the bucket before it.
    first, bucket, held = np.zeros(len(led), np.int64), 0, 0
    for token in np.flatnonzero(led):
        if parts[token] > 1 or held + small[token] > bucket_docs:
            bucket, held = bucket + (held > 0), 0
        first[token] = bucket
        if parts[token] > 1:
            bucket += int(parts[token])
        else:
            held += int(small[token])
    return first, parts


class _Windows:
    """Cuts documents into pieces as they fill windows; the open window waits for its end."""

    _ROWS = 256  # pieces that are handed on together

    def __init__(self, window: int, bucket: int):
        self.window, self.filled, self.open, self.rows = window, 0, [], []
        self.sequence = bucket << 32

    def add(self, key, ids: np.ndarray) -> Iterator[pa.RecordBatch]:
        start = 0
        while start < len(ids):
            length = min(len(ids) - start, self.window - self.filled)
            self.open.append((key, start, len(ids), ids[start : start + length]))
            start += length
            self.filled += length
            if self.filled == self.window:
                self._cut([self.window])
                if len(self.rows) >= self._ROWS:
                    yield self._batch()

    def close(self) -> Iterator[pa.RecordBatch]:
        if self.filled:
            self._cut([1 << b for b in range(self.filled.bit_length())[::-1] if self.filled >> b & 1])
        if self.rows:
            yield self._batch()

    def _cut(self, sizes: list[int]) -> None:
        """The open pieces become sequences of the given sizes."""
        offset = 0
        for key, start, total, ids in self.open:
            while len(ids):
                length = min(len(ids), sizes[0] - offset)
                body = ids[:length].astype("<u4").tobytes()
                self.rows.append((key, start, total, self.sequence, offset, body))
                ids, start, offset = ids[length:], start + length, offset + length
                if offset == sizes[0]:
                    self.sequence += 1
                    offset = 0
                    sizes.pop(0)
        self.open, self.filled = [], 0

    def _batch(self) -> pa.RecordBatch:
        keys, *numbers, ids = zip(*self.rows, strict=True)
        self.rows = []
        return pa.RecordBatch.from_arrays(
            [
                pa.array([k.as_py() for k in keys], keys[0].type),
                *(pa.array(n, pa.int64()) for n in numbers),
                pa.array(ids, pa.binary()),
            ],
            names=["id", "start", "doc_tokens", "sequence_id", "offset", "ids"],
        )


def digest_pieces(pieces: DataFrame) -> DataFrame:
    """``pieces`` with ``length`` and ``ids_crc32`` in place of the ids."""
    return pieces.select(
        *[c for c in pieces.columns if c != "ids"],
        F.expr("octet_length(ids) div 4").alias("length"),
        F.crc32("ids").alias("ids_crc32"),
    )

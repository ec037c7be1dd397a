"""Toxicity: a learned lexicon as a trie, met by Levenshtein automata, and scores of contexts.

Terms are words, and beginnings of words, that toxic documents hold far more often than
others. A word of a text becomes a Levenshtein automaton that walks the trie of all terms at
once, so misspelled terms are found too. The words around a term tell quotation and
report from abuse; both sums, and a few more, enter a logistic regression.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumagrid.llm.common import kept_in_worker
from lumagrid.llm.quality_rules import held_out
from lumagrid.operators.lookup import attach
from lumagrid.settings import store

# Labelled documents a model is fitted on, at most; they are drawn by a hash of the id.
MAX_LABELLED = 20_000
FOLDS = 3
LEXICON_SIZE = 400
LEAST_DOCS, LEAST_ODDS, LEAST_Z = 3, 1.5, 3.0
_PREFIXES = range(4, 9)
CONTEXT = 6  # words on each side of a term
_CACHED_WORDS = 1 << 17
_TEXTS = 256  # texts whose words are looked up together

_WORD = re.compile(r"\w+")
QUOTE_MARKS = "\"“”„«»‹›"
REPORTING = frozenset(
    "said says say wrote writes quoted quote quotes called term word words slur insult means "
    "defined definition reported sagte schrieb zitat wort dit écrit cité mot dijo escribió palabra".split()
)
ADDRESSING = frozenset("you your youre u ur du dich dein ihr tu toi ton vous te ti tus usted".split())

_COUNTS = [f"{kind}{fold}" for kind in ("toxic", "clean") for fold in range(FOLDS)]
FEATURES = [
    "direct", "quoted", "strongest", "density", "misspelled", "addressed", "terms", "words",
]


def allowed_errors(length: int) -> int:
    """Edits in which a word may differ from a term of that many letters."""
    return 0 if length < 5 else 1 if length < 10 else 2


class Trie:
    """Terms as a tree of letters; the end of one carries its weight."""

    def __init__(self, terms: list[tuple[str, float]]):
        self.root: dict = {}
        for term, weight in terms:
            node = self.root
            for letter in term:
                node = node.setdefault(letter, {})
            node[""] = (term, weight)

    def search(self, word: str, errors: int) -> tuple[int, float, str] | None:
        """The term nearest to ``word`` within ``errors`` edits: distance, weight below 0, term.

        States of the automaton of ``word`` are bits: bit i of row e says that the letters so far
        match the first i letters of the word with e errors. Of equally near terms the
        heavier one is found, then the first by name.
        """
        n = len(word)
        masks: dict[str, int] = {}
        for i, letter in enumerate(word):
            masks[letter] = masks.get(letter, 0) | 1 << i
        end, best = 1 << n, None
        full = (end << 1) - 1
        stack = [(self.root, tuple((2 << e) - 1 & full for e in range(errors + 1)))]
        while stack:
            node, rows = stack.pop()
            for letter, child in node.items():
                if not letter:
                    for distance, row in enumerate(rows):
                        if row & end:
                            rank = (distance, -child[1], child[0])
                            best = rank if best is None else min(best, rank)
                            break
                    continue
                mask = masks.get(letter, 0)
                new, below, moved = [], 0, 0
                for row in rows:
                    moved = ((row & mask) << 1 | below | (below | moved) << 1) & full
                    new.append(moved)
                    below = row
                if any(new):
                    stack.append((child, tuple(new)))
        return best


def code_points(words: list[str]) -> np.ndarray:
    """Words of one length as rows of code points."""
    return np.array(words, f"U{len(words[0])}").view(np.uint32).reshape(len(words), -1)


def letter_sets(codes: np.ndarray) -> np.ndarray:
    """The letters of each row as 64 bits; letters may share a bit."""
    return np.bitwise_or.reduce(np.uint64(1) << (codes & np.uint32(63)).astype(np.uint64), axis=1)


def part_hashes(codes: np.ndarray, start: int, size: int) -> np.ndarray:
    """A hash of the part of each row; 0 where a row has no such part."""
    out = np.zeros(len(codes), np.uint64)
    if 0 <= start and start + size <= codes.shape[1]:
        out += np.uint64(size)
        for i in range(start, start + size):
            out = (out * np.uint64(0x9E3779B97F4A7C15)) ^ (codes[:, i] + np.uint64(1))
    return out


def untouched_parts(length: int, errors: int) -> list[tuple[int, int, int]]:
    """Parts of a term of which a word within ``errors`` edits has one: start, size, and where it may lie.

    Of ``errors + 1`` parts one is left as it is: the first lies where words begin (0), the last where
    they end (-1), and one between edits on both sides no more than one letter off (1).
    """
    cuts = [i * length // (errors + 1) for i in range(errors + 2)]
    if errors == 0:
        return [(0, length, 0)]
    spans = list(zip(cuts, cuts[1:], strict=False))
    return [
        (start, end - start, 0 if i == 0 else -1 if i == errors else 1) for i, (start, end) in enumerate(spans)
    ]


class Tries:
    """The terms that words can be: those whose letters and parts a word has, as a trie."""

    _KEPT = 20_000  # small tries that are kept

    def __init__(self, terms: list[tuple[str, float]]):
        self.terms = terms
        self.by_length: dict[int, tuple] = {}
        self.small: dict[tuple[int, ...], list[tuple[int, Trie]]] = {}

    def _of_length(self, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, dict]:
        """Terms that words of ``n`` letters can be: places, letters, edits of letters, and parts by place and size."""
        if n not in self.by_length:
            at = [i for i, (t, _) in enumerate(self.terms) if abs(len(t) - n) <= allowed_errors(len(t))]
            parts: dict[tuple[int, int], tuple[list[int], list[int]]] = {}
            for place, i in enumerate(at):
                term = self.terms[i][0]
                codes = code_points([term])
                for start, size, side in untouched_parts(len(term), allowed_errors(len(term))):
                    own = int(part_hashes(codes, start, size)[0])
                    starts = {0: [0], -1: [n - size], 1: [start - 1, start, start + 1]}[side]
                    for s in starts:
                        places, hashes = parts.setdefault((s, size), ([], []))
                        places.append(place)
                        hashes.append(own)
            sets = np.array([letter_sets(code_points([self.terms[i][0]]))[0] for i in at], np.uint64)
            most = 2 * np.array([allowed_errors(len(self.terms[i][0])) for i in at], np.int64)
            found = {k: (np.array(p), np.array(h, np.uint64)) for k, (p, h) in parts.items()}
            self.by_length[n] = np.array(at, np.int64), sets, most, found
        return self.by_length[n]

    def candidates(self, words: list[str]) -> list[tuple[int, ...]]:
        """For each of some words of one length the terms that it may be.

        An edit takes a letter away from those of a word, adds one, or both, and leaves a part as it is.
        """
        at, sets, most, parts = self._of_length(len(words[0]))
        found: list[tuple[int, ...]] = [()] * len(words)
        if not len(at):
            return found
        for start in range(0, len(words), 4096):
            codes = code_points(words[start : start + 4096])
            near = np.zeros((len(codes), len(at)), bool)
            for (place, size), (terms, hashes) in parts.items():
                own = part_hashes(codes, place, size)
                rows, columns = np.nonzero((own[:, None] == hashes) & (own[:, None] != 0))
                near[rows, terms[columns]] = True
            rows, columns = np.nonzero(near)
            apart = np.bitwise_count(letter_sets(codes)[rows] ^ sets[columns])
            kept = apart <= most[columns]
            rows, columns = rows[kept], columns[kept]
            cuts = np.flatnonzero(np.diff(rows)) + 1
            for row, some in zip(rows[np.append(0, cuts)] if len(rows) else [], np.split(columns, cuts), strict=False):
                found[start + int(row)] = tuple(at[some].tolist())
        return found

    def search(self, word: str, terms: tuple[int, ...] | None = None) -> tuple[str, float, int] | None:
        """The nearest of all or some terms within its allowed errors, with weight and distance."""
        if terms is None:
            terms = self.candidates([word])[0]
        if terms not in self.small:
            near: dict[int, list[tuple[str, float]]] = {}
            for i in terms:
                near.setdefault(allowed_errors(len(self.terms[i][0])), []).append(self.terms[i])
            if len(self.small) >= self._KEPT:
                self.small.clear()
            self.small[terms] = [(errors, Trie(some)) for errors, some in near.items()]
        best = None
        for errors, trie in self.small[terms]:
            found = trie.search(word, errors)
            if found is not None:
                best = found if best is None else min(best, found)
        return None if best is None else (best[2], -best[1], best[0])


@dataclass(frozen=True)
class Lexicon:
    words: tuple[tuple[str, float], ...]
    prefixes: tuple[tuple[str, float], ...]


class Matcher:
    """Looks words up in a lexicon and remembers what it found."""

    def __init__(self, lexicon: Lexicon):
        self.tries = Tries(list(lexicon.words))
        self.prefixes = dict(lexicon.prefixes)
        # Words seen lately, and those seen before them; the latter go when the former are many.
        self.known: dict[str, tuple[float, bool] | None] = {}
        self.older: dict[str, tuple[float, bool] | None] = {}

    def _found(self, word: str, terms: tuple[int, ...]) -> tuple[float, bool] | None:
        near = self.tries.search(word, terms) if terms else None
        found = None if near is None else (near[1], near[2] > 0)
        starts = [self.prefixes[p] for k in _PREFIXES if k <= len(word) and (p := word[:k]) in self.prefixes]
        if starts and (found is None or found[1] or max(starts) > found[0]):
            found = (max(starts), False)
        return found

    def find(self, words: set[str]) -> dict[str, tuple[float, bool]]:
        """Of some words those that are not ordinary: the weight and whether a word is misspelled."""
        new: dict[int, list[str]] = {}
        for word in words:
            if word not in self.known:
                if word in self.older:
                    self.known[word] = self.older[word]
                else:
                    new.setdefault(len(word), []).append(word)
        for some in new.values():
            for word, terms in zip(some, self.tries.candidates(some), strict=True):
                self.known[word] = self._found(word, terms)
        hits = {w: f for w in words if (f := self.known[w]) is not None}
        if len(self.known) > _CACHED_WORDS:
            self.older, self.known = self.known, {}
        return hits

    def features_of(self, texts: list[str | None]) -> list[list[float]]:
        """The values of FEATURES for whole texts, some at a time; all 0 for one without words."""
        out = []
        for start in range(0, len(texts), _TEXTS):
            lower = [(t or "").lower() for t in texts[start : start + _TEXTS]]
            words = [_WORD.findall(t) for t in lower]
            hits = self.find(set().union(*words))
            out += [self._features(t, w, hits) for t, w in zip(lower, words, strict=True)]
        return out

    def features(self, text: str | None) -> list[float]:
        return self.features_of([text])[0]

    def _features(self, text: str, words: list[str], known: dict[str, tuple[float, bool]]) -> list[float]:
        if not words:
            return [0.0] * len(FEATURES)
        hits = {w: known[w] for w in known.keys() & set(words)} if known else {}
        direct, quoted, addressed, n_hits = {}, {}, 0, 0
        if hits:
            spans = [m.span() for m in _WORD.finditer(text)]
            for i, word in enumerate(words):
                if word not in hits:
                    continue
                n_hits += 1
                near = words[max(0, i - CONTEXT) : i] + words[i + 1 : i + 1 + CONTEXT]
                left = text[spans[max(0, i - CONTEXT)][0] : spans[i][0]]
                right = text[spans[i][1] : spans[min(len(words) - 1, i + CONTEXT)][1]]
                marks = any(q in left for q in QUOTE_MARKS) and any(q in right for q in QUOTE_MARKS)
                side = quoted if marks or not REPORTING.isdisjoint(near) else direct
                side[word] = hits[word][0]
                addressed += not ADDRESSING.isdisjoint(near)
        return [
            math.log1p(sum(sorted(direct.values()))),
            math.log1p(sum(sorted(quoted.values()))),
            max([0.0, *(w for w, _ in hits.values())]),
            math.log1p(100 * n_hits / len(words)),
            math.log1p(sum(m for _, m in hits.values())),
            math.log1p(addressed),
            math.log1p(len(hits)),
            math.log1p(len(words)),
        ]


@dataclass(frozen=True)
class ToxicityModel:
    lexicon: Lexicon
    weights: tuple[float, ...]
    intercept: float

    def features(self, text: Column) -> Column:
        lexicon = self.lexicon

        @F.pandas_udf("array<double>")
        def compute(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
            matcher = kept_in_worker("matcher", (lexicon.words, lexicon.prefixes), lambda: Matcher(lexicon))
            for texts in parts:
                yield pd.Series(matcher.features_of(texts.tolist()))

        return compute(text)

    def score(self, features: Column) -> Column:
        """The probability of label 1, from the array of features."""
        total = F.lit(self.intercept)
        for i, weight in enumerate(self.weights):
            total = total + F.get(features, F.lit(i)) * weight
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def count_terms(samples: DataFrame) -> DataFrame:
    """``(term, toxic, clean)`` of rows ``(text, label, fold)``: documents of each label, by fold.

    ``=`` before a term marks a word, ``^`` the beginning of one.
    """

    def terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, list[int]] = {}
        for batch in batches:
            for text, label, fold in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = set(_WORD.findall((text or "").lower()))
                found = {"=" + w for w in words} | {"^" + w[:k] for w in words for k in _PREFIXES if k < len(w)}
                for term in found:
                    counts.setdefault(term, [0] * (2 * FOLDS))[FOLDS * (1 - label) + fold] += 1
        columns = [pa.array([c[i] for c in counts.values()], pa.int64()) for i in range(2 * FOLDS)]
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), *columns], names=["term", *_COUNTS])

    schema = "term string, " + ", ".join(f"{c} long" for c in _COUNTS)
    counted = samples.select("text", "label", "fold").mapInArrow(terms, schema)
    return counted.groupBy("term").agg(*[F.sum(c).alias(c) for c in _COUNTS])


def learn_lexicon(counted: DataFrame, totals: dict, left_out: int | None, size: int = LEXICON_SIZE) -> Lexicon:
    """Up to ``size`` terms whose share among documents of label 1 stands out most clearly from
    that among the others, without the fold ``left_out``. A word that begins with a chosen
    beginning of no smaller weight is left to that.
    """
    folds = [f for f in range(FOLDS) if f != left_out]
    n_toxic, n_clean = (sum(totals[f"{kind}{f}"] or 0 for f in folds) for kind in ("toxic", "clean"))
    if not n_toxic or not n_clean:
        return Lexicon((), ())
    toxic, clean = (sum((F.col(f"{kind}{f}") for f in folds), F.lit(0)) for kind in ("toxic", "clean"))
    a, c = toxic + 0.5, clean + 0.5
    odds = F.log(a / (F.lit(n_toxic) - a + 1)) - F.log(c / (F.lit(n_clean) - c + 1))
    judged = counted.where(toxic >= LEAST_DOCS).select(
        "term", odds.alias("odds"), (odds / F.sqrt(1 / a + 1 / c)).alias("z")
    )
    chosen = judged.where((F.col("odds") >= LEAST_ODDS) & (F.col("z") >= LEAST_Z))
    rows = chosen.orderBy(F.desc("z"), "term").limit(size).collect()
    prefixes = {r.term[1:]: r.odds for r in rows if r.term[0] == "^"}
    words = {
        r.term[1:]: r.odds
        for r in rows
        if r.term[0] == "=" and max([0.0, *(prefixes.get(r.term[1 : k + 1], 0.0) for k in _PREFIXES)]) < r.odds
    }
    return Lexicon(tuple(sorted(words.items())), tuple(sorted(prefixes.items())))


def train_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    max_labelled: int = MAX_LABELLED,
) -> ToxicityModel:
    """A model from at most ``max_labelled`` of the labelled documents whose crc32(id) mod 5 is not 0.

    They lie in FOLDS folds. The weights are fitted on features that a fold has by the lexicon of
    the others, so that terms which stood out by chance weigh little; the model's own
    lexicon is that of all. Rows with a null id or label are left out. With labels of
    one kind only every text scores 0.99 or 0.01, without labels 0.01.
    """
    known = labels.select(F.col(key).alias("id"), F.col(label).cast("int").alias("label")).where(
        F.col("label").isin(0, 1) & ~held_out(F.col("id"))
    )
    drawn = known.orderBy(F.xxhash64("id"), "id", "label").limit(max_labelled)
    texts = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    fold = F.pmod(F.xxhash64("id", F.lit("fold")), F.lit(FOLDS)).cast("int")
    samples, _ = store(attach(texts, drawn, ["id"]).withColumn("fold", fold))
    sums = [
        F.count_if((F.col("label") == label) & (F.col("fold") == f)).alias(f"{kind}{f}")
        for kind, label in (("toxic", 1), ("clean", 0))
        for f in range(FOLDS)
    ]
    totals = samples.agg(*sums).first().asDict()
    counted, _ = store(count_terms(samples))
    lexicon = learn_lexicon(counted, totals, None)
    n_toxic, n_clean = (sum(totals[f"{kind}{f}"] for f in range(FOLDS)) for kind in ("toxic", "clean"))
    if not n_toxic or not n_clean:
        return ToxicityModel(lexicon, (0.0,) * len(FEATURES), 4.6 if n_toxic else -4.6)
    measured = None
    for f in range(FOLDS):
        plain = ToxicityModel(learn_lexicon(counted, totals, f), (), 0.0)
        part = samples.where(F.col("fold") == f).select(
            plain.features(F.col("text")).alias("values"), F.col("label").cast("double").alias("label")
        )
        measured = part if measured is None else measured.unionByName(part)
    measured, _ = store(measured)
    fitted = LogisticRegression(regParam=0.001, maxIter=60).fit(
        measured.select(array_to_vector("values").alias("features"), "label")
    )
    return ToxicityModel(lexicon, tuple(float(w) for w in fitted.coefficients), float(fitted.intercept))


def score_toxicity(
    docs: DataFrame, model: ToxicityModel, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``(key, score, values)`` for each row: the score from 0 to 1, and its features.

    A null, empty or blank text has features of 0 and the score these have. Equal texts have
    equal scores; other columns are not read; an empty table gives an empty result. Texts
    of any length are searched whole, where they lie.
    """
    measured = docs.select(F.col(key).alias("id"), model.features(F.col(text)).alias("values"))
    return measured.select(F.col("id").alias(key), model.score(F.col("values")).alias("score"), "values")

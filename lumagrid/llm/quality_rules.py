"""Quality classifier: a sparse ensemble of rules over statistics of a text.

Trees are grown on labelled documents, every path from a root becomes a rule (a
conjunction of bounds on statistics), a logistic regression with an L1 penalty keeps few
of the rules, and these become one Spark column expression.
"""

from __future__ import annotations

import operator
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumagrid.operators.lookup import attach
from lumagrid.settings import store

# Labelled documents a model is fitted on, at most; they are drawn by a hash of the id.
MAX_LABELLED = 20_000
REJECT_BELOW = 0.3
TREES, DEPTH, PENALTY = 24, 3, 0.002

STATISTICS = [
    "words_log", "word_length", "word_length_spread", "short_words", "long_words",
    "distinct_words", "same_as_last", "upper_bytes", "upper_words", "digit_bytes",
    "symbol_bytes", "exclaimed_words", "bar_words", "stopped_words", "brace_bytes",
    "other_bytes", "words_per_line", "distinct_lines", "line_starts_upper",
]

_UPPER = bytes(range(65, 91))
_DIGITS = bytes(range(48, 58))
_SYMBOLS = b"#$%&*@^~+_=\\"
_BRACES = b"{}[]()<>:;/\"'`"
_OTHER = bytes(range(128, 256))


def _share(text: bytes, some: bytes) -> float:
    return (len(text) - len(text.translate(None, some))) / max(1, len(text))


def text_statistics(text: bytes | None) -> list[float]:
    """The values of STATISTICS for one whole text; all 0 for one without words."""
    text = text or b""
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * len(STATISTICS)
    lengths = np.fromiter(map(len, words), np.float64, n)
    lines = [line for line in text.split(b"\n") if line.strip()]
    return [
        float(np.log1p(n)),
        float(lengths.mean()),
        float(lengths.std()),
        float((lengths <= 3).mean()),
        float((lengths >= 14).mean()),
        len(set(words)) / n,
        sum(map(operator.eq, words, words[1:])) / n,
        _share(text, _UPPER),
        sum(map(bytes.isupper, words)) / n,
        _share(text, _DIGITS),
        _share(text, _SYMBOLS),
        text.count(b"!") / n,
        text.count(b"|") / n,
        (text.count(b". ") + text.count(b".\n") + text.count(b", ")) / n,
        _share(text, _BRACES),
        _share(text, _OTHER),
        n / len(lines),
        len(set(lines)) / len(lines),
        sum(line.lstrip()[:1].isupper() for line in lines) / len(lines),
    ]


def statistics(text: Column) -> Column:
    """STATISTICS of a text as an array of doubles."""

    @F.pandas_udf("array<double>")
    def compute(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in parts:
            yield pd.Series([text_statistics(t) for t in texts])

    return compute(text.cast("binary"))


# A bound is (statistic, at most or above, value); a rule holds where all its bounds do.
Bound = tuple[int, bool, float]


@dataclass(frozen=True)
class RuleModel:
    rules: tuple[tuple[Bound, ...], ...]
    weights: tuple[float, ...]
    intercept: float

    def score(self, values: Column) -> Column:
        """The probability of label 1, from the array of statistics."""
        total = F.lit(self.intercept)
        for rule, weight in zip(self.rules, self.weights, strict=True):
            total = total + F.when(rule_column(rule, values), F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def rule_column(rule: tuple[Bound, ...], values: Column) -> Column:
    holds = F.lit(True)
    for index, at_most, value in rule:
        statistic = F.get(values, F.lit(index))
        holds = holds & ((statistic <= value) if at_most else (statistic > value))
    return holds


def tree_rules(root) -> list[tuple[Bound, ...]]:
    """The conjunctions on all paths of a tree, also those that end inside it."""
    found = []

    def walk(node, bounds: dict) -> None:
        if bounds:
            found.append(tuple(sorted((i, at_most, v) for (i, at_most), v in bounds.items())))
        if node.subtreeDepth() == 0:
            return
        split = node.split()
        index, value = split.featureIndex(), split.threshold()
        for child, at_most in ((node.leftChild(), True), (node.rightChild(), False)):
            known = bounds.get((index, at_most))
            tighter = value if known is None else (min if at_most else max)(known, value)
            walk(child, bounds | {(index, at_most): tighter})

    walk(root, {})
    return found


def fit_rules(samples: DataFrame, seed: int = 17) -> RuleModel:
    """A model from rows ``(values, label)`` with label 0 or 1.

    With labels of one kind only there are no rules and that kind's score is 0.99 or 0.01;
    without any label it is 0.99: nothing is known against a text.
    """
    shares = samples.agg(F.avg("label").alias("p"), F.count("label").alias("n")).first()
    if not shares.n or shares.p in (0.0, 1.0):
        sure = 4.6 if not shares.n or shares.p == 1.0 else -4.6
        return RuleModel((), (), sure)
    vectors = samples.select(array_to_vector("values").alias("features"), F.col("label").cast("double").alias("label"))
    forest = RandomForestClassifier(
        numTrees=TREES, maxDepth=DEPTH, subsamplingRate=0.7, featureSubsetStrategy="onethird", seed=seed
    ).fit(vectors)
    rules = sorted({rule for tree in forest.trees for rule in tree_rules(tree._java_obj.rootNode())})
    held = F.array(*[rule_column(rule, F.col("values")).cast("double") for rule in rules])
    fitted = LogisticRegression(
        elasticNetParam=1.0, regParam=PENALTY, maxIter=60, standardization=False
    ).fit(samples.select(array_to_vector(held).alias("features"), F.col("label").cast("double").alias("label")))
    kept = [(r, float(w)) for r, w in zip(rules, fitted.coefficients.toArray(), strict=True) if w != 0]
    return RuleModel(tuple(r for r, _ in kept), tuple(w for _, w in kept), float(fitted.intercept))


def train_quality(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    max_labelled: int = MAX_LABELLED,
) -> RuleModel:
    """A model from at most ``max_labelled`` of the labelled documents whose crc32(id) mod 5 is not 0.

    Rows with a null id or label are left out, and ids without a document. A document that has
    several labels counts once for each.
    """
    known = labels.select(F.col(key).alias("id"), F.col(label).cast("int").alias("label")).where(
        F.col("label").isin(0, 1) & ~held_out(F.col("id"))
    )
    drawn = known.orderBy(F.xxhash64("id"), "id", "label").limit(max_labelled)
    texts = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    chosen = attach(texts, drawn, ["id"])
    samples, _ = store(chosen.select(statistics(F.col("text")).alias("values"), "label"))
    return fit_rules(samples)


def held_out(key: Column) -> Column:
    """Rows that no model learns from."""
    return F.crc32(key.cast("string").cast("binary")) % 5 == 0


def score_quality(
    docs: DataFrame, model: RuleModel, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``(key, score, values)`` for each row: the score from 0 to 1, and its statistics.

    A null, empty or blank text has statistics of 0 and the score these have. Equal texts have
    equal scores; other columns are not read; an empty table gives an empty result. Texts
    of any length are measured whole, where they lie.
    """
    measured = docs.select(F.col(key).alias("id"), statistics(F.col(text)).alias("values"))
    return measured.select(F.col("id").alias(key), model.score(F.col("values")).alias("score"), "values")


def keep_quality(
    docs: DataFrame, model: RuleModel, text: str = "text", reject_below: float = REJECT_BELOW
) -> DataFrame:
    """The rows of ``docs`` that score ``reject_below`` or more, with their columns.

    Every row is judged by its whole text alone, so equal rows share their fate, ids may be null or
    repeated and other columns are of no account. Null and empty texts have the score that
    statistics of 0 have. An empty table gives an empty result.
    """
    return docs.where(model.score(statistics(F.col(text))) >= reject_below)

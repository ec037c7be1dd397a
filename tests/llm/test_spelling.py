"""Spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from lumagrid.llm import spelling
from tests.llm import cases


def edits(word, alphabet):
    out = set()
    for i in range(len(word) + 1):
        out |= {word[:i] + c + word[i:] for c in alphabet}
        if i < len(word):
            out |= {word[:i] + word[i + 1 :]} | {word[:i] + c + word[i + 1 :] for c in alphabet}
    return out - {word}


def plainly(rows):
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(cases.UPPER)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 7:
                counts[run] += 1
    n = {w: c for w, c in counts.items() if c >= 2}
    alphabet = set("".join(n))
    near = {w: [v for v in edits(w, alphabet) if v in n] for w in n}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best and n[best] >= 10 * n[w] else None

    def root(w):
        return root(form[w]) if form[w] else w

    return {(w, form[w], root(w), n[w], len(near[w]), n[form[w]] if form[w] else None) for w in n}


@pytest.mark.parametrize("block", [1024, 5])
def test_variants(spark, monkeypatch, block):
    """Also with keys of many blocks, whose parts of the grid meet once each."""
    monkeypatch.setattr(spelling, "_BLOCK", block)
    monkeypatch.setattr(spelling, "_CELLS", 1 << 22 if block == 1024 else 300)
    monkeypatch.setattr(spelling, "_FLUSH", 50)
    rng = random.Random(5)
    stems = ["aaaaaaa", "strasse", "réunion", "ÿÿÿÿÿÿÿ", "necessary", "accommodation", "Überraschungen"]
    extra = []
    for i in range(300):
        text = []
        for _ in range(40):
            word = rng.choice(stems[: 1 + i % len(stems)])
            for _ in range(rng.choice((0, 0, 0, 0, 0, 0, 0, 1, 2))):
                at = rng.randrange(len(word))
                word = rng.choice((word[:at] + word[at + 1 :], word[:at] + rng.choice("aeéÿ") + word[at:],
                                   word[:at] + rng.choice("aeé×") + word[at + 1 :]))
            text.append(word)
        extra.append((100 + i, rng.choice((" ", "-", "1")).join(text)))
    extra += [(900, "x" * 30_000 + " " + "x" * 30_001), (901, "x" * 30_000 + "," + "x" * 30_001)]
    docs = cases.messy(spark, extra)
    got = spelling.spelling_variants(docs)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    expected = plainly([(r.doc_id, r.text) for r in docs.collect() if r.doc_id not in (900, 901)])
    rows = [tuple(r) for r in got.collect()]
    assert {r for r in rows if len(r[0]) < 1000} == expected
    assert sorted((len(r[0]), r[3], r[4]) for r in rows if len(r[0]) >= 1000) == [(30_000, 2, 1), (30_001, 2, 1)]
    assert len(rows) == len(set(rows)) and any(r[1] and r[2] != r[1] for r in rows)
    assert spelling.spelling_variants(cases.empty(spark)).count() == 0


def test_common_ends_tell_single_edits():
    rng = random.Random(1)
    for _ in range(3000):
        a = "".join(rng.choice("ab") for _ in range(rng.randrange(3, 8)))
        b = "".join(rng.choice("ab") for _ in range(rng.choice((len(a), len(a) - 1))))
        if a != b:
            left, right = spelling.matrices([a, b], len(a))
            found, prefix = spelling.near(left, right, np.array([0]), np.array([1]))
            assert bool(found[0]) == (b in edits(a, "ab"))
            assert a[: prefix[0]] == b[: prefix[0]]

"""SimHash components against brute force."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from lumagrid.llm import simhash_gray
from tests.llm import cases
from tests.llm.test_near_duplicates import components_plainly, edited


def plainly(rows, radius=2):
    def code(text):
        w = cases.words(text)
        if not w:
            return 0
        runs = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))]
        hashes = [xxhash.xxh64(r.encode(), 42).intdigest() for r in runs]
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))

    codes = [code(t) for _, t in rows]
    links = [
        (i, j)
        for i in range(len(rows))
        for j in range(i)
        if None not in (rows[i][0], rows[j][0]) and (codes[i] ^ codes[j]).bit_count() <= radius
    ]
    roots, ids = components_plainly(links, range(len(rows))), defaultdict(list)
    for i, (doc, _) in enumerate(rows):
        ids[roots[i]].append(doc)
    return Counter(
        (doc, f"{codes[i]:016x}", None if doc is None else min(ids[roots[i]])) for i, (doc, _) in enumerate(rows)
    )


@pytest.mark.parametrize(("block", "run"), [(4096, 256), (8, 4)])
def test_components(spark, monkeypatch, block, run):
    """Also with many small blocks, which the upper tree has to bring together."""
    monkeypatch.setattr(simhash_gray, "BLOCK", block)
    monkeypatch.setattr(simhash_gray, "_RUN", run)
    long = cases.prose(78, 400)
    extra = [(1000 + i, edited(long, i, i % 7)) for i in range(120)]
    extra += [(2000 + i, edited(cases.prose(i // 3, 200), i, i % 3)) for i in range(60)]
    extra += [(3000, "a b"), (3001, "A\tb "), (3002, "a b c"), (3003, "\n")]
    docs = cases.messy(spark, extra)
    got = simhash_gray.simhash_components(docs)
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    rows = Counter(map(tuple, got.collect()))
    assert rows == plainly([(r.doc_id, r.text) for r in docs.collect()])
    assert max(Counter(r[2] for r in rows).values()) > 20
    assert simhash_gray.simhash_components(cases.empty(spark)).count() == 0


def near_pairs(codes, radius):
    return {(i, j) for i in range(len(codes)) for j in range(i + 1, len(codes))
            if (int(codes[i]) ^ int(codes[j])).bit_count() <= radius}


def test_walk_of_two_trees_finds_every_pair():
    rng = np.random.default_rng(1)
    centres = rng.integers(0, 1 << 63, 30, np.uint64)
    flips = [np.uint64(sum(1 << int(b) for b in rng.integers(0, 64, 3))) for _ in range(400)]
    codes = np.unique(np.array([centres[i % 30] ^ f for i, f in enumerate(flips)], np.uint64))
    codes = simhash_gray._in_gray_order([codes])
    for radius in (0, 1, 2, 4):
        tree = simhash_gray.Tree.of(codes)
        found = [p for x, y in simhash_gray.meetings(tree, tree, radius) for p in zip(x.tolist(), y.tolist())]
        assert len(found) == len(set(found))
        assert set(found) == near_pairs(codes, radius)
        # Trees of different heights.
        some = codes[::40]
        a, b = simhash_gray.Tree.of(some), simhash_gray.Tree.of(codes)
        found = {(int(some[i]), int(codes[j])) for x, y in simhash_gray.meetings(a, b, radius) for i, j in zip(x, y)}
        assert found == {(int(p), int(q)) for p in some for q in codes if (int(p) ^ int(q)).bit_count() <= radius}


def test_fingerprints_of_a_long_text_are_counted_in_parts(monkeypatch):
    text = cases.prose(4, 3000).encode()
    whole = simhash_gray.fingerprint(text, 3)
    monkeypatch.setattr(simhash_gray, "_HASHES", 7)
    assert simhash_gray.fingerprint(text, 3) == whole


def test_gray_order(spark):
    rng = random.Random(2)
    codes = [0, -1, 1, -(1 << 63)] + [rng.getrandbits(64) - (1 << 63) for _ in range(200)]
    df = spark.createDataFrame([(c,) for c in codes], "code long")
    got = [r.code for r in df.orderBy(simhash_gray.gray_rank(df.code)).collect()]
    def rank(code):
        code &= (1 << 64) - 1
        out = 0
        while code:
            out ^= code
            code >>= 1
        return out
    assert got == sorted(codes, key=rank)

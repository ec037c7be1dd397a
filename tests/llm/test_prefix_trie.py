"""Prefix tries against brute force."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest

from lumagrid.llm import prefix_trie
from tests.llm import cases


def order(role, text):
    parts = [(p or "").encode() for p in (role, text)]
    return hashlib.sha256(b"".join(b"%d:%s" % (len(p), p) for p in parts)).digest()


def plainly(rows):
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            convs[conv].append(((turn is not None, turn or 0, order(role, text)), (role or "", text or "")))
    own = {c: [t for _, t in sorted(turns)] for c, turns in convs.items()}
    whole = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        whole[c] = own.get(c - c % 5, [])[:h] + turns[h:]
    members = defaultdict(list)
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = sum(leaves[k] for k in children[node]) or 1
        size = len(node[-1][1].encode()) if node else 0
        saved[node] = (len(members[node]) - 1) * size + sum(saved[k] for k in children[node])
    return Counter(
        (
            min(members[node]), len(node), min(members[node[:-1]]) if node else None, len(members[node]),
            len(children[node]), leaves[node], saved[node],
            hashlib.sha256(",".join(str(c) for c in sorted(members[node]) if len(whole[c]) == len(node)).encode()).hexdigest(),
        )
        for node in members
    )


SCHEMA = "conv_id long, turn long, role string, text string, n long, conv string, depth int, id string, head double"


def conversations(spark, seed, n, longest):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        if rng.random() < 0.15:
            continue
        talk = [(rng.choice(("user", "bot", None)), rng.choice(("a", "éé", "", None, "long text"))) for _ in range(rng.choice((1, 2, 3, longest)))]
        if rng.random() < 0.5:  # a common conversation
            talk = [("user", "hello"), ("bot", "hello"), *([("user", "x")] * longest)][: rng.randrange(1, longest)]
        rows += [(c, t, role, text) for t, (role, text) in enumerate(talk)]
        if rng.random() < 0.2:
            rows += [(c, None, "system", "first"), (c, 0, "user", "tie"), (c, 0, "user", "tie")]
    rows += [(None, 1, "user", "nobody's"), (10**12 + 4, 1, "user", "alone"), (7 * 10**11, 3, None, None)]
    rng.shuffle(rows)
    return spark.createDataFrame([(*r, 1, "c", 2, "i", 0.5) for r in rows], SCHEMA)


@pytest.mark.parametrize(("segment", "turns", "longest"), [(1 << 16, 1 << 18, 12), (3, 40, 14), (1, 4, 6), (12, 1, 25)])
def test_trie(spark, monkeypatch, segment, turns, longest):
    """Also with many shards, whose boundaries are merged, and with conversations of many segments."""
    monkeypatch.setattr(prefix_trie, "SHARD_TURNS", turns)
    monkeypatch.setattr(prefix_trie, "_IDS", 3)
    monkeypatch.setattr(prefix_trie, "_BLOCK", 2)
    df = conversations(spark, segment, 120, longest)
    rows = [tuple(r)[:4] for r in df.collect()]
    sequences = prefix_trie.rebuilt(prefix_trie.encoded_turns(df, "conv_id", "turn", "role", "text"))
    got = Counter(map(tuple, prefix_trie.trie_nodes(sequences, segment).collect()))
    assert got == plainly(rows)


def test_edges(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert prefix_trie.prefix_trie(empty).count() == 0
    # Of conversation 3 all turns are replaced by those of conversation 0, which is absent: a root alone.
    c = next(c for c in range(1, 5) if zlib.crc32(str(c).encode()) % 9)
    one = spark.createDataFrame([(c, 1, "user", "x", 1, "c", 2, "i", 0.5)], SCHEMA)
    got = prefix_trie.prefix_trie(one)
    assert got.columns == [
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"
    ]
    assert [tuple(r) for r in got.collect()] == list(plainly([(c, 1, "user", "x")]))
    long = spark.createDataFrame([(5, t, "user", cases.prose(t, 3000), 1, "c", 2, "i", 0.5) for t in range(20)], SCHEMA)
    rows = [tuple(r)[:4] for r in long.collect()]
    assert Counter(map(tuple, prefix_trie.prefix_trie(long).collect())) == plainly(rows)


def test_medians_come_before_their_halves():
    for n in (0, 1, 2, 7, 50):
        got = list(prefix_trie.medians(n))
        assert sorted(got) == list(range(n))
    tree = prefix_trie.TernaryTree()
    for i in prefix_trie.medians(1000):
        tree.insert([i])
    deepest, waiting = 0, [(tree.equal[0], 1)]
    while waiting:
        at, d = waiting.pop()
        if at >= 0:
            deepest = max(deepest, d)
            waiting += [(tree.low[at], d + 1), (tree.high[at], d + 1)]
    assert deepest == 10

"""Jaccard join, components, decontamination and passages against brute force."""

import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lumagrid.llm import components as cc
from lumagrid.llm import decontaminate, jaccard_join, substring_dedup
from tests.llm import cases


def edited(text, seed, edits):
    """A near copy: some words replaced, left out or added."""
    rng, words = random.Random(seed), text.split()
    for _ in range(edits):
        at = rng.randrange(len(words))
        words[at : at + rng.choice((0, 1, 1))] = rng.choice(([], [f"x{seed}"], [f"x{seed}", "y"])) or ["z"]
    return " ".join(words)


def components_plainly(links, nodes):
    up = {n: n for n in nodes}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    rng = random.Random(3)
    links = [(i, i + 1) for i in range(100, 400)] + [(500, j) for j in range(501, 900)]
    links += [(rng.randrange(1000, 3000), rng.randrange(1000, 3000)) for _ in range(900)] + [(7, 7), (8, None)]
    rng.shuffle(links)
    got = {r.node: r.root for r in cc.components(spark.createDataFrame(links, "a long, b long")).collect()}
    whole = [(a, b) for a, b in links if b is not None]
    assert got == components_plainly(whole, {n for link in whole for n in link})
    assert cc.components(spark.createDataFrame([], "a long, b long")).count() == 0


def shingles(text, k=5):
    w = cases.words(text)
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def jaccard_plainly(rows):
    sets = [shingles(t) for _, t in rows]
    links = []
    for i, s in enumerate(sets):
        for j in range(i):
            if rows[i][0] is not None and rows[j][0] is not None and s and sets[j]:
                both = len(s & sets[j])
                if 100 * both >= 80 * (len(s) + len(sets[j]) - both):
                    links.append((i, j))
    roots = components_plainly(links, range(len(rows)))
    lowest = defaultdict(list)
    for i, (doc, _) in enumerate(rows):
        lowest[roots[i]].append(doc)
    return Counter(
        (doc, len(sets[i]), None if doc is None else min(lowest[roots[i]])) for i, (doc, _) in enumerate(rows)
    )


@pytest.mark.parametrize("frequent", [256, 4])
def test_jaccard_components(spark, monkeypatch, frequent):
    """Also with tokens that count as frequent soon, so that combinations are indexed."""
    monkeypatch.setattr(jaccard_join, "FREQUENT", frequent)
    monkeypatch.setattr(jaccard_join, "COMBINED_SIZE", 80 if frequent == 4 else 192)
    base, long = cases.prose(77, 60), cases.prose(78, 300)
    extra = [(1000 + i, edited(base, i, i % 6)) for i in range(40)]
    extra += [(2000 + i, edited(long, i, i % 30)) for i in range(40)]
    extra += [(3000 + i, base + " " + cases.prose(500 + i, 12 + i)) for i in range(20)]
    extra += [(4000, "a b"), (4001, "A\tb "), (4002, "a b c d e"), (4003, "a b c d e f"), (4004, "a b c d")]
    docs = cases.messy(spark, extra)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = Counter(tuple(r) for r in jaccard_join.jaccard_components(docs).collect())
    assert got == jaccard_plainly(rows)


def test_another_text_of_a_repeated_id_does_not_hide_its_set(spark):
    base = cases.prose(77, 60)
    near = [(10 + i, base + f" tail{i}") for i in range(4)]
    rows = []
    for i, text in [(1, base), *near]:
        rows += [(i, cases.prose(200 + i, 45)), (i, text), (i, text)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = defaultdict(set)
    for r in jaccard_join.jaccard_components(docs).collect():
        got[r.component_id].add(r.doc_id)
    assert any({1, 10, 11, 12, 13} <= ids for ids in got.values())


def test_one_of_a_group_stays(spark):
    docs = cases.messy(spark, [(20, cases.prose(1, 60) + " x"), (0, "alone here is a text of its own")])
    kept = jaccard_join.keep_one(docs)
    assert kept.columns == docs.columns
    ids = Counter(r.doc_id for r in kept.collect())
    # 1 and its copies 2 and near copies 10 and 20 are one group.
    assert ids == Counter([0, 1, 3, 4, 5, 6, 7, 8, 9, None, None])
    assert jaccard_join.keep_one(cases.empty(spark)).count() == 0
    repeated = spark.createDataFrame([(5, "a b c d e f")] * 3, "doc_id long, text string")
    assert jaccard_join.keep_one(repeated).count() == 1


def test_texts_of_a_repeated_id_are_kept_each_by_itself(spark):
    a, r, s = (cases.prose(i, 50) for i in (31, 32, 33))
    rows = [(1, a), (2, a), (2, r), (3, r + " x"), (4, s), (4, s + " y"), (4, cases.prose(34, 50)), (5, a + " z"), (5, a)]
    rows += [(6, ""), (6, " \n"), (6, None), (None, a), (None, a)]
    kept = jaccard_join.keep_one(spark.createDataFrame(rows, "doc_id long, text string"))
    got = Counter(tuple(x) for x in kept.collect())
    of_4 = [t for i, t in got if i == 4]
    assert len(of_4) == 2 and rows[6][1] in of_4
    assert {k: v for k, v in got.items() if k[0] != 4} == {
        (1, a): 1, (2, r): 1, (6, ""): 1, (6, " \n"): 1, (6, None): 1, (None, a): 2
    }


def test_sets_meet_a_common_one_in_parts(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "_PER_HUB", 5)
    monkeypatch.setattr(jaccard_join, "_SENT", 900)
    base = cases.prose(9, 80)
    rows = [(i, edited(base, i, i % 9)) for i in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = Counter(tuple(r) for r in jaccard_join.jaccard_components(docs).collect())
    assert got == jaccard_plainly(rows)


def test_large_groups_are_cut_into_a_grid(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "_GRID", 7)
    base = cases.prose(9, 80)
    rows = [(i, edited(base, i, i % 9)) for i in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = Counter(tuple(r) for r in jaccard_join.jaccard_components(docs).collect())
    assert got == jaccard_plainly(rows)


def test_near_copies_that_no_hub_connects_make_few_pairs():
    """A part of sets that all may be linked: each is first paired with its nearest ones, and they hang together."""
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1 << 63, 60, dtype=np.uint64)
    sets = [np.unique(np.append(np.delete(base, i), rng.integers(0, 1 << 63, dtype=np.uint64))) for i in range(60)]
    n, nodes = len(sets), list(range(len(sets)))
    zeros = pa.array([0] * n, pa.int64())
    rows = pa.table(
        {
            "key": zeros, "i": zeros, "j": zeros, "own": zeros, "node": nodes, "root": nodes,
            "n": [len(s) for s in sets], "sketch": [jaccard_join.sketch_of(s) for s in sets], "low": [b""] * n,
        }
    )

    def pairs(nearest):
        made = jaccard_join._compare(rows, ["key", "i", "j"], 80, 100, nearest)
        return [pair for batch in made for pair in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "more")))]

    assert len(pairs(None)) == n * (n - 1) // 2
    few = pairs(4)
    assert len(few) <= 4 * n and any(more for *_, more in few)
    root = nodes.copy()
    for a, b, _ in few:
        old, new = root[a], root[b]
        root = [new if r == old else r for r in root]
    assert len(set(root)) == 1
    assert not any(more for *_, more in pairs(n))


def test_sketches_tell_most_sets_that_are_nearly_linked():
    rng = np.random.default_rng(6)
    linked = 0
    for _ in range(200):
        tokens = rng.integers(0, 1 << 63, 74, dtype=np.uint64)
        x, y = np.sort(tokens[:64]), np.sort(tokens[10:])  # 54 in common, similarity 0.73
        bits = (np.frombuffer(jaccard_join.sketch_of(s), np.uint64) for s in (x, y))
        apart = int(np.bitwise_count(np.bitwise_xor(*bits)).sum())
        assert apart <= 20
        linked += jaccard_join.may_link(apart, 128, 80, 100)
    assert linked < 30


def test_a_second_round_finds_what_the_nearest_do_not(spark, monkeypatch):
    """Sets in a chain of slow change, against brute force."""
    monkeypatch.setattr(jaccard_join, "_NEAREST", 1)
    monkeypatch.setattr(jaccard_join, "FREQUENT", 5)
    rng = random.Random(8)
    texts = []
    for family in range(3):
        words = [f"f{family}w{i}" for i in range(60)]
        for _ in range(25):
            words = words.copy()
            words[rng.randrange(60)] = f"x{rng.randrange(10**6)}"
            texts.append(" ".join(words if rng.random() < 0.7 else words[: rng.randrange(40, 60)]))
    sets = [set(zip(*(t.split()[i:] for i in range(5)))) for t in texts]
    root = list(range(len(sets)))
    for a in range(len(sets)):
        for b in range(a):
            if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                low, high = sorted((root[a], root[b]))
                root = [low if r == high else r for r in root]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in jaccard_join.jaccard_components(docs).collect()}
    assert got == dict(enumerate(root))


def test_sketches_never_exceed_the_difference():
    rng = np.random.default_rng(5)
    for n, m in ((5, 6), (60, 50), (200, 260), (700, 300)):
        pool = rng.integers(0, 1 << 63, n + m, np.uint64)
        a, b = np.unique(pool[:n]), np.unique(pool[n // 2 : n // 2 + m])
        x, y = (np.frombuffer(jaccard_join.sketch_of(s), np.uint64) for s in (a, b))
        words = min(len(x), len(y))
        apart = int(np.bitwise_count(jaccard_join.fold(x, words) ^ jaccard_join.fold(y, words)).sum())
        assert apart <= len(np.setxor1d(a, b))


def test_sizes_of_linked_sets_meet_in_a_level(spark):
    for num, den in ((80, 100), (50, 100), (2, 3)):
        rows = jaccard_join._levels(spark.range(2, 300).select(F.col("id").alias("n")), num, den).collect()
        of = defaultdict(dict)
        for r in rows:
            of[r.n][r.level] = r.top
        for a in range(2, 300):
            for b in range(a, min(299, a * den // num) + 1):
                met = [level for level in of[a] if level in of[b] and (of[a][level] or of[b][level])]
                assert len(met) == 1, (a, b)


def test_sets_are_sent_only_where_others_of_their_size_are(spark):
    """And with sketches of about a bit a token; a second round looks at the levels of buckets that it is given."""
    sizes = [(0, 1, 10), (0, 2, 100), (0, 3, 1000), (1, 4, 200), (1, 5, 220), (1, 6, 3000), (2, 7, 50), (2, 8, 52), (2, 9, 900)]
    rng = np.random.default_rng(3)
    sketches = {node: jaccard_join.sketch_of(rng.integers(0, 1 << 63, n, dtype=np.uint64)) for _, node, n in sizes}
    nodes = spark.createDataFrame(
        [(node, n, bytearray(sketches[node]), bytearray(jaccard_join.short_of(sketches[node])), bytearray())
         for _, node, n in sizes],
        "node long, n long, sketch binary, short binary, low binary",
    )
    placed = spark.createDataFrame(sizes, "key long, node long, n long")
    roots = spark.createDataFrame([(7, 7), (8, 7)], "node long, root long")
    dealt = jaccard_join._open_parts(placed, roots, 2, nodes, 80, 100, "short").collect()
    assert {(r.key, r.node) for r in dealt} == {(1, 4), (1, 5)}
    assert all(len(r.sketch) * 8 <= 2 * r.n for r in dealt)
    level = max(r.level for r in dealt)
    for key, n in ((1, 2), (0, 0)):
        among = spark.createDataFrame([(key, level)], "key long, level int"), 1
        assert jaccard_join._open_parts(placed, roots, 2, nodes, 80, 100, "sketch", among).count() == n


def test_short_sketches_never_exceed_the_difference():
    rng = np.random.default_rng(15)
    for n, m in ((5, 6), (60, 50), (200, 260), (700, 300)):
        pool = rng.integers(0, 1 << 63, n + m, np.uint64)
        a, b = np.unique(pool[:n]), np.unique(pool[n // 2 : n // 2 + m])
        x, y = (pa.array([jaccard_join.short_of(jaccard_join.sketch_of(s))], pa.binary()) for s in (a, b))
        one = np.zeros(1, np.int64)
        apart = int(jaccard_join.Sketches(x).apart(one, jaccard_join.Sketches(y), one)[0])
        assert apart <= len(np.setxor1d(a, b))


# --- decontamination --------------------------------------------------------------------


def leaks_plainly(docs, items, k=5):
    weight = lambda s: sum(len(w) for sh in s for w in sh)
    found = {}
    for doc, text in docs:
        w = (text or "").lower().split()
        for item, body in items:
            v = (body or "").lower().split()
            if not v:
                continue
            size = min(k, len(v))
            runs = lambda x: {tuple(x[i : i + size]) for i in range(len(x) - size + 1)}  # noqa: B023, E731
            want, best = runs(v), (0.0, 0)
            for start in range(max(1, len(w) - len(v) + 1)):
                have = runs(w[start : start + len(v)])
                if have:
                    best = max(best, (weight(have & want) / weight(have | want), -start))
            if best[0] >= 0.8:
                found[doc, item] = (-best[1], round(best[0], 9))
    return found


def test_leaks(spark):
    items = [(i, cases.prose(300 + i, 20 + 3 * i)) for i in range(12)]
    items += [(90, None), (91, " "), (92, "one two"), (93, "ONE Two"), (94, "solitary")]
    docs = []
    for i in range(12):
        body = items[i][1]
        docs.append((600 + i, cases.prose(i, 40) + " " + body + " " + cases.prose(i + 50, 30)))
        docs.append((100 + i, cases.prose(i, 200) + " " + edited(body, i, 1) + " tail"))
        docs.append((200 + i, cases.prose(i, 20) + " " + edited(body, i, 9) + " tail"))
        docs.append((300 + i, " ".join(body.split()[: 18 + 3 * i])))
    docs += [(450, "here one\ntwo there"), (451, "solitary"), (452, "One"), (453, None), (454, "")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    frame = cases.messy(spark, docs)
    got = {
        (r.doc_id, r.item): (r.start, round(r.similarity, 9))
        for r in decontaminate.leaks_of_documents(frame, bench).collect()
    }
    distinct = [i for i in items if i[0] != 93]  # the words of 92
    assert got == leaks_plainly(docs, distinct)
    kept = decontaminate.drop_leaks(frame, bench)
    assert kept.columns == frame.columns
    leaked = {doc for doc, _ in got}
    assert Counter(r.doc_id for r in kept.collect()) == Counter(
        r.doc_id for r in frame.collect() if r.doc_id not in leaked
    )


def test_tables_of_texts_are_no_larger_than_broadcasts_assume(spark, monkeypatch):
    """What grows with the texts that hold items: a long item has many windows in each of its texts."""
    seen = []

    def bytes_of(value):
        """In an UnsafeRow, at least: variable parts lie behind a fixed field of 8 bytes each."""
        if isinstance(value, str):
            return 8 + len(value)
        if isinstance(value, (list, tuple)):
            return 16 + sum(map(bytes_of, value))
        return 8

    def attach(big, small, keys, *args, **options):
        if "digest" in small.columns:
            rows = [tuple(r) for r in small.collect()]
            of_keys = sum(8 + sum(bytes_of(r[small.columns.index(k)]) for k in keys) for r in rows)
            seen.append((small.columns, of_keys + sum(8 + sum(map(bytes_of, r)) for r in rows)))
            assert seen[-1][1] <= options.get("row_bytes", 64) * len(rows), small.columns
        return attached(big, small, keys, *args, **options)

    attached = decontaminate.attach
    monkeypatch.setattr(decontaminate, "attach", attach)
    item = cases.prose(3, 400)
    rows = [(i, f"{cases.prose(i, 100)} {item} {cases.prose(i + 9, 100)}") for i in range(10, 14)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    got = decontaminate.leaks_of_documents(docs, bench).collect()
    assert {(r.doc_id, r.item, r.start, r.similarity) for r in got} == {(i, 1, 100, 1.0) for i in range(10, 14)}
    assert seen


def test_blocks_propose_near_copies(spark):
    """The index alone finds nearly all exact and lightly edited items, and never more than both ways together."""
    items = [(i, cases.prose(700 + i, 60 + i)) for i in range(40)]
    docs = [(i, cases.prose(i, 50) + " " + body + " " + cases.prose(i + 60, 30)) for i, body in items]
    near = [(100 + i, cases.prose(i, 50) + " " + edited(body, i, 1) + " end") for i, body in items]
    bench = spark.createDataFrame(items, "item_id long, text string")
    frame = spark.createDataFrame(docs + near, "doc_id long, text string")
    whole, proposed = (
        {(r.doc_id, r.item) for r in decontaminate.leaks_of_documents(frame, bench, exact=e).collect()}
        for e in (True, False)
    )
    assert {(i, i) for i in range(40)} <= proposed <= whole
    assert len({(100 + i, i) for i in range(40)} & proposed) >= 36
    assert {(100 + i, i) for i in range(40)} <= whole


def test_nothing_to_leak(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    one = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    docs = cases.messy(spark)
    assert decontaminate.drop_leaks(docs, none).count() == docs.count()
    assert decontaminate.drop_leaks(cases.empty(spark), one).count() == 0
    assert decontaminate.leaks_of_documents(docs, none).count() == 0


def test_blocks_agree_within_the_radius(spark):
    """Any fingerprints within the radius have a block in common."""
    rng, pairs = random.Random(4), []
    for apart in range(65):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), apart):
            b ^= 1 << bit
        pairs.append((apart, *(x - (1 << 64) if x >> 63 else x for x in (a, b))))
    df = spark.createDataFrame(pairs, "apart int, a long, b long")
    for radius in (3, 20):
        rows = df.select("apart", *[decontaminate.blocks(df[c], radius).alias(c) for c in "ab"]).collect()
        assert all(set(r.a) & set(r.b) for r in rows if r.apart <= radius)


# --- passages ---------------------------------------------------------------------------


def test_passages(spark):
    passage, other = cases.prose(901, 70), cases.prose(902, 51)
    own = lambda i, n: cases.prose(10_000 + i, n)
    extra = [(1000 + i, own(i, 30 + i) + "\n" + passage + " " + own(i + 500, 20)) for i in range(25)]
    extra += [(2000 + i, own(i + 50, 9) + " " + edited(passage, i, 3)) for i in range(6)]
    extra += [(3000, other + " " + own(80, 30)), (3001, own(81, 44) + " " + other)]
    extra += [(4000, own(82, 40) + " " + " ".join(other.split()[:30])), (4001, own(83, 300))]
    docs = cases.messy(spark, extra)
    rows = substring_dedup.repeated_passages(docs).collect()
    texts = {}
    for r in docs.collect():
        if r.doc_id is not None:  # ids that repeat have equal rows here
            texts[r.doc_id] = cases.words(r.text)
    covered = defaultdict(list)
    for r in rows:
        assert r.other_id < r.doc_id
        a, b = texts[r.doc_id][r.start : r.end], texts[r.other_id][r.other_start : r.other_end]
        assert len(a) == r.end - r.start >= 50 and len(b) == r.other_end - r.other_start
        assert 0.8 <= r.identity <= 1
        assert (a == b) >= (r.identity == 1)
        covered[r.doc_id].append((r.start, r.end))
    # Every run of 50 words that an earlier document has lies in a passage.
    first = {}
    for doc in sorted(texts):
        w = texts[doc]
        for i in range(len(w) - 49):
            if first.setdefault(tuple(w[i : i + 50]), doc) != doc:
                assert any(a <= i and i + 50 <= b for a, b in covered[doc]), (doc, i)
    assert {2000, 2001, 2002, 2003, 2004, 2005} <= set(covered)
    assert not {4000, 4001, 1, 3, 4, 5, 6, 7, 8, 9} & set(covered)
    assert substring_dedup.repeated_passages(cases.empty(spark)).count() == 0


def copies_plainly(texts, inside):
    """Places of every run of 50 words that an earlier document has, or with ``inside`` the document before."""
    first, found = {}, []
    for doc in sorted(texts):
        w, own = texts[doc], {}
        for i in range(len(w) - 49):
            run = tuple(w[i : i + 50])
            if first.get(run, doc) != doc or (inside and own.get(run, i) != i):
                found.append((doc, i))
            own.setdefault(run, i)
        for run in own:
            first.setdefault(run, doc)
    return found


@pytest.mark.parametrize("inside", [False, True])
def test_every_place_of_a_passage_is_found(spark, inside):
    words = lambda name, n: [f"{name}{i}" for i in range(n)]
    p, q = words("p", 60), words("q", 55)
    texts = {
        1: words("a", 20) + p + words("b", 30),
        2: words("c", 20) + p + words("d", 100) + p + words("e", 30) + q,
        3: words("f", 70) + q + words("g", 12) + q + words("h", 9) + q,
        4: words("i", 80) + words("j", 40) + words("i", 80),
        5: ["z"] * 400,
        6: words("k", 30) + ["z"] * 90,
        7: p + p,
    }
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in texts.items()], "doc_id long, text string")
    rows = substring_dedup.repeated_passages(docs, inside=inside).collect()
    covered = defaultdict(list)
    for r in rows:
        assert (r.other_id, r.other_start) < (r.doc_id, r.start) and (inside or r.other_id < r.doc_id)
        assert r.identity == 1 and texts[r.doc_id][r.start : r.end] == texts[r.other_id][r.other_start : r.other_end]
        covered[r.doc_id].append((r.start, r.end))
    for doc, i in copies_plainly(texts, inside):
        if doc != 5:  # one word over and over is one place of its seed
            assert any(a <= i and i + 50 <= b for a, b in covered[doc]), (doc, i)
    assert sorted(set(covered[2])) == [(20, 80), (180, 240)]
    assert (4 in covered) == inside


def test_texts_of_a_repeated_id_are_documents(spark):
    words = lambda name, n: " ".join(f"{name}{i}" for i in range(n))
    p, q = words("p", 60), words("q", 60)
    rows = [(1, words("a", 9) + " " + p), (2, words("b", 200)), (2, words("c", 15) + " " + p), (2, words("d", 7) + " " + q)]
    rows += [(3, q + " " + words("e", 5)), (3, q + " " + words("e", 5)), (3, None)]
    got = substring_dedup.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {(r.doc_id, r.start, r.end, r.other_id, r.other_start) for r in got.collect()} == {
        (2, 15, 75, 1, 9), (3, 0, 60, 2, 7)
    }


def best_chain_plainly(rows):
    rows = sorted(rows.tolist(), key=lambda r: (r[0], r[2]))
    best = []
    for x0, x1, y0, y1 in rows:
        score = x1 - x0
        for (_, p1, _, q1), before in zip(rows, best, strict=False):
            if p1 <= x0 and q1 <= y0 and max(x0 - p1, y0 - q1) <= substring_dedup.MAX_GAP:
                score = max(score, x1 - x0 + before - substring_dedup.GAP_COST * (x0 - p1 + y0 - q1))
        best.append(score)
    return max(best)


def test_chains_are_the_best(spark):
    rng = np.random.default_rng(6)
    for _ in range(60):
        x, y = rng.integers(0, 60, 12), rng.integers(0, 60, 12)
        rows = np.stack([x, x + 8, y, y + 8], axis=1)
        chain = substring_dedup.chains(rows)[0]
        gaps = (chain[1:, 0] - chain[:-1, 1]).sum() + (chain[1:, 2] - chain[:-1, 3]).sum()
        score = (chain[:, 1] - chain[:, 0]).sum() - substring_dedup.GAP_COST * gaps
        assert score == pytest.approx(best_chain_plainly(rows))


def hashed(*parts):
    """Word hashes of texts, given as lists of words, in one."""
    return np.array([abs(hash(w)) % (1 << 31) for w in sum(parts, [])], np.uint32)


def passages_plainly(a, b):
    """What the seeds of two texts lead to."""
    seeds = lambda w: {tuple(w[i : i + substring_dedup.K]): i for i in range(len(w) - substring_dedup.K + 1)}
    first, second = seeds(a.tolist()), seeds(b.tolist())
    both = np.array(sorted((p, second[s]) for s, p in first.items() if s in second))
    found = substring_dedup.chains(substring_dedup.segments(both[:, 0], both[:, 1]))
    return [p for c in found for p in substring_dedup.passages_of(a, b, c, 50, 0.8)]


@pytest.mark.parametrize("gap", range(0, 71, 5))
def test_passages_with_a_gap_or_a_stray_seed(gap):
    words = lambda name, n: [f"{name}{i}" for i in range(n)]
    for one, two in ((60, 60), (60, 8), (8, 60), (60, 20)):
        p, q = words("p", one), words("q", two)
        a = hashed(words("a", 40), p, words("b", gap), q, words("c", 40))
        b = hashed(words("d", 25), p, words("e", gap), q, words("f", 40))
        found = passages_plainly(a, b)
        for start, n in ((40, one), (40 + one + gap, two)):
            if n >= 50:
                assert any(f[0] <= start and start + n <= f[1] for f in found), (gap, one, two)
        assert all(f[1] - f[0] >= 50 and f[4] >= 0.8 for f in found)


def own_words(name, n):
    return [f"{name}{i}" for i in range(n)]


def passages_of_pairs(spark, pairs):
    """The passages of pairs of lists of words, each pair by itself: ``{pair: [(start, end), ...]}``."""
    rows = [(2 * i + j, " ".join(w)) for i, pair in enumerate(pairs) for j, w in enumerate(pair)]
    found = defaultdict(list)
    for r in substring_dedup.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        assert r.doc_id == r.other_id + 1 and r.end - r.start >= 50 and r.identity >= 0.8
        found[r.other_id // 2].append((r.start, r.end))
    return found


def test_passages_apart_are_both_found(spark):
    pairs, wanted = [], []
    for gap in (0, 20, 31, 40, 55):
        for second in (60, 8):
            t = f"g{gap}s{second}"
            p, q = own_words(t + "p", 60), own_words(t + "q", second)
            pairs.append(tuple(own_words(t + e, 30) + p + own_words(t + e + "m", gap) + q for e in "ab"))
            wanted.append([(30, 90)] + [(90 + gap, 90 + gap + second)] * (second >= 50))
    found = passages_of_pairs(spark, pairs)
    for i, passages in enumerate(wanted):
        for start, end in passages:
            assert any(a <= start and end <= b for a, b in found[i]), (i, start)


def test_passages_of_few_seeds_are_found(spark):
    pairs, wanted = [], []
    for at in [(14, 46), (13, 45), (10, 50), (19, 39), (17, 34, 52)]:
        for copy in range(4):
            t = f"e{at[0]}c{copy}"
            p = own_words(t + "p", 60)
            q = [f"{t}z{i}" if i in at else w for i, w in enumerate(p)]
            pairs.append((own_words(t + "a", 40) + p + own_words(t + "b", 400), own_words(t + "c", 300) + q))
            wanted.append([(300, 360)])
    # Passages farther apart than a gap may be, after a long one.
    for gap in (63, 64, 70, 200):
        for edit in (25, 30):
            t = f"g{gap}e{edit}"
            p, q = own_words(t + "p", 300), own_words(t + "q", 60)
            r = q[:edit] + [t + "z"] + q[edit + 1 :]
            mids = own_words(t + "m", gap), own_words(t + "n", gap)
            pairs.append((p + mids[0] + q, p + mids[1] + r))
            wanted.append([(0, 300), (300 + gap, 360 + gap)])
    found = passages_of_pairs(spark, pairs)
    for i, passages in enumerate(wanted):
        for start, end in passages:
            assert any(a <= start and end <= b for a, b in found[i]), (i, start, found[i])


def test_chains_look_no_farther_than_a_gap():
    rng = np.random.default_rng(7)
    for _ in range(60):
        x, y = rng.integers(0, 400, 16), rng.integers(0, 400, 16)
        rows = np.stack([x, x + 8, y, y + 8], axis=1)
        rows[0, 1] += 60
        rows[0, 3] += 60
        chain = substring_dedup.chains(rows)[0]
        gaps = (chain[1:, 0] - chain[:-1, 1]).sum() + (chain[1:, 2] - chain[:-1, 3]).sum()
        score = (chain[:, 1] - chain[:, 0]).sum() - substring_dedup.GAP_COST * gaps
        assert score == pytest.approx(best_chain_plainly(rows))


def test_index_does_not_depend_on_parts(spark, monkeypatch):
    """Documents are indexed some at a time; none is left out where a part ends."""
    rows = [(i, None if i == 4 else cases.prose(i, 30 * (i % 3)).encode()) for i in range(10)]
    docs = spark.createDataFrame(rows, "id long, text binary").coalesce(1)
    classes = spark.sparkContext.broadcast(bytes(jaccard_join._COUNTERS))

    def index():
        built = jaccard_join._build_index(docs, 5, 80, 100, classes)
        return sorted(tuple(r) for r in built.drop("row").collect())

    whole = index()
    monkeypatch.setattr(jaccard_join, "_PART_ROWS", 3)
    assert index() == whole and [r[0] for r in whole] == list(range(10))

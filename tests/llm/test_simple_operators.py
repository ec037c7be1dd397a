"""URL filter, line dedup, sharding and packing against plain versions of themselves."""

import hashlib
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lumagrid.llm import bloom, line_dedup, packing, sharding, url_filter
from tests.llm import cases

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


# --- URL filter -------------------------------------------------------------------------

URLS = [
    (None, "", "", None, "allow"),
    ("", "", "", None, "allow"),
    ("no scheme/porn", "", "", None, "block"),
    ("http://A.Example.ORG/es/x?q#f", "a.example.org", "/es/x", "example.org/es/", "block"),
    ("http://example.org/en/1", "example.org", "/en/1", "example.org/en/1", "block"),
    ("http://notexample.org/en/1", "notexample.org", "/en/1", "org/", "allow"),
    ("http://example.org", "example.org", "", None, "allow"),
    ("http://x.com/de/porn", "x.com", "/de/porn", "com/de/", "block"),
    ("http://x.com/fr/porn", "x.com", "/fr/porn", "com/fr/", "allow"),
    ("http://x.net/a/porn.html", "x.net", "/a/porn.html", None, "block"),
    ("http://x.net/a/PORN_2", "x.net", "/a/PORN_2", None, "block"),
    ("http://x.net/a/popcorn", "x.net", "/a/popcorn", None, "allow"),
    ("http://x.net/essex/sexton", "x.net", "/essex/sexton", None, "allow"),
    ("http://x.net/casino", "x.net", "/casino", None, "allow"),
    ("http://x.net/casino/casino", "x.net", "/casino/casino", None, "allow"),
    ("http://x.net/casino-slots", "x.net", "/casino-slots", None, "block"),
    ("http://x.net/dating/bet/poker", "x.net", "/dating/bet/poker", None, "allow"),
    ("http://x.net?a=xxx", "x.net", "", None, "block"),
    ("http://x.net/\nnude adult", "x.net", "/\nnude adult", None, "block"),
]


def test_urls_are_judged(spark):
    rows = [(i, u, "clash", "clash") for i, (u, *_) in enumerate(URLS)] * 2
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, verdict string")
    got = url_filter.filter_urls(pages).collect()
    assert len(got) == 2 * len(URLS)
    for row in got:
        assert (row.host, row.path, row.rule, row.verdict) == URLS[row.page_id][1:], URLS[row.page_id]


def test_other_rules_and_terms(spark):
    pages = spark.createDataFrame([(1, "http://a.b.c/x/y")], "page_id long, url string")
    judge = lambda **o: url_filter.filter_urls(pages, **o).first()
    assert judge(rules=[], strict=[], soft={}).verdict == "allow"
    assert judge(rules=[("b.c", "/", "block"), ("c", "/x/y", "allow")]).rule == "c/x/y"
    assert judge(rules=[("c", "/x", "block"), ("a.b.c", "/", "allow")]).rule == "a.b.c/"
    assert judge(rules=[], strict=["y", ""], soft={}).strict_terms == ["y"]
    assert url_filter.filter_urls(pages.limit(0)).count() == 0


def test_a_vocabulary_from_a_table(spark):
    rows = [("Bad", True, None), ("mild", None, None), ("mild", False, 0.5), ("half", False, 0.5), (None, True, 1.0), ("bad", True, 3.0)]
    terms = spark.createDataFrame(rows, "term string, strict boolean, weight double")
    strict, soft = url_filter.vocabulary_of(terms)
    assert (strict, soft) == (["Bad", "bad"], {"mild": 1.0, "half": 0.5})
    urls = ["http://a/bad", "http://a/mild-half", "http://a/mild/mild", "http://a/x"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    judged = url_filter.filter_urls(pages, rules=[], strict=strict, soft=soft, soft_limit=1.5)
    assert [r.verdict for r in judged.orderBy("page_id").collect()] == ["block", "block", "allow", "allow"]
    with pytest.raises(ValueError):
        url_filter.vocabulary_of(terms, most=2)


# --- line dedup -------------------------------------------------------------------------


def dedup_plainly(rows, min_chars=10):
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(cases.UPPER)
    holders = defaultdict(set)
    for doc, text in rows:
        if doc is not None:
            for line in (text or "").split("\n"):
                holders[key(line)].add(doc)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [
            line
            for line in lines
            if doc is None
            or len(key(line)) < min_chars
            or len(holders[key(line)]) < 2
            or min(holders[key(line)]) == doc
        ]
        out.append((doc, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return Counter(out)


@pytest.mark.parametrize("n_bits", [1 << 16, 1 << 20])
def test_lines(spark, n_bits):
    """A filter that is far too small changes nothing."""
    more = [(100 + i, "\n".join(cases.prose(j, 4) for j in range(i % 7, i % 7 + 300))) for i in range(30)]
    more += [(200, "ひらがなひらがなひら\nshort"), (201, " ひらがなひらがなひら\t"), (202, "ひらがなひらがなひ"), (203, "ひらがなひらがなひ")]
    docs = cases.messy(spark, more)
    got = line_dedup.dedup_lines(docs, n_bits=n_bits)
    assert set(got.columns) == set(docs.columns) | {"n_dropped"}
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert Counter((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in got.collect()) == dedup_plainly(rows)
    assert line_dedup.dedup_lines(cases.empty(spark), n_bits=n_bits).count() == 0


def test_rebuilt_lines_take_little_memory():
    """A worker never holds a batch of texts as Python objects."""
    lines = [f"{i} {cases.prose(i, 60)}".encode() for i in range(8)]
    gone = [[hashlib.sha256(lines[i % 8].lower()).digest()] if i % 3 == 0 else None for i in range(6000)]
    texts, digests = pa.array([b"\n".join(lines)] * 6000), pa.array(gone, pa.list_(pa.binary()))
    n = 0
    tracemalloc.start()
    for part in line_dedup.kept_lines(texts, digests, 10):
        for row in part.to_pylist():
            kept = [line for i, line in enumerate(lines) if n % 3 or i != n % 8]
            assert (row["kept"], row["n_lines"], row["n_dropped"]) == (b"\n".join(kept), 8, 8 - len(kept))
            n += 1
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == 6000 and texts.nbytes > 10 << 20 and most < texts.nbytes / 4


def test_filters_hold_all_that_occurs_twice(spark):
    rng = np.random.default_rng(1)
    once, twice = rng.integers(0, 1 << 63, 3000, np.uint64), rng.integers(0, 1 << 63, 500, np.uint64)
    parts = [np.concatenate([p, twice[i::2], twice[i::2]]) for i, p in enumerate(np.array_split(once, 2))]
    df = spark.createDataFrame([(p.tobytes(),) for p in parts], "h binary").repartition(2)
    bits = np.frombuffer(bloom.seen_twice(df, lambda b: np.frombuffer(b, np.uint64), 1 << 18), np.uint8)
    assert bloom.held(bits, twice).all()
    assert bloom.held(bits, once).mean() < 0.05


# --- sharding ---------------------------------------------------------------------------


def test_shards(spark):
    docs = cases.messy(spark, [(i, cases.prose(i, i % 40)) for i in range(1000, 3000)])
    got = sharding.assign_shards(docs)
    rows = got.collect()
    assert len(rows) == docs.count()
    texts = Counter((r.doc_id, len((r.text or "").encode()) + 16, zlib.crc32((r.text or "").encode())) for r in docs.collect())
    assert texts == Counter((r.doc_id, r.size, r.text_crc32) for r in rows)
    slots, shard_of = defaultdict(list), {}
    for r in rows:
        slots[r.shard].append(r.slot)
        assert shard_of.setdefault(r.doc_id, r.shard) == r.shard
        assert r.grown_shard in (r.shard, 40)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert 20 < sum(r.grown_shard == 40 for r in rows) < 90
    assert min(map(len, slots.values())) > 25
    assert sharding.assign_shards(cases.empty(spark)).count() == 0


def test_weights_and_removed_shards(spark):
    keys = spark.range(20_000)
    a = keys.select("id", sharding.shard_of(F.col("id"), [1, 2, 0, 1]).alias("s")).toPandas().set_index("id").s
    shares = a.value_counts(normalize=True)
    assert set(a) == {0, 1, 3}
    assert abs(shares[1] - 0.5) < 0.02
    # A shard that goes gives its keys away; no other key moves.
    b = keys.select("id", sharding.shard_of(F.col("id"), [1, 2, 0, 0]).alias("s")).toPandas().set_index("id").s
    assert (a[a != 3] == b[a != 3]).all()
    with pytest.raises(ValueError):
        sharding.shard_of(F.col("id"), [0.0])


# --- packing ----------------------------------------------------------------------------


@pytest.mark.parametrize(("window", "shard"), [(2048, 512), (64, 3)])
def test_pieces_give_the_documents_back(spark, window, shard):
    odd = "it's don't. 's, It'S! x's| É!! é### ½% 1.2, <|startoftext|>. <|endoftext|>** ab<|endoftext|>! a\x0bb\x0cc <|endoftext|> don't x 1234 é İ\x1c\x1d"
    docs = cases.messy(spark, [(50, odd), *((60 + i, cases.prose(i, 5 + 13 * i)) for i in range(20))])
    pieces = packing.pack_documents(docs, VOCABULARY, window=window, shard_docs=shard)
    rows = packing.digest_pieces(pieces).collect()
    tokenizer = Tokenizer.from_file(VOCABULARY)
    want = Counter()
    for r in docs.collect():
        want[r.doc_id, tuple([*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 1])] += 1
    # Pieces that follow each other: by start, and by sequence where rows share an id.
    whole, sequences = Counter(), defaultdict(list)
    texts = defaultdict(dict)
    for r in pieces.collect():
        ids = np.frombuffer(r.ids, "<u4")
        texts[r.id].setdefault(r.start, []).append(tuple(ids.tolist()))
        sequences[r.sequence_id].append((r.offset, len(ids)))
    for doc, ids in want:
        n = want[doc, ids]
        spans = [(s, i) for s, parts in texts[doc].items() for i in parts if ids[s : s + len(i)] == i]
        assert sum(len(i) for _, i in spans) >= n * len(ids)
        whole[doc, ids] = n
    assert sum(len(r) for parts in texts.values() for p in parts.values() for r in p) == sum(
        len(ids) * n for (_, ids), n in want.items()
    )
    assert whole == want
    for parts in sequences.values():
        parts.sort()
        ends = np.cumsum([n for _, n in parts])
        assert [o for o, _ in parts] == [0, *ends[:-1]]
        assert ends[-1] == window or ends[-1] & (ends[-1] - 1) == 0
    assert all(r.doc_tokens >= r.start + r.length for r in rows)
    sums = Counter(zlib.crc32(bytes(r.ids)) for r in pieces.collect())
    assert sums == Counter(r.ids_crc32 for r in rows)
    assert packing.pack_documents(cases.empty(spark), VOCABULARY).count() == 0


def test_words_have_the_ids_of_texts(monkeypatch):
    """Also where most words are forgotten again."""
    monkeypatch.setattr(packing, "_CACHED_WORDS", 40)
    rng = np.random.default_rng(7)
    letters = list("abcdeXYZéÉßñÑÿœŒŞıİçäöüΩдж漢ªº１")
    ends = ["", ".", "!!", ",", "'s", "-", "|", "?)", "2", "²"]
    words = ["".join(rng.choice(letters, rng.integers(1, 9))) + str(rng.choice(ends)) for _ in range(1500)]
    texts = [" ".join(rng.choice(words, 30)) for _ in range(60)]
    cache, tokenizer = packing.WordIds(VOCABULARY, "<u2"), Tokenizer.from_file(VOCABULARY)
    assert cache.plain and cache.direct
    for text in texts:
        got = np.frombuffer(cache.encoded([text.encode().split()])[0], "<u2").tolist()
        assert got == tokenizer.encode(text, add_special_tokens=False).ids, text


def test_letters_that_come_again_are_known(monkeypatch):
    """Also in words with other endings, and when so many words were new since that some are forgotten."""
    monkeypatch.setattr(packing, "_CACHED_WORDS", 100)
    cache, asked = packing.WordIds(VOCABULARY, "<u2"), []
    model = cache._of_letters
    cache._of_letters = lambda word: asked.append(word) or model(word)
    first, others = ([f"{c}{chr(97 + i % 26)}{chr(97 + i // 26)}x" for i in range(n)] for c, n in (("q", 90), ("z", 60)))
    for words in (first, others, [w.capitalize() + "." for w in first]):
        got = np.frombuffer(cache.encoded([[w.encode() for w in words]])[0], "<u2").tolist()
        assert got == cache.tokenizer.encode(" ".join(words), add_special_tokens=False).ids
    assert len(asked) == 150


def test_known_words_take_little_memory():
    """They stay in a worker for as long as it lives, also beside other stages of the pipeline."""
    cache = packing.WordIds(VOCABULARY, "<u2")
    words = [f"{'xyz'[i % 3]}{i:o}".translate(str.maketrans("01234567", "aeioubdg")).encode() for i in range(30_000)]
    assert len(set(words)) == len(words)
    arrow = pa.total_allocated_bytes()
    tracemalloc.start()
    cache.encoded([words])
    kept = tracemalloc.get_traced_memory()[0] + pa.total_allocated_bytes() - arrow
    tracemalloc.stop()
    assert kept < 100 * len(words)


def test_parts_of_texts_become_ids(spark, monkeypatch):
    """White space is that of ASCII alone, and no text is left out where parts end."""
    monkeypatch.setattr(packing, "_PART_BYTES", 40)
    texts = [None, "", " ", " a  b\t", "\x1cA\u00a0b\x0bc\x0cD\x85e", "x" * 100, "Äb.\r\nc", None, "a b", "\u3000a\u2028b."] * 3
    assert len(list(packing._parts(pa.array(texts).fill_null(""), 40))) > 5
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    got = {r.id: np.frombuffer(r.ids, "<u2").tolist() for r in packing.token_ids(docs, "doc_id", "text", VOCABULARY, "<u2", 1).collect()}
    tokenizer = Tokenizer.from_file(VOCABULARY)
    assert got == {i: tokenizer.encode(t or "", add_special_tokens=False).ids + [1] for i, t in enumerate(texts)}
    words = pa.array([["a"], ["b.", "c"], [], None, ["c", "a"]], pa.list_(pa.binary())).slice(1)
    cache = packing.WordIds(VOCABULARY, "<u2")
    assert [None if i is None else np.frombuffer(i, "<u2").tolist() for i in cache.encoded(words).to_pylist()] == [
        tokenizer.encode(t, add_special_tokens=False).ids for t in ("b. c", "", "", "c a")
    ]


def test_sequences_do_not_depend_on_files(spark):
    rows = [(i, cases.prose(i % 50, 20 + i % 37)) for i in range(150)] + [(7, "x"), (7, "x"), (None, "a b"), (3, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    options = {"window": 256, "shard_docs": 16, "bucket_docs": 40}
    one, many = (
        Counter(tuple(r) for r in packing.pack_documents(d, VOCABULARY, **options).collect())
        for d in (docs.coalesce(1), docs.repartition(11))
    )
    assert one == many


def test_what_is_near_comes_to_one_shard(spark):
    """Documents of a subject fill windows together, whatever order they come in."""
    rng = np.random.default_rng(3)
    subjects = [[f"{a}{b}ology" for b in "klmnprst"] for a in ("ba", "ce", "di", "fo", "gu", "ha")]
    rows = []
    for i in range(240):
        subject = subjects[i % 6]
        rows.append((i, " ".join(["the of and to"] + [str(rng.choice(subject)) for _ in range(30)])))
    rng.shuffle(rows)
    docs = spark.createDataFrame([(int(i), t) for i, t in rows], "doc_id long, text string").repartition(5)
    pieces = packing.pack_documents(docs, VOCABULARY, window=1024, shard_docs=40, bucket_docs=60).collect()
    together, alike = 0, 0
    sequences = defaultdict(list)
    for p in pieces:
        sequences[p.sequence_id].append(p.id)
    for ids in sequences.values():
        for a, b in zip(ids, ids[1:]):
            together, alike = together + 1, alike + (a % 6 == b % 6)
    assert alike > 0.8 * together  # a sixth by chance


def test_buckets_hold_what_their_tokens_lead():
    led = np.array([0, 3, 3, 9, 0, 25, 1, 1, 8, 2])
    first, parts = packing._buckets(led, 10)
    assert parts.tolist() == [1, 1, 1, 1, 1, 3, 1, 1, 1, 1]
    held = defaultdict(int)
    for token, n in enumerate(led):
        for part in range(parts[token]):
            held[first[token] + part] += n / parts[token]
    assert max(held.values()) <= 10 and sorted(held) == list(range(len(held)))


def test_bm25_scores_and_order():
    docs = [np.array(d) for d in ([5, 6, 7], [1, 2, 2], [5, 6, 9, 9], [2, 8])]
    n = len(docs)
    frequency = np.bincount(np.concatenate([np.unique(d) for d in docs]), minlength=10)
    idf = np.log1p((n - frequency + 0.5) / (frequency + 0.5))
    mean = np.mean([len(d) for d in docs])
    shard = packing.Shard(docs, idf, mean)
    for seed, body in enumerate(docs):
        for other, score in enumerate(shard.scores(seed)):
            tf = Counter(docs[other].tolist())
            want = sum(
                idf[t] * tf[t] * 2.2 / (tf[t] + 1.2 * (0.25 + 0.75 * len(docs[other]) / mean)) for t in set(body.tolist())
            )
            assert score == pytest.approx(want)
    # The first document seeds, what it has most in common with follows.
    assert shard.order([3, 3, 4, 2], 7, 7) == [0, 2, 1, 3]


def test_kept_text_is_hashed_as_utf8(spark):
    got = line_dedup.dedup_lines(cases.messy(spark)).where("doc_id = 9")
    row = got.select("text", F.sha2(F.col("text").cast("binary"), 256).alias("h")).first()
    assert row.h == hashlib.sha256(row.text.encode()).hexdigest()

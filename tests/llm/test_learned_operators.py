"""Classifiers by held-out accuracy, neighbours by recall, and the pipeline stage by stage."""

import math
import os
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

import corpus_pipeline
from lumagrid.llm import nn_descent, quality_rules, registry, toxicity
from lumagrid.settings import checkpoint_dir
from tests.llm import cases

SF = "/root/testdata/sf0.01"
LABELLED = "/root/testdata/sf0.1"  # some hundred toxic documents


def auc(rows):
    ones, zeros = ([s for s, y in rows if y == v] for v in (1, 0))
    wins = sum((a > b) + (a == b) / 2 for a in ones for b in zeros)
    return wins / (len(ones) * len(zeros))


def edits_apart(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def statistics_plainly(text):
    """The statistics of quality_rules, one by one."""
    raw = (text or "").encode()
    words = re.findall(rb"[^\x20\x09-\x0D]+", raw)
    if not words:
        return [0.0] * len(quality_rules.STATISTICS)
    n, sizes = len(words), [len(w) for w in words]
    lines = [line for line in raw.split(b"\n") if re.search(rb"[^\x20\x09-\x0D]", line)]
    share = lambda some: sum(b in some for b in raw) / len(raw)
    mean = sum(sizes) / n
    heads = [re.search(rb"[^\x20\x09-\x0D]", line)[0] for line in lines]
    return [
        math.log(1 + n), mean, math.sqrt(sum((s - mean) ** 2 for s in sizes) / n),
        sum(s <= 3 for s in sizes) / n, sum(s >= 14 for s in sizes) / n, len(set(words)) / n,
        sum(a == b for a, b in zip(words, words[1:])) / n,
        share(range(65, 91)), sum(w.isupper() for w in words) / n, share(range(48, 58)),
        share(b"#$%&*@^~+_=\\"), raw.count(b"!") / n, raw.count(b"|") / n,
        sum(len(re.findall(p, raw)) for p in (rb"\. ", rb"\.\n", rb", ")) / n,
        share(b"{}[]()<>:;/\"'`"), share(range(128, 256)), n / len(lines),
        len(set(lines)) / len(lines), sum(65 <= h[0] <= 90 for h in heads) / len(lines),
    ]


def test_statistics_by_hand(spark):
    texts = [None, "", " \n", "One. Two, three!\nAND 12 | {x} ünï\n\none\none", cases.prose(3, 200), "a a a\tA\r\nB.\n"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    got = [r[0] for r in df.select(quality_rules.statistics(F.col("text"))).collect()]
    for text, values in zip(texts, got):
        assert values == pytest.approx(statistics_plainly(text), abs=1e-12), text


def test_rules_are_the_paths_of_trees(spark):
    """Of a tree's rules those hold for a row that are beginnings of its own path, and no others."""
    rng = np.random.default_rng(2)
    rows = [([float(v) for v in rng.normal(0, 1, 4)],) for _ in range(300)]
    rows = [(v, float(v[0] + v[1] * v[2] > 0.2)) for (v,) in rows]
    df = spark.createDataFrame(rows, "values array<double>, label double")
    vectors = df.select(array_to_vector("values").alias("features"), "label")
    forest = RandomForestClassifier(numTrees=3, maxDepth=3, seed=5).fit(vectors)
    holds = lambda rule, x: all((x[i] <= v) == at_most for i, at_most, v in rule)
    for tree in forest.trees:
        rules = quality_rules.tree_rules(tree._java_obj.rootNode())
        for x, _ in rows[:60]:
            node, path = tree._java_obj.rootNode(), []
            while node.subtreeDepth():
                split = node.split()
                left = x[split.featureIndex()] <= split.threshold()
                path.append((split.featureIndex(), left, split.threshold()))
                node = node.leftChild() if left else node.rightChild()
            held = [r for r in rules if holds(r, x)]
            assert len(held) == len(path)
            for rule in held:
                assert {(i, m) for i, m, _ in rule} <= {(i, m) for i, m, _ in path}


def scores_plainly(model, values):
    total = model.intercept
    for rule, weight in zip(model.rules, model.weights):
        total += weight * all((values[i] <= v) == at_most for i, at_most, v in rule)
    return 1 / (1 + math.exp(-total))


def test_quality_query_by_hand(spark):
    """Every score of the query from the model's rules over the plain statistics."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = quality_rules.train_quality(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    got = {r.doc_id: (r.held_out, r.score, r.predicted) for r in registry.op2_quality_rules(spark, SF).collect()}
    for r in docs.collect():
        score = scores_plainly(model, statistics_plainly(r.text))
        held, found, predicted = got[r.doc_id]
        assert held == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert found == pytest.approx(score, abs=1e-9) and predicted == (found >= 0.3)


def toxic_features_plainly(lexicon, text):
    """Features of a text by edit distances to all terms."""
    text = (text or "").lower()
    spans = [(m.group(), *m.span()) for m in re.finditer(r"\w+", text)]
    if not spans:
        return [0.0] * 8
    terms, prefixes, found = lexicon.words, dict(lexicon.prefixes), {}
    for word in {w for w, _, _ in spans}:
        near = [
            (d, -weight, t)
            for t, weight in terms
            if abs(len(t) - len(word)) <= toxicity.allowed_errors(len(t))
            and (d := edits_apart(word, t)) <= toxicity.allowed_errors(len(t))
        ]
        hit = (-min(near)[1], min(near)[0] > 0) if near else None
        starts = [w for p, w in prefixes.items() if word.startswith(p)]
        if starts and (hit is None or hit[1] or max(starts) > hit[0]):
            hit = (max(starts), False)
        if hit:
            found[word] = hit
    direct, quoted, addressed, n = {}, {}, 0, 0
    for i, (word, a, b) in enumerate(spans):
        if word in found:
            n += 1
            before, after = spans[max(0, i - 6) : i], spans[i + 1 : i + 7]
            near = {w for w, _, _ in before + after}
            left = text[before[0][1] if before else a : a]
            right = text[b : after[-1][2] if after else b]
            marks = set(left) & set(toxicity.QUOTE_MARKS) and set(right) & set(toxicity.QUOTE_MARKS)
            (quoted if marks or near & toxicity.REPORTING else direct)[word] = found[word][0]
            addressed += bool(near & toxicity.ADDRESSING)
    log = math.log1p
    return [
        log(sum(direct.values())), log(sum(quoted.values())), max([0.0, *(w for w, _ in found.values())]),
        log(100 * n / len(spans)), log(sum(m for _, m in found.values())), log(addressed), log(len(found)), log(len(spans)),
    ]


def test_toxicity_query_by_hand(spark):
    """Every score of the query for some hundred documents by plain edit distances and contexts."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = toxicity.train_toxicity(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    if not model.lexicon.words:
        words = [(w, 1.5) for w in ("worthless", "idiot", "stupid", "terrible")]
        model = toxicity.ToxicityModel(toxicity.Lexicon(tuple(words), (("thet", 2.0),)), (0.5,) * 8, -2.0)
    some = docs.where("length(text) < 1500").limit(150).collect()
    scored = {r.doc_id: (r.score, r["values"]) for r in toxicity.score_toxicity(docs, model).collect()}
    for r in some:
        values = toxic_features_plainly(model.lexicon, r.text)
        score, got = scored[r.doc_id]
        assert got == pytest.approx(values, abs=1e-9), r.doc_id
        total = model.intercept + sum(w * v for w, v in zip(model.weights, values))
        assert score == pytest.approx(1 / (1 + math.exp(-total)), abs=1e-9)


def test_letters_never_rule_out_a_term():
    rng = random.Random(8)
    terms = [("".join(rng.choice("abcdeéü") for _ in range(rng.randrange(3, 12))), rng.random()) for _ in range(60)]
    terms = list(dict(terms).items())
    matcher = toxicity.Matcher(toxicity.Lexicon(tuple(terms), ()))
    words = {"".join(rng.choice("abcdeéü") for _ in range(rng.randrange(1, 12))) for _ in range(600)}
    for term, _ in terms:
        at = rng.randrange(len(term))
        words |= {term, term[:at] + "x" + term[at:], term[:at] + term[at + 1 :] or "a", term[:at] + "y" + term[at + 1 :]}
    for term, _ in [t for t in terms if len(t[0]) >= 9] * 12:
        for _ in range(2):
            at = rng.randrange(len(term) + 1)
            term = term[:at] + rng.choice(["", "x", "a"]) + term[at + rng.choice((0, 1, 1)) :]
        words.add(term)
    found = matcher.find(words)
    for word in words:
        near = [
            (edits_apart(word, t), -w, t) for t, w in terms if edits_apart(word, t) <= toxicity.allowed_errors(len(t))
        ]
        best = min(near, default=None)
        assert found.get(word) == (None if best is None else (-best[1], best[0] > 0)), word
    # What was forgotten is found again, and what is remembered stays the same.
    for _ in range(3):
        matcher.older, matcher.known = matcher.known, {}
        assert matcher.find(words) == found


@pytest.mark.parametrize(
    ("name", "label", "least"), [("op2_quality_rules", "quality", 0.98), ("op7_toxicity", "toxic", 0.93)]
)
def test_held_out_scores(spark, name, label, least):
    got = registry.queries()[name](spark, LABELLED).cache()
    labels = spark.read.parquet(f"{LABELLED}/labels.parquet").where(F.col(label).isNotNull())
    assert got.count() == spark.read.parquet(f"{LABELLED}/documents.parquet").count()
    rows = got.join(labels, "doc_id").where("held_out").select("score", label).collect()
    assert auc([tuple(r) for r in rows]) >= least
    assert got.where("score < 0 or score > 1 or score is null").isEmpty()


def test_rules_are_the_statistics_bounds(spark):
    """The compiled column equals the rules taken one by one."""
    rng = random.Random(2)
    model = quality_rules.RuleModel(
        (((0, True, 0.5),), ((1, False, 0.2), (2, True, 0.7)), ((0, False, 0.1), (0, True, 0.3))), (1.5, -2.0, 0.7), 0.3
    )
    rows = [([rng.random() for _ in range(3)],) for _ in range(200)]
    got = spark.createDataFrame(rows, "v array<double>").select("v", model.score(F.col("v")).alias("s")).collect()
    for r in got:
        total = 0.3
        for rule, weight in zip(model.rules, model.weights, strict=True):
            total += weight * all((r.v[i] <= b) if at_most else (r.v[i] > b) for i, at_most, b in rule)
        assert r.s == pytest.approx(1 / (1 + math.exp(-total)))


def test_scores_of_odd_texts(spark):
    docs = cases.messy(spark)
    labels = spark.createDataFrame([(i, i % 2, i % 3 == 0) for i in range(1, 8)], "doc_id long, quality int, toxic boolean")
    labels = labels.withColumn("toxic", F.col("toxic").cast("int"))
    for none in (labels.limit(0), labels.where("quality = 1"), labels):
        quality = quality_rules.train_quality(docs, none)
        scores = quality_rules.score_quality(docs, quality)
        assert Counter(r.doc_id for r in scores.collect()) == Counter(r.doc_id for r in docs.collect())
        assert scores.where("score is null or score < 0 or score > 1").isEmpty()
    assert quality_rules.keep_quality(docs, quality_rules.fit_rules(spark.createDataFrame([], "values array<double>, label int"))).count() == docs.count()
    model = toxicity.train_toxicity(docs, labels)
    scores = toxicity.score_toxicity(docs, model)
    assert scores.count() == docs.count()
    assert scores.where("score is null or score < 0 or score > 1").isEmpty()
    assert toxicity.score_toxicity(cases.empty(spark), model).count() == 0


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def test_automata_find_what_is_within_the_allowed_edits():
    rng = random.Random(8)
    letters = "abcd"
    terms = [("".join(rng.choice(letters) for _ in range(rng.randrange(3, 13))), rng.random()) for _ in range(60)]
    terms = list(dict(terms).items())
    tries = toxicity.Tries(terms)
    for _ in range(600):
        word = list(rng.choice(terms)[0])
        for _ in range(rng.randrange(4)):
            at = rng.randrange(len(word) + 1)
            word[at : at + rng.randrange(2)] = rng.choice(["", rng.choice(letters)])
        word = "".join(word)
        near = [(d, -w, t) for t, w in terms if (d := distance(word, t)) <= toxicity.allowed_errors(len(t))]
        got = tries.search(word)
        want = min(near, default=None)
        assert got == (None if want is None else (want[2], -want[1], want[0]))


def test_quotation_is_told_from_abuse():
    matcher = toxicity.Matcher(toxicity.Lexicon((("idiot", 4.0),), ()))
    at = dict(zip(toxicity.FEATURES, range(8), strict=True))
    plain = matcher.features("you are such an Idiot, go away now")
    quoted = matcher.features('the critic called the play "an idiot at work" in print')
    reported = matcher.features("the old word idiot once had other uses")
    wrong = matcher.features("what an idiiot")
    assert plain[at["direct"]] > 0 and plain[at["quoted"]] == 0 and plain[at["addressed"]] > 0
    assert quoted[at["direct"]] == 0 and quoted[at["quoted"]] > 0
    assert reported[at["direct"]] == 0 and reported[at["quoted"]] > 0
    assert wrong[at["misspelled"]] > 0
    assert matcher.features(None) == matcher.features(" \n") == [0.0] * 8


# --- neighbours -------------------------------------------------------------------------


def nearest_plainly(rows, k=10):
    usable = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v) and len(v) == 8:
            usable[i] = np.array(v)
    ids = sorted(usable)
    matrix = np.stack([usable[i] for i in ids])
    found = {}
    for q in ids:
        if q % 10 == 0:
            d = np.sqrt(((matrix - usable[q]) ** 2).sum(axis=1))
            order = [j for j in np.lexsort((ids, d)) if ids[j] != q][:k]
            found[q] = [(ids[j], d[j]) for j in order]
    return found


def test_neighbours(spark):
    rng = np.random.default_rng(3)
    centers = rng.standard_normal((6, 8)) * 3
    rows = [(i, (centers[i % 6] + rng.standard_normal(8)).tolist()) for i in range(900)]
    rows += [(1000 + i, rows[5][1]) for i in range(300)]  # a third is one vector
    odd = [
        (2000, None), (2001, []), (2002, [0.0] * 8), (2003, [1.0] * 7 + [None]), (2004, [1.0] * 7 + [math.inf]),
        (2005, [1.0] * 7 + [math.nan]), (2006, [1.0] * 9), (None, [1.0] * 8), (2010, [-0.0] * 8), rows[0], rows[10],
    ]
    df = spark.createDataFrame(
        [(i, v, 1, 2, 3.0) for i, v in rows + odd], "vec_id long, embedding array<double>, id int, node int, d double"
    ).repartition(5)
    got = nn_descent.nearest_neighbours(df, F.col("id") % 10 == 0).collect()
    want = nearest_plainly(rows + odd)
    by_query = {}
    for r in got:
        by_query.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    assert set(by_query) == set(want)
    hits = 0
    for q, ranks in by_query.items():
        assert sorted(ranks) == list(range(1, 11))
        exact = dict(want[q])
        for vec, score in ranks.values():
            if vec in exact:
                assert score == pytest.approx(exact[vec], abs=1e-12)
                hits += 1
    assert hits / (10 * len(want)) >= 0.95
    copies = by_query[1000]
    assert [copies[i] for i in range(1, 11)] == [(5, 0.0), *((1000 + i, 0.0) for i in range(1, 10))]


def test_recall_at_the_shipped_parameters(spark):
    """The given embeddings, each also with noise, by exact search."""
    rows = [
        (r.vec_id, np.array(r.embedding, np.float64))
        for r in spark.read.parquet(f"{LABELLED}/embeddings.parquet").select("vec_id", "embedding").collect()
    ]
    rng = np.random.default_rng(1)
    rows += [(10_000 + i, v + rng.normal(0, 0.05, len(v))) for i, v in rows]
    df = spark.createDataFrame([(int(i), v.tolist()) for i, v in rows], "vec_id long, embedding array<double>")
    got = {}
    for r in nn_descent.nearest_neighbours(df, F.col("id") % 100 == 0).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    ids, matrix = np.array([i for i, _ in rows]), np.stack([v for _, v in rows])
    hits = 0
    for q in got:
        apart = ((matrix - matrix[ids == q][0]) ** 2).sum(axis=1)
        apart[ids == q] = np.inf
        hits += len(got[q] & set(ids[np.argsort(apart)[:10]].tolist()))
    assert set(got) == {i for i, _ in rows if i % 100 == 0}
    assert hits / (10 * len(got)) >= 0.97


def test_search_leaves_no_rounds_behind(spark):
    folder = checkpoint_dir(spark).removeprefix("file:")
    tables = lambda: {d for d in os.listdir(folder) if len(d) == 32}
    points = np.random.default_rng(5).standard_normal((600, 6))
    df = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], "vec_id long, embedding array<double>")
    before = tables()
    found = nn_descent.nearest_neighbours(df, F.col("id") % 50 == 0)
    assert len(tables() - before) <= 6
    assert found.count() == 120


def test_vectors_of_each_length_have_their_own_neighbours(spark):
    rows = [(0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [4.0]), (3, [5.0]), (4, [9.0, 1.0]), (5, [1.0] * 3)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = {(r.query_id, r.rank): r.vec_id for r in nn_descent.nearest_neighbours(df, F.col("id") < 6).collect()}
    assert got == {(0, 1): 1, (0, 2): 4, (1, 1): 0, (1, 2): 4, (2, 1): 3, (3, 1): 2, (4, 1): 1, (4, 2): 0}


def test_few_or_no_neighbours(spark):
    schema = "vec_id long, embedding array<float>"
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [4.0, 0.0])], schema)
    got = nn_descent.nearest_neighbours(few, F.col("id") == 0).orderBy("rank").collect()
    assert [(r.rank, r.vec_id, r.score) for r in got] == [(1, 1, 1.0), (2, 2, 3.0)]
    for n in (0, 1):
        assert nn_descent.nearest_neighbours(few.limit(n), F.col("id") == 0).count() == 0


# --- pipeline ---------------------------------------------------------------------------


def test_pipeline_stands_messy_and_empty_tables(spark, tmp_path):
    """All stages over nulls, blanks, repeated rows, a very long text and further columns, and over nothing."""
    plain = [(100 + i, cases.prose(i, 40 + i)) for i in range(60)]
    docs = cases.messy(spark, [*plain, (200, cases.prose(5, 45) + " tail"), (12, None), (12, "x")])
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(100, 160)] + [(None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")
    bench = spark.createDataFrame([(1, cases.prose(7, 30)), (2, None), (None, "a b")], "item_id long, text string")
    for name, table in (("full", docs), ("none", docs.limit(0))):
        folder = f"{tmp_path}/{name}"
        table.write.parquet(f"{folder}/documents.parquet")
        labels.write.parquet(f"{folder}/labels.parquet")
        bench.write.parquet(f"{folder}/benchmark.parquet")
        rows = spark.read.parquet(f"{folder}/documents.parquet")
        for _, stage in corpus_pipeline.STAGES[:-1]:
            left = stage(spark, rows, folder)
            assert left.columns == docs.columns
            rows = left.cache()
        kept = rows.count()
        packed = corpus_pipeline.run(spark, folder)
        assert packed.where("start = 0").count() == kept
        if name == "none":
            assert kept == 0
        else:
            assert kept > 40 and rows.where("text is null").count() <= 3
            # The one line of document 2 is in document 1, so its rows are empty and stay.
            assert [r.text for r in rows.where("doc_id = 2").collect()] == ["", ""]


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, ids = docs.columns, {r.doc_id for r in docs.select("doc_id").collect()}
    counts = [len(ids)]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF).cache()
        assert docs.columns == columns, name
        left = {r.doc_id for r in docs.select("doc_id").collect()}
        assert left <= ids and docs.count() == len(left)
        ids = left
        counts.append(len(ids))
    # Documents go in all stages but line dedup.
    assert counts[0] > counts[1] == counts[2] > counts[3] > counts[4] > 0.6 * counts[0]
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert {r.doc_id for r in last.select("doc_id").distinct().collect()} == ids
    whole = last.groupBy("doc_id").agg(F.sum(F.octet_length("ids") / 4).alias("n"), F.max("doc_tokens").alias("t"))
    assert whole.where("n != t").isEmpty()


@pytest.mark.parametrize("n", [2, 40, 300, 700])
def test_start_graph_has_all_nodes_at_many_partitions(spark, n):
    points = np.random.default_rng(n).standard_normal((n, 8))
    rows = [(i, p.tobytes()) for i, p in enumerate(points)]
    nodes = spark.createDataFrame(rows, "node long, vec binary").cache()
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    try:
        edges = nn_descent.build_graph(nodes, rounds=0).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    around = {}
    for e in edges:
        around.setdefault(e.u, set()).add(e.v)
    least = min(n - 1, nn_descent.NEIGHBOURS)
    assert set(around) == set(range(n)) and all(len(v) == least for v in around.values())
    if n < 2 * nn_descent._BLOCK:
        apart = ((points[:, None] - points) ** 2).sum(axis=2)
        np.fill_diagonal(apart, np.inf)
        for u, v in around.items():
            assert v == set(np.argsort(apart[u])[:least].tolist())

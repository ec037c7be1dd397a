"""Approximate nearest neighbours: NN-descent builds a graph, queries walk it greedily.

Neighbours of a node are likely neighbours of each other. Starting from blocks along random
directions, each round gathers the vectors of a node's neighbours (and of those it is a
neighbour of) and tells all of them about each other; every node keeps its nearest. A query
keeps a beam of the nearest nodes seen and asks for the neighbours of those that it has not
asked yet, until the beam holds no such node. Equal vectors are one node.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumagrid.operators.lookup import attach
from lumagrid.settings import store, stored_scope

NEIGHBOURS = 24
DIRECTIONS = 4
_BLOCK = 256  # nodes that are compared with each other along a direction
ROUNDS = 6
SETTLED = 0.01  # share of new edges below which the graph is done
BEAM = 256
_ASKED = 48  # nodes of a beam that are asked in one step
_STEPS = 24
ENTRIES = 32


def _matrix(column: pa.Array) -> np.ndarray:
    """A row of doubles for each (equally long) binary value."""
    values = column.to_pylist()
    return np.frombuffer(b"".join(values), np.float64).reshape(len(values), -1)


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """``(id, vec)``: different rows that take part, the vector as bytes of doubles."""

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64) + 0.0
            ends = np.cumsum(np.nan_to_num(lists.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64))
            parts = np.split(flat, ends)[: len(lists)]
            kept = [bool(len(p) and np.isfinite(p).all() and p.any()) for p in parts]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).filter(pa.array(kept, pa.bool_())),
                    pa.array([p.tobytes() for p, k in zip(parts, kept, strict=True) if k], pa.binary()),
                ],
                names=["id", "vec"],
            )

    named = vectors.where(F.col(key).isNotNull() & F.col(vector).isNotNull())
    named = named.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vec"))
    found, _ = store(named.mapInArrow(convert, "id long, vec binary"))
    return found


def distinct_nodes(found: DataFrame, kept_ids: int) -> tuple[DataFrame, int]:
    """``(node, vec, ids)``: different vectors, each with the smallest ids that have it."""
    by_vector = Window.partitionBy("digest").orderBy("id")
    first = found.withColumn("digest", F.md5("vec")).dropDuplicates(["digest", "id"])
    first = first.withColumn("place", F.row_number().over(by_vector)).where(F.col("place") <= kept_ids)
    nodes = first.groupBy("digest").agg(
        F.first("vec").alias("vec"), F.sort_array(F.collect_list("id")).alias("ids")
    )
    nodes, n = store(nodes.drop("digest"))
    # The stored rows lie still, so their numbers do too.
    return store(nodes.select(F.monotonically_increasing_id().alias("node"), "vec", "ids"))[0], n


def nearest_edges(edges: DataFrame, k: int) -> DataFrame:
    """Of the edges ``(u, v, d, new)`` the ``k`` shortest of every ``u``; one that was there is not new."""
    once = edges.groupBy("u", "v").agg(F.min("d").alias("d"), F.min("new").alias("new"))
    by_node = Window.partitionBy("u").orderBy("d", "v")
    return once.withColumn("place", F.row_number().over(by_node)).where(F.col("place") <= k).drop("place")


def _block_edges(nodes: DataFrame, direction: int, k: int, n_nodes: int) -> DataFrame:
    """Edges between nodes that lie close to each other along one random direction.

    What is left of a partition after its blocks belongs to the last of them, and there are no more
    partitions than blocks, so no node is alone.
    """

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                rows = _matrix(batch.column(1))
                along = rows @ np.random.default_rng(direction).standard_normal(rows.shape[1])
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(along)], names=["node", "vec", "along"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[pa.RecordBatch] = []
        for batch in batches:
            table = pa.Table.from_batches([*rest, batch]).combine_chunks()
            start = 0
            while len(table) - start >= 2 * _BLOCK:
                yield near_each_other(table.slice(start, _BLOCK))
                start += _BLOCK
            rest = table.slice(start).to_batches()
        if any(len(r) for r in rest):
            yield near_each_other(pa.Table.from_batches(rest))

    def near_each_other(block: pa.Table) -> pa.RecordBatch:
        at, own = block.column(0).to_numpy(), _matrix(block.column(1))
        square = (own * own).sum(axis=1)
        apart = np.maximum(square[:, None] + square - 2 * own @ own.T, 0)
        np.fill_diagonal(apart, np.inf)
        near = np.argsort(apart, axis=1, kind="stable")[:, : min(k, len(at) - 1)]
        return _edges(np.repeat(at, near.shape[1]), at[near.ravel()], np.take_along_axis(apart, near, 1).ravel())

    parts = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(1, min(parts, n_nodes // _BLOCK))
    along = nodes.select("node", "vec").mapInArrow(project, "node long, vec binary, along double")
    laid = along.repartitionByRange(parts, "along", "node").sortWithinPartitions("along", "node")
    return laid.mapInArrow(compare, "u long, v long, d double").withColumn("new", F.lit(True))


def _edges(u: np.ndarray, v: np.ndarray, d: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(u, pa.int64()), pa.array(v, pa.int64()), pa.array(d, pa.float64())], names=["u", "v", "d"]
    )


def _local_join(members: DataFrame) -> DataFrame:
    """All nodes around a node ``w`` hear of each other; what helps neither end is left out."""

    def introduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            table = pa.Table.from_batches([batch] if rest is None else [*rest, batch])
            w = table.column("w").to_numpy()
            if not len(w):
                continue
            cuts = np.flatnonzero(np.diff(w)) + 1
            last = int(cuts[-1]) if len(cuts) else 0
            rest = table.slice(last).to_batches()
            yield from joined(table.slice(0, last), cuts)
        if rest is not None:
            table = pa.Table.from_batches(rest)
            yield from joined(table, np.array([len(table)]))

    def joined(table: pa.Table, cuts: np.ndarray) -> Iterator[pa.RecordBatch]:
        if not len(table):
            return
        ids, new, worst = (table.column(c).to_numpy() for c in ("v", "new", "worst"))
        rows, found = _matrix(table.column("vec")), []
        for start, end in zip(np.append(0, cuts[:-1]), cuts, strict=True):
            part = slice(start, end)
            own, fresh = rows[part], new[part]
            square = (own * own).sum(axis=1)
            apart = np.maximum(square[:, None] + square - 2 * own @ own.T, 0)
            useful = (fresh[:, None] | fresh) & (apart < worst[part][:, None]) & (ids[part][:, None] != ids[part])
            a, b = np.nonzero(useful)
            found.append((ids[part][a], ids[part][b], apart[a, b]))
        yield _edges(*(np.concatenate(c) for c in zip(*found, strict=True)))

    dealt = members.select("w", "v", "new", "worst", "vec").repartition("w").sortWithinPartitions("w")
    return dealt.mapInArrow(introduce, "u long, v long, d double").withColumn("new", F.lit(True))


def build_graph(nodes: DataFrame, k: int = NEIGHBOURS, rounds: int = ROUNDS) -> DataFrame:
    """``(u, v, d, new)``: for each node edges to about its ``k`` nearest, ``d`` the squared distance."""
    with stored_scope(nodes.sparkSession):
        n_nodes = nodes.count()
        edges = _block_edges(nodes, 0, k, n_nodes)
        for direction in range(1, DIRECTIONS):
            edges = edges.unionByName(_block_edges(nodes, direction, k, n_nodes))
        graph, n_edges = store(nearest_edges(edges, k))
        row_bytes = _row_bytes(nodes)
        for turn in range(rounds):
            fresh = graph.where("new").count()
            if fresh <= SETTLED * n_edges:
                break
            # Of those that have a node as neighbour, as many again take part, drawn anew each round.
            drawn = Window.partitionBy("v").orderBy(F.xxhash64("u", "v", F.lit(turn)), "u")
            back = graph.withColumn("place", F.row_number().over(drawn)).where(F.col("place") <= k)
            around = graph.select(F.col("u").alias("w"), "v", "new").unionByName(
                back.select(F.col("v").alias("w"), F.col("u").alias("v"), "new")
            )
            around = around.groupBy("w", "v").agg(F.max("new").alias("new"))
            worst = graph.groupBy("u").agg(
                F.when(F.count(F.lit(1)) < k, float("inf")).otherwise(F.max("d")).alias("worst")
            )
            known, n_known = store(
                nodes.select(F.col("node").alias("v"), "vec").join(worst.withColumnRenamed("u", "v"), "v")
            )
            members = attach(around, known, ["v"], row_bytes=row_bytes, n_rows=n_known)
            old = graph.withColumn("new", F.lit(False))
            graph, n_edges = store(nearest_edges(old.unionByName(_local_join(members)), k))
        return store(graph, outlives=True)[0]


def _row_bytes(nodes: DataFrame) -> int:
    return (nodes.agg(F.max(F.octet_length("vec"))).first()[0] or 0) + 64


def _distances(pairs: DataFrame) -> DataFrame:
    """``pairs`` with the Euclidean distance ``d`` of ``qvec`` and ``vec`` instead of ``vec``."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                apart = _matrix(batch.column("qvec")) - _matrix(batch.column("vec"))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("query"), batch.column("node"), pa.array(np.sqrt((apart * apart).sum(axis=1)))],
                    names=["query", "node", "d"],
                )

    return pairs.select("query", "node", "qvec", "vec").mapInArrow(measure, "query long, node long, d double")


def search_graph(queries: DataFrame, nodes: DataFrame, graph: DataFrame, beam: int = BEAM) -> DataFrame:
    """``(query, node, d)``: the beam of each of the ``queries`` ``(query, qvec, start)`` at its end.

    ``start`` is a node to begin at, or null; every query also begins at a few fixed nodes.
    """
    with stored_scope(nodes.sparkSession):
        queries, n_queries = store(queries)
        row_bytes = _row_bytes(nodes)
        entries = nodes.orderBy(F.xxhash64("node"), "node").limit(ENTRIES).select("node")
        begun = queries.select("query", F.explode(F.lit(None).cast("array<long>")).alias("node"))
        entry_list = [r.node for r in entries.collect()]
        if entry_list:
            begun = queries.select("query", F.explode(F.array(*[F.lit(e) for e in entry_list])).alias("node"))
        begun = begun.unionByName(
            queries.where(F.col("start").isNotNull()).select("query", F.col("start").alias("node"))
        ).distinct()
        vectors = nodes.select("node", "vec")
        around = graph.select(F.col("u").alias("node"), F.col("v").alias("next"))
        by_query = Window.partitionBy("query").orderBy("d", "node")

        def measured(pairs: DataFrame) -> DataFrame:
            # Pairs come to the vectors of nodes, which stay where they are while the pairs are few.
            pairs, n_pairs = store(pairs)
            both = attach(vectors, pairs, ["node"], row_bytes=32, n_rows=n_pairs)
            return _distances(
                attach(both, queries.select("query", "qvec"), ["query"], row_bytes=row_bytes, n_rows=n_queries)
            )

        seen = measured(begun).withColumn("asked", F.lit(False))
        for _ in range(_STEPS):
            held = seen.withColumn("place", F.row_number().over(by_query)).where(F.col("place") <= beam)
            waiting = Window.partitionBy("query", "asked").orderBy("d", "node")
            held = held.withColumn("turn", F.row_number().over(waiting))
            held = held.withColumn("ask", ~F.col("asked") & (F.col("turn") <= _ASKED))
            held, _ = store(held.select("query", "node", "d", "asked", "ask"))
            asking, n_asking = store(held.where("ask").select("query", "node"))
            if not n_asking:
                break
            told = attach(around, asking, ["node"], row_bytes=32, n_rows=n_asking)
            told = told.select("query", F.col("next").alias("node"))
            # A node that left the beam may come back, but is not better than before.
            fresh = told.distinct().join(held.select("query", "node"), ["query", "node"], "left_anti")
            seen = held.select("query", "node", "d", (F.col("asked") | F.col("ask")).alias("asked")).unionByName(
                measured(fresh).withColumn("asked", F.lit(False))
            )
        return store(held.select("query", "node", "d"), outlives=True)[0]


def nearest_neighbours(
    vectors: DataFrame,
    queries: Column,
    key: str = "vec_id",
    vector: str = "embedding",
    k: int = 10,
    neighbours: int = NEIGHBOURS,
    beam: int = BEAM,
) -> DataFrame:
    """``(query_id, rank, key, score)``: up to ``k`` nearest rows of each row where ``queries`` holds.

    ``queries`` is a condition on ``id``. The score is the Euclidean distance in double precision,
    the smallest first, ties by the smaller id; a row is not its own neighbour. All rows are
    in the graph. Which neighbours are found is approximate, what is returned of them exact.

    Rows with a null id, and vectors that are null, empty, zero or hold nulls or values that
    are not finite take no part. Vectors of different lengths have no distance: each length is
    searched by itself, one after the other. Equal rows count once; an id with several vectors has each of them. Other columns are not read; with
    fewer than ``k`` others all of them are returned; an empty table gives an empty result.
    """
    found = usable(vectors, key, vector)
    asked = found.where(queries).select("id", "vec", F.octet_length("vec").alias("size")).distinct()
    asked, _ = store(asked)
    sizes = sorted(r["size"] for r in asked.select("size").distinct().collect())
    parts = [
        _nearest(
            found.where(F.octet_length("vec") == size), asked.where(F.col("size") == size), key, k, neighbours, beam
        )
        for size in sizes
    ]
    if not parts:
        none = vectors.sparkSession.createDataFrame([], f"query_id long, rank int, {key} long, score double")
        return none
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def _nearest(found: DataFrame, asked: DataFrame, key: str, k: int, neighbours: int, beam: int) -> DataFrame:
    """``nearest_neighbours`` of the rows ``asked`` among all rows ``found``, vectors of one length."""
    nodes, _ = distinct_nodes(found, k + 1)
    graph = build_graph(nodes, neighbours)
    # A query row is in the graph itself: its walk begins there.
    asked = asked.select("id", "vec", F.md5("vec").alias("digest"))
    places = nodes.select(F.md5("vec").alias("digest"), "node")
    asked = asked.join(places, "digest")
    starts = asked.groupBy("node").agg(F.first("vec").alias("qvec"))
    walks = starts.select(F.col("node").alias("query"), "qvec", F.col("node").alias("start"))
    ends = search_graph(walks, nodes, graph, beam)
    rows = ends.join(nodes.select("node", "ids"), "node").select("query", "d", F.explode("ids").alias(key))
    pairs = asked.select(F.col("id").alias("query_id"), F.col("node").alias("query")).join(rows, "query")
    pairs = pairs.where(F.col("query_id") != F.col(key))
    order = Window.partitionBy("query_id", "query").orderBy("d", key)
    ranked = pairs.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), key, F.col("d").alias("score"))

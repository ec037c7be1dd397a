"""K-means over one-dimensional luminance histograms, for all images at once.

A model is one row per image: its cluster centres as an ascending array of at
most ``k`` numbers. A value belongs to the nearest centre; at equal distance,
to the lower one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumagrid.operators.lookup import attach, interval_index
from lumagrid.operators.raster import IMAGE
from lumagrid.settings import store, stored_scope

# The number of clusters and iterations of the k-means curve.
K = 256
MAX_ITER = 1000

# A centre that moves no further than this has settled.
TOLERANCE = 1e-4

# An image with at most this many levels sends all of them to the task that fits it.
LOCAL_LEVELS = 1_000_000
# Levels in one block.
BLOCK_LEVELS = 4096

_PRIME = 2147483647


def model_bytes(k: int) -> int:
    """Upper bound of a model row that carries two arrays of k numbers."""
    return 16 * k + 64


def cluster_bounds(centers) -> Column:
    """Midpoints between neighbouring centres."""
    n = F.size(centers)
    return F.zip_with(
        F.slice(centers, F.lit(1), n - 1),
        F.slice(centers, F.lit(2), n - 1),
        lambda low, high: (low + high) / 2,
    )


def nearest_center(df: DataFrame, value: Column, centers: list[float], out: str = "cid") -> DataFrame:
    """Index of the nearest of a few fixed centres, which are sorted first."""
    ordered = sorted(centers)
    middles = [(low + high) / 2 for low, high in zip(ordered, ordered[1:])]
    bounds = F.array(*[F.lit(float(m)) for m in middles]).cast("array<double>")
    return interval_index(df, value, bounds, len(middles), out)


def most_centers(models: DataFrame) -> int:
    """The number of centres of the largest model."""
    return models.agg(F.max(F.size("centers"))).first()[0] or 1


def assign_clusters(
    hist: DataFrame, models: DataFrame, k: int | None = None, n_models: int | None = None
) -> DataFrame:
    """Histogram rows ``(image_id, lum, n_pixels)`` with the index of their cluster, ``cid``.

    ``k`` is the number of centres of the largest model, and ``n_models`` that of models if
    they are a stored table; both are looked up if they are not given.
    """
    if k is None:
        if n_models is None:
            models, n_models = store(models)
        k = most_centers(models)
    bounds = models.select(IMAGE, cluster_bounds("centers").alias("_bounds"))
    with_bounds = attach(hist, bounds, [IMAGE], row_bytes=model_bytes(k), n_rows=n_models)
    return interval_index(with_bounds, F.col("lum"), F.col("_bounds"), k - 1, "cid").drop("_bounds")


def cluster_sizes(assigned: DataFrame) -> DataFrame:
    """Levels and pixels per cluster."""
    return assigned.groupBy(IMAGE, "cid").agg(
        F.count(F.lit(1)).alias("n_levels"), F.sum("n_pixels").alias("n_pixels")
    )


def cluster_means(assigned: DataFrame, weighting: str = "squared") -> DataFrame:
    """Weighted mean level and number of pixels per cluster.

    ``squared`` weighs every pixel by the count of its level, so a level counts
    with its squared pixel number; ``count`` is the plain mean over pixels.
    """
    n = F.col("n_pixels").cast("double")
    if weighting not in ("squared", "count"):
        raise ValueError(f"unknown weighting: {weighting}")
    weight = n * n if weighting == "squared" else n
    return assigned.groupBy(IMAGE, "cid").agg(
        (F.sum(weight * F.col("lum")) / F.sum(weight)).alias("mean"),
        F.sum("n_pixels").alias("n_pixels"),
    )


def kmeans_fit(
    hist: DataFrame,
    k: int = K,
    max_iter: int = MAX_ITER,
    seed: int = 0,
    tolerance: float = TOLERANCE,
    local_levels: int = LOCAL_LEVELS,
) -> DataFrame:
    """Fit one model per image to ``(image_id, lum, n_pixels)``, one row per level.

    Starts from up to k levels drawn by arithmetic on their values, so a fit does not depend on how
    the rows are spread over partitions. Levels are sorted into blocks that know their sums, so
    a round looks at the k - 1 blocks in which clusters meet and adds up the others. A task
    fits an image from the sums of its blocks and from those blocks themselves that it needs:
    all, if the image has at most ``local_levels`` levels; else the ones that hold its bounds, and when a
    bound leaves them the image waits for a job that brings others.
    """
    spark = hist.sparkSession
    kind = dict(hist.dtypes)[IMAGE]
    with stored_scope(spark):
        blocks, _ = store(_level_blocks(hist, kind, k, seed))
        sizes, n_images = store(blocks.groupBy(IMAGE).agg(F.sum("n").alias("_levels")))
        nothing = [F.lit(None).cast("array<double>").alias("centers"), F.lit(0).alias("step")]
        sized = attach(blocks, sizes, [IMAGE], n_rows=n_images)
        whole = F.col("_levels") <= local_levels
        rows = sized.select(
            IMAGE, *_SUMS, *[F.when(whole, F.col(c)).alias(c) for c in ("lums", "weights")], *nothing
        )
        found = []
        while True:
            state, _ = store(_fitted(rows, kind, k, max_iter, tolerance), outlives=True)
            found.append(state.where("done").select(IMAGE, "centers"))
            waiting, n_waiting = store(state.where(~F.col("done")))
            if not n_waiting:
                break
            wanted = waiting.select(IMAGE, F.explode("needed").alias("first")).withColumn("_sent", F.lit(True))
            rest = blocks.join(waiting.select(IMAGE), IMAGE, "left_semi").join(wanted, [IMAGE, "first"], "left")
            sent = F.coalesce("_sent", F.lit(False))
            rows = rest.select(
                IMAGE, *_SUMS, *[F.when(sent, F.col(c)).alias(c) for c in ("lums", "weights")], *nothing
            ).unionByName(waiting.select(IMAGE, "centers", "step"), allowMissingColumns=True)
        models = found[0]
        for more in found[1:]:
            models = models.unionByName(more)
        return models


def _draw(level: Column, seed: int) -> Column:
    """A number that depends on a level and the seed only, by plain arithmetic."""
    start = F.pmod(F.floor(level * (1 << 20)).cast("bigint"), F.lit(_PRIME))
    mixed = F.pmod(start * 48271 + (seed * 7919 + 1) % _PRIME, F.lit(_PRIME))
    return F.pmod(mixed * mixed + mixed, F.lit(_PRIME))


_SUMS = ["first", "last", "n", "mass", "total", "draws", "drawn"]


def _level_blocks(hist: DataFrame, kind: str, k: int, seed: int) -> DataFrame:
    """Sorted levels of an image, some thousand a row, with their sums and the k that are drawn first."""

    def block(image, lum: np.ndarray, weight: np.ndarray, draw: np.ndarray) -> tuple:
        first = np.lexsort((lum, draw))[:k]
        return (
            image, lum[0], lum[-1], len(lum), weight.sum(), (weight * lum).sum(), draw[first].tobytes(),
            lum[first].tobytes(), lum.tobytes(), weight.tobytes(),
        )

    names = [IMAGE, *_SUMS, "lums", "weights"]
    schema = (
        f"{IMAGE} {kind}, first double, last double, n long, mass double, total double, draws binary, "
        "drawn binary, lums binary, weights binary"
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        image, held = None, [np.empty(0), np.empty(0), np.empty(0, np.int64)]
        for batch in batches:
            ids, rows = batch.column(0), []
            levels = [batch.column(c).to_numpy() for c in ("lum", "w", "draw")]
            bounds = pc.run_end_encode(ids).run_ends.to_numpy().tolist() if len(ids) else []
            for start, end in zip([0, *bounds], bounds):
                own = ids[start].as_py()
                if own != image and len(held[0]):
                    rows.append(block(image, *held))
                    held = [h[:0] for h in held]
                image = own
                held = [np.concatenate([h, v[start:end]]) for h, v in zip(held, levels)]
                while len(held[0]) > BLOCK_LEVELS:
                    rows.append(block(image, *(h[:BLOCK_LEVELS] for h in held)))
                    held = [h[BLOCK_LEVELS:] for h in held]
            if rows:
                yield _rows(rows, names, ids.type)
            last_type = ids.type
        if len(held[0]):
            yield _rows([block(image, *held)], names, last_type)

    levels = hist.select(
        IMAGE,
        F.col("lum").cast("double").alias("lum"),
        F.col("n_pixels").cast("double").alias("w"),
        _draw(F.col("lum").cast("double"), seed).alias("draw"),
    )
    return levels.repartitionByRange(IMAGE, "lum").sortWithinPartitions(IMAGE, "lum").mapInArrow(cut, schema)


def _rows(rows: list[tuple], names: list[str], image_type: pa.DataType) -> pa.RecordBatch:
    kinds = [image_type, *[pa.float64()] * 2, pa.int64(), *[pa.float64()] * 2, *[pa.binary()] * 4]
    columns = [pa.array(c, t) for c, t in zip(zip(*rows), kinds)]
    return pa.RecordBatch.from_arrays(columns, names=names)


class Levels:
    """The sorted levels of an image: sums of blocks, and the levels of some."""

    def __init__(self, table: pa.Table):
        self.first, self.last, self.mass, self.total = (
            table[c].to_numpy() for c in ("first", "last", "mass", "total")
        )
        self.lums = [None if v is None else np.frombuffer(v) for v in table["lums"].to_pylist()]
        weights = [None if v is None else np.frombuffer(v) for v in table["weights"].to_pylist()]
        if all(v is not None for v in self.lums):  # then one block will do
            self.lums, weights = [np.concatenate(self.lums)], [np.concatenate(weights)]
            self.first, self.last = self.first[:1], self.last[-1:]
        self.weights = weights
        self.products = [None if v is None else v * w for v, w in zip(self.lums, weights)]

    def bounds(self, middles: np.ndarray) -> tuple[list[tuple[int, int]], set[int]]:
        """Where clusters end, as a block and a place in it, and the blocks that were needed and lack."""
        blocks = np.searchsorted(self.first, middles, side="right") - 1
        found, lacking = [], set()
        for middle, at in zip(middles.tolist(), blocks.tolist()):
            if at < 0 or middle >= self.last[at]:
                found.append((at + 1, 0))
            elif self.lums[at] is None:
                lacking.add(at)
            else:
                found.append((at, int(np.searchsorted(self.lums[at], middle, side="right"))))
        return found, lacking

    def whole(self) -> bool:
        """Whether all levels are here, as one block."""
        return len(self.lums) == 1 and self.lums[0] is not None

    def whole_sums(self, middles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``sums`` between ``middles`` where all levels are here."""
        n = len(self.lums[0])
        at = np.append(0, np.searchsorted(self.lums[0], middles, side="right"))
        masses, totals = (np.add.reduceat(np.append(v[0], 0.0), at) for v in (self.weights, self.products))
        empty = np.diff(np.append(at, n)) == 0  # for which reduceat gives a level of another
        return np.where(empty, 0.0, masses), np.where(empty, 0.0, totals)

    def sums(self, bounds: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
        """Mass and weighted total of each cluster. Only its own levels enter, so nothing cancels out."""
        edges = [(0, 0), *bounds, (len(self.lums), 0)]
        masses, totals = np.zeros(len(edges) - 1), np.zeros(len(edges) - 1)
        for cluster, ((b0, o0), (b1, o1)) in enumerate(zip(edges, edges[1:])):
            for out, parts, whole in ((masses, self.weights, self.mass), (totals, self.products, self.total)):
                if b0 == b1:
                    out[cluster] = parts[b0][o0:o1].sum() if o1 > o0 else 0.0
                    continue
                out[cluster] = whole[b0 + (o0 > 0) : b1].sum()
                if o0:
                    out[cluster] += parts[b0][o0:].sum()
                if o1:
                    out[cluster] += parts[b1][:o1].sum()
        return masses, totals


def _fitted(rows: DataFrame, kind: str, k: int, max_iter: int, tolerance: float) -> DataFrame:
    """``(image_id, centers, step, done, needed)``: rounds until an image has settled or lacks a block."""

    def fit(table: pa.Table) -> pa.Table:
        is_state = pc.is_valid(table["centers"])
        state = table.filter(is_state)
        table = table.filter(pc.invert(is_state)).sort_by("first").combine_chunks()
        levels = Levels(table)
        if state.num_rows:
            centers, step = np.array(state["centers"][0].as_py()), state["step"][0].as_py()
        else:
            draws = np.frombuffer(b"".join(table["draws"].to_pylist()), np.int64)
            drawn = np.frombuffer(b"".join(table["drawn"].to_pylist()))
            centers, step = np.sort(drawn[np.lexsort((drawn, draws))[:k]]), 0
        done, needed = step >= max_iter, set()
        while not done:
            middles = (centers[:-1] + centers[1:]) / 2
            if levels.whole():
                mass, total = levels.whole_sums(middles)
            else:
                bounds, needed = levels.bounds(middles)
                if needed:
                    break
                mass, total = levels.sums(bounds)
            moved = np.where(mass > 0, total / np.where(mass > 0, mass, 1.0), centers)
            settled = np.abs(moved - centers).max() <= tolerance
            centers, step = moved, step + 1
            done = bool(settled) or step >= max_iter
        # Bounds that were in place are needed again, and they may move to a block next to theirs.
        if needed:
            middles = (centers[:-1] + centers[1:]) / 2
            at = np.searchsorted(levels.first, middles, side="right") - 1
            needed = {b for n in at.tolist() for b in (n - 1, n, n + 1) if 0 <= b < len(levels.first)}
        return pa.table(
            {
                IMAGE: table[IMAGE].slice(0, 1),
                "centers": pa.array([centers.tolist()], pa.list_(pa.float64())),
                "step": pa.array([step], pa.int32()),
                "done": pa.array([done]),
                "needed": pa.array([[float(levels.first[b]) for b in sorted(needed)]], pa.list_(pa.float64())),
            }
        )

    schema = f"{IMAGE} {kind}, centers array<double>, step int, done boolean, needed array<double>"
    return rows.groupBy(IMAGE).applyInArrow(fit, schema)

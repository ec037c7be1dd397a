import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lumagrid.operators import clusters
from lumagrid.plans.kmeans_tonemap import map_by_clusters, tone_map_kmeans
from lumagrid.operators.raster import luminance_histogram, luminance_level


@pytest.fixture(scope="module")
def hist(spark):
    rng = random.Random(5)
    rows = []
    for image in range(4):
        for v in {round(rng.expovariate(1.0), 3) for _ in range(300 * (image + 1))}:
            rows.append((image, v, rng.randrange(1, 50)))
    rows.append((9, 0.5, 3))
    return spark.createDataFrame(rows, "image_id int, lum double, n_pixels bigint").repartition(5)


def models(df):
    return {r.image_id: r.centers for r in df.collect()}


def lloyd(rows, k, max_iter=1000):
    """Rounds over plain lists, from the same first centers."""
    prime = 2147483647
    mixed = {lum: (int(lum * (1 << 20)) % prime * 48271 + 1) % prime for lum, _ in rows}
    centers = sorted(sorted(mixed, key=lambda v: ((mixed[v] ** 2 + mixed[v]) % prime, v))[:k])
    for _ in range(max_iter):
        middles = [(a + b) / 2 for a, b in zip(centers, centers[1:])]
        members = [[] for _ in centers]
        for lum, n in sorted(rows):
            members[sum(m < lum for m in middles)].append((lum, n))
        moved = [
            sum(lum * n for lum, n in m) / sum(n for _, n in m) if m else c for m, c in zip(members, centers)
        ]
        step = max(abs(a - b) for a, b in zip(moved, centers))
        centers = moved
        if step <= clusters.TOLERANCE:
            break
    return centers


@pytest.mark.parametrize("local", [10**6, 0, 400])
def test_fit_runs_to_the_tolerance(hist, monkeypatch, local):
    """Whole images and block by block."""
    monkeypatch.setattr(clusters, "BLOCK_LEVELS", 16)
    rows = {}
    for r in hist.collect():
        rows.setdefault(r.image_id, []).append((r.lum, r.n_pixels))
    got = models(clusters.kmeans_fit(hist, k=8, local_levels=local))
    for image, centers in got.items():
        np.testing.assert_allclose(centers, lloyd(rows[image], 8), rtol=1e-9)


def test_a_fit_leaves_its_models_alone(spark, hist, tmp_path):
    from lumagrid.settings import checkpoint_dir

    def tables():
        folder = checkpoint_dir(spark).removeprefix("file:")
        return {d for d in os.listdir(folder) if len(d) == 32}

    checkpoint_dir(spark)
    before = tables()
    fit = clusters.kmeans_fit(hist, k=8, local_levels=0)
    kept = len(tables() - before)
    assert fit.count() == 5
    assert kept <= 12  # a small table a job, and neither blocks nor levels


def test_one_task_and_one_job_per_iteration_agree(hist, monkeypatch):
    monkeypatch.setattr(clusters, "BLOCK_LEVELS", 16)
    small = models(clusters.kmeans_fit(hist, k=8, max_iter=6))
    large = models(clusters.kmeans_fit(hist, k=8, max_iter=6, local_levels=0))
    mixed = models(clusters.kmeans_fit(hist, k=8, max_iter=6, local_levels=500))
    assert set(small) == {0, 1, 2, 3, 9} == set(large) == set(mixed)
    for image, centers in small.items():
        np.testing.assert_allclose(centers, large[image], rtol=1e-9)
        np.testing.assert_allclose(centers, mixed[image], rtol=1e-9)


def test_fit_does_not_depend_on_partitions(hist):
    one = models(clusters.kmeans_fit(hist.coalesce(1), k=8, max_iter=20))
    many = models(clusters.kmeans_fit(hist.repartition(11), k=8, max_iter=20))
    for image in one:
        np.testing.assert_allclose(one[image], many[image], rtol=1e-12)


def test_fit_is_a_local_optimum(hist):
    k = 16
    fit = clusters.kmeans_fit(hist, k=k)
    assigned = clusters.assign_clusters(hist, fit, k)
    centers = models(fit)
    assert all(len(c) <= k and c == sorted(c) for c in centers.values())
    assert centers[9] == [0.5]
    rows = assigned.collect()
    assert len(rows) == hist.count()
    for r in rows:
        distances = np.abs(np.array(centers[r.image_id]) - r.lum)
        assert distances[r.cid] == pytest.approx(distances.min(), abs=1e-12)
    for r in clusters.cluster_means(assigned, "count").collect():
        assert r["mean"] == pytest.approx(centers[r.image_id][r.cid], abs=2 * clusters.TOLERANCE)


def test_squared_and_plain_weights(spark):
    rows = [(1, 1.0, 1, 0), (1, 2.0, 3, 0), (1, 9.0, 5, 1)]
    assigned = spark.createDataFrame(rows, "image_id int, lum double, n_pixels bigint, cid int")
    squared = {r.cid: r["mean"] for r in clusters.cluster_means(assigned).collect()}
    assert squared == {0: (1 * 1.0 + 9 * 2.0) / 10, 1: 9.0}
    count = {r.cid: r["mean"] for r in clusters.cluster_means(assigned, "count").collect()}
    assert count == {0: 7 / 4, 1: 9.0}
    with pytest.raises(ValueError):
        clusters.cluster_means(assigned, "cubed")
    sizes = {r.cid: (r.n_levels, r.n_pixels) for r in clusters.cluster_sizes(assigned).collect()}
    assert sizes == {0: (2, 4), 1: (1, 5)}


def test_nearest_center_takes_the_lower_of_two(spark):
    df = spark.createDataFrame([(v,) for v in (-1.0, 1.0, 1.5, 1.6, 2.4, 2.5, 9.0)], "v double")
    got = clusters.nearest_center(df, F.col("v"), [3.0, 1.0, 2.0]).collect()
    assert [r.cid for r in got] == [0, 0, 0, 1, 1, 1, 2]
    assert clusters.nearest_center(df, F.col("v"), [4.0]).where("cid != 0").isEmpty()


@pytest.fixture(scope="module")
def pixels(spark):
    rng = random.Random(11)
    rows = [
        (image, i // 20, i % 20, *(rng.choice([0.0, rng.uniform(0, 2)]) for _ in range(3)))
        for image in (1, 2)
        for i in range(200)
    ]
    rows += [(3, 0, x, 0.0, 0.0, 0.0) for x in range(5)]
    return spark.createDataFrame(
        rows, "image_id int, y int, x int, b double, g double, r double"
    ).repartition(4)


@pytest.mark.parametrize("bins", [None, 10])
def test_kmeans_tone_mapping(pixels, bins):
    raw = tone_map_kmeans(pixels, k=8, bins_per_unit=bins, quantize=False)
    before = pixels.withColumn("lum", luminance_level(bins))
    rows = (
        before.join(raw.withColumnsRenamed({c: f"new_{c}" for c in "bgr"}), ["image_id", "y", "x"])
        .orderBy("image_id", "lum")
        .collect()
    )
    assert len(rows) == 405
    last = {}
    levels = {}
    for r in rows:
        if r.lum == 0:
            assert r.new_b == r.new_g == r.new_r == 0
            continue
        channel = max("bgr", key=lambda c: r[c])
        new = r[f"new_{channel}"] / r[channel] * r.lum
        # The curve never falls and takes at most k values.
        assert new >= last.get(r.image_id, 0) - 1e-9
        last[r.image_id] = new
        levels.setdefault(r.image_id, set()).add(round(new, 6))
    assert all(len(v) <= 8 for v in levels.values())


def test_as_many_clusters_as_levels_change_nothing(pixels):
    bins = 4
    hist = luminance_histogram(pixels, bins)
    fit = hist.groupBy("image_id").agg(F.sort_array(F.collect_list("lum")).alias("centers"))
    same = map_by_clusters(pixels, hist, fit, bins, quantize=False)
    off = (
        pixels.withColumn("lum", luminance_level(bins))
        .join(same.withColumnsRenamed({c: f"new_{c}" for c in "bgr"}), ["image_id", "y", "x"])
        .where("lum > 0 and abs(new_g - g) > 1e-9")
    )
    assert off.isEmpty()

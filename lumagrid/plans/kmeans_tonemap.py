"""Tone mapping by clustering the luminance histogram of each image."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumagrid.operators import clusters
from lumagrid.operators.lookup import attach, interval_index
from lumagrid.operators.raster import IMAGE, luminance_histogram, luminance_level
from lumagrid.plans.tonemap import apply_luminance
from lumagrid.settings import store


def tone_map_kmeans(
    pixels: DataFrame,
    k: int = clusters.K,
    max_iter: int = clusters.MAX_ITER,
    seed: int = 0,
    bins_per_unit: int | None = None,
    weighting: str = "squared",
    quantize: bool = True,
    local_levels: int = clusters.LOCAL_LEVELS,
    hist: DataFrame | None = None,
) -> DataFrame:
    """Every pixel takes the weighted mean level of its luminance cluster.

    ``hist`` is the pixels' own histogram, if there is a cheaper way to it.
    """
    hist, _ = store(luminance_histogram(pixels, bins_per_unit) if hist is None else hist)
    models = clusters.kmeans_fit(hist, k, max_iter, seed, local_levels=local_levels)
    return map_by_clusters(pixels, hist, models, bins_per_unit, weighting, quantize)


def map_by_clusters(
    pixels: DataFrame,
    hist: DataFrame,
    models: DataFrame,
    bins_per_unit: int | None = None,
    weighting: str = "squared",
    quantize: bool = True,
) -> DataFrame:
    """The same with given models ``(image_id, centers)`` and the pixels' own histogram.

    Pixels meet the model of their image, never the histogram.
    """
    models, n_models = store(models)
    k = clusters.most_centers(models)
    means = clusters.cluster_means(clusters.assign_clusters(hist, models, k, n_models), weighting)
    # NULL where no pixel falls into a cluster; no pixel looks such an entry up.
    levels = F.transform(
        F.sequence(F.lit(0), F.size("centers") - 1), lambda cid: F.try_element_at("_means", cid)
    )
    curves = (
        means.groupBy(IMAGE)
        .agg(
            F.map_from_entries(F.collect_list(F.struct("cid", "mean"))).alias("_means"),
            F.sum("n_pixels").alias("_n_pixels"),
        )
        .join(models, IMAGE)
        .select(
            IMAGE,
            "_n_pixels",
            clusters.cluster_bounds("centers").alias("_bounds"),
            levels.alias("_levels"),
        )
    )
    source = pixels.select(IMAGE, "y", "x", "b", "g", "r").withColumn(
        "lum", luminance_level(bins_per_unit)
    )
    joined = attach(
        source, curves, [IMAGE], weight="_n_pixels", row_bytes=clusters.model_bytes(k)
    )
    located = interval_index(joined, F.col("lum"), F.col("_bounds"), k - 1, "cid")
    mapped = located.withColumn("new_lum", F.get("_levels", F.col("cid")))
    return apply_luminance(mapped, quantize)

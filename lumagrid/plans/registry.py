"""Every operator as a query over the given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumagrid.functions import pixel, timing
from lumagrid.operators import clusters, compare, matrix, raster, runs, tiles
from lumagrid.operators.lookup import attach
from lumagrid.operators.stencil import sobel
from lumagrid.plans import edges, kmeans_tonemap, views
from lumagrid.plans.tonemap import gamma_image, tone_map, tone_map_all
from lumagrid.plans.report import run_report
from lumagrid.settings import checkpoint_dir, cut_lineage
from lumagrid.sources import derived, images, synthetic
from lumagrid.sources.pixels import load_hdr_pixels, write_ldr
from lumagrid.sources.reports import log_batches, log_runs, log_summaries, scan_run_log, write_report
from lumagrid.streaming.drain import drain_folder, folder_report

Query = Callable[[SparkSession, str], DataFrame]

# Cluster centres of the queries that need fixed ones. No midpoint between two of
# them is a multiple of 1/BINS, so no level is equally near to two centres.
CENTERS = [round(0.05 + 0.237 * k, 3) for k in range(16)]
BINS = 100
# Lines of an image in one file of a stream, and runs in one block of a log.
FILE_LINES, LOG_RUNS = 16, 4096

_AT = ["image_id", "y", "x"]
_QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    _QUERIES[function.__name__] = function
    return function


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


# Scans and reshaping


@query
def hdr_scan(spark, sf):
    return _rounded(derived.hdr_pixels(spark, sf), "b", "g", "r")


@query
def raster_explode(spark, sf):
    images = derived.table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("image_id"), F.col("embedding").cast("array<double>").alias("data")
    )
    pixels = raster.explode_raster(images, "data", width=4, channels=("b", "g", "r", "a"))
    return _rounded(pixels, "b", "g", "r", "a")


@query
def raster_pack(spark, sf):
    packed = raster.pack_raster(derived.ldr_pixels(derived.hdr_pixels(spark, sf)), run=16)
    return packed.select(
        "image_id", "y0", "x0", F.array_join(F.col("data").cast("array<string>"), ",").alias("data")
    )


def _holes(spark, sf):
    """8-bit pixels of images that lack some pixels, and some pixels a channel."""
    pixels = derived.ldr_pixels(derived.hdr_pixels(spark, sf))
    kept = pixels.where((F.col("b") + F.col("x")) % 5 != 2)
    return kept.withColumn("g", F.when(F.col("g") % 7 != 0, F.col("g")))


@query
def raster_pack_holes(spark, sf):
    packed = raster.pack_raster(_holes(spark, sf), run=16)
    values = F.transform("data", lambda v: F.coalesce(v.cast("string"), F.lit("-")))
    return packed.select(
        "image_id",
        "y0",
        "x0",
        F.array_join(values, ",").alias("data"),
        F.array_join(F.col("offsets").cast("array<string>"), ",").alias("offsets"),
    )


@query
def raster_round_trip(spark, sf):
    packed = raster.pack_raster(_holes(spark, sf), run=16)
    return raster.explode_raster(packed, "data", width=1 << 20)


@query
def random_matrix(spark, sf):
    return synthetic.random_like(derived.entries(spark, sf), seed=42)


# Projections


@query
def luminance(spark, sf):
    pixels = raster.with_luminance(derived.hdr_pixels(spark, sf))
    return _rounded(pixels.select(*_AT, "lum"), "lum")


@query
def gray_trunc(spark, sf):
    return derived.gray_pixels(derived.hdr_pixels(spark, sf))


@query
def gray_round(spark, sf):
    colour = derived.ldr_pixels(derived.hdr_pixels(spark, sf))
    return colour.select(*_AT, pixel.bgr_to_gray(mode="round").alias("g"))


@query
def gamma_per_channel(spark, sf):
    return gamma_image(derived.hdr_pixels(spark, sf))


@query
def luminance_rescale(spark, sf):
    lum = pixel.luminance()
    return _rounded(
        derived.hdr_pixels(spark, sf).select(
            *_AT, *[pixel.rescale(c, lum, F.sqrt(lum)).alias(c) for c in "bgr"]
        ),
        "b",
        "g",
        "r",
    )


@query
def quantize_8bit(spark, sf):
    return derived.hdr_pixels(spark, sf).select(
        *_AT, *[pixel.quantize8(c).alias(c) for c in "bgr"]
    )


@query
def times2_wrap(spark, sf):
    gray = derived.gray_pixels(derived.hdr_pixels(spark, sf))
    return gray.select(
        *_AT,
        pixel.intensity_times("g").alias("wrapped"),
        pixel.intensity_times("g", saturate=True).alias("saturated"),
    )


@query
def image_type_name(spark, sf):
    modes = derived.table(spark, sf, "events").select(
        "event_id", (F.col("user_id") % 32).cast("int").alias("mode")
    )
    return modes.withColumn("name", pixel.image_type_name("mode"))


@query
def change_extension(spark, sf):
    kind = F.col("user_id") % 5
    ending = (
        F.when(kind == 0, ".exr").when(kind == 1, ".jpeg").when(kind == 2, ".tar.gz")
        .when(kind == 3, ".h").otherwise("")
    )
    names = derived.table(spark, sf, "events").select(
        F.concat(F.lit("test"), F.col("event_id"), ending).alias("name")
    )
    return names.withColumn("new_name", pixel.change_extension("name"))


@query
def crop_bounds(spark, sf):
    """In-bounds part of every image moved up and left by one pixel."""
    gray = derived.gray_pixels(derived.hdr_pixels(spark, sf))
    return raster.shift(gray, -1, -1).select(*_AT, "g")


# Tone mapping


@query
def tonemap_gamma(spark, sf):
    return tone_map(derived.hdr_pixels(spark, sf), "gamma")


def _maxima(spark, sf, source=derived.hdr_pixels):
    return raster.max_luminance(source(spark, sf, placed=False))


@query
def tonemap_log(spark, sf):
    return tone_map(derived.hdr_pixels(spark, sf), "log", stats=_maxima(spark, sf))


@query
def tonemap_adaptive_log(spark, sf):
    return tone_map(
        derived.hdr_pixels(spark, sf), "adap_log", stats=_maxima(spark, sf), b=0.85, ld_max=100.0
    )


@query
def tonemap_all(spark, sf):
    return tone_map_all(derived.hdr_pixels(spark, sf), stats=_maxima(spark, sf))


@query
def tonemap_log_big(spark, sf):
    stats = _maxima(spark, sf, derived.big_pixels)
    return tone_map(derived.big_pixels(spark, sf), "log", stats=stats)


# Edges


@query
def sobel_zero(spark, sf):
    return sobel(derived.gray_pixels(derived.hdr_pixels(spark, sf)), strategy="scatter")


@query
def sobel_halo(spark, sf):
    return sobel(derived.gray_pixels(derived.hdr_pixels(spark, sf)), strategy="halo", tile=16)


@query
def sobel_reflect101(spark, sf):
    return sobel(derived.gray_pixels(derived.hdr_pixels(spark, sf)), border="reflect101")


@query
def edge_map_big(spark, sf):
    return edges.edge_map(derived.ldr_pixels(derived.big_pixels(spark, sf)))


@query
def edge_map(spark, sf):
    return edges.edge_map(derived.ldr_pixels(derived.hdr_pixels(spark, sf)))


@query
def edge_map_tiles(spark, sf):
    """The same over tiles of bytes instead of rows of pixels."""
    packed = tiles.tiles_from_pixels(derived.ldr_pixels(derived.hdr_pixels(spark, sf)), tile=16)
    return tiles.pixels_from_tiles(tiles.edge_map_tiles(packed, tile=16), ("edge",), tile=16)


@query
def edge_map_tiles_big(spark, sf):
    """Images that end in the middle of a line, in tiles that divide nothing."""
    packed = tiles.tiles_from_pixels(derived.ldr_pixels(derived.big_pixels(spark, sf)), tile=7)
    return tiles.pixels_from_tiles(tiles.edge_map_tiles(packed, tile=7), ("edge",), tile=7)


# Histograms and clusters


def _hist(spark, sf):
    return raster.luminance_histogram(derived.hdr_pixels(spark, sf, placed=False), BINS)


def _assigned(spark, sf):
    return clusters.nearest_center(_hist(spark, sf), F.col("lum"), CENTERS)


@query
def max_luminance(spark, sf):
    return _rounded(_maxima(spark, sf), "lum_max")


@query
def luminance_histogram(spark, sf):
    return _rounded(_hist(spark, sf), "lum")


@query
def luminance_histogram_big(spark, sf):
    return _rounded(raster.luminance_histogram(derived.big_pixels(spark, sf, placed=False), BINS), "lum")


@query
def hist_lookup(spark, sf):
    pixels = derived.hdr_pixels(spark, sf).withColumn("lum", raster.luminance_level(BINS))
    found = raster.hist_lookup(pixels.select(*_AT, "lum"), _hist(spark, sf))
    return _rounded(found.select(*_AT, "lum", "n_pixels"), "lum")


@query
def nearest_centroid(spark, sf):
    pixels = derived.hdr_pixels(spark, sf).withColumn("lum", raster.luminance_level(BINS))
    near = clusters.nearest_center(pixels, F.col("lum"), CENTERS)
    return near.select(*_AT, "cid")


@query
def cluster_sizes(spark, sf):
    return clusters.cluster_sizes(_assigned(spark, sf))


@query
def cluster_weighted_mean(spark, sf):
    means = clusters.cluster_means(_assigned(spark, sf))
    return _rounded(means.select("image_id", "cid", "mean"), "mean", digits=9)


@query
def cluster_mean_lookup(spark, sf):
    pixels = derived.hdr_pixels(spark, sf).withColumn("lum", raster.luminance_level(BINS))
    near = clusters.nearest_center(pixels, F.col("lum"), CENTERS)
    means = clusters.cluster_means(_assigned(spark, sf))
    found = attach(near, means, ["image_id", "cid"], weight="n_pixels", how="left")
    return _rounded(found.select(*_AT, "cid", "mean"), "mean", digits=9)


@query
def tonemap_kmeans_fixed_centers(spark, sf):
    pixels = derived.hdr_pixels(spark, sf)
    hist = _hist(spark, sf)
    models = hist.select("image_id").distinct().withColumn(
        "centers", F.array(*[F.lit(c) for c in CENTERS])
    )
    return kmeans_tonemap.map_by_clusters(pixels, hist, models, BINS)


# Fewer centres than an image has levels.
FITTED = {"k": 16}


def _centers(models):
    return _rounded(
        models.select("image_id", F.posexplode("centers").alias("cid", "center")), "center"
    )


@query
def kmeans_luminance(spark, sf):
    return _centers(clusters.kmeans_fit(_hist(spark, sf), **FITTED))


@query
def kmeans_luminance_large(spark, sf):
    return _centers(clusters.kmeans_fit(_hist(spark, sf), local_levels=0, **FITTED))


@query
def tonemap_kmeans(spark, sf):
    return kmeans_tonemap.tone_map_kmeans(
        derived.hdr_pixels(spark, sf), bins_per_unit=BINS, hist=_hist(spark, sf), **FITTED
    )


# Vectors and matrices


@query
def vector_add(spark, sf):
    part = derived.table(spark, sf, "part")
    price = part.select(F.col("p_partkey").alias("i"), F.col("p_retailprice").alias("v"))
    size = part.select(F.col("p_partkey").alias("i"), F.col("p_size").cast("double").alias("v"))
    return _rounded(matrix.vector_add(price, size), "v")


@query
def vector_add_arrays(spark, sf):
    a = F.col("embedding").cast("array<double>")
    sums = derived.table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("i"),
        F.posexplode(matrix.add_arrays(a, F.reverse(a))).alias("j", "v"),
    )
    return _rounded(sums, "v")


def _gram_factors(spark, sf):
    entries = derived.entries(spark, sf)
    return matrix.transpose(entries), entries


@query
def matmul_join(spark, sf):
    return _rounded(matrix.matmul_join(*_gram_factors(spark, sf)), "v")


@query
def matmul_tiled(spark, sf):
    return _rounded(matrix.matmul_tiled(*_gram_factors(spark, sf)), "v")


@query
def matmul_rows(spark, sf):
    """Vectors times their Gram matrix."""
    rows = derived.table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("i"), F.col("embedding").cast("array<double>").alias("row")
    )
    gram = cut_lineage(matrix.matmul_tiled(*_gram_factors(spark, sf)))
    return _rounded(matrix.entries_from_rows(matrix.matmul_rows(rows, gram)), "v")


@query
def matmul_rows_large(spark, sf):
    """Vectors times all vectors, by blocks; vectors of one label share an id and stay rows of their own."""
    rows = derived.table(spark, sf, "embeddings").select(
        F.col("label").cast("bigint").alias("i"), F.col("embedding").cast("array<double>").alias("row")
    )
    product = matrix.matmul_rows(rows, matrix.transpose(derived.entries(spark, sf)), copied=False, summed=True)
    counted = F.transform("row", lambda v: F.struct("n_rows", v.alias("v"))).alias("row")
    cells = matrix.entries_from_rows(product.select("i", counted)).groupBy("i", "j")
    return _rounded(cells.agg(F.sum("v.n_rows").alias("n_rows"), F.sum("v.v").alias("v")), "v")


@query
def results_diff(spark, sf):
    """Retail prices of the parts against the unit prices they were sold for."""
    listed = derived.table(spark, sf, "part").select(
        F.col("p_partkey").alias("i"), F.col("p_retailprice").alias("v")
    )
    sold = (
        derived.table(spark, sf, "lineitem")
        .groupBy(F.col("l_partkey").alias("i"))
        .agg(F.max(F.col("l_extendedprice") / F.col("l_quantity")).alias("v"))
    )
    return compare.results_diff(listed, sold, ["i"], tolerance=0.01)


# Run reports


@query
def run_speedup(spark, sf):
    timed = derived.runs(spark, sf).select("section", "iteration", "serial", "variant")
    return _rounded(
        runs.with_speedup(timed, "serial", "variant"), "serial", "variant", "ratio"
    )


@query
def run_bandwidth(spark, sf):
    pixels = F.col("iteration") + 1
    rate = timing.effective_bandwidth(pixels * 3000000.0, pixels * 1000000.0, F.col("serial"))
    return derived.runs(spark, sf).select("section", "iteration", rate.alias("gb_per_s"))


@query
def run_throughput(spark, sf):
    pixels = (F.col("iteration") + 1) * 1000000.0
    rate = timing.throughput(F.lit(18), pixels, F.col("serial"))
    return derived.runs(spark, sf).select("section", "iteration", rate.alias("gflop_per_s"))


@query
def run_summary(spark, sf):
    timed = derived.runs(spark, sf)
    values = ["serial", "variant", "ratio"]
    summary = runs.run_summary(timed, "section", values, medians=["serial", "variant"])
    numbers = [c for c in summary.columns if c not in ("section", "n_runs")]
    return _rounded(summary, *numbers, digits=9)


@query
def batch_report(spark, sf):
    return _rounded(runs.batch_report(derived.dispatch(spark, sf)), "total_seconds")


@query
def worker_report(spark, sf):
    return _rounded(runs.worker_report(derived.dispatch(spark, sf)), "total_seconds")


@query
def run_verdicts(spark, sf):
    timed = derived.runs(spark, sf)
    wrong = compare.differs(F.col("serial"), F.col("variant") * F.col("factor"))
    judged = timed.withColumn("verdict", F.when(wrong, compare.BAD).otherwise(compare.GOOD))
    return runs.run_verdicts(judged)


# Files: written to the checkpoint folder and read back


def _folder(spark):
    return f"{checkpoint_dir(spark)}/files-{uuid.uuid4().hex}"


def _pixel_files(spark, sf):
    """The pixels as files of some lines of an image each, and three files without a pixel."""
    folder = f"{_folder(spark)}"
    pixels = derived.hdr_pixels(spark, sf)
    block = F.floor(F.col("y") / FILE_LINES)
    pixels.repartition("image_id", block).write.parquet(f"{folder}/in")
    for _ in range(3):
        pixels.limit(0).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    drain_folder(
        spark,
        f"{folder}/in",
        f"{folder}/out",
        f"{folder}/report",
        f"{folder}/state",
        schema=pixels.schema,
        files_per_batch=4,
        stats=_maxima(spark, sf),
    ).awaitTermination()
    return folder


@query
def drain_tonemap(spark, sf):
    """The images as files of a folder, tone mapped as a stream."""
    return spark.read.parquet(f"{_pixel_files(spark, sf)}/out").select(*_AT, "b", "g", "r")


@query
def drain_report(spark, sf):
    """Every file of the stream once, by whether it has pixels."""
    report = folder_report(spark, f"{_pixel_files(spark, sf)}/report")
    return report.select(
        "operator", "n_pixels", (F.col("n_pixels") > 0).alias("has_pixels"), "file"
    ).groupBy("operator", "has_pixels").agg(
        F.sum("n_pixels").alias("n_pixels"),
        F.sum(F.when(F.col("n_pixels") == 0, 1).otherwise(0)).alias("n_empty"),
        (F.count("file") == F.count_distinct("file")).alias("each_once"),
    )


@query
def image_files_round_trip(spark, sf):
    """8-bit images written as PNG files and decoded again."""
    folder = _folder(spark)
    images.write_images(derived.ldr_pixels(derived.hdr_pixels(spark, sf)), folder)
    return images.load_image_pixels(spark, folder)


def _nation_files(spark, sf, folder):
    """A text file per nation in a folder per region; some are empty and some are hidden."""
    key = F.col("n_nationkey")
    files = derived.table(spark, sf, "nation").select(
        F.concat(
            F.col("n_regionkey").cast("string"),
            F.when(key % 5 == 1, "/.").when(key % 5 == 2, "/_").otherwise("/"),
            F.regexp_replace("n_name", " ", "+"),
            F.lit(".txt"),
        ).alias("name"),
        F.when(key % 4 != 0, F.col("n_name")).otherwise("").cast("binary").alias("content"),
    )
    return images.write_files(files, folder)


@query
def list_images(spark, sf):
    """The files of all nations: hidden ones and those without a byte too, in every subfolder."""
    folder = _folder(spark)
    _nation_files(spark, sf, folder)
    listed = images.list_images(spark, folder, recursive=True)
    region = F.element_at(F.split("path", "/"), -2).cast("bigint")
    return listed.select(region.alias("n_regionkey"), "name", "length")


@query
def unreadable_images(spark, sf):
    """Of a folder of images and texts those files that are no image."""
    folder = _folder(spark)
    images.write_images(derived.ldr_pixels(derived.hdr_pixels(spark, sf)), folder)
    texts = derived.table(spark, sf, "nation").select(
        F.concat(F.col("n_nationkey").cast("string"), F.lit(".exr")).alias("name"),
        F.when(F.col("n_nationkey") % 4 != 0, F.col("n_name")).otherwise("").cast("binary").alias("content"),
    )
    images.write_files(texts, folder)
    return images.unreadable_images(spark, folder).select("name", "length")


@query
def image_headers(spark, sf):
    folder = _folder(spark)
    images.write_images(derived.ldr_pixels(derived.hdr_pixels(spark, sf)), folder)
    return images.load_headers(spark, folder).drop("path")


@query
def replace_extension(spark, sf):
    """Names with a ``.exr`` anywhere, more than once or not at all."""
    kind = F.col("user_id") % 4
    ending = F.when(kind == 0, ".exr").when(kind == 1, ".exr.exr").when(kind == 2, ".exr.png").otherwise(".jpg")
    names = derived.table(spark, sf, "events").select(F.concat(F.lit("test"), "event_id", ending).alias("name"))
    return names.withColumn("new_name", pixel.replace_extension("name"))


@query
def views_sql(spark, sf):
    """Views over float and 8-bit pixels and over file names, in one SQL statement."""
    prefix = f"v{uuid.uuid4().hex[:8]}_"
    views.register_float_views(derived.hdr_pixels(spark, sf), prefix)
    views.register_colour_views(derived.ldr_pixels(derived.hdr_pixels(spark, sf)), prefix)
    files = derived.table(spark, sf, "events").select(
        F.concat(F.lit("test"), "event_id", F.lit(".exr")).alias("name"),
        (F.col("user_id") % 32).cast("int").alias("mode"),
    )
    views.register_file_views(files, prefix)
    return spark.sql(f"""
        select p.image_id, count(*) as n_pixels, round(max(m.lum_max), 6) as lum_max,
               sum(g.b) as gamma_b, sum(l.g) as log_g, sum(q.r) as quantized_r,
               sum(e.edge) as edges, sum(t.g) as doubled,
               max((select count(*) from {prefix}change_extension c join {prefix}image_type_name n
                    on n.name = c.name where c.new_name like '%.png' and n.type_name like '8U%')) as n_files
        from {prefix}luminance p
        join {prefix}max_luminance m on m.image_id = p.image_id
        join {prefix}tonemap_gamma g on g.image_id = p.image_id and g.y = p.y and g.x = p.x
        join {prefix}tonemap_log l on l.image_id = p.image_id and l.y = p.y and l.x = p.x
        join {prefix}quantize_8bit q on q.image_id = p.image_id and q.y = p.y and q.x = p.x
        join {prefix}edges e on e.image_id = p.image_id and e.y = p.y and e.x = p.x
        join {prefix}times2 t on t.image_id = p.image_id and t.y = p.y and t.x = p.x
        group by p.image_id""")


@query
def write_ldr_round_trip(spark, sf):
    path = f"{_folder(spark)}/ldr"
    write_ldr(tone_map(derived.hdr_pixels(spark, sf), "gamma"), path)
    return load_hdr_pixels(spark, path, "image_id int, y bigint, x int, b int, g int, r int")


def _run_log(spark, sf):
    """The run table as text: blocks of a section's runs, each below its section line and titles."""
    path = f"{_folder(spark)}/log"
    runs_of = derived.runs(spark, sf).withColumn("block", F.floor(F.col("iteration") / LOG_RUNS))
    lines = runs_of.select(
        "section",
        "block",
        F.lit(2).alias("part"),
        "iteration",
        F.concat_ws(
            ",",
            "iteration",
            "serial",
            "variant",
            F.when(F.col("serial") == F.col("variant") * F.col("factor"), "Good calculation").otherwise(
                "Bad calculation"
            ),
        ).alias("value"),
    )
    titles = F.array(
        F.struct(F.lit(0).alias("part"), F.concat(F.lit("Image: "), "section").alias("value")),
        F.struct(F.lit(1).alias("part"), F.lit("iteration,host,device,verdict").alias("value")),
    )
    return _log_lines(lines, titles, path)


def _log_lines(lines, titles, path):
    """Writes the lines of all blocks in order, ``titles`` before those of each."""
    heads = lines.select("section", "block").distinct().select("section", "block", F.inline(titles))
    heads = heads.withColumn("iteration", F.lit(0).cast("bigint"))
    ordered = lines.unionByName(heads).repartition("section", "block").sortWithinPartitions(
        "section", "block", "part", "iteration"
    )
    ordered.select("value").write.text(path)
    return path


def _dispatch_log(spark, sf):
    """Seconds of every file below its operator, and blocks end with their total and their mean."""
    events = derived.table(spark, sf, "events").select(
        F.col("event_type").alias("section"),
        F.floor(F.col("event_id") / LOG_RUNS).alias("block"),
        F.col("event_id").alias("iteration"),
        F.round(F.col("value"), 6).cast("decimal(20,6)").alias("seconds"),
        (F.col("user_id") % 3).cast("string").alias("worker"),
    )
    file = F.concat(F.lit("test"), "iteration", F.lit(".exr"))
    lines = events.select(
        "section", "block", F.lit(2).alias("part"), "iteration", F.concat_ws("|", file, "seconds", "worker").alias("value")
    )
    ends = events.groupBy("section", "block").agg(
        F.sum("seconds").alias("total"), F.max("seconds").cast("string").alias("largest")
    )
    ends = ends.select(
        "section",
        "block",
        F.inline(
            F.array(
                F.struct(F.lit(3).alias("part"), F.concat_ws("|", F.lit("batch time"), "total", F.lit("0")).alias("value")),
                F.struct(F.lit(4).alias("part"), F.concat(F.lit("**Promedios:**|**"), "largest", F.lit("**|-")).alias("value")),
            )
        ),
    ).withColumn("iteration", F.lit(0).cast("bigint"))
    titles = F.array(
        F.struct(F.lit(0).alias("part"), F.concat(F.lit("**Operador: "), "section", F.lit("**")).alias("value")),
        F.struct(F.lit(1).alias("part"), F.lit("imagen|tiempo|id worker").alias("value")),
    )
    return _log_lines(lines.unionByName(ends), titles, f"{_folder(spark)}/log")


@query
def log_batches_round_trip(spark, sf):
    log = scan_run_log(spark, _dispatch_log(spark, sf), "|")
    batches = log_batches(log).groupBy("section", "worker").agg(
        F.count(F.lit(1)).alias("n_batches"), F.sum("seconds").alias("seconds")
    )
    return _rounded(batches, "seconds", digits=4)


@query
def log_summaries_round_trip(spark, sf):
    log = scan_run_log(spark, _dispatch_log(spark, sf), "|")
    rows = log_summaries(log, {"seconds": "tiempo", "worker": "id worker"})
    return rows.groupBy("section").agg(
        F.count(F.lit(1)).alias("n_summaries"),
        F.max("seconds").alias("largest"),
        F.count("worker").alias("n_workers"),
    )


@query
def log_runs_round_trip(spark, sf):
    log = scan_run_log(spark, _run_log(spark, sf))
    cells = log_runs(log, {"serial": "host", "variant": "device", "verdict": "verdict"})
    return _rounded(
        cells.select("section", "iteration", "serial", "variant", "verdict"), "serial", "variant"
    )


@query
def run_report_from_log(spark, sf):
    report = run_report(spark, _run_log(spark, sf), ",", "host", "device", "verdict")
    numbers = [c for c in report.columns if c.startswith(("mean", "min", "max", "median"))]
    return _rounded(report, *numbers, digits=9)


@query
def write_report_round_trip(spark, sf):
    path = f"{_folder(spark)}/report"
    write_report(derived.dispatch(spark, sf).select("file", "seconds", "worker"), path)
    back = spark.read.option("sep", "|").schema("file string, seconds double, worker int").csv(path)
    return _rounded(back, "seconds")

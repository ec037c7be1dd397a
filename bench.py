"""Times the headline queries and prints one JSON line.

Pixels are made from the line items of ``BENCH_SF_DIR`` and stored first
(``ingest``), so the queries start from decoded pixels in Parquet: seven pixels
per line item, about 4.2 million at sf0.1, as 20 images and as one image of
2560 columns (also stored as tiles). Every result is computed in full and written to a sink that
drops it. A time is the median of ``BENCH_RUNS`` runs after one run to warm up.
"""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumagrid.functions.pixel import bgr_to_gray
from lumagrid.operators import matrix, raster
from lumagrid.operators.ordering import position_in_group
from lumagrid.operators.tiles import edge_map_tiles, tiles_from_pixels
from lumagrid.plans.edges import edge_map
from lumagrid.plans.kmeans_tonemap import tone_map_kmeans
from lumagrid.plans.registry import BINS, queries
from lumagrid.plans.tonemap import gamma_image, tone_map, tone_map_all
from lumagrid.sources import derived, synthetic

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
PER_ITEM = 7


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("lumagrid-bench")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", str(CPUS))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def pixels(spark: SparkSession, images: int, width: int) -> DataFrame:
    items = derived.table(spark, SF_DIR, "lineitem").withColumn(
        "image_id", (F.col("l_suppkey") % images).cast("int")
    )
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    placed = position_in_group(
        items, "image_id", F.shiftright("l_orderkey", 14), order, "i"
    )
    at = F.col("i") * PER_ITEM + F.col("k")
    fade = F.lit(1.0) + F.col("k") / 10
    return placed.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(PER_ITEM - 1)))).select(
        "image_id",
        F.floor(at / width).cast("int").alias("y"),
        F.pmod(at, F.lit(width)).cast("int").alias("x"),
        (F.col("l_quantity") / 10 / fade).cast("float").alias("b"),
        (F.col("l_extendedprice") / 10000 / fade).cast("float").alias("g"),
        (F.col("l_tax") * 100 / fade).cast("float").alias("r"),
    )


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(make) -> float:
    times = []
    for _ in range(RUNS + 1):
        start = time.perf_counter()
        run(make())
        times.append(time.perf_counter() - start)
    return round(statistics.median(times[1:]), 3)


def main() -> None:
    spark = session()
    folder = tempfile.mkdtemp(prefix="run-bench-")
    start = time.perf_counter()
    pixels(spark, 20, 512).write.parquet(f"{folder}/many")
    ingest = round(time.perf_counter() - start, 3)
    pixels(spark, 1, 2560).write.parquet(f"{folder}/one")
    many = spark.read.parquet(f"{folder}/many")
    one = derived.ldr_pixels(spark.read.parquet(f"{folder}/one"))
    one.write.parquet(f"{folder}/one8")
    one = spark.read.parquet(f"{folder}/one8")
    tiles_from_pixels(one).write.parquet(f"{folder}/tiles")
    tiles = spark.read.parquet(f"{folder}/tiles")
    factors = {}
    for n in (1000, 2000):
        for name, seed in (("a", 1), ("b", 2)):
            path = f"{folder}/{name}{n}"
            synthetic.random_matrix(spark, n, seed=seed).write.parquet(path)
            factors[name, n] = spark.read.parquet(path)
        path = f"{folder}/rows{n}"
        matrix.rows_from_entries(factors["a", n]).write.parquet(path)
        factors["rows", n] = spark.read.parquet(path)
    n_pixels = many.count()
    given = queries()

    jobs = {
        "tonemap_gamma": lambda: tone_map(many, "gamma"),
        "tonemap_log": lambda: tone_map(many, "log"),
        "tonemap_adaptive_log": lambda: tone_map(many, "adap_log"),
        "tonemap_all": lambda: tone_map_all(many),
        "gamma_per_channel": lambda: gamma_image(many),
        "tonemap_kmeans": lambda: tone_map_kmeans(many, bins_per_unit=BINS),
        "luminance_histogram": lambda: raster.luminance_histogram(many, BINS),
        "gray": lambda: one.select("image_id", "y", "x", bgr_to_gray().alias("g")),
        "edge_map_tiles": lambda: edge_map_tiles(tiles),
        "edge_map": lambda: edge_map(one),
        "edge_map_halo": lambda: edge_map(one, strategy="halo"),
        "edge_map_scatter": lambda: edge_map(one, strategy="scatter"),
        "edge_map_reflect101": lambda: edge_map(one, border="reflect101"),
        "matmul_tiled_1000": lambda: matrix.matmul_tiled(factors["a", 1000], factors["b", 1000]),
        "matmul_tiled_2000": lambda: matrix.matmul_tiled(factors["a", 2000], factors["b", 2000]),
        "matmul_rows_1000": lambda: matrix.matmul_rows(factors["rows", 1000], factors["b", 1000]),
        "matmul_rows_2000": lambda: matrix.matmul_rows(factors["rows", 2000], factors["b", 2000]),
        "gram_join": lambda: given["matmul_join"](spark, SF_DIR),
        "gram_tiled": lambda: given["matmul_tiled"](spark, SF_DIR),
        "vector_add": lambda: given["vector_add"](spark, SF_DIR),
        "run_summary": lambda: given["run_summary"](spark, SF_DIR),
    }
    wanted = os.environ.get("BENCH_ONLY")
    times = {k: timed(j) for k, j in jobs.items() if not wanted or k in wanted.split(",")}
    print(
        json.dumps(
            {
                "metric": "sum of median query times",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "ingest": ingest,
                "n_pixels": n_pixels,
                "sf": os.path.basename(SF_DIR.rstrip("/")),
                "cpus": CPUS,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

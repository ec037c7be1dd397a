"""Tone mapping of pixel files as they arrive."""

from __future__ import annotations

import re
import time

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from lumagrid.operators.raster import IMAGE
from lumagrid.plans.tonemap import tone_map
from lumagrid.settings import stored_scope
from lumagrid.sources.pixels import HDR_SCHEMA

# Columns of a table of files.
_FILES = "path string, modificationTime timestamp, length bigint, content binary"


def drain_folder(
    spark: SparkSession,
    source: str,
    target: str,
    report: str,
    checkpoint: str,
    op: str = "log",
    schema: T.StructType = HDR_SCHEMA,
    files_per_batch: int | None = None,
    stats: DataFrame | None = None,
    **params,
) -> StreamingQuery:
    """Tone map every new Parquet file of ``source``, then stop.

    The stream is one of files: its state knows each, also those without a pixel. Results and
    one report row per file are written to a folder per batch, which a repeated batch
    overwrites, so each file is handled and reported exactly once, wherever a drain was
    stopped. An image is what one file holds of it, so the batches in which files come make
    no difference; with ``stats`` (``max_luminance`` of whole images) it may lie in several
    files. Tables that a batch stores are removed with it.
    """
    reader = spark.readStream.format("binaryFile").schema(_FILES)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    files = reader.load(source).select("path", F.col("_metadata.file_path").alias("file"))

    def handle(batch: DataFrame, batch_id: int) -> None:
        folder, start = f"batch={batch_id}", time.perf_counter()
        # The files of a batch, which the stream's own log has in the driver's memory as well.
        found = [(_literal(r.path), r.file) for r in batch.collect()]
        pixels = spark.read.schema(schema).parquet(*[path for path, _ in found])
        pixels = pixels.select("*", F.col("_metadata.file_path").alias("file"))
        pixels = pixels.persist(StorageLevel.DISK_ONLY)
        try:
            with stored_scope(spark):
                if stats is None:
                    apart = pixels.withColumn(IMAGE, F.struct("file", IMAGE))
                    mapped = tone_map(apart, op, **params)
                    mapped = mapped.withColumn(IMAGE, F.col(IMAGE).getField(IMAGE))
                else:
                    mapped = tone_map(pixels, op, stats=stats, **params)
                mapped.write.mode("overwrite").parquet(f"{target}/{folder}")
                seconds = time.perf_counter() - start
                names = spark.createDataFrame([(file,) for _, file in found], "file string")
                timed = file_report(names, pixels, op, seconds)
                timed.write.mode("overwrite").parquet(f"{report}/{folder}")
        finally:
            pixels.unpersist()

    return (
        files.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _literal(path: str) -> str:
    """A path that is no pattern, whatever characters it has."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def file_report(files: DataFrame, pixels: DataFrame, op: str, seconds: float) -> DataFrame:
    """One row per input file: its images, its pixels, and its share by pixels of the time taken."""
    per_image = pixels.groupBy("file", IMAGE).agg(F.count(F.lit(1)).alias("_n"))
    per_file = per_image.groupBy("file").agg(
        F.count(F.lit(1)).alias("n_images"), F.sum("_n").alias("n_pixels")
    )
    total = per_file.agg(F.sum("n_pixels").alias("_total"))
    counted = files.join(per_file, "file", "left").join(F.broadcast(total))
    none = F.lit(0).cast("bigint")
    return counted.select(
        "file",
        F.coalesce("n_images", none).alias("n_images"),
        F.coalesce("n_pixels", none).alias("n_pixels"),
        F.lit(op).alias("operator"),
        F.coalesce(F.col("n_pixels") / F.col("_total") * seconds, F.lit(0.0)).alias("seconds"),
    )


def folder_report(spark: SparkSession, report: str) -> DataFrame:
    """The reports of all batches: a row for every file that was handled."""
    return spark.read.parquet(report).drop("batch")

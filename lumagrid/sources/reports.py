"""Run logs: sectioned text tables in, timing reports out."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumagrid.functions.timing import seconds
from lumagrid.operators.ordering import carry_forward

# Texts that mark lines of a run log.
HEADER_LABELS = ("iteracion", "imagen", "iteration", "image")
SUMMARY_LABEL = "promedios"
BATCH_LABEL = "batch time"
MISSING = "-"


def write_report(report: DataFrame, path: str, sep: str = "|", mode: str = "overwrite") -> None:
    """Lines ``name<sep>seconds[<sep>worker]`` with ten decimals."""
    columns = [
        F.format_string("%.10f", F.col(c)).alias(c) if kind == "double" else F.col(c)
        for c, kind in report.dtypes
    ]
    report.select(*columns).write.mode(mode).option("sep", sep).csv(path)


def scan_run_log(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """Run tables below section lines, as one row per table line.

    ``section`` and ``header`` come from the lines above. ``kind`` is ``run``,
    ``summary`` (a table's own averages) or ``batch`` (the total of a log).
    Files are split like any text: lines are ordered by the split's offset and
    their place in it, and what a split inherits is carried from split to split.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("line"),
        F.trim(F.regexp_replace("value", r"\*\*", "")).alias("text"),
    )
    cells = F.transform(F.split("text", re.escape(sep)), lambda c: F.trim(c))
    label = F.lower(F.get("cells", F.lit(0)))
    filled = F.size(F.filter("cells", lambda c: c != ""))
    label_word = F.regexp_replace(label, ":$", "")
    kind = (
        F.when((F.col("text") == "") | F.col("text").rlike(r"^[:\-| ]+$"), F.lit("rule"))
        .when(label_word == SUMMARY_LABEL, F.lit("summary"))
        .when(label.isin(*HEADER_LABELS), F.lit("header"))
        .when(filled == 1, F.lit("section"))
        .when(label == BATCH_LABEL, F.lit("batch"))
        .otherwise(F.lit("run"))
    )
    marked = (
        lines.withColumn("cells", cells)
        .withColumn("kind", kind)
        .withColumn("section", F.when(F.col("kind") == "section", F.get("cells", F.lit(0))))
        .withColumn("header", F.when(F.col("kind") == "header", F.col("cells")))
    )
    carried = carry_forward(marked, ["file"], "split", ["line"], ["section", "header"])
    return carried.where(F.col("kind").isin("run", "summary", "batch")).select(
        "file", "split", "line", "kind", "section", "header", "cells"
    )


def section_value(section="section"):
    """What a section line names: ``Image: img1.jpg`` -> ``img1.jpg``."""
    return F.trim(F.regexp_extract(section, r":\s*(.*)$", 1))


def log_batches(log: DataFrame) -> DataFrame:
    """The ``batch`` rows: what a log says that all files of a section took, and by which worker."""
    rows = log.where(F.col("kind") == "batch")
    return rows.select(
        "file",
        section_value().alias("section"),
        seconds(_said(F.get("cells", F.lit(1)))).alias("seconds"),
        _said(F.get("cells", F.lit(2))).try_cast("int").alias("worker"),
    )


def log_summaries(log: DataFrame, columns: dict[str, str]) -> DataFrame:
    """The ``summary`` rows: a table's own averages, with named cells as columns like ``log_runs``.

    Averages are written with a point or a comma.
    """
    rows = log.where(F.col("kind") == "summary").withColumn("kind", F.lit("run"))
    cells = F.transform("cells", lambda c: F.regexp_replace(c, r"^(-?\d+),(\d+)$", "$1.$2"))
    return log_runs(rows.withColumn("cells", cells), columns).drop("iteration")


def _said(cell):
    """A cell's text; NULL for one that is empty or a ``-``."""
    return F.when(~cell.isin("", MISSING), cell)


def log_runs(log: DataFrame, columns: dict[str, str]) -> DataFrame:
    """The ``run`` rows with named cells as columns: ``{"serial": "secuencial", ...}``.

    A column the table does not have, a cell that a short row lacks, a row below no
    titles, or a ``-``, is NULL. Of equal titles the first counts. Timings become numbers;
    ``iteration`` a whole number; other texts stay as they are.
    """
    rows = log.where(F.col("kind") == "run")

    def cell(name: str):
        place = F.array_position("header", name)
        return _said(F.when(place > 0, F.get("cells", (place - 1).cast("int"))))

    return rows.select(
        "file",
        section_value().alias("section"),
        F.get("cells", F.lit(0)).alias("label"),
        F.get("cells", F.lit(0)).try_cast("bigint").alias("iteration"),
        *[
            (cell(source) if name in ("verdict", "file_name") else seconds(cell(source))).alias(name)
            for name, source in columns.items()
        ],
    )

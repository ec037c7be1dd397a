"""Summaries of run tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lumagrid.functions.timing import speedup
from lumagrid.operators.compare import BAD, GOOD
from lumagrid.operators.lookup import attach
from lumagrid.settings import PART_ROWS, store

# Rank error of the sketch that brackets a median, as a share of the rows.
_SKETCH_ACCURACY = 10_000


def with_speedup(runs: DataFrame, base: str, variant: str, out: str = "ratio") -> DataFrame:
    return runs.withColumn(out, speedup(F.col(base), F.col(variant)))


def run_summary(
    runs: DataFrame, section: str, values: list[str], medians: list[str] | tuple = ()
) -> DataFrame:
    """Per section, the number of runs and the mean, least and largest of each value.

    A ratio column is averaged like the others: the mean of ratios. Exact medians of the
    columns ``medians`` follow; with them the runs are read twice, else once.
    """
    parts = [F.count(F.lit(1)).alias("n_runs")]
    for v in values:
        parts += [
            F.avg(v).alias(f"mean_{v}"), F.min(v).alias(f"min_{v}"), F.max(v).alias(f"max_{v}")
        ]
    if not medians:
        return runs.groupBy(section).agg(*parts)
    summary, n = store(runs.groupBy(section).agg(*parts, *_brackets(medians)))
    middle = _middles(runs, section, medians, summary, n)
    kept = [c for c in summary.columns if not c.startswith(("_n_", "_bracket_"))]
    return summary.select(*kept).join(middle, section, "left")


def exact_median(df: DataFrame, group: str, value: str) -> DataFrame:
    """Exact median per group of any size: ``(group, median)``."""
    return exact_medians(df, group, [value]).select(group, F.col(f"median_{value}").alias("median"))


def exact_medians(df: DataFrame, group: str, values: list[str]) -> DataFrame:
    """Exact medians of several columns per group of any size: ``(group, median_<value>...)``.

    NULLs are left out; a group without a value has no median.
    """
    brackets, n = store(df.groupBy(group).agg(*_brackets(values)))
    return _middles(df, group, values, brackets, n)


def _brackets(values) -> list:
    """Per column the number of values and two of them that the middle lies between, by a sketch."""
    slack = 2.0 / _SKETCH_ACCURACY
    shares = F.array(F.lit(0.5 - slack), F.lit(0.5 + slack))
    parts = []
    for at, v in enumerate(values):
        parts += [
            F.count(v).alias(f"_n_{at}"),
            F.percentile_approx(v, shares, _SKETCH_ACCURACY).alias(f"_bracket_{at}"),
        ]
    return parts


def _middles(df: DataFrame, group: str, values, brackets: DataFrame, n_groups: int) -> DataFrame:
    """The medians of all columns in one more pass over ``df``.

    Values below a bracket are only counted. Those inside are counted level by level and
    dealt to blocks in order; sums of the blocks tell the one or two of them that hold the middle,
    and only these are sorted, each by itself.
    """
    every = range(len(values))

    def long(rows: DataFrame, *structs) -> DataFrame:
        return rows.select(group, F.inline(F.array(*structs)))

    brackets = long(
        brackets,
        *[
            F.struct(
                F.lit(at).alias("_of"),
                F.col(f"_n_{at}").alias("_n"),
                F.get(f"_bracket_{at}", F.lit(0)).cast("double").alias("_low"),
                F.get(f"_bracket_{at}", F.lit(1)).cast("double").alias("_high"),
            )
            for at in every
        ],
    )
    cells = [F.struct(F.lit(at).alias("_of"), F.col(v).cast("double").alias("_v")) for at, v in enumerate(values)]
    rows = long(df, *cells).where(F.col("_v").isNotNull())
    rows = attach(rows, brackets, [group, "_of"], weight="_n", n_rows=n_groups * len(values))
    # Everything below the bracket falls into one row, everything above is left out.
    levels = (
        rows.where(F.col("_v") <= F.col("_high"))
        .groupBy(group, "_of", F.when(F.col("_v") >= F.col("_low"), F.col("_v")).alias("_v"))
        .agg(F.count(F.lit(1)).alias("_count"), F.first("_n").alias("_n"))
    )
    levels, n_levels = store(levels)
    # 1-based ranks of the two middle rows; they coincide for an odd number of rows.
    lower, upper = F.floor((F.col("_n") + 1) / 2), F.floor((F.col("_n") + 2) / 2)
    if n_levels <= PART_ROWS:  # no more than one block of all groups together
        blocks = levels.withColumns({"_block": F.lit(0), "_start": F.lit(0)})
    else:
        dealt = levels.repartitionByRange(group, "_of", F.col("_v").asc_nulls_first())
        levels, _ = store(dealt.withColumn("_block", F.spark_partition_id()))
        sums = levels.groupBy(group, "_of", "_block").agg(F.sum("_count").alias("_rows"))
        along = Window.partitionBy(group, "_of").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
        sums = sums.withColumn("_start", F.coalesce(F.sum("_rows").over(along), F.lit(0)))
        blocks = attach(levels, sums, [group, "_of", "_block"])
        blocks = blocks.where((F.col("_start") < upper) & (F.col("_start") + F.col("_rows") >= lower))
    upto = Window.partitionBy(group, "_of", "_block").orderBy(F.col("_v").asc_nulls_first()).rowsBetween(
        Window.unboundedPreceding, 0
    )
    ranked = blocks.withColumn("_last", F.col("_start") + F.sum("_count").over(upto)).where(F.col("_v").isNotNull())
    first, second = (F.min(F.when(F.col("_last") >= rank, F.col("_v"))) for rank in (lower, upper))
    middles = ranked.groupBy(group, "_of").agg(((first + second) / 2).alias("_median"))
    return middles.groupBy(group).agg(
        *[F.max(F.when(F.col("_of") == at, F.col("_median"))).alias(f"median_{values[at]}") for at in every]
    )


def batch_report(dispatch: DataFrame) -> DataFrame:
    """Files and total seconds per operator."""
    return dispatch.groupBy("operator").agg(
        F.count(F.lit(1)).alias("n_files"), F.sum("seconds").alias("total_seconds")
    )


def worker_report(dispatch: DataFrame) -> DataFrame:
    """Files and seconds per operator and worker."""
    return dispatch.groupBy("operator", "worker").agg(
        F.count(F.lit(1)).alias("n_files"), F.sum("seconds").alias("total_seconds")
    )


def run_verdicts(runs: DataFrame, section: str = "section") -> DataFrame:
    """Good and bad calculations per section, and whether all were good."""
    good, bad = (F.count_if(F.col("verdict") == text) for text in (GOOD, BAD))
    return runs.groupBy(section).agg(
        good.alias("n_good"), bad.alias("n_bad"), (bad == 0).alias("all_good")
    )

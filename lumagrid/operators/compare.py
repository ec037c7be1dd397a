"""Cell-by-cell comparison of two results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Verdict texts of a comparison.
GOOD, BAD = "Good calculation", "Bad calculation"


def differs(a: Column, b: Column, tolerance: float = 0.0) -> Column:
    """True where a value is missing on one side, NaN, or further off than the tolerance."""
    missing = a.isNull() != b.isNull()
    nan = F.isnan(a.cast("double")) | F.isnan(b.cast("double"))
    apart = (a != b) if tolerance == 0 else (F.abs(a - b) > tolerance)
    return F.coalesce(missing | nan | apart, missing)


def diff_cells(
    left: DataFrame, right: DataFrame, keys: list[str], value: str = "v", tolerance: float = 0.0
) -> DataFrame:
    """The cells in which two tables with unique keys differ."""
    return _aligned(left, right, keys, value).where(differs(F.col("a"), F.col("b"), tolerance))


def results_diff(
    left: DataFrame, right: DataFrame, keys: list[str], value: str = "v", tolerance: float = 0.0
) -> DataFrame:
    """One row: cells in all, cells that differ, cells on one side only, and the verdict."""
    n_diff = F.count_if(differs(F.col("a"), F.col("b"), tolerance))
    return (
        _aligned(left, right, keys, value)
        .agg(
            F.count(F.lit(1)).alias("n_cells"),
            n_diff.alias("n_different"),
            F.count_if(F.col("in_b").isNull()).alias("n_left_only"),
            F.count_if(F.col("in_a").isNull()).alias("n_right_only"),
        )
        .withColumn("verdict", F.when(F.col("n_different") == 0, GOOD).otherwise(BAD))
    )


def _aligned(left, right, keys, value) -> DataFrame:
    a = left.select(*keys, F.col(value).alias("a"), F.lit(True).alias("in_a"))
    b = right.select(*keys, F.col(value).alias("b"), F.lit(True).alias("in_b"))
    return a.join(b, keys, "full_outer")

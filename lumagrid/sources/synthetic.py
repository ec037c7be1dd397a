"""Random test matrices and vectors, reproducible under any partitioning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A prime modulus below 2^31 and multipliers that spread indexes over it.
_PRIME = 2_147_483_647
_ROW, _COLUMN, _SEED = 1_000_003, 7_919, 48_271


def random_digit(i, j, seed: int) -> Column:
    """A whole number 0..9 that depends on the cell and the seed only."""
    i, j = (F.col(c).cast("bigint") if isinstance(c, str) else c for c in (i, j))
    mixed = (F.pmod(i, F.lit(_PRIME)) * _ROW + F.pmod(j, F.lit(_PRIME)) * _COLUMN) % _PRIME
    mixed = (mixed + seed * _SEED + 1) % _PRIME
    mixed = (mixed * mixed + mixed) % _PRIME
    mixed = (mixed * mixed + 1) % _PRIME
    return (mixed % 10).cast("double")


def random_like(entries: DataFrame, seed: int = 0) -> DataFrame:
    """Random digits in the cells of another matrix."""
    return entries.select("i", "j", random_digit("i", "j", seed).alias("v"))


def random_matrix(spark: SparkSession, n: int, m: int | None = None, seed: int = 0) -> DataFrame:
    """An n x m matrix (square by default) of random digits."""
    m = n if m is None else m
    cells = spark.range(n * m).select(
        F.floor(F.col("id") / m).alias("i"), F.pmod("id", F.lit(m)).alias("j")
    )
    return random_like(cells.withColumn("v", F.lit(0.0)), seed)


def random_vector(spark: SparkSession, n: int, seed: int = 0) -> DataFrame:
    return spark.range(n).select(
        F.col("id").alias("i"), random_digit(F.col("id"), F.lit(0).cast("bigint"), seed).alias("v")
    )

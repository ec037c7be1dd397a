"""Row order inside groups without putting a whole group into one task.

A group is cut into blocks of bounded size whose order is known. Only a block
is sorted in one task; one summary row per block carries counts (or the last
value seen) from block to block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def position_in_group(
    df: DataFrame, group: str, block: Column, order: list, out: str
) -> DataFrame:
    """Add ``out``: the 0-based position of a row inside its group.

    ``block`` must not decrease along ``order`` and must bound the rows that
    share a (group, block) pair.
    """
    df = df.withColumn("_block", block)
    inside = Window.partitionBy(group, "_block").orderBy(*order)
    before = Window.partitionBy(group).orderBy("_block").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = (
        df.groupBy(group, "_block")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select(group, "_block", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    )
    ranked = df.withColumn("_inside", F.row_number().over(inside) - 1)
    return (
        ranked.join(offsets, [group, "_block"])
        .withColumn(out, F.col("_start") + F.col("_inside"))
        .drop("_block", "_inside", "_start")
    )


def carry_forward(
    df: DataFrame, group: list[str], block: str, order: list[str], columns: list[str]
) -> DataFrame:
    """Fill NULLs of ``columns`` with the last value seen earlier in the group."""
    inside = Window.partitionBy(*group, block).orderBy(*order).rowsBetween(
        Window.unboundedPreceding, 0
    )
    before = Window.partitionBy(*group).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    ordinal = F.struct(*order)
    lasts = df.groupBy(*group, block).agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), ordinal)).alias(c) for c in columns]
    )
    carried = lasts.select(
        *group,
        block,
        *[F.last(c, ignorenulls=True).over(before).alias(f"_carried_{c}") for c in columns],
    )
    filled = df.select(
        *[c for c in df.columns if c not in columns],
        *[F.last(c, ignorenulls=True).over(inside).alias(c) for c in columns],
    )
    return filled.join(carried, [*group, block]).select(
        *[c for c in df.columns if c not in columns],
        *[F.coalesce(F.col(c), F.col(f"_carried_{c}")).alias(c) for c in columns],
    )

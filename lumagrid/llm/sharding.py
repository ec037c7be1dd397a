"""Rendezvous hashing of stable record keys over weighted shards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumagrid.operators.lookup import attach
from lumagrid.settings import store

# Bits of a digest that become the draw of a (key, shard) pair; a double holds them exactly.
_BITS = 52


def _draw(key: Column, shard: int) -> Column:
    digest = F.md5(F.concat(F.coalesce(key.cast("string"), F.lit("null")), F.lit(f"#{shard}")))
    return (F.conv(F.substring(digest, 1, _BITS // 4), 16, 10).cast("double") + 0.5) / float(1 << _BITS)


def shard_of(key: Column, weights: list[float]) -> Column:
    """The shard (int) with the largest weighted draw for the key.

    Each pair of key and shard has a draw ``u`` in (0, 1) of its own and the score
    ``ln(u) / weight``; the highest score wins, a tie goes to the lower shard. A shard
    gets a share of the keys in proportion to its weight. Another shard at the end only
    takes keys into itself: no other pair changes. A shard of weight 0 takes no key.
    A null key is one more key.
    """
    if not any(w > 0 for w in weights):
        raise ValueError("at least one shard needs a positive weight")
    equal = len({w for w in weights if w > 0}) == 1
    scored = [
        F.struct(
            (_draw(key, i) if equal else F.ln(_draw(key, i)) / float(w)).alias("score"),
            F.lit(-i).alias("shard"),
        )
        for i, w in enumerate(weights)
        if w > 0
    ]
    best = scored[0] if len(scored) == 1 else F.greatest(*scored)
    return (-best["shard"]).cast("int")


def assign_shards(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    weights: list[float] | None = None,
    overhead: int = 16,
) -> DataFrame:
    """``(key, size, text_crc32, shard, slot, grown_shard)``: one row per row of ``df``.

    Args:
        weights: one positive number per shard (40 equal ones by default).
        overhead: bytes of a record besides those of its text.

    ``slot`` numbers the rows of a shard from 0 without gaps, in the order of key, size
    and checksum. ``grown_shard`` is the shard after one more of the last weight is added.
    Rows with equal keys share a shard and get slots of their own; a null text counts as
    empty; a null key comes first. Other columns of ``df`` are not read, so their names
    do not matter; an empty table gives an empty result.

    Rows are range-partitioned once as small records, numbered where they lie, and each
    part is moved up by the rows of the parts before it, so no shard is gathered anywhere.
    """
    weights = weights or [1.0] * 40
    body = F.coalesce(F.col(text), F.lit(""))
    records = df.select(
        F.col(key).alias("key"),
        (F.octet_length(body) + overhead).cast("long").alias("size"),
        F.crc32(F.encode(body, "UTF-8")).alias("text_crc32"),
        shard_of(F.col(key), weights).alias("shard"),
        shard_of(F.col(key), [*weights, weights[-1]]).alias("grown_shard"),
        # Lets a range boundary fall between rows that are alike in all else.
        F.monotonically_increasing_id().alias("row"),
    )
    order = ["key", "size", "text_crc32", "row"]
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    records, _ = store(
        records.repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id())
    )
    inside = Window.partitionBy("part", "shard").orderBy(*order)
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = records.groupBy("part", "shard").agg(F.count(F.lit(1)).alias("n"))
    starts = starts.select(
        "part", "shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")
    )
    placed = attach(
        records.withColumn("inside", F.row_number().over(inside) - 1), starts, ["part", "shard"]
    )
    return placed.select(
        F.col("key").alias(key),
        "size",
        "text_crc32",
        "shard",
        (F.col("start") + F.col("inside")).cast("long").alias("slot"),
        "grown_shard",
    )

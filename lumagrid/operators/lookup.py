"""Keyed lookups that neither broadcast unchecked tables nor shuffle hot keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumagrid.settings import HOT_SHARES, SALT_ROWS, broadcast_bytes, store


def attach(
    big: DataFrame,
    small: DataFrame,
    keys: list[str],
    weight: str | None = None,
    row_bytes: int = 64,
    how: str = "inner",
    n_rows: int | None = None,
) -> DataFrame:
    """Add the columns of ``small`` (one row per key) to every row of ``big``.

    ``small`` is stored first (unless it is stored and ``n_rows`` gives its
    size), so its size is known before the join is chosen:

    * up to the broadcast bound it is broadcast and ``big`` is not shuffled;
    * beyond it, keys holding at least a HOT_SHARES-th of the rows (by the
      ``weight`` column, the number of ``big`` rows per key) are broadcast -
      there are at most HOT_SHARES of them - and only the rest is shuffled.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"unsupported lookup: {how}")
    if n_rows is None:
        small, n_rows = store(small)
    limit = broadcast_bytes(big.sparkSession)
    if n_rows * row_bytes <= limit:
        return big.join(F.broadcast(small), keys, how)
    if weight is None:
        weight = "_weight"
        rows = big.groupBy(*keys).agg(F.count(F.lit(1)).alias(weight))
        return attach(big, small.join(rows, keys), keys, weight, row_bytes, how).drop(weight)

    shares = max(1, min(HOT_SHARES, limit // row_bytes))
    total = small.agg(F.sum(F.col(weight).cast("double"))).first()[0] or 0.0
    is_hot = F.col(weight).cast("double") * shares >= total
    hot = small.where(is_hot)
    hot_rows = big.join(F.broadcast(hot), keys)
    others = big.join(F.broadcast(hot.select(*keys)), keys, "left_anti")
    return hot_rows.unionByName(others.join(small.where(~is_hot), keys, how))


def salted_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    spread_by: list[str],
    rows_per_salt: int = SALT_ROWS,
) -> DataFrame:
    """Inner n:m join on ``key`` with the rows of large keys spread over a grid of salts.

    Keys of more than ``rows_per_salt`` rows of one side (and more than a HOT_SHARES-th of
    that side's rows, so there are at most twice HOT_SHARES such keys) get one salt for
    that many rows of each side. Every row of one side meets all salts of the other, so
    a task makes at most the products of two such shares. ``spread_by`` names columns of the
    left side; right rows are spread by all of theirs.
    """
    sides = []
    for rows, name in ((left, "_left"), (right, "_right")):
        counts, _ = store(rows.groupBy(key).agg(F.count(F.lit(1)).alias(name)))
        total = counts.agg(F.sum(name)).first()[0] or 0
        sides.append((counts, max(float(rows_per_salt), total / HOT_SHARES)))
    (lefts, left_share), (rights, right_share) = sides
    large = lefts.where(F.col("_left") > left_share).select(key).unionByName(
        rights.where(F.col("_right") > right_share).select(key)
    )
    hot = F.broadcast(large.distinct()).join(lefts, key).join(rights, key).select(
        key,
        F.ceil(F.col("_left") / F.lit(left_share)).cast("int").alias("_lefts"),
        F.ceil(F.col("_right") / F.lit(right_share)).cast("int").alias("_rights"),
    )
    hot, n_hot = store(hot)
    if not n_hot:
        return left.join(right, key)

    def placed(rows: DataFrame, own: str, other: str, by: list[str]) -> DataFrame:
        with_salts = rows.join(F.broadcast(hot), key, "left")
        salts = {n: F.coalesce(F.col(n), F.lit(1)) for n in ("_lefts", "_rights")}
        return (
            with_salts.withColumn("_own", F.pmod(F.xxhash64(*by), salts[own]).cast("int"))
            .withColumn("_other", F.explode(F.sequence(F.lit(0), salts[other] - 1)))
            .drop("_lefts", "_rights")
        )

    spread = placed(left, "_lefts", "_rights", spread_by).withColumnsRenamed(
        {"_own": "_salt", "_other": "_salt_right"}
    )
    copies = placed(right, "_rights", "_lefts", right.columns).withColumnsRenamed(
        {"_own": "_salt_right", "_other": "_salt"}
    )
    return spread.join(copies, [key, "_salt", "_salt_right"]).drop("_salt", "_salt_right")


def interval_index(df: DataFrame, value: Column, bounds, n_bounds: int, out: str) -> DataFrame:
    """Add ``out``: how many of the ascending ``bounds`` lie strictly below ``value``.

    A binary search written as one CASE per halving, so it stays in generated
    code. ``bounds`` is an array column of at most ``n_bounds`` entries.
    """
    step = 1
    while step * 2 - 1 < n_bounds:
        step *= 2
    df = df.withColumn("_value", value).withColumn(out, F.lit(0))
    while step >= 1:
        below = F.get(bounds, F.col(out) + (step - 1)) < F.col("_value")
        df = df.withColumn(out, F.col(out) + F.when(below, step).otherwise(0))
        step //= 2
    return df.drop("_value")

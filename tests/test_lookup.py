import random

import pytest
from pyspark.sql import functions as F

from lumagrid.operators import lookup, ordering


@pytest.fixture
def tight_broadcast(spark):
    """A broadcast bound that no table keeps, so the other ways are taken."""
    spark.conf.set("spark.lumagrid.broadcastBytes", "256")
    yield
    spark.conf.unset("spark.lumagrid.broadcastBytes")


def skewed(spark):
    # Key 0 holds a third of the rows, keys 1..99 the rest.
    rows = spark.range(3000).withColumn(
        "k", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 99 + 1)
    )
    stats = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("top"))
    return rows, stats


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_small_table_is_broadcast(spark):
    rows, stats = skewed(spark)
    joined = lookup.attach(rows, stats, ["k"], weight="n")
    assert "strategy=broadcast" in plan(joined)
    assert joined.count() == 3000


@pytest.mark.parametrize("weight", ["n", None])
@pytest.mark.parametrize("how", ["inner", "left"])
def test_large_table_broadcasts_hot_keys_only(spark, tight_broadcast, weight, how):
    rows, stats = skewed(spark)
    some = stats.where("k != 7")
    joined = lookup.attach(rows, some, ["k"], weight=weight, how=how)
    assert "Union" in plan(joined)
    want = rows.join(some, "k", how)
    assert sorted(joined.columns) == sorted(want.columns)
    got = joined.select(want.columns)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_salted_join_matches_plain_join(spark):
    rows, stats = skewed(spark)
    right = stats.select("k", "top").union(stats.select("k", -F.col("top")))
    want = rows.join(right, "k")
    got = lookup.salted_join(rows, right, "k", ["id"], rows_per_salt=100).select(want.columns)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    # The hot key's rows meet in several salts.
    assert "_salt" in plan(got)
    assert "_salt" not in plan(lookup.salted_join(rows, right, "k", ["id"]))


def test_salts_of_a_key_that_is_hot_on_the_right_only(spark):
    left = spark.createDataFrame([(k, i) for i, k in enumerate([0, 0, 1, 2])], "k int, id int")
    right = spark.createDataFrame([(0 if i % 3 else i, i) for i in range(900)], "k int, v int")
    want = left.join(right, "k")
    got = lookup.salted_join(left, right, "k", ["id"], rows_per_salt=50).select(want.columns)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    assert "_salt_right" in plan(got)


@pytest.mark.parametrize("n", [0, 1, 2, 3, 7, 8, 100, 255])
def test_interval_index(spark, n):
    rng = random.Random(n)
    bounds = sorted(rng.uniform(0, 1) for _ in range(n))
    values = [rng.uniform(-0.1, 1.1) for _ in range(50)] + bounds[:20]
    df = spark.createDataFrame([(v, bounds) for v in values], "v double, b array<double>")
    got = lookup.interval_index(df, F.col("v"), F.col("b"), n, "i").select("v", "i").collect()
    assert all(i == sum(b < v for b in bounds) for v, i in got)


def test_position_in_group(spark):
    rng = random.Random(1)
    keys = rng.sample(range(100_000), 2000)
    rows = [(k, 0 if rng.random() < 0.4 else rng.randrange(1, 9)) for k in keys]
    df = spark.createDataFrame(rows, "k bigint, grp int").repartition(7)
    placed = ordering.position_in_group(df, "grp", F.floor(F.col("k") / 100), ["k"], "pos")
    got = {(r.grp, r.k): r.pos for r in placed.collect()}
    assert len(got) == 2000
    for grp in range(9):
        ordered = sorted(k for k, g in rows if g == grp)
        assert [got[grp, k] for k in ordered] == list(range(len(ordered)))


def test_carry_forward_over_blocks(spark):
    rng = random.Random(2)
    marks = [rng.choice("ABC") if rng.random() < 0.05 else None for _ in range(500)]
    rows = [("f", i // 17, i, m) for i, m in enumerate(marks)]
    df = spark.createDataFrame(rows, "file string, block int, line int, mark string").repartition(5)
    got = ordering.carry_forward(df, ["file"], "block", ["line"], ["mark"])
    last, want = None, []
    for m in marks:
        last = m or last
        want.append(last)
    assert [r.mark for r in got.orderBy("line").collect()] == want

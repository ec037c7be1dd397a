import random
import statistics

import pytest

from lumagrid.operators import runs


@pytest.mark.parametrize("accuracy", [10_000, 20])
def test_exact_median(spark, monkeypatch, accuracy):
    monkeypatch.setattr(runs, "_SKETCH_ACCURACY", accuracy)
    rng = random.Random(accuracy)
    groups = {
        "one": [4.0],
        "two": [1.0, 2.0],
        "ties": [5.0] * 400 + [6.0] * 400,
        "odd": [rng.gauss(0, 1) for _ in range(3001)],
        "even": [round(rng.gauss(0, 1), 1) for _ in range(3000)],
    }
    rows = [(g, v) for g, vs in groups.items() for v in vs] + [("odd", None), ("empty", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(6)
    got = {r.g: r["median"] for r in runs.exact_median(df, "g", "v").collect()}
    assert got == {g: statistics.median(v) for g, v in groups.items()}


@pytest.mark.parametrize("rows_at_once", [100_000, 0])
def test_medians_of_several_columns(spark, monkeypatch, rows_at_once):
    """Also where the levels inside the brackets are dealt to blocks."""
    monkeypatch.setattr(runs, "PART_ROWS", rows_at_once)
    monkeypatch.setattr(runs, "_SKETCH_ACCURACY", 30)
    rng = random.Random(4)
    rows = [(f"g{i % 3}", rng.gauss(0, 1), rng.choice([None, rng.randrange(5)])) for i in range(5000)]
    rows += [("none", 1.0, None), (None, 2.0, 2)]
    df = spark.createDataFrame(rows, "g string, v double, w int").repartition(7)
    got = {r.g: (r.n_runs, r.mean_v, r.median_v, r.median_w) for r in
           runs.run_summary(df, "g", ["v"], medians=["v", "w"]).collect()}
    for g in ("g0", "g1", "g2"):
        v, w = ([r[k] for r in rows if r[0] == g and r[k] is not None] for k in (1, 2))
        assert got[g][0] == len([r for r in rows if r[0] == g])
        assert got[g][1] == pytest.approx(statistics.mean(v))
        assert got[g][2:] == (statistics.median(v), statistics.median(w))
    assert got["none"] == (1, 1.0, 1.0, None)


def test_summary_reads_its_runs_twice(spark):
    reads = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    df = spark.range(1000).selectExpr("id % 3 g", "id * 0.37e0 v", "id * id % 101 * 1e0 w").mapInArrow(count, "g long, v double, w double")
    runs.run_summary(df, "g", ["v", "w"], medians=["v", "w"]).collect()
    assert reads.value == 2000


def test_summaries(spark):
    rows = [("s", 2.0, 1.0, "Good calculation"), ("s", 6.0, 1.0, "Bad calculation"), ("t", 1.0, None, None)]
    df = spark.createDataFrame(rows, "section string, a double, b double, verdict string")
    timed = runs.with_speedup(df, "a", "b")
    got = {r.section: r for r in runs.run_summary(timed, "section", ["a", "ratio"]).collect()}
    assert (got["s"].n_runs, got["s"].mean_a, got["s"].min_ratio, got["s"].max_ratio) == (2, 4.0, 2.0, 6.0)
    assert got["t"].mean_ratio is None
    verdicts = {r.section: (r.n_good, r.n_bad, r.all_good) for r in runs.run_verdicts(df).collect()}
    assert verdicts["s"] == (1, 1, False)


def test_batch_and_worker_reports(spark):
    rows = [("log", "a", 1.0, 0), ("log", "b", 2.0, 1), ("gamma", "a", 4.0, 1)]
    df = spark.createDataFrame(rows, "operator string, file string, seconds double, worker int")
    batch = {r.operator: (r.n_files, r.total_seconds) for r in runs.batch_report(df).collect()}
    assert batch == {"log": (2, 3.0), "gamma": (1, 4.0)}
    assert runs.worker_report(df).count() == 3

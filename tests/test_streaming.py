import os

import pytest
from pyspark.sql import functions as F

from lumagrid.operators.raster import max_luminance
from lumagrid.plans.tonemap import tone_map
from lumagrid.settings import checkpoint_dir
from lumagrid.sources.pixels import HDR_SCHEMA
from lumagrid.streaming import drain
from lumagrid.streaming.drain import drain_folder, folder_report


def frame(spark, images):
    rows = [
        (i, y, x, 0.1 * i + y, 0.2 * x, 0.5) for i in images for y in range(3) for x in range(4)
    ]
    return spark.createDataFrame(rows, HDR_SCHEMA).coalesce(1)


def test_each_file_is_mapped_and_reported_once(spark, tmp_path):
    source = f"{tmp_path}/in"
    frame(spark, [1, 2]).write.parquet(source)
    frame(spark, [3]).write.mode("append").parquet(source)

    def drain():
        query = drain_folder(
            spark, source, f"{tmp_path}/out", f"{tmp_path}/report", f"{tmp_path}/state",
            op="log", files_per_batch=1,
        )
        query.awaitTermination()

    drain()
    frame(spark, [4]).write.mode("append").parquet(source)
    drain()
    drain()
    columns = ["image_id", "y", "x", "b", "g", "r"]
    got = spark.read.parquet(f"{tmp_path}/out").select(columns)
    want = tone_map(frame(spark, [1, 2, 3, 4]), "log").select(columns)
    assert got.exceptAll(want).isEmpty() and got.count() == 48
    report = spark.read.parquet(f"{tmp_path}/report")
    assert report.count() == 3
    assert report.agg(F.sum("n_images"), F.sum("n_pixels")).first() == (4, 48)


def test_files_and_batches_do_not_mix_images(spark, tmp_path):
    """Two files with one image each of the same id, and one without a row."""
    source = f"{tmp_path}/in"
    one = spark.createDataFrame([(1, 0, 0, 0.9, 0.9, 0.9), (1, 0, 1, 0.1, 0.1, 0.1)], HDR_SCHEMA)
    two = spark.createDataFrame([(1, 0, 0, 9.0, 9.0, 9.0), (1, 0, 1, 1.0, 1.0, 1.0)], HDR_SCHEMA)
    for part in (one, two, one.limit(0)):
        part.coalesce(1).write.mode("append").parquet(source)
    results = []
    for n in (1, 2, None):
        out = f"{tmp_path}/{n}"
        drain_folder(
            spark, source, f"{out}/out", f"{out}/report", f"{out}/state", files_per_batch=n
        ).awaitTermination()
        rows = spark.read.parquet(f"{out}/out").select("image_id", "y", "x", "b", "g", "r")
        results.append(sorted(map(tuple, rows.collect())))
        report = folder_report(spark, f"{out}/report").collect()
        assert sorted(r.n_pixels for r in report) == [0, 2, 2]
        assert {r.operator for r in report} == {"log"}
        assert all(r.seconds > 0 for r in report if r.n_pixels)
    assert results[0] == results[1] == results[2]
    assert max(r[3] for r in results[0]) == 255


def test_a_drain_that_stops_before_its_report_goes_on(spark, tmp_path, monkeypatch):
    source = f"{tmp_path}/in"
    for images in ([1], [2], [], [3]):
        frame(spark, images).write.mode("append").parquet(source)
    whole = drain.file_report
    calls = []

    def stops_once(*args):
        calls.append(args)
        if len(calls) == 2:
            raise RuntimeError("stopped between output and report")
        return whole(*args)

    monkeypatch.setattr(drain, "file_report", stops_once)

    def run():
        drain_folder(
            spark, source, f"{tmp_path}/out", f"{tmp_path}/report", f"{tmp_path}/state", files_per_batch=2
        ).awaitTermination()

    with pytest.raises(Exception, match="stopped between"):
        run()
    run()
    report = folder_report(spark, f"{tmp_path}/report").collect()
    assert sorted(r.n_pixels for r in report) == [0, 12, 12, 12]
    assert len({r.file for r in report}) == 4
    columns = ["image_id", "y", "x", "b", "g", "r"]
    got = spark.read.parquet(f"{tmp_path}/out").select(columns)
    assert got.exceptAll(tone_map(frame(spark, [1, 2, 3]), "log").select(columns)).isEmpty() and got.count() == 36


def test_an_image_in_several_files_has_its_maxima(spark, tmp_path):
    whole = frame(spark, [1, 2])
    whole.repartition(5, "y").write.parquet(f"{tmp_path}/in")
    drain_folder(
        spark, f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/report", f"{tmp_path}/state",
        files_per_batch=1, stats=max_luminance(whole),
    ).awaitTermination()
    columns = ["image_id", "y", "x", "b", "g", "r"]
    got = spark.read.parquet(f"{tmp_path}/out").select(columns)
    assert got.exceptAll(tone_map(whole, "log").select(columns)).isEmpty() and got.count() == 24


def test_batches_leave_no_stored_tables(spark, tmp_path):
    """Ten drains, and as many tables in the checkpoint folder as before."""
    source = f"{tmp_path}/in"
    folder = checkpoint_dir(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    for i in range(10):
        frame(spark, [i]).write.mode("append").parquet(source)
        drain_folder(
            spark, source, f"{tmp_path}/out", f"{tmp_path}/report", f"{tmp_path}/state"
        ).awaitTermination()
    assert set(os.listdir(folder)) == before

import struct
import zlib

import pytest
from pyspark.sql import functions as F

from lumagrid.operators.runs import with_speedup
from lumagrid.operators.tiles import pixels_from_tiles
from lumagrid.plans.report import run_report
from lumagrid.sources import images, pixels, reports


def png(width, height, colour_type, samples):
    def chunk(kind, data):
        body = kind + data
        return struct.pack(">I", len(data)) + body + struct.pack(">I", zlib.crc32(body))

    n = {0: 1, 2: 3, 6: 4}[colour_type]
    lines = b"".join(
        b"\0" + bytes(samples[y * width * n : (y + 1) * width * n]) for y in range(height)
    )
    header = struct.pack(">IIBBBBB", width, height, 8, colour_type, 0, 0, 0)
    return (
        b"\x89PNG\r\n\x1a\n"
        + chunk(b"IHDR", header)
        + chunk(b"IDAT", zlib.compress(lines))
        + chunk(b"IEND", b"")
    )


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "a.b.png").write_bytes(png(3, 2, 2, [10, 20, 30] * 3 + [1, 2, 3] * 3))
    (tmp_path / "gray one.png").write_bytes(png(2, 2, 0, [0, 50, 100, 255]))
    (tmp_path / "alpha.png").write_bytes(png(1, 1, 6, [7, 8, 9, 128]))
    (tmp_path / "junk.exr").write_bytes(b"no image at all")
    (tmp_path / "empty.png").write_bytes(b"")
    (tmp_path / "deeper").mkdir()
    (tmp_path / "deeper" / "unseen.png").write_bytes(png(1, 1, 0, [1]))
    return str(tmp_path)


def test_list_images(spark, folder):
    listed = images.list_images(spark, folder)
    assert {r["name"]: r["length"] > 0 for r in listed.collect()} == {
        "a.b.png": True, "gray one.png": True, "alpha.png": True, "junk.exr": True, "empty.png": False,
    }
    assert "content" not in listed._jdf.queryExecution().executedPlan().toString()


def test_subfolders_are_listed_level_by_level(spark, tmp_path):
    for name in ("a.png", "x/_b", "x/.c", "x/y/d e.png", "x/y/z/f%.png", "empty/none/g+h"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(b"" if name == "x/_b" else b"123")
    (tmp_path / "no files").mkdir()
    whole = images.list_images(spark, str(tmp_path), recursive=True)
    by_spark = images._listed_by_spark(spark, str(tmp_path), True)
    got = {(r.path, r["name"], r["length"]) for r in whole.collect()}
    assert got == {(r.path, r["name"], r["length"]) for r in by_spark.collect()}
    assert {n for _, n, _ in got} == {"a.png", "_b", ".c", "d e.png", "f%.png", "g+h"}
    assert [r["name"] for r in images.list_images(spark, str(tmp_path)).collect()] == ["a.png"]
    assert [r["name"] for r in images.list_images(spark, f"{tmp_path}/x/y/*.png").collect()] == ["d e.png"]
    assert images.list_images(spark, f"{tmp_path}/no files").count() == 0


def test_image_files_hold_their_pixels(spark, tmp_path):
    rows = [(i, y, x, i, 10 * y, 20 * x) for i in range(4) for y in range(3 + i) for x in range(5) if (y, x) != (1, 2)]
    rows += [(9, 0, 0, 300, -5, 7)]
    pixels_of = spark.createDataFrame(rows, "image_id int, y int, x int, b int, g int, r int").repartition(3)
    written = images.write_images(pixels_of, f"{tmp_path}/colour").collect()
    assert {(r.image_id, r.width, r.height) for r in written} == {*((i, 5, 3 + i) for i in range(4)), (9, 1, 1)}
    assert all(r["length"] == (tmp_path / "colour" / f"{r.image_id}.png").stat().st_size for r in written)
    back = {tuple(r) for r in images.load_image_pixels(spark, f"{tmp_path}/colour").collect()}
    want = {(f"{i}.png", y, x, *v) for i, y, x, *v in rows if i != 9} | {("9.png", 0, 0, 255, 0, 7)}
    assert back == want | {(f"{i}.png", 1, 2, 0, 0, 0) for i in range(4)}
    images.write_images(pixels_of.select("image_id", "y", "x", "g"), f"{tmp_path}/gray")
    gray = images.load_image_pixels(spark, f"{tmp_path}/gray", "gray")
    assert {(r.image_id, r.y, r.x): r.g for r in gray.collect()}["2.png", 4, 1] == 40


def test_load_pixels(spark, folder):
    colour = images.load_image_pixels(spark, folder)
    got = {(r.image_id, r.y, r.x): (r.b, r.g, r.r) for r in colour.collect()}
    assert len(got) == 6 + 4 + 1
    assert got["a.b.png", 0, 2] == (30, 20, 10) and got["a.b.png", 1, 0] == (3, 2, 1)
    assert got["gray one.png", 0, 1] == (50, 50, 50) and got["gray one.png", 1, 1] == (255,) * 3
    assert got["alpha.png", 0, 0] == (9, 8, 7)
    gray = images.load_image_pixels(spark, folder, "gray")
    levels = {(r.image_id, r.y, r.x): r.g for r in gray.collect()}
    assert levels["a.b.png", 0, 0] == round(30 * 0.114 + 20 * 0.587 + 10 * 0.299)
    assert levels["gray one.png", 1, 0] == 100
    with pytest.raises(ValueError):
        images.load_image_pixels(spark, folder, "cmyk")


def test_load_tiles(spark, folder):
    colour = images.load_image_pixels(spark, folder)
    cut = images.load_image_tiles(spark, folder, tile=2)
    assert {(r.image_id, r.ty, r.tx, r.height, r.width) for r in cut.collect()} == {
        ("a.b.png", 0, 0, 2, 2), ("a.b.png", 0, 1, 2, 1),
        ("gray one.png", 0, 0, 2, 2), ("alpha.png", 0, 0, 1, 1),
    }
    back = pixels_from_tiles(cut, tile=2)
    assert back.exceptAll(colour).isEmpty() and back.count() == colour.count()


def test_headers_and_unreadable(spark, folder):
    heads = {r["name"]: r for r in images.load_headers(spark, folder).collect()}
    assert set(heads) == {"a.b.png", "gray one.png", "alpha.png"}
    assert (heads["a.b.png"].width, heads["a.b.png"].height, heads["a.b.png"].mode) == (3, 2, 16)
    bad = images.unreadable_images(spark, folder)
    assert {r["name"] for r in bad.collect()} == {"junk.exr", "empty.png"}


def test_names_of_all_kinds(spark, tmp_path):
    flat, days = tmp_path / "flat", tmp_path / "days"
    flat.mkdir()
    one = png(1, 1, 0, [9])
    for name in ("a+b.png", "50%.png", "a%20b.png", "_under.png", ".hidden.png"):
        (flat / name).write_bytes(one)
    (flat / "_none").write_bytes(b"")
    for day, width in ((1, 1), (2, 3)):
        (days / f"day={day}").mkdir(parents=True)
        (days / f"day={day}" / "same.png").write_bytes(png(width, 1, 0, [day] * width))
    names = [r["name"] for r in images.list_images(spark, str(flat)).collect()]
    assert {"a+b.png", "50%.png", "a%20b.png", "_under.png", ".hidden.png", "_none"} <= set(names)
    ids = images.load_image_pixels(spark, str(flat)).select("image_id")
    assert {r.image_id for r in ids.collect()} == {"a+b.png", "50%.png", "a%20b.png"}
    days = images.load_image_pixels(spark, str(days)).groupBy("image_id").count()
    assert {tuple(r) for r in days.collect()} == {("day=1/same.png", 1), ("day=2/same.png", 3)}
    bad = {r["name"] for r in images.unreadable_images(spark, str(flat)).collect()}
    assert bad == {"_under.png", ".hidden.png", "_none"}


def test_short_rows_and_equal_titles(spark, tmp_path):
    lines = ["Image: a", "iteration,serial,serial,verdict", "1,2.0,9.0,Good", "2,3.0", "3,-,1.0,Bad,more"]
    (tmp_path / "log.csv").write_text("\n".join(lines) + "\n")
    (tmp_path / "bare.csv").write_text("1,2.0\n")
    log = reports.scan_run_log(spark, str(tmp_path))
    rows = reports.log_runs(log, {"serial": "serial", "verdict": "verdict"}).collect()
    got = sorted((r.iteration, str(r.serial), str(r.verdict)) for r in rows)
    assert got == [
        (1, "2.0", "Good"), (1, "None", "None"), (2, "3.0", "None"), (3, "None", "Bad"),
    ]


def test_hdr_scan_reads_only_what_is_asked(spark, tmp_path):
    rows = [(i, y, x, 0.5 * i, 1.0, 2.0) for i in range(3) for y in range(4) for x in range(4)]
    spark.createDataFrame(rows, pixels.HDR_SCHEMA).transform(
        lambda df: pixels.write_pixels(df, f"{tmp_path}/hdr") or df
    )
    back = pixels.load_hdr_pixels(spark, f"{tmp_path}/hdr")
    assert back.schema == pixels.HDR_SCHEMA and back.count() == 48
    plan = back.where("image_id = 2").select("b")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(image_id,2)" in plan and "ReadSchema: struct<image_id:int,b:float>" in plan


def test_write_ldr_one_folder_per_image(spark, tmp_path):
    rows = [(f"img{i}.v{i}.exr", y, x, 1, 2, 3) for i in range(3) for y in range(8) for x in range(8)]
    df = spark.createDataFrame(rows, "image_id string, y int, x int, b int, g int, r int")
    pixels.write_ldr(df, f"{tmp_path}/out", name="image_id")
    names = {p.name for p in (tmp_path / "out").iterdir() if p.is_dir()}
    assert names == {f"file=img{i}.v{i}.png" for i in range(3)}
    assert spark.read.parquet(f"{tmp_path}/out").count() == 3 * 64
    pixels.write_ldr(df, f"{tmp_path}/ids")
    assert spark.read.parquet(f"{tmp_path}/ids").groupBy("image_id").count().count() == 3


def test_write_report(spark, tmp_path):
    rows = [("test1.exr", 0.25, 2), ("test2.exr", 1.0, 1)]
    df = spark.createDataFrame(rows, "name string, seconds double, worker int")
    reports.write_report(df.coalesce(1), f"{tmp_path}/r", sep="|")
    text = "".join(p.read_text() for p in (tmp_path / "r").glob("*.csv"))
    assert text == "test1.exr|0.2500000000|2\ntest2.exr|1.0000000000|1\n"
    reports.write_report(df.drop("worker").coalesce(1), f"{tmp_path}/s", sep=";")
    text = "".join(p.read_text() for p in (tmp_path / "s").glob("*.csv"))
    assert text.splitlines()[0] == "test1.exr;0.2500000000"


MATRIX_LOG = """Matrix size: 10 x 10,,,,,
iteracion,secuencial,cuda,tiled,aceleracion,resultado
1,4.0,2.0,1.0,4.0,Good calculation
2,-,2.0,-,-,-
3,6.0,2.0,3.0,2.0,Bad calculation
Matrix size: 20 x 20,,,,,
iteracion,secuencial,cuda,tiled,aceleracion,resultado
1,8.0,4.0,2.0,4.0,Good calculation
"""

IMAGE_LOG = """**Image**: img1.jpg

iteracion|Host|OpenCV|aceleracion Host-OCV
:---:|:---:|:---:|:---:
1|2.0|1.0|2.0
2|4.0|1.0|4.0
**Promedios:**|**3,0**|**1,0**|**3,0**

**Image**: img2.jpg

iteracion|Host|OpenCV|aceleracion Host-OCV
:---:|:---:|:---:|:---:
1|9.0|3.0|3.0
Promedios:| | |
"""

BATCH_LOG = """**Operador: gamma**

imagen|tiempo|id worker
:---:|:---:|:---:
test3.exr|0.25|1
test1.exr|0.5|2
batch time|3.75|0
"""


def test_scan_matrix_log(spark, tmp_path):
    (tmp_path / "m.csv").write_text(MATRIX_LOG)
    log = reports.scan_run_log(spark, str(tmp_path), ",")
    columns = {
        "serial": "secuencial", "cuda": "cuda", "tiled": "tiled", "ratio": "aceleracion",
        "verdict": "resultado", "absent": "nothing",
    }
    runs = reports.log_runs(log, columns).orderBy("section", "iteration").collect()
    assert [(r.section, r.iteration, r.serial, r.tiled, r.verdict) for r in runs] == [
        ("10 x 10", 1, 4.0, 1.0, "Good calculation"),
        ("10 x 10", 2, None, None, None),
        ("10 x 10", 3, 6.0, 3.0, "Bad calculation"),
        ("20 x 20", 1, 8.0, 2.0, "Good calculation"),
    ]
    assert all(r.absent is None and r.cuda is not None for r in runs)


def test_scan_image_and_batch_logs(spark, tmp_path):
    (tmp_path / "i.md").write_text(IMAGE_LOG)
    (tmp_path / "b.md").write_text(BATCH_LOG)
    log = reports.scan_run_log(spark, str(tmp_path), "|")
    kinds = {(r.section, r.kind): r.n for r in log.groupBy("section", "kind").agg(
        F.count(F.lit(1)).alias("n")).collect()}
    assert kinds == {
        ("Image: img1.jpg", "run"): 2, ("Image: img1.jpg", "summary"): 1,
        ("Image: img2.jpg", "run"): 1, ("Image: img2.jpg", "summary"): 1,
        ("Operador: gamma", "run"): 2, ("Operador: gamma", "batch"): 1,
    }
    total = reports.log_batches(log).first()
    assert (total.section, total.seconds, total.worker) == ("gamma", 3.75, 0)
    summaries = {r.section: r for r in reports.log_summaries(log, {"host": "Host", "cv": "OpenCV"}).collect()}
    assert (summaries["img1.jpg"].host, summaries["img1.jpg"].cv) == (3.0, 1.0)
    assert summaries["img2.jpg"].host is None and summaries["img2.jpg"].label == "Promedios:"
    batch = reports.log_runs(log.where("section like 'Oper%'"), {"seconds": "tiempo"})
    assert {(r.label, r.seconds) for r in batch.collect()} == {("test3.exr", 0.25), ("test1.exr", 0.5)}


@pytest.mark.parametrize("split", ["64b", "200b"])
def test_scan_does_not_depend_on_splits(spark, tmp_path, split):
    lines = []
    for section in range(12):
        lines += [f"Matrix size: {section} x {section},,", "iteracion,secuencial,cuda"]
        lines += [f"{i},{section}.{i},1.0" for i in range(1, 21)]
    (tmp_path / "long.csv").write_text("\n".join(lines) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        log = reports.scan_run_log(spark, str(tmp_path), ",")
        assert log.select("split").distinct().count() > 10
        runs = reports.log_runs(log, {"serial": "secuencial", "cuda": "cuda"}).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    got = sorted((r.section, r.iteration, r.serial) for r in runs)
    want = sorted(
        (f"{s} x {s}", i, float(f"{s}.{i}")) for s in range(12) for i in range(1, 21)
    )
    assert got == want


def test_run_report(spark, tmp_path):
    (tmp_path / "m.csv").write_text(MATRIX_LOG)
    report = run_report(spark, str(tmp_path), ",", "secuencial", "tiled", "resultado")
    got = {r.section: r for r in report.collect()}
    ten = got["10 x 10"]
    assert (ten.n_runs, ten.mean_ratio, ten.median_ratio, ten.max_ratio) == (3, 3.0, 3.0, 4.0)
    assert (ten.n_good, ten.n_bad, ten.all_good) == (1, 1, False)
    assert got["20 x 20"].all_good and got["20 x 20"].mean_base == 8.0


def test_mean_of_ratios_is_no_ratio_of_means(spark, tmp_path):
    (tmp_path / "i.md").write_text(IMAGE_LOG)
    log = reports.scan_run_log(spark, str(tmp_path), "|")
    runs = with_speedup(reports.log_runs(log, {"host": "Host", "cv": "OpenCV"}), "host", "cv")
    assert sorted(r.ratio for r in runs.collect()) == [2.0, 3.0, 4.0]

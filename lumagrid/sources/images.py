"""Image folders: listing, decoding of 8-bit rasters, unreadable files, PNG files."""

from __future__ import annotations

import re
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumagrid.functions.pixel import bgr_to_gray
from lumagrid.operators.lookup import attach
from lumagrid.operators.stencil import TILE
from lumagrid.operators.tiles import TILE_COLUMNS, tile_row
from lumagrid.settings import store

# Image type codes of 8-bit rasters by number of channels.
GRAY_MODE, BGR_MODE, BGRA_MODE = 0, 16, 24

# Pixels per emitted batch, so that a large image leaves a task in pieces.
_BATCH_PIXELS = 1 << 20
_ENTRIES = 10_000  # of a folder in one batch


def list_images(spark: SparkSession, path: str, recursive: bool = False) -> DataFrame:
    """All files of a folder: path, name, length. Contents are not read.

    Files without a byte and names that begin with ``_`` or ``.`` are listed too. Folders are read by
    tasks, with ``recursive`` one level of subfolders after the other, where a task can open them
    (local and object stores); patterns and other stores are listed by Spark's own sources.
    """
    if re.search(r"[*?\[\]{}]", path) or not _opens_in_tasks(path):
        return _listed_by_spark(spark, path, recursive)
    folders, found = spark.createDataFrame([(path,)], "path string"), None
    while True:
        level, _ = store(folders.mapInArrow(_entries, "path string, length long, is_folder boolean"))
        files = level.where(~F.col("is_folder")).select("path", _name(F.col("path")).alias("name"), "length")
        found = files if found is None else found.unionByName(files)
        folders = level.where("is_folder").select("path")
        if not recursive or folders.isEmpty():
            return found
        folders = folders.repartition(spark.sparkContext.defaultParallelism)


def _opens_in_tasks(path: str) -> bool:
    try:
        fs.FileSystem.from_uri(path)
    except (pa.ArrowException, OSError, NotImplementedError):
        return False
    return True


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What folders hold, some thousand entries at a time."""
    for batch in batches:
        for path in batch.column(0).to_pylist():
            system, folder = fs.FileSystem.from_uri(path)
            infos = system.get_file_info(fs.FileSelector(folder, allow_not_found=True))
            for start in range(0, len(infos), _ENTRIES):
                part = infos[start : start + _ENTRIES]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(["/" + i.path.lstrip("/") for i in part], pa.string()),
                        pa.array([0 if i.size is None else i.size for i in part], pa.int64()),
                        pa.array([i.type == fs.FileType.Directory for i in part], pa.bool_()),
                    ],
                    names=["path", "length", "is_folder"],
                )


def _listed_by_spark(spark: SparkSession, path: str, recursive: bool) -> DataFrame:
    """The same by Spark's file source and, for what that leaves out, the folder's own listing."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    listed = reader.load(path).select(_path().alias("path"), "length")
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    rows = []
    if system.exists(folder):
        statuses = system.listFiles(folder, recursive)
        while statuses.hasNext():
            status = statuses.next()
            at = status.getPath()
            if status.getLen() == 0 or at.getName()[0] in "_.":
                rows.append((at.toUri().getPath(), status.getLen()))
    listed = listed.unionByName(spark.createDataFrame(rows, "path string, length long"))
    return listed.select("path", _name(F.col("path")).alias("name"), "length").dropDuplicates(["path"])


def write_images(pixels: DataFrame, path: str) -> DataFrame:
    """8-bit colour or gray pixels ``(image_id, y, x, [b,] g[, r])`` as PNG files named by their image.

    One row per file: image_id, width, height, length. Pixels that an image lacks are black; an image is
    encoded line by line as its sorted pixels pass by. A repeated task writes its files
    anew. The folder has to be one that all tasks can open.
    """
    colour = {"b", "r"} <= set(pixels.columns)
    channels = ["r", "g", "b"] if colour else ["g"]
    sizes = pixels.groupBy("image_id").agg(
        (F.max("y") + 1).cast("int").alias("height"),
        (F.max("x") + 1).cast("int").alias("width"),
        F.count(F.lit(1)).alias("n"),
    )
    named = attach(pixels.select("image_id", "y", "x", *channels), sizes, ["image_id"], weight="n").drop("n")
    kind = dict(named.dtypes)["image_id"]

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, folder = fs.FileSystem.from_uri(path)
        system.create_dir(folder, recursive=True)
        done: list[tuple] = []
        at, image = None, None
        for batch in batches:
            ids = batch.column("image_id").to_pylist()
            y, x, height, width = (batch.column(c).to_numpy() for c in ("y", "x", "height", "width"))
            values = np.stack([batch.column(c).to_numpy() for c in channels], axis=1)
            bounds = [i for i in range(len(ids)) if i == 0 or ids[i] != ids[i - 1]] + [len(ids)]
            for start, end in zip(bounds, bounds[1:]):
                if image is None or ids[start] != at:
                    if image is not None:
                        done.append(image.close())
                    at = ids[start]
                    image = PngFile(system, f"{folder}/{at}.png", at, int(width[start]), int(height[start]), len(channels))
                image.add(y[start:end], x[start:end], values[start:end])
        if image is not None:
            done.append(image.close())
        kinds = [batch.column("image_id").type, pa.int32(), pa.int32(), pa.int64()] if done else []
        if done:
            columns = [pa.array(c, t) for c, t in zip(zip(*done), kinds)]
            yield pa.RecordBatch.from_arrays(columns, names=["image_id", "width", "height", "length"])

    dealt = named.repartition("image_id").sortWithinPartitions("image_id", "y", "x")
    return store(dealt.mapInArrow(write, f"image_id {kind}, width int, height int, length long"))[0]


def write_files(files: DataFrame, path: str) -> DataFrame:
    """Rows ``(name, content)`` as files below a folder that all tasks can open: name, length."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, folder = fs.FileSystem.from_uri(path)
        for batch in batches:
            lengths = []
            for name, content in zip(batch.column("name").to_pylist(), batch.column("content").to_pylist()):
                at = f"{folder}/{name}"
                system.create_dir(at.rpartition("/")[0], recursive=True)
                part = f"{folder}/{uuid.uuid4().hex}"
                with system.open_output_stream(part) as out:
                    out.write(content or b"")
                system.move(part, at)
                lengths.append(len(content or b""))
            yield pa.RecordBatch.from_arrays(
                [batch.column("name"), pa.array(lengths, pa.int64())], names=["name", "length"]
            )

    return store(files.select("name", "content").mapInArrow(write, "name string, length long"))[0]


class PngFile:
    """An 8-bit gray or RGB image that is written line by line, under its name once it is whole."""

    def __init__(self, system: fs.FileSystem, path: str, image, width: int, height: int, channels: int):
        self.system, self.path, self.image, self.width, self.height = system, path, image, width, height
        self.part = f"{path}.{uuid.uuid4().hex}"
        self.out, self.length = system.open_output_stream(self.part), 0
        self.packer = zlib.compressobj()
        self.line, self.row = np.zeros((width, channels), np.uint8), 0
        header = struct.pack(">IIBBBBB", width, height, 8, 2 if channels == 3 else 0, 0, 0, 0)
        self._put(b"\x89PNG\r\n\x1a\n")
        self._chunk(b"IHDR", header)

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.length += len(data)

    def _chunk(self, kind: bytes, data: bytes) -> None:
        self._put(struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data)))

    def _end_lines(self, row: int) -> None:
        packed = b""
        while self.row < row:
            packed += self.packer.compress(b"\0" + self.line.tobytes())
            self.line[:] = 0
            self.row += 1
        if packed:
            self._chunk(b"IDAT", packed)

    def add(self, y: np.ndarray, x: np.ndarray, values: np.ndarray) -> None:
        """Pixels of the next lines, in order."""
        starts = np.flatnonzero(np.append(True, y[1:] != y[:-1]))
        for start, end in zip(starts, np.append(starts[1:], len(y))):
            self._end_lines(int(y[start]))
            self.line[x[start:end]] = np.clip(values[start:end], 0, 255)

    def close(self) -> tuple:
        self._end_lines(self.height)
        self._chunk(b"IDAT", self.packer.flush())
        self._chunk(b"IEND", b"")
        self.out.close()
        self.system.move(self.part, self.path)
        return self.image, self.width, self.height, self.length


def load_headers(spark: SparkSession, path: str) -> DataFrame:
    """Readable images: origin, name, width, height, channels and type code."""
    image = _images(spark, path)
    return image.select(
        "path",
        _name(F.col("path")).alias("name"),
        F.col("image.width").alias("width"),
        F.col("image.height").alias("height"),
        F.col("image.nChannels").alias("n_channels"),
        F.col("image.mode").alias("mode"),
    )


def load_image_pixels(spark: SparkSession, path: str, mode: str = "colour") -> DataFrame:
    """8-bit images of a folder as pixel rows.

    ``image_id`` is the file's path below the folder, so its name if it lies directly in it.
    ``colour`` gives b, g, r; ``gray`` gives g, rounded. Gray files have three
    equal channels in colour mode; an alpha channel is left out.
    """
    channels = _decoded(spark, path).mapInArrow(
        _pixels, "image_id string, y int, x int, b int, g int, r int"
    )
    if mode == "colour":
        return channels
    if mode == "gray":
        return channels.select("image_id", "y", "x", bgr_to_gray(mode="round").alias("g"))
    raise ValueError(f"unknown mode: {mode}")


def load_image_tiles(spark: SparkSession, path: str, tile: int = TILE) -> DataFrame:
    """8-bit images of a folder as colour tiles, without a row per pixel on the way."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                name, width, n, _, data = (batch.column(c)[row] for c in range(5))
                image = np.frombuffer(data.as_buffer(), np.uint8)
                image = image.reshape(-1, width.as_py(), n.as_py())
                image = image[:, :, :3] if n.as_py() >= 3 else np.repeat(image[:, :, :1], 3, axis=2)
                for top in range(0, image.shape[0], tile):
                    for left in range(0, image.shape[1], tile):
                        part = image[top : top + tile, left : left + tile]
                        yield tile_row(
                            (name.as_py(), top // tile, left // tile), part, pa.string()
                        )

    return _decoded(spark, path).mapInArrow(cut, f"image_id string, {TILE_COLUMNS}")


def unreadable_images(spark: SparkSession, path: str) -> DataFrame:
    """Files of a folder that are no image this engine can decode."""
    readable = load_headers(spark, path).where(
        F.col("mode").isin(GRAY_MODE, BGR_MODE, BGRA_MODE)
    )
    return list_images(spark, path).join(readable.select("path"), "path", "left_anti")


def _decoded(spark: SparkSession, path: str) -> DataFrame:
    return (
        _images(spark, path)
        .select(
            _below(spark, path).alias("image_id"),
            F.col("image.width").alias("width"),
            F.col("image.nChannels").alias("n"),
            F.col("image.mode").alias("mode"),
            F.col("image.data").alias("data"),
        )
        .where(F.col("mode").isin(GRAY_MODE, BGR_MODE, BGRA_MODE))
    )


def _images(spark: SparkSession, path: str) -> DataFrame:
    return (
        spark.read.format("image")
        .option("dropInvalid", True)
        .load(path)
        .select("image", _path().alias("path"))
        .where((F.col("image.width") > 0) & (F.col("image.height") > 0))
    )


def _path():
    """The path of a row's file: without the scheme, only percent signs decoded."""
    encoded = F.regexp_replace(F.col("_metadata.file_path"), "^[A-Za-z0-9+.-]+:/+", "/")
    return F.url_decode(F.replace(encoded, F.lit("+"), F.lit("%2B")))


def _name(path):
    return F.element_at(F.split(path, "/"), -1)


def _below(spark: SparkSession, folder: str):
    """The path of a file relative to the folder it was loaded from; whole for a pattern."""
    root = spark._jvm.org.apache.hadoop.fs.Path(folder)
    root = root.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(root).toUri().getPath()
    root = root.rstrip("/") + "/"
    at = F.col("path")
    return F.when(at.startswith(root), F.substr(at, F.lit(len(root) + 1))).otherwise(at)


def _pixels(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(batch.num_rows):
            name, width, n, _, data = (batch.column(c)[row] for c in range(5))
            name, width, n = name.as_py(), width.as_py(), n.as_py()
            flat = np.frombuffer(data.as_buffer(), dtype=np.uint8).reshape(-1, n)
            for start in range(0, len(flat), _BATCH_PIXELS):
                part = flat[start : start + _BATCH_PIXELS].astype(np.int32)
                at = np.arange(start, start + len(part), dtype=np.int32)
                bgr = [part[:, c if n >= 3 else 0] for c in range(3)]
                yield pa.record_batch(
                    {
                        "image_id": pa.array([name]).take(pa.array(np.zeros(len(part), np.int32))),
                        "y": pa.array(at // width),
                        "x": pa.array(at % width),
                        "b": pa.array(bgr[0]),
                        "g": pa.array(bgr[1]),
                        "r": pa.array(bgr[2]),
                    }
                )

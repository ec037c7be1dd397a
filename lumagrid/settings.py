"""Size bounds and lineage handling shared by the operators."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# A table is broadcast only when its row count times its row width stays below this.
BROADCAST_BYTES = 64 << 20

# A key is "hot" when it holds at least one HOT_SHARES-th of the rows, so there
# can never be more than HOT_SHARES hot keys.
HOT_SHARES = 2000

# Rows of one join key that a single task may take before the key is salted.
SALT_ROWS = 1_000_000


def broadcast_bytes(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.lumagrid.broadcastBytes", str(BROADCAST_BYTES)))


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder that the session names.

    Only a local session without such a setting gets a folder of its own.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if shared is None:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            shared = tempfile.mkdtemp(prefix="run-checkpoint-")
        context.setCheckpointDir(shared)
    return context.getCheckpointDir()


# Rows of a small table that one partition holds.
PART_ROWS = 100_000

_open_scopes: list[list[str]] = []


@contextlib.contextmanager
def stored_scope(spark: SparkSession) -> Iterator[None]:
    """Removes the tables that ``store`` writes inside it when it ends.

    For steps that are done by then: what they return must not read these tables, but for
    those that were stored with ``outlives``.
    """
    paths: list[str] = []
    _open_scopes.append(paths)
    try:
        yield
    finally:
        _open_scopes.remove(paths)
        remove_stored(spark, paths)


def remove_stored(spark: SparkSession, paths: list[str]) -> None:
    for path in paths:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def store(df: DataFrame, outlives: bool = False) -> tuple[DataFrame, int]:
    """``df`` as a table in the checkpoint folder, and its number of rows.

    It is computed once; what reads it later neither recomputes it nor depends
    on executors that may be lost, and its size is known. With ``outlives`` it belongs to
    the scope around the innermost one, as the result of that.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/{uuid.uuid4().hex}"
    scopes = _open_scopes[:-1] if outlives else _open_scopes
    if scopes:
        scopes[-1].append(path)
    rows = Observation()
    df.observe(rows, F.count(F.lit(1)).alias("n")).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), rows.get["n"]


def sized(df: DataFrame, rows: int, rows_per_part: int = PART_ROWS) -> DataFrame:
    """``df`` in no more partitions than its rows (at most ``rows``) and the cores of the session ask for.

    For tables whose size is known and may be far below what the number of shuffle
    partitions is meant for.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.coalesce(max(cores, -(-rows // rows_per_part)))


def cut_lineage(df: DataFrame) -> DataFrame:
    return store(df)[0]

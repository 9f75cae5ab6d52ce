"""Session settings the library relies on."""

from __future__ import annotations

import atexit
import math
import shutil
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache

from pyspark.sql import DataFrame, SparkSession

# Runtime settings. Skewed joins are left to adaptive execution, which must be allowed to
# add a shuffle where a later step wanted to reuse the skewed partitioning. Rows that come sorted
# by the keys of a group are aggregated in one pass.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.replaceHashWithSortAgg": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}

# Bytes of compressed input; as shuffled rows they are several times as many.
BYTES_PER_SHUFFLE_TASK = 20 * 1024 * 1024


def configure(spark: SparkSession, input_bytes: int | None = None) -> SparkSession:
    """Apply the runtime settings to a session that already exists.

    ``input_bytes`` are the bytes of the input files; the pipeline measures them. Adaptive execution merges small shuffle partitions but never adds partitions to a
    balanced shuffle, so the starting number is sized from the input when it is known; a greater
    number that the session has already stays.
    """
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    if input_bytes is not None:
        wanted = math.ceil(input_bytes / BYTES_PER_SHUFFLE_TASK)
        given = int(spark.conf.get("spark.sql.shuffle.partitions"))
        spark.conf.set("spark.sql.shuffle.partitions", str(max(wanted, given, 8)))
    return spark


def build_session(app_name: str = "reshelve", master: str | None = None,
                  settings: dict[str, str] | None = None) -> SparkSession:
    """Create a session; memory and connector settings are the caller's to pass."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for name, value in {**SETTINGS, **(settings or {})}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


@cache
def _local_folder() -> str:
    folder = tempfile.mkdtemp(prefix="reshelve-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def shared_folder(spark: SparkSession) -> str:
    """The shared folder for intermediate tables.

    A cluster names it in ``spark.checkpoint.dir``. Only a local session may fall back to a
    folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        return _local_folder()
    raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")


REMOVE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Queries begun in here remove their shuffle files when they end.

    Else the files go when the driver collects garbage, which may be long after. For queries whose
    rows nothing reads again, such as writes.
    """
    before = spark.conf.get(REMOVE_SHUFFLES, "false")
    spark.conf.set(REMOVE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(REMOVE_SHUFFLES, before)


def stored(df: DataFrame) -> DataFrame:
    """The rows of a frame written to the shared folder and read from there.

    This cuts the lineage and survives the loss of executors. The folder is the one the cluster
    names; a session without one gets it from :func:`shared_folder`.
    """
    spark = df.sparkSession
    if spark.conf.get("spark.checkpoint.dir", None) is None:
        context = spark.sparkContext
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(shared_folder(spark))
    return df.checkpoint()

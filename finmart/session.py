"""Session settings and the shared work folder."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import threading
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


BYTES_PER_SHUFFLE_PARTITION = 512 << 20


def shuffle_partitions(input_bytes: int, cores: int = 8) -> int:
    """Initial shuffle partitions for an input size; AQE merges the small ones afterwards.

    AQE never splits an ordinary shuffle, so the start has to be large enough: 100 TB at
    the default of 200 would put half a terabyte into every task.
    """
    return max(cores, -(-input_bytes // BYTES_PER_SHUFFLE_PARTITION))


def build_session(
    app_name: str = "finmart", master: str | None = None, input_bytes: int | None = None, **conf: str
) -> SparkSession:
    """Session with the settings the plans assume: UTC, ANSI casts and AQE.

    ``input_bytes`` sizes the shuffles for the expected input; ``conf`` overrides anything.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
    }
    if input_bytes is not None:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions(input_bytes))
    for key, value in {**settings, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def private_folder(master: str) -> str:
    if not re.fullmatch(r"local(\[[^\]]*\])?", master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    folder = tempfile.mkdtemp(prefix="finmart-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def work_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: the cluster's ``spark.checkpoint.dir``.

    A private folder is made only for a local master, where one machine does all the work, and
    removed when the process ends. On a cluster it would leave every executor its own part.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        folder = private_folder(context.master)
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return folder.rstrip("/")


@contextmanager
def configured(spark: SparkSession, **conf: str) -> Iterator[None]:
    """Session settings for the queries that start inside; names as in ``spark.sql``, with ``__`` for a dot."""
    wanted = {"spark.sql." + name.replace("__", "."): value for name, value in conf.items()}
    before = {name: spark.conf.get(name, None) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_removing: list[str | None] = []  # the setting before, once for every block that is open
_removing_lock = threading.Lock()


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of DataFrames made and collected inside go with the end of the query, not with the next
    garbage collection of the driver. One that is collected again computes its shuffle again.

    Blocks may be open in several threads; the last one to end restores the setting.
    """
    with _removing_lock:
        _removing.append(_removing[0] if _removing else spark.conf.get(SHUFFLE_CLEANUP, None))
        spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        with _removing_lock:
            before = _removing.pop()
            if not _removing:
                spark.conf.unset(SHUFFLE_CLEANUP) if before is None else spark.conf.set(SHUFFLE_CLEANUP, before)


def cut_lineage(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept as files in the work folder, which outlive executors."""
    work_dir(df.sparkSession)
    with shuffles_removed(df.sparkSession):
        return df.select("*").checkpoint()  # a frame made before the block would keep its shuffle files

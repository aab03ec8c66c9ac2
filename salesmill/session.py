"""Session, layer databases and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from dataclasses import dataclass
from functools import cache

from pyspark.sql import DataFrame, SparkSession

SHUFFLE_PARTITION_BYTES = 128 * 1024 * 1024
# What adaptive execution gives one task of a shuffle, compressed, at most. Lines take some 25 times that in
# the sorts and hash maps of a join with an aggregation above it, and more than a task's memory is spilled.
TASK_BYTES = 16 * 1024 * 1024
ADVISORY_SIZE = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
# A partition of a join beyond both of these, bytes and times the median, is split: 256 MB and 5 are Spark's own.
SKEWED_BYTES, SKEWED_TIMES = TASK_BYTES * 3 // 2, 2.0
SKEWED_SIZE = "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes"
SKEWED_FACTOR = "spark.sql.adaptive.skewJoin.skewedPartitionFactor"
# Adaptive execution merges pieces of a shuffle but splits no even ones: their number follows the input.
FIRST_PIECES = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
MOST_PIECES = 4096

# What the plans rely on. ANSI arithmetic makes an amount that does not fit raise, where it
# would become null and drop out of its sum. Forcing the skew rule matters where an aggregation reuses the
# partitioning of the join below it: unforced, Spark would rather leave a hot key in one
# task than add a shuffle. Shuffle files go when the write or action that made them is over: without that they stay
# until the driver's garbage happens to be collected, and a job of several writes holds those of all.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}


# Parquet tables are merged by re-pointing; the others bring a MERGE of their own.
TABLE_FORMATS = ("parquet", "delta", "iceberg")


def quoted(name: str) -> str:
    """A name for SQL text or a column reference, whatever characters it has."""
    return "`" + name.replace("`", "``") + "`"


def quoted_table(name: str) -> str:
    """A table's name with its database's before a dot."""
    return ".".join(map(quoted, name.split(".")))


def literal(text: str) -> str:
    """A string for SQL text."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


@dataclass(frozen=True)
class Layers:
    """Where the three layers live: a database each, and the format of their tables.

    ``root`` gives the databases a location of their own; without it they go to the
    session's warehouse folder, which on a cluster must be shared storage.
    """

    bronze: str = "bronze"
    silver: str = "silver"
    gold: str = "gold"
    root: str | None = None
    table_format: str = "parquet"

    def __post_init__(self) -> None:
        if self.table_format not in TABLE_FORMATS:
            raise ValueError(f"table_format {self.table_format!r}: one of {TABLE_FORMATS}")

    def create(self, spark: SparkSession) -> "Layers":
        if not self.root and not _is_local(spark) and _on_this_machine(spark.conf.get("spark.sql.warehouse.dir")):
            raise RuntimeError("root, or spark.sql.warehouse.dir, must name a folder all executors share")
        for database in (self.bronze, self.silver, self.gold):
            place = f" LOCATION {literal(f'{self.root}/{database}')}" if self.root else ""
            spark.sql(f"CREATE SCHEMA IF NOT EXISTS {quoted(database)}{place}")
        return self


LAYERS = Layers()


def get_spark_session(
    app_name: str = "sales-analytics",
    layers: Layers = LAYERS,
    input_bytes: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Get a session with the layer databases in place.

    With ``input_bytes`` (the size of the largest table a job shuffles) the first
    shuffle is cut into pieces of about 128 MB; adaptive execution then merges the
    small ones and splits the skewed ones. Memory and cores stay deployment settings.
    """
    builder = SparkSession.builder.appName(app_name)
    if input_bytes:
        pieces = max(200, -(-input_bytes // SHUFFLE_PARTITION_BYTES))
        builder = builder.config(FIRST_PIECES, str(pieces))
    for key, value in (conf or {}).items():
        builder = builder.config(key, value)
    spark = configure(builder.getOrCreate())
    layers.create(spark)
    return spark


def configure(spark: SparkSession, input_bytes: int | None = None) -> SparkSession:
    """Give a session that was made elsewhere the settings the plans rely on. Tasks of less than ``TASK_BYTES``
    stay as small as the session has them.

    With ``input_bytes`` (the stored size of all tables that are joined) shuffles begin with a piece for each
    ``TASK_BYTES / 2`` of it, ``MOST_PIECES`` at most and never fewer than the session has.
    """
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    in_bytes = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    for key, most in ((ADVISORY_SIZE, TASK_BYTES), (SKEWED_SIZE, SKEWED_BYTES)):
        if in_bytes(spark.conf.get(key)) > most:
            spark.conf.set(key, f"{most}b")
    if float(spark.conf.get(SKEWED_FACTOR)) > SKEWED_TIMES:
        spark.conf.set(SKEWED_FACTOR, str(SKEWED_TIMES))
    if input_bytes:
        pieces = min(MOST_PIECES, -(-input_bytes // (TASK_BYTES // 2)))
        if pieces > int(spark.conf.get(FIRST_PIECES, None) or spark.conf.get("spark.sql.shuffle.partitions")):
            spark.conf.set(FIRST_PIECES, str(pieces))
    return spark


def stored_bytes(spark: SparkSession, *paths: str) -> int:
    """Size of the files at and below ``paths``; what is not there has none."""
    size = 0
    for path in map(spark._jvm.org.apache.hadoop.fs.Path, paths):
        store = path.getFileSystem(spark._jsc.hadoopConfiguration())
        size += store.getContentSummary(path).getLength() if store.exists(path) else 0
    return size


def scratch_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder under the cluster's shared ``spark.checkpoint.dir``.

    A folder set by ``setCheckpointDir`` serves too. Only a local session may do without
    either; it gets one temporary folder, removed when the program ends. Within
    ``owned_scratch`` it is a folder of the owner.
    """
    return f"{_OWNER.get() or _scratch_base(spark)}/{purpose}-{uuid.uuid4().hex}"


def _scratch_base(spark: SparkSession) -> str:
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not _is_local(spark):
            raise RuntimeError("spark.checkpoint.dir must name a folder all executors share")
        base = _local_scratch()
    return base.rstrip("/")


# The folder that scratch folders are made in while one task owns them.
_OWNER: ContextVar[str | None] = ContextVar("scratch_owner", default=None)


@contextmanager
def owned_scratch(spark: SparkSession, purpose: str) -> Iterator[str]:
    """A folder that holds all scratch folders made within, and is removed when the work is done.

    For work that leaves nothing lazy behind. If it fails its folder stays, since what has been written
    may be needed to finish it; an owner within another is part of that one.
    """
    if _OWNER.get():
        yield _OWNER.get()
        return
    folder = f"{_scratch_base(spark)}/{purpose}-{uuid.uuid4().hex}"
    token = _OWNER.set(folder)
    try:
        yield folder
    finally:
        _OWNER.reset(token)
    remove_folder(spark, folder)


def remove_folder(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def remove_file(spark: SparkSession, file_path: str) -> None:
    """A file as ``_metadata.file_path`` names it, if it is there."""
    path = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(file_path))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, False)


def _is_local(spark: SparkSession) -> bool:
    return spark.conf.get("spark.master", "").startswith("local")


def _on_this_machine(folder: str) -> bool:
    return ":" not in folder or folder.startswith("file:")


@cache
def _local_scratch() -> str:
    folder = tempfile.mkdtemp(prefix="sales-scratch-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def stage(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    Cuts the lineage: what follows neither recomputes ``df`` nor depends on the
    executors that produced it.
    """
    folder = scratch_folder(df.sparkSession, purpose)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)

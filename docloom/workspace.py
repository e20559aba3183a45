"""Where intermediate tables live, and the few file-system calls the engine needs."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: Above this many rows a side is never hinted for broadcast.
BROADCAST_ROW_LIMIT = 200_000
#: Above this many bytes on disk a stored table is never hinted for broadcast.
BROADCAST_BYTE_LIMIT = 64 * 1024 * 1024


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach, taken from ``spark.checkpoint.dir``.

    Only a local master, where driver and executors share a disk, may fall back to a
    temporary folder; elsewhere a missing setting is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    folder = tempfile.mkdtemp(prefix="docloom-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_root(spark)}/docloom/{label}-{uuid.uuid4().hex}"


def file_system(spark: SparkSession, path: str):
    """(Hadoop file system, Hadoop path) of ``path``."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, target = file_system(spark, path)
    return fs.exists(target)


def is_directory(spark: SparkSession, path: str) -> bool:
    fs, target = file_system(spark, path)
    return fs.exists(target) and fs.getFileStatus(target).isDirectory()


def delete_path(spark: SparkSession, path: str) -> bool:
    """Remove a path; True when nothing is left there."""
    fs, target = file_system(spark, path)
    if fs.exists(target):
        fs.delete(target, True)
    return not fs.exists(target)


def bytes_under(spark: SparkSession, path: str) -> int:
    fs, target = file_system(spark, path)
    return fs.getContentSummary(target).getLength() if fs.exists(target) else 0


def modified_at(spark: SparkSession, path: str) -> float:
    """When a file or folder was last changed, in epoch seconds."""
    fs, target = file_system(spark, path)
    return fs.getFileStatus(target).getModificationTime() / 1000.0


def child_names(spark: SparkSession, pattern: str) -> list[str]:
    """Last path parts matching a glob; used on version folders only."""
    fs, target = file_system(spark, pattern)
    found = fs.globStatus(target)
    return [] if found is None else [status.getPath().toString() for status in found]


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file of ASCII text."""
    fs, target = file_system(spark, path)
    out = fs.create(target, True)
    try:
        out.writeBytes(text)
    finally:
        out.close()


def local_frame(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType | str) -> DataFrame:
    """A DataFrame of a few driver-side rows, such as configuration, kept in the plan itself."""
    kind = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    columns = to_arrow_schema(kind)
    table = pa.Table.from_pylist([dict(zip(kind.names, row)) for row in rows], schema=columns)
    return spark.createDataFrame(table, schema=kind)


def broadcast_if_small(df: DataFrame, rows: int | None = None) -> DataFrame:
    """Hint a broadcast when the row count, taken here unless known, proves the side small.

    Beyond the limit the frame is returned unhinted: the join then runs as a shuffled
    join, where adaptive execution splits skewed partitions.
    """
    size = df.count() if rows is None else rows
    return F.broadcast(df) if size <= BROADCAST_ROW_LIMIT else df


def stage(df: DataFrame, label: str, path: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder, or to ``path``, and read it back.

    Cuts the lineage, so that later passes see the same rows even if the source moves
    on, and survives the loss of executors.
    """
    spark = df.sparkSession
    target = path or fresh_path(spark, label)
    df.write.mode("errorifexists").parquet(target)
    return spark.read.schema(df.schema).parquet(target)


class Stage:
    """Staged tables that are removed again when the work that needs them is done."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: list[str] = []

    def __call__(self, df: DataFrame, label: str) -> DataFrame:
        self.paths.append(fresh_path(self.spark, label))
        return stage(df, label, self.paths[-1])

    def __enter__(self) -> Stage:
        return self

    def __exit__(self, *_exc) -> None:
        for path in self.paths:
            delete_path(self.spark, path)

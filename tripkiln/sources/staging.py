"""Staged intermediate tables in the cluster's shared checkpoint folder.

A plan that is read by several branches (statistics and the fill of the
imputation; the count branches of the gold stage) would otherwise recompute
its whole input, e.g. parse the raw CSV once per branch. Writing it once as
parquet cuts the lineage (a lost executor recomputes from the staged files,
not from the source) and lets every branch read only the columns it needs.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from tripkiln.session import checkpoint_dir

#: Wide rows take about a third less as zstd than as snappy.
CODEC = "zstd"


def _new_path(spark: SparkSession, label: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/tripkiln-stage/{label}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_end(spark: SparkSession) -> Iterator[None]:
    """Spark removes the shuffle files of a write in this block when the write
    ends: what is read from then on is what was written. (Otherwise they stay
    until the driver's JVM collects its garbage, those of all steps side by side.)"""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def stage(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` as parquet under ``spark.checkpoint.dir`` and read it back.

    The folder stays until the caller removes it (:func:`remove`); use
    :func:`staged` where the copy has a known end."""
    spark = df.sparkSession
    path = _new_path(spark, label)
    with shuffles_end(spark):
        df.write.mode("error").parquet(path)
    return spark.read.parquet(path)


def stage_all(frames: Iterable[DataFrame], label: str = "stage") -> DataFrame:
    """Like :func:`stage` for the rows of several frames, one after another:
    no two of them have shuffle files at the same time."""
    path = ""
    for df in frames:
        spark = df.sparkSession
        path = path or _new_path(spark, label)
        with shuffles_end(spark):
            df.write.mode("append").option("compression", CODEC).parquet(path)
    return spark.read.parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a staged folder through the cluster's file system client;
    raises where it cannot, as staged rows may hold personal data."""
    try:
        jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    except AttributeError as e:
        raise RuntimeError(f"this session has no file system client; remove {path} by hand") from e
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(conf)
    if not fs.delete(p, True) and fs.exists(p):
        raise RuntimeError(f"could not remove staged folder {path}")


def size_of(spark: SparkSession, path: str) -> int:
    """Bytes of a folder's files (0: it does not exist)."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.getContentSummary(p).getLength() if fs.exists(p) else 0


@contextmanager
def staged(df: DataFrame, label: str = "stage") -> Iterator[DataFrame]:
    """Like :func:`stage`, and delete the staged copy when the block ends.

    Everything that reads the staged frame must have run (written its
    output) inside the block.
    """
    spark = df.sparkSession
    path = _new_path(spark, label)
    try:
        with shuffles_end(spark):
            df.write.mode("error").option("compression", CODEC).parquet(path)
        yield spark.read.parquet(path)
    finally:
        remove(spark, path)

"""Tables on storage: scans, versioned replacement, CSV."""

from __future__ import annotations

import time
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fraudlens.session import stage

_VERSION = "version="


def read_table(
    spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType | None = None
) -> DataFrame:
    """A table scan (S5); with ``schema`` no file is opened to infer one."""
    reader = spark.read.format(fmt)
    return (reader.schema(schema) if schema else reader).load(path)


def read_table_or_none(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame | None:
    """A table scan, or None where there is no table."""
    try:
        return read_table(spark, path, fmt)
    except AnalysisException as error:
        if error.getCondition() in {"PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"}:
            return None
        raise


def replace_table(
    df: DataFrame, path: str, fmt: str = "parquet", keep: int | None = None
) -> str:
    """Replace a table (S7) and return the path written.

    Formats with transactions overwrite in place.  Plain files go to a new version folder, so
    readers of the old version are not disturbed and ``df`` may read the table it replaces.
    With ``keep`` only so many newest finished versions stay; readers of older ones must be done.
    """
    if keep is not None and keep < 1:
        raise ValueError("keep at least one version")
    if fmt == "delta":
        df.write.format(fmt).mode("overwrite").save(path)
        return path
    target = f"{path}/{_VERSION}{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    df.write.format(fmt).save(target)
    if keep is not None:
        fs, versions = _versions(df.sparkSession, path)
        for old in sorted(versions, key=lambda v: v.toString())[:-keep]:
            fs.delete(old, True)
    return target


def _versions(spark: SparkSession, path: str) -> tuple:
    """The file system of ``path`` and its finished versions."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return fs, []
    return fs, [
        entry.getPath()
        for entry in fs.listStatus(folder)
        if entry.getPath().getName().startswith(_VERSION)
        and fs.exists(jvm.org.apache.hadoop.fs.Path(entry.getPath(), "_SUCCESS"))
    ]


def current_version(spark: SparkSession, path: str) -> str | None:
    """Path of the newest finished version under ``path``, or None."""
    _, versions = _versions(spark, path)
    return max((v.toString() for v in versions), default=None)


def read_current(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame | None:
    """The newest version of a table written by :func:`replace_table`, or None."""
    if fmt == "delta":
        return read_table_or_none(spark, path, fmt)
    version = current_version(spark, path)
    return None if version is None else read_table(spark, version, fmt)


def read_latest(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The newest version of a versioned table, or a plain table as it is."""
    return read_table(spark, current_version(spark, path) or path, fmt)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A headered CSV with an explicit schema."""
    return spark.read.csv(path, schema=schema, header=True, mode="FAILFAST")


def number_rows(df: DataFrame, name: str = "row_id") -> DataFrame:
    """Rows of a file scan with their 0-based position, files by path and rows by place.

    A file may be read in several splits. A row's place in its split is its distance to the
    split's first row; the rows before a split are added up over one row per split, staged so that
    the optimizer knows its size when it joins. ``df`` is a scan without filters.
    """
    columns = df.columns
    keys = ["_file", "_split"]
    placed = df.select(
        "*",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_split"),
        F.monotonically_increasing_id().alias("_id"),
    )
    sizes = placed.groupBy(*keys).agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        *keys, "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")
    )
    position = F.col("_start") + F.col("_id") - F.col("_first")
    return placed.join(stage(starts, "splits"), keys).select(position.alias(name), *columns)


def write_csv(df: DataFrame, path: str, label: str | None = None) -> None:
    """A headered CSV without index; the label is written as an integer."""
    if label:
        df = df.withColumn(label, F.col(label).cast("int"))
    df.write.csv(path, header=True)

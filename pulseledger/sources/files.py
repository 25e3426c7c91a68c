"""Folders of Parquet files: existence, removal, and the swap of whole partitions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _located(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    files, target = _located(spark, path)
    return files.exists(target)


def has_tables(spark: SparkSession, folder: str) -> bool:
    """Whether a folder holds Parquet files."""
    files, target = _located(spark, f"{folder}/*.parquet")
    return len(files.globStatus(target) or []) > 0


def delete(spark: SparkSession, path: str) -> None:
    files, target = _located(spark, path)
    files.delete(target, True)


def mark(spark: SparkSession, path: str) -> None:
    """Create an empty file."""
    files, target = _located(spark, path)
    files.create(target, True).close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Replace a small file."""
    files, target = _located(spark, path)
    out = files.create(target, True)
    out.write(bytearray(text.encode()))
    out.close()


def read_text(spark: SparkSession, path: str) -> str | None:
    if not exists(spark, path):
        return None
    files, target = _located(spark, path)
    source = files.open(target)
    text = bytes(source.readAllBytes()).decode()
    source.close()
    return text


def stored(df: DataFrame, path: str) -> DataFrame:
    """Replace the folder with ``df`` and read it back."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def swap_partitions(rows: DataFrame, target: str, column: str, values: Iterable, sort_by: str) -> None:
    """Replace the partitions of ``column`` at ``target`` by those in ``rows``.

    ``values`` names all partitions that are replaced; those without rows are
    removed. Nothing else is read or written, and running it again changes
    nothing. ``rows`` must not read from ``target``.
    """
    spark = rows.sparkSession
    (
        rows.hint("rebalance", F.col(column))
        .sortWithinPartitions(column, sort_by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(column)
        .parquet(target)
    )
    left = {row[0] for row in rows.select(column).distinct().collect()}
    for value in set(values) - left:
        delete(spark, f"{target.rstrip('/')}/{column}={value}")

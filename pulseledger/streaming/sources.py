"""File streams of raw relations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_stream(spark: SparkSession, path: str, schema: T.StructType, max_files: int | None = None) -> DataFrame:
    """Parquet files arriving under ``path`` (a folder or a glob).

    ``max_files`` bounds a micro-batch. Staging works on the result as it
    does on a table: the look-up map joins as a static relation.
    """
    reader = spark.readStream.schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)

"""Scans of the raw relations, from tables or files."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import Config
from .schemas import RAW_SCHEMAS

TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
_FILE_FORMATS = {".orc": "orc", ".json": "json", ".jsonl": "json", ".parquet": "parquet"}


def source_location(cfg: Config, name: str) -> str:
    """Path or qualified table name of a source, after all overrides."""
    target = cfg.sources.get(name, name)
    if "/" in target or "." in target:
        return target
    return ".".join(part for part in (cfg.source_database, cfg.source_schema, target) if part)


def read_seed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header, matched to ``schema`` by column name.

    Columns the file lacks stay absent, so later stages can tell "no such
    column" from "empty".
    """
    # The header decides the column order; only its single line is read here.
    header = spark.read.option("header", True).csv(path).columns
    declared = {f.name.lower(): f for f in schema.fields}
    fields = [declared.get(c.lower(), T.StructField(c, T.StringType())) for c in header]
    return (
        spark.read.schema(T.StructType(fields))
        .option("header", True)
        .option("timestampFormat", TIMESTAMP_FORMAT)
        .option("mode", "FAILFAST")
        .csv(path)
    )


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast the declared columns that are present; keep everything else."""
    declared = {f.name.lower(): f.dataType for f in schema.fields}
    columns = []
    for f in df.schema.fields:
        wanted = declared.get(f.name.lower(), f.dataType)
        column = F.col(f"`{f.name}`")
        # A cast to the same type would only get in the way of push-down.
        columns.append(column if wanted == f.dataType else column.cast(wanted).alias(f.name))
    return df.select(*columns)


def read_source(spark: SparkSession, cfg: Config, name: str) -> DataFrame:
    location = source_location(cfg, name)
    schema = RAW_SCHEMAS[name]
    if "/" not in location:
        return conform(spark.table(location), schema)
    suffix = os.path.splitext(location.rstrip("/"))[1].lower()
    if suffix == ".csv":
        return read_seed(spark, location, schema)
    reader = spark.read.format(_FILE_FORMATS.get(suffix, "parquet"))
    if suffix in (".json", ".jsonl"):
        reader = reader.schema(schema).option("timestampFormat", TIMESTAMP_FORMAT)
    return conform(reader.load(location), schema)


def read_tracks(spark: SparkSession, cfg: Config) -> DataFrame:
    return read_source(spark, cfg, "tracks")


def read_pages(spark: SparkSession, cfg: Config) -> DataFrame:
    return read_source(spark, cfg, "pages")


def read_identifies(spark: SparkSession, cfg: Config) -> DataFrame:
    return read_source(spark, cfg, "identifies")


def read_users(spark: SparkSession, cfg: Config) -> DataFrame:
    return read_source(spark, cfg, "users")


def read_groups(spark: SparkSession, cfg: Config) -> DataFrame:
    return read_source(spark, cfg, "groups")

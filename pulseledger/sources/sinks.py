"""Views, tables and alert output; the session upsert is in ``session_store``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.sessions import SESSION_DATE
from .session_store import forget, read_sessions, upsert_sessions, with_session_date  # noqa: F401  (re-exported)


def register(df: DataFrame, name: str) -> DataFrame:
    """Name a relation as a lazy view."""
    df.createOrReplaceTempView(name)
    return df


def _is_path(target: str) -> bool:
    return "/" in target


def write_table(df: DataFrame, target: str, partition_by: Sequence[str] = (), sort_by: Sequence[str] = ()) -> DataFrame:
    """Replace a table or Parquet folder with ``df`` and read it back.

    Partitioned output is clustered by the partition columns first, so that a
    task does not open a file in every partition. The rebalance hint, unlike
    a repartition, lets the runtime split a partition value with much data
    into several files.
    """
    out = df
    if partition_by:
        out = out.hint("rebalance", *[F.col(c) for c in partition_by])
    if sort_by:
        out = out.sortWithinPartitions(*partition_by, *sort_by)
    writer = out.write.mode("overwrite").format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    spark = df.sparkSession
    if _is_path(target):
        writer.save(target)
        return spark.read.parquet(target)
    writer.saveAsTable(target)
    return spark.table(target)


def write_sessions(sessions: DataFrame, target: str) -> DataFrame:
    """Replace the session table, partitioned by start day."""
    if _is_path(target):
        forget(sessions.sparkSession, target)
    return write_table(with_session_date(sessions), target, [SESSION_DATE], ["user_id"])


def write_alerts(alerts: DataFrame, path: str) -> None:
    """Alert rows as JSON lines, for whatever delivers them."""
    alerts.write.mode("overwrite").json(path)

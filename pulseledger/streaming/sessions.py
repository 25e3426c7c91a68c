"""Sessions over event streams.

Two forms. ``streaming_sessions`` emits a session once, when the watermark
says it can no longer grow; later events for it are dropped. The upsert form
keeps the session table current and takes late events in, at once or set aside
first.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from ..config import Config
from ..functions import second_diff, surrogate_key
from ..sources import files
from ..sources.session_store import upsert_sessions


def streaming_sessions(events: DataFrame, cfg: Config, delay: str = "1 hour") -> DataFrame:
    """Closed sessions of a stream of (user_id, account_id, event_at).

    Windows run over minute starts, so that a gap is measured in minute
    boundaries as in batch; two of them merge when the later starts no later
    than the earlier ends, which makes the window gap equal the timeout. The
    key is made of user and start, because a position in the user's history
    is not known while events may still be late.
    """
    minutes = events.selectExpr("user_id", "account_id", "event_at", "date_trunc('MINUTE', event_at) AS minute_at")
    windows = (
        minutes.withWatermark("minute_at", delay)
        .groupBy("user_id", F.session_window("minute_at", f"{cfg.session_timeout_minutes} minutes"))
        .agg(
            F.expr("min(struct(event_at, account_id)) AS first_event"),
            F.expr("max(event_at) AS session_end_at"),
            F.expr("count(*) AS events_in_session"),
        )
    )
    flat = windows.selectExpr(
        "user_id",
        "first_event.event_at AS session_start_at",
        "session_end_at",
        "events_in_session",
        "first_event.account_id AS account_id",
    )
    return flat.selectExpr(
        f"{surrogate_key('user_id', 'unix_micros(session_start_at)')} AS session_key",
        "user_id",
        "session_start_at",
        "session_end_at",
        f"{second_diff('session_start_at', 'session_end_at')} AS session_duration_seconds",
        "events_in_session",
        "account_id",
    )


def emit_sessions(sessions: DataFrame, path: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Append closed sessions to Parquet files, exactly once.

    ``once`` works off what has arrived and then stops.
    """
    writer = sessions.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    if once:
        writer = writer.trigger(availableNow=True)
    return writer.start(path)


def upsert_sessions_stream(
    events: DataFrame, path: str, checkpoint: str, cfg: Config, once: bool = False, delay: timedelta | None = None
) -> StreamingQuery:
    """Merge each micro-batch into the session table at ``path``.

    A repeated micro-batch keeps its id, which the upsert recognises. With
    ``delay``, rows older than the newest row of earlier batches less the delay
    are set aside in ``<path>_late`` with their batch, so that a stream never
    rewrites old days; ``reconcile_late`` merges them when that suits.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        rows = batch if delay is None else _set_late_aside(batch, path, batch_id, delay)
        upsert_sessions(rows, path, batch_id, cfg.session_timeout_minutes)

    writer = events.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    if once:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def _set_late_aside(batch: DataFrame, path: str, batch_id: int, delay: timedelta) -> DataFrame:
    """The rows of a batch that are not late; the others are written.

    The watermark in force is noted before the batch is split, so that a
    repeated batch is split in the same way.
    """
    spark, notes = batch.sparkSession, f"{path.rstrip('/')}_watermark"
    own = f"{notes}/before-{batch_id}"
    before = files.read_text(spark, own)
    if before is None:
        before = files.read_text(spark, f"{notes}/current") or ""
        files.write_text(spark, own, before)
        files.delete(spark, f"{notes}/before-{batch_id - 1}")
    is_late = f"coalesce(unix_micros(event_at) < {before}L, false)" if before else "false"
    late = batch.filter(is_late).withColumn("batch", F.lit(batch_id))
    late.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(late_path(path))
    newest = batch.selectExpr("unix_micros(max(event_at))").first()[0]
    reached = [int(before)] if before else []
    if newest is not None:
        reached.append(newest - delay // timedelta(microseconds=1))
    if reached:
        files.write_text(spark, f"{notes}/current", str(max(reached)))
    return batch.filter(f"NOT ({is_late})")


def late_path(path: str) -> str:
    return f"{path.rstrip('/')}_late"


def late_rows(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Rows set aside so far, of the stream's ``schema``, with the ``batch`` they came in."""
    schema = StructType([*schema.fields, StructField("batch", LongType())])
    found = files.exists(spark, late_path(path))
    return spark.read.schema(schema).parquet(late_path(path)) if found else spark.createDataFrame([], schema)


def reconcile_late(spark: SparkSession, path: str, schema: StructType, cfg: Config) -> int:
    """Merge the late rows not merged yet; returns how many there were.

    The range of batches is noted first: an interrupted call is finished by the
    next one with the same rows under the same id.
    """
    notes = f"{path.rstrip('/')}_watermark"
    late = late_rows(spark, path, schema)
    pending = files.read_text(spark, f"{notes}/reconciling")
    if pending is None:
        done = int(files.read_text(spark, f"{notes}/reconciled") or -1)
        last = late.filter(f"batch > {done}").selectExpr("max(batch)").first()[0]
        if last is None:
            return 0
        pending = f"{done} {last}"
        files.write_text(spark, f"{notes}/reconciling", pending)
    done, last = map(int, pending.split())
    rows = late.filter(f"batch > {done} AND batch <= {last}")
    upsert_sessions(rows.drop("batch"), path, f"late-{done}-{last}", cfg.session_timeout_minutes)
    files.write_text(spark, f"{notes}/reconciled", str(last))
    files.delete(spark, f"{notes}/reconciling")
    return rows.count()

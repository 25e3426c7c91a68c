"""The stored session table, its state per user, and the upsert that keeps both.

Beside the table at ``path``, which is partitioned by start day, ``<path>_users``
holds one row per user: last index, last end and the days on which sessions
start, in hash buckets. A batch reads the buckets of its users, learns from them
which days of the table can change, and reads and rewrites only those days. A
user whose events are newer than all stored ones costs the last start day, or
nothing if the last session is over.

``<path>_log/batch=<id>`` has a batch's complete outcome before any of it is
copied. A batch that was interrupted or is delivered again is repeated with its
id: a complete log is copied again and not computed again. A batch with a marker
is done, unless a day that it wrote has lost its files while the log is there, and once
a later batch is in, only the marker is left of its log. A batch
makes a fixed number of file-system calls, however many came before it.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import aggregate, minute_diff
from ..operators import activity
from ..operators.sessions import SESSION_COLUMNS, SESSION_DATE, number_from, sessionize, sessionize_minutes
from ..session import side_by_side
from . import files

STATE_BUCKETS = 32
# Names a state that covers the whole table; readers skip names that begin with _.
_READY = "_ready"
_STATE = "user_id string, last_index long, last_end_at timestamp, start_days array<date>, bucket int"


def _bucket(user: str) -> str:
    return f"CAST(pmod(xxhash64({user}), {STATE_BUCKETS}) AS INT) AS bucket"


@dataclass(frozen=True)
class Again:
    """Users whose sessions are computed anew from all their events.

    ``users`` has their user_id, each once. ``minutes`` gives the minute roll-up of these
    users over the days it is handed (those their stored sessions lie on) and
    over any other days on which they may have gained events.
    """

    users: DataFrame
    minutes: Callable[[Sequence[date]], DataFrame]


def with_session_date(sessions: DataFrame) -> DataFrame:
    """Add the physical partition column: the day a session starts."""
    return sessions.withColumn(SESSION_DATE, F.to_date("session_start_at"))


def read_sessions(spark: SparkSession, path: str) -> DataFrame:
    """The stored session table; empty if nothing was stored yet."""
    schema = with_session_date(sessionize(spark.createDataFrame([], "user_id string, account_id string, event_at timestamp"))).schema
    return spark.read.schema(schema).parquet(path) if files.exists(spark, path) else spark.createDataFrame([], schema)


def forget(spark: SparkSession, path: str) -> None:
    """Drop state and logs of a table that is replaced as a whole."""
    for folder in (f"{path.rstrip('/')}_users", f"{path.rstrip('/')}_log"):
        files.delete(spark, folder)


def _read_state(spark: SparkSession, path: str) -> DataFrame:
    """State of all users; a table without one is read once to make it."""
    folder = f"{path.rstrip('/')}_users"
    if not files.exists(spark, f"{folder}/{_READY}"):
        if not files.exists(spark, path):
            return spark.createDataFrame([], _STATE)
        state = aggregate(
            read_sessions(spark, path),
            ["user_id"],
            "max(user_session_index) AS last_index",
            "max(session_end_at) AS last_end_at",
            f"array_sort(collect_set({SESSION_DATE})) AS start_days",
        ).selectExpr("*", _bucket("user_id"))
        state.hint("rebalance", F.col("bucket")).write.mode("overwrite").partitionBy("bucket").parquet(folder)
        files.mark(spark, f"{folder}/{_READY}")
    return spark.read.schema(_STATE).parquet(folder)


def upsert_sessions(new_events: DataFrame, path: str, batch_id: int | str, timeout_minutes: int = 30) -> None:
    """Merge a batch of events (user_id, account_id, event_at) into the table.

    Events may be late by any time and arrive in any order.
    """
    update_sessions(activity.minutes(new_events), path, batch_id, timeout_minutes)


def update_sessions(minutes: DataFrame, path: str, batch_id: int | str, timeout_minutes: int = 30, again: Again | None = None) -> None:
    """As ``upsert_sessions`` for a minute roll-up, optionally with users whose
    sessions are computed anew (their rows in ``minutes`` are not used)."""
    spark = minutes.sparkSession
    root = f"{path.rstrip('/')}_log"
    log = f"{root}/batch={batch_id}"
    if files.exists(spark, f"{log}/applied") and not _has_lost_days(spark, log, path):
        return
    if not files.exists(spark, f"{log}/rows/_SUCCESS"):
        _plan(minutes, path, log, timeout_minutes, again)
    _copy(spark, log, path)
    _mark_applied(spark, root, log)


def _has_lost_days(spark: SparkSession, log: str, path: str) -> bool:
    """Whether a day that the batch has written is without files, though its log is still there."""
    if not files.exists(spark, f"{log}/rows/_SUCCESS"):
        return False
    days = spark.read.schema(f"{SESSION_DATE} date").parquet(f"{log}/rows").distinct().collect()
    return not all(files.has_tables(spark, f"{path.rstrip('/')}/{SESSION_DATE}={row[0]}") for row in days)


def replaced_and_new(spark: SparkSession, path: str, batch_id: int | str) -> tuple[DataFrame, DataFrame]:
    """Sessions that the latest batch replaced, and those it put in their place."""
    log = f"{path.rstrip('/')}_log/batch={batch_id}"
    schema = read_sessions(spark, path).select(*SESSION_COLUMNS).schema
    return spark.read.schema(schema).parquet(f"{log}/removed"), spark.read.schema(schema).parquet(f"{log}/changes")


def _reach(touched: DataFrame, known: DataFrame, timeout_minutes: int) -> DataFrame:
    """Per user of the batch the first day whose sessions may change (null: none)
    and the index that a session after all stored ones has.

    Only the last session that starts on a day before the first new event can
    reach it from an earlier day; the ones before are over.
    """
    state = known.selectExpr("user_id AS known_user", "last_index", "last_end_at", "start_days")
    joined = touched.join(state, F.expr("user_id <=> known_user"), "left")
    is_over = f"{minute_diff('last_end_at', 'earliest_at')} > {timeout_minutes}"
    open_from = f"""CASE WHEN start_days IS NULL OR (NOT again AND {is_over}) THEN NULL WHEN again THEN start_days[0]
        ELSE coalesce(array_max(filter(start_days, d -> d < to_date(earliest_at))), start_days[0]) END"""
    return joined.selectExpr(
        "user_id AS reach_user", "bucket", "earliest_at", "again", f"{open_from} AS open_from",
        "coalesce(last_index + 1, 0L) AS next_index", "coalesce(start_days, array()) AS old_days",
    )


def _plan(minutes: DataFrame, path: str, log: str, timeout_minutes: int, again: Again | None) -> None:
    """Write the outcome of a batch to its log; ``rows`` last."""
    spark = minutes.sparkSession
    minutes = files.stored(minutes, f"{log}/minutes")
    touched = aggregate(minutes, ["user_id"], "min(first_at) AS earliest_at").selectExpr("*", "false AS again")
    if again is not None:
        anew = again.users.selectExpr("user_id", "CAST(NULL AS TIMESTAMP) AS earliest_at", "true AS again")
        others = again.users.withColumnRenamed("user_id", "other_user")
        touched = touched.join(others, F.expr("user_id <=> other_user"), "left_anti").unionByName(anew)
    touched = files.stored(touched.selectExpr("*", _bucket("user_id")), f"{log}/touched")
    # At most one value per bucket; prunes the state below.
    buckets = [row[0] for row in touched.select("bucket").distinct().collect()]
    known = _read_state(spark, path).filter(F.col("bucket").isin(buckets))
    reach = files.stored(_reach(touched, known, timeout_minutes), f"{log}/reach")

    # One value per day; prunes the partitions read below.
    open_days = reach.selectExpr("explode(filter(old_days, d -> d >= open_from)) AS day").distinct()
    days = [row[0] for row in open_days.collect()]
    table = read_sessions(spark, path)
    loaded = table.filter(F.col(SESSION_DATE).isin(days)).join(reach, F.expr(f"user_id <=> reach_user AND {SESSION_DATE} >= open_from"))
    is_fixed = f"NOT again AND {minute_diff('session_end_at', 'earliest_at')} > {timeout_minutes}"
    tail = loaded.filter(f"NOT ({is_fixed})")

    changes = _merged(minutes, tail.filter("NOT again"), reach.filter("NOT again"), timeout_minutes)
    if again is not None:
        lies_on = "explode(sequence(to_date(session_start_at), to_date(session_end_at))) AS day"
        used = [row[0] for row in tail.filter("again").selectExpr(lies_on).distinct().collect()]
        changes = changes.unionByName(sessionize_minutes(again.minutes(used), timeout_minutes))
    changes, removed = side_by_side(
        lambda: files.stored(changes.select(*SESSION_COLUMNS), f"{log}/changes"),
        lambda: files.stored(tail.select(*SESSION_COLUMNS), f"{log}/removed"),
    )

    fixed = aggregate(loaded.filter(is_fixed), ["reach_user"], f"collect_set({SESSION_DATE}) AS fixed_days")
    state = _new_state(reach, changes, fixed).unionByName(known.join(reach, F.expr("user_id <=> reach_user"), "left_anti"))
    _, changed_days = side_by_side(lambda: files.stored(state, f"{log}/users"), lambda: _days(removed, changes))
    # Users are few against sessions, so the days are held against the users and not against the removed sessions.
    of = reach.select("reach_user", "earliest_at", "again", "open_from")
    affected = table.filter(F.col(SESSION_DATE).isin(changed_days)).join(of, F.expr("user_id <=> reach_user"), "left")
    kept = affected.filter(f"NOT coalesce({SESSION_DATE} >= open_from AND NOT ({is_fixed}), false)").select(*SESSION_COLUMNS)
    files.stored(with_session_date(kept.unionByName(changes)), f"{log}/rows")


def _merged(minutes: DataFrame, tail: DataFrame, reach: DataFrame, timeout_minutes: int) -> DataFrame:
    """New minutes merged with the sessions that may change, numbered on."""
    spans = tail.selectExpr(
        "user_id", "events_in_session AS n_events", "session_start_at AS first_at", "session_end_at AS last_at", "account_id",
        "user_session_index AS span_index",
    )
    # A new minute opens the next index, unless a stored session that may change comes before it.
    next_of = reach.selectExpr("reach_user", "next_index AS span_index")
    new = minutes.join(next_of, F.expr("user_id <=> reach_user"))
    return number_from(spans.unionByName(new.select(*spans.columns)), timeout_minutes)


def _new_state(reach: DataFrame, changes: DataFrame, fixed: DataFrame) -> DataFrame:
    """State of the users of a batch; users without sessions left have none."""
    now = aggregate(
        with_session_date(changes).withColumnRenamed("user_id", "changed_user"),
        ["changed_user"],
        "max(user_session_index) AS last_index",
        "max(session_end_at) AS last_end_at",
        f"collect_set({SESSION_DATE}) AS new_days",
    )
    fixed = fixed.withColumnRenamed("reach_user", "fixed_user")
    joined = reach.join(now, F.expr("reach_user <=> changed_user")).join(fixed, F.expr("reach_user <=> fixed_user"), "left")
    earlier = "filter(old_days, d -> open_from IS NULL OR d < open_from)"
    return joined.selectExpr(
        "reach_user AS user_id",
        "last_index",
        "last_end_at",
        f"array_sort(array_distinct(concat({earlier}, coalesce(fixed_days, array()), new_days))) AS start_days",
        "bucket",
    )


def _days(removed: DataFrame, changes: DataFrame) -> list[date]:
    """Start days of replaced and of new sessions: one value per changed day."""
    starts = removed.select("session_start_at").union(changes.select("session_start_at"))
    return [row[0] for row in starts.selectExpr("to_date(session_start_at) AS day").distinct().collect()]


def _copy(spark: SparkSession, log: str, path: str) -> None:
    """Swap the changed days and the buckets of the batch in."""
    schema = read_sessions(spark, path).schema
    removed, changes = (spark.read.schema(schema).parquet(f"{log}/{part}") for part in ("removed", "changes"))
    rows = spark.read.schema(schema).parquet(f"{log}/rows")
    state = spark.read.schema(_STATE).parquet(f"{log}/users")
    folder = f"{path.rstrip('/')}_users"

    def buckets() -> list[int]:
        return [row[0] for row in spark.read.schema("bucket int").parquet(f"{log}/reach").distinct().collect()]

    side_by_side(
        lambda: files.swap_partitions(rows, path, SESSION_DATE, _days(removed, changes), "user_id"),
        lambda: files.swap_partitions(state, folder, "bucket", buckets(), "user_id"),
    )
    files.mark(spark, f"{folder}/{_READY}")


def _mark_applied(spark: SparkSession, root: str, log: str) -> None:
    """Reduce the log of the batch before to its marker, then mark this one as
    done: with the marker nothing is left to do when it is delivered again."""
    before = files.read_text(spark, f"{root}/latest")
    if before is not None and before != log:
        for part in ("rows", "minutes", "touched", "reach", "changes", "removed", "users"):
            files.delete(spark, f"{before}/{part}")
    files.write_text(spark, f"{root}/latest", log)
    files.mark(spark, f"{log}/applied")

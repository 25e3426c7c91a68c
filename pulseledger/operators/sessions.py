"""Gap-based sessions, from scratch and incrementally.

A session ends when more than ``timeout`` minute boundaries lie between two
events of a user. Events within one clock minute can never be separated, so
the minute roll-up loses nothing, and it bounds a user's window partition by
the minutes of the look-back (525,600 a year, times the accounts used in a
minute) however many events there are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import aggregate, minute_diff, second_diff, surrogate_key
from . import activity

SESSION_COLUMNS = (
    "session_id",
    "user_id",
    "user_session_index",
    "session_start_at",
    "session_end_at",
    "session_duration_seconds",
    "events_in_session",
    "account_id",
)
# Tie rule for a session's account: at equal times the smallest account id.
_FIRST_ACCOUNT = "min_by(account_id, struct(first_at, account_id)) AS account_id"


SESSION_DATE = "session_date"


def start_day(sessions: DataFrame) -> str:
    """SQL for the day a session starts: the partition column of a stored
    table, so that filters on it prune partitions, or taken from the start."""
    return SESSION_DATE if SESSION_DATE in sessions.columns else "to_date(session_start_at)"


def combine_events(tracks: DataFrame, pages: DataFrame | None = None) -> DataFrame:
    """Staged tracks, and page views if given, as (user, account, event_at)."""
    events = tracks.select("user_id", "account_id", "event_at")
    if pages is None:
        return events
    return events.unionByName(pages.selectExpr("user_id", "account_id", "page_viewed_at AS event_at"))


def _islands(spans: DataFrame, timeout_minutes: int, *more: str) -> DataFrame:
    """Merge spans (user, first_at, last_at, n_events, account_id) of a user.

    A span is the events of an account in a minute, or a whole session. Spans may overlap, so
    the gap is measured from the latest end so far. ``more`` measures per session.
    """
    ordered = "PARTITION BY user_id ORDER BY first_at, last_at"
    marked = spans.selectExpr(
        "*", f"max(last_at) OVER ({ordered} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reached_at"
    )
    opens = f"IF({minute_diff('reached_at', 'first_at')} > {timeout_minutes}, 1L, 0L)"
    numbered = marked.selectExpr(
        "*", f"sum({opens}) OVER ({ordered} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS user_session_index"
    )
    return aggregate(
        numbered,
        ["user_id", "user_session_index"],
        "min(first_at) AS session_start_at",
        "max(last_at) AS session_end_at",
        "sum(n_events) AS events_in_session",
        _FIRST_ACCOUNT,
        *more,
    )


def _finish(islands: DataFrame, index: str = "user_session_index") -> DataFrame:
    return islands.withColumn("user_session_index", F.expr(index)).selectExpr(
        f"{surrogate_key('user_id', 'user_session_index')} AS session_id",
        "user_id",
        "user_session_index",
        "session_start_at",
        "session_end_at",
        f"{second_diff('session_start_at', 'session_end_at')} AS session_duration_seconds",
        "events_in_session",
        "account_id",
    )


def sessionize_minutes(minute_rows: DataFrame, timeout_minutes: int = 30) -> DataFrame:
    """Sessions of a minute roll-up."""
    return _finish(_islands(minute_rows, timeout_minutes))


def sessionize(events: DataFrame, timeout_minutes: int = 30, drop_null_user: bool = False) -> DataFrame:
    """Sessions of (user_id, account_id, event_at) rows.

    Index counts from 0 per user. Rows without a user form one sequence, as
    the metric definition has it; ``drop_null_user`` leaves them out.
    """
    if drop_null_user:
        events = events.filter("user_id IS NOT NULL")
    return sessionize_minutes(activity.minutes(events), timeout_minutes)


def number_from(spans: DataFrame, timeout_minutes: int = 30) -> DataFrame:
    """Sessions of spans (user_id, first_at, last_at, n_events, account_id,
    span_index), numbered per user from the smallest ``span_index`` on.

    That index comes with the spans, so that the sessions stay where their
    user is and are not shuffled again to meet it.
    """
    islands = _islands(spans, timeout_minutes, "min(span_index) AS span_index")
    first = "min(span_index) OVER (PARTITION BY user_id)"
    return _finish(islands.withColumn("first_index", F.expr(first)), "user_session_index + first_index")


def changed_sessions(previous: DataFrame, batch_minutes: DataFrame, timeout_minutes: int = 30) -> DataFrame:
    """New rows for every user with new events, late ones included.

    Stored sessions that end more than ``timeout`` before the user's earliest
    new event cannot change. The rest of that user's sessions are merged with
    the new minutes as spans, which needs none of the old events, and are
    numbered on from the unchanged ones.
    """
    touched = aggregate(batch_minutes, ["user_id"], "min(first_at) AS earliest_at")
    touched = touched.withColumnRenamed("user_id", "touched_user")
    stored = previous.join(touched, F.expr("user_id <=> touched_user"), "inner")
    is_fixed = f"{minute_diff('session_end_at', 'earliest_at')} > {timeout_minutes}"

    tail = stored.filter(f"NOT ({is_fixed})").selectExpr(
        "user_id", "events_in_session AS n_events", "session_start_at AS first_at", "session_end_at AS last_at", "account_id"
    )
    spans = tail.unionByName(batch_minutes.select(*tail.columns))
    fixed = aggregate(stored.filter(is_fixed), ["touched_user"], "max(user_session_index) + 1 AS n_fixed")
    merged = _islands(spans, timeout_minutes).join(fixed, F.expr("user_id <=> touched_user"), "left")
    return _finish(merged, "user_session_index + coalesce(n_fixed, 0L)")


def apply_changes(previous: DataFrame, changes: DataFrame) -> DataFrame:
    """Replace each changed user's sessions from its first changed index on.

    Applying the same changes twice gives the same table.
    """
    replaced = aggregate(changes, ["user_id"], "min(user_session_index) AS from_index")
    replaced = replaced.withColumnRenamed("user_id", "changed_user")
    joined = previous.join(replaced, F.expr("user_id <=> changed_user"), "left")
    kept = joined.filter("from_index IS NULL OR user_session_index < from_index")
    return kept.select(*previous.columns).unionByName(changes.select(*previous.columns))


def sessionize_incremental(previous: DataFrame, new_events: DataFrame, timeout_minutes: int = 30) -> DataFrame:
    """Sessions after ``new_events`` joined those already in ``previous``.

    Equals ``sessionize`` over all events, in whatever order they arrive.
    ``new_events`` must not contain events counted in ``previous`` already.
    """
    changes = changed_sessions(previous, activity.minutes(new_events), timeout_minutes)
    return apply_changes(previous, changes)


def events_since(events: DataFrame, previous: DataFrame, timeout_minutes: int = 30) -> DataFrame:
    """Events from the newest stored session end less the timeout on; all if
    none is stored.

    The cutoff as the metric definition has it: one for all users, so users who
    lag behind lose events, and what lies within the timeout comes again.
    ``sessionize_recent`` has neither fault.
    """
    newest = previous.selectExpr(f"max(session_end_at) - INTERVAL {timeout_minutes} MINUTES").scalar()
    return events.filter(newest.isNull() | (events["event_at"] >= newest))


def sessionize_recent(previous: DataFrame, events: DataFrame, timeout_minutes: int = 30) -> DataFrame:
    """Sessions after each user's last stored session was computed again.

    ``events`` may hold any events, counted before or not; those from the start
    of a user's last stored session on are used, the earlier sessions stay.
    Equals ``sessionize`` over all events if no event is older than its user's
    last stored session, however far a user lags behind the others, and
    running it again changes nothing.
    """
    last = aggregate(previous, ["user_id"], "max(struct(user_session_index AS last_index, session_start_at AS last_start_at)) AS last")
    last = last.selectExpr("user_id AS known_user", "last.*")
    recent = events.join(last, F.expr("user_id <=> known_user"), "left").filter(
        "last_start_at IS NULL OR event_at >= last_start_at"
    )
    islands = _islands(activity.minutes(recent.select("user_id", "account_id", "event_at")), timeout_minutes)
    again = islands.join(last, F.expr("user_id <=> known_user"), "left")
    return apply_changes(previous, _finish(again, "user_session_index + coalesce(last_index, 0L)"))

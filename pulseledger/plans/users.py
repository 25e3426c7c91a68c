"""User activity per day and the latest snapshot of every user."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame

from ..config import Config
from ..functions import aggregate, day_literal, flag, lifecycle_status, safe_ratio
from ..operators.ranking import rank_descending
from ..operators.rolling import union_measures
from ..operators.sessions import start_day
from ..session import Share, keep_lazy

SNAPSHOT_COLUMNS = (
    "metric_date", "user_id", "latest_account_id", "n_events_daily", "is_active_daily", "is_active_weekly",
    "is_active_monthly", "active_days_last_7", "active_days_last_14", "n_events_monthly", "n_sessions_daily",
    "n_sessions_monthly", "avg_session_duration_minutes_monthly", "avg_session_length_monthly",
    "usage_rank_in_account", "is_admin_proxy", "distinct_features_used_30d", "user_lifecycle_status",
)


def user_daily_activity(daily: DataFrame) -> DataFrame:
    """Events and distinct event names per known user and day."""
    per_feature = aggregate(
        daily.filter("user_id IS NOT NULL"), ["activity_date", "user_id", "event_name"], "sum(n_events) AS n_events"
    )
    return aggregate(
        per_feature, ["activity_date", "user_id"], "sum(n_events) AS n_events", "count(event_name) AS n_features"
    )


def _session_days(sessions: DataFrame) -> DataFrame:
    dated = sessions.filter("user_id IS NOT NULL").selectExpr(
        f"{start_day(sessions)} AS session_date", "user_id", "session_duration_seconds", "events_in_session"
    )
    return aggregate(
        dated,
        ["session_date", "user_id"],
        "count(*) AS n_sessions",
        "sum(session_duration_seconds) AS session_seconds",
        "sum(events_in_session) AS session_events",
    )


# Averages from exact sums, so they do not depend on row order.
_MEAN_MINUTES = f"{safe_ratio('session_seconds', 'n_sessions')} / 60D"
_MEAN_EVENTS = safe_ratio("session_events", "n_sessions")


def user_daily_sessions(sessions: DataFrame) -> DataFrame:
    """Sessions per known user and start day, with average length."""
    return _session_days(sessions).selectExpr(
        "session_date",
        "user_id",
        "n_sessions",
        f"{_MEAN_MINUTES} AS avg_session_duration_minutes",
        f"{_MEAN_EVENTS} AS avg_events_per_session",
    )


def user_metrics_latest(
    daily: DataFrame, sessions: DataFrame, users: DataFrame, accounts: DataFrame, cfg: Config, share: Share = keep_lazy
) -> DataFrame:
    """One row per user as of the last spine day.

    Trailing windows that end on one fixed day are conditional aggregates:
    no calendar per user and no window is needed, and only 31 days are read.
    Literal: features are the sum of daily distinct counts and averages are
    means of daily means. Documented: distinct over 30 days, and per session.
    """
    last = cfg.last_day
    newest = day_literal(last)

    def reach(column: str, days: int) -> str:
        oldest = max(last - timedelta(days=days - 1), cfg.spine_start)
        return f"{column} BETWEEN {day_literal(oldest)} AND {newest}"

    activity = user_daily_activity(daily.filter(reach("activity_date", 31))).withColumnRenamed("activity_date", "day")
    session_days = _session_days(sessions).withColumnRenamed("session_date", "day").filter(reach("day", 31))
    measures = ["n_events", "n_features", "n_sessions", "session_seconds", "session_events", "n_distinct_features"]
    parts = [activity, session_days]
    if cfg.documented:
        month = daily.filter(f"{reach('activity_date', 30)} AND user_id IS NOT NULL AND event_name IS NOT NULL")
        used = month.select("user_id", "event_name").distinct()
        counted = aggregate(used, ["user_id"], "count(*) AS n_distinct_features")
        parts.append(counted.selectExpr("user_id", f"{newest} AS day", "n_distinct_features"))
    days = union_measures(parts, ["user_id", "day"], measures)

    on_spine = "true" if cfg.spine_start <= last else "false"
    known = users.filter(f"to_date(first_seen_at) <= {newest} AND {on_spine}").selectExpr(
        "user_id", "latest_account_id", "to_date(first_seen_at) AS first_day"
    )
    # The spine of a user starts on the first seen day; with page views,
    # sessions can be older. At most 31 days of two sources join per user.
    joined = known.join(days, "user_id", "left")

    def within(n: int, end: int = 0) -> str:
        ends = last - timedelta(days=end)
        return f"(day >= first_day AND day BETWEEN {day_literal(ends - timedelta(days=n - 1))} AND {day_literal(ends)})"

    def total(column: str, n: int) -> str:
        return f"coalesce(sum(IF({within(n)}, {column}, NULL)), 0L)"

    def days_active(n: int, end: int = 0) -> str:
        return f"count(IF({within(n, end)} AND n_events > 0, 1, NULL))"

    def daily_mean(value: str) -> str:
        return f"avg(IF({within(30)}, {value}, NULL))"

    if cfg.documented:
        features = total("n_distinct_features", 1)
        mean_minutes = f"{safe_ratio(total('session_seconds', 30), total('n_sessions', 30))} / 60D"
        mean_events = safe_ratio(total("session_events", 30), total("n_sessions", 30))
    else:
        features = total("n_features", 30)
        mean_minutes, mean_events = daily_mean(_MEAN_MINUTES), daily_mean(_MEAN_EVENTS)
    snapshot = aggregate(
        joined,
        ["user_id", "latest_account_id", "first_day"],
        f"{total('n_events', 1)} AS n_events_daily",
        f"{days_active(1)} AS days_1",
        f"{days_active(7)} AS active_days_last_7",
        f"{days_active(14)} AS active_days_last_14",
        f"{days_active(30)} AS days_30",
        f"{days_active(30, end=1)} AS days_30_before",
        f"{total('n_events', 30)} AS n_events_monthly",
        f"{total('n_sessions', 1)} AS n_sessions_daily",
        f"{total('n_sessions', 30)} AS n_sessions_monthly",
        f"{mean_minutes} AS avg_session_duration_minutes_monthly",
        f"{mean_events} AS avg_session_length_monthly",
        f"{features} AS distinct_features_used_30d",
    )
    created = accounts.selectExpr("account_id AS latest_account_id", "to_date(first_seen_at) AS account_first_day")
    described = snapshot.join(created, "latest_account_id", "left").selectExpr(
        "*",
        f"{newest} AS metric_date",
        f"{flag('days_1 > 0')} AS is_active_daily",
        f"{flag('active_days_last_7 > 0')} AS is_active_weekly",
        f"{flag('days_30 > 0')} AS is_active_monthly",
        f"{flag('first_day = account_first_day')} AS is_admin_proxy",
        f"{lifecycle_status(f'first_day = {newest}', 'days_1', 'days_30', 'days_30_before')} AS user_lifecycle_status",
    )
    # Ranking reads its input twice.
    described = share(described, "user_days")
    ranked = rank_descending(described, "latest_account_id", "n_events_monthly", "user_id", "usage_rank_in_account")
    return ranked.select(*SNAPSHOT_COLUMNS)

"""Daily account metrics: actives, breadth, sessions, signals, health."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame

from ..config import Config
from ..functions import (
    aggregate,
    day_literal,
    each_day,
    flag,
    health_score,
    health_segment,
    round_half_up,
    safe_ratio,
)
from ..operators.rolling import coverage_steps, fill_days, trailing, trend_columns, union_measures
from ..operators.sessions import start_day

USER_WINDOWS = {"dau": 1, "wau": 7, "mau": 30}
FEATURE_WINDOWS = {"distinct_features_used_30d": 30}
TREND_SPANS = (7, 14, 30)
LONGEST_WINDOW = 30
LONGEST_LAG = 30
_KEYS = ["account_id", "metric_date"]
_DAY_MEASURES = ["activity_rows", "events", "session_rows", "sessions", "session_seconds", "anchors"]
_MEASURES = [*USER_WINDOWS, *FEATURE_WINDOWS, *_DAY_MEASURES]
_ORDER = "PARTITION BY account_id ORDER BY metric_date"


def account_spine(accounts: DataFrame, cfg: Config) -> DataFrame:
    """(metric_date, account_id) from the first seen day through yesterday."""
    first = f"greatest(to_date(first_seen_at), {day_literal(cfg.spine_start)})"
    return accounts.selectExpr(f"{each_day(first, day_literal(cfg.last_day))} AS metric_date", "account_id")


def daily_sessions(sessions: DataFrame) -> DataFrame:
    """Sessions and their seconds per account and start day."""
    dated = sessions.filter("account_id IS NOT NULL").selectExpr(
        "account_id", f"{start_day(sessions)} AS session_date", "session_duration_seconds"
    )
    return aggregate(
        dated,
        ["account_id", "session_date"],
        "count(*) AS n_sessions",
        "sum(session_duration_seconds) AS total_session_time_seconds",
    )


def _account_days(daily: DataFrame, sessions: DataFrame, accounts: DataFrame, cfg: Config, lowest: date | None) -> DataFrame:
    """Per account and day, without gaps: steps and sums of that day."""
    last = day_literal(cfg.last_day)
    first_day = "to_date(first_seen_at)"
    seen = daily.filter(f"account_id IS NOT NULL AND activity_date <= {last}")
    by_account = daily_sessions(sessions).filter(f"session_date <= {last}")
    if lowest is not None:
        # Windows ending on or after ``lowest`` reach back this far.
        reach = day_literal(lowest - timedelta(days=LONGEST_WINDOW - 1))
        seen = seen.filter(f"activity_date >= {reach}")
        by_account = by_account.filter(f"session_date >= {reach}")
        first_day = f"greatest({first_day}, {day_literal(lowest)})"

    seen = seen.withColumnRenamed("activity_date", "metric_date")
    users = seen.filter("user_id IS NOT NULL").select(*_KEYS, "user_id").distinct()
    features = seen.filter("event_name IS NOT NULL").select(*_KEYS, "event_name").distinct()
    parts = [
        coverage_steps(users, ["account_id"], "user_id", "metric_date", USER_WINDOWS, cfg.last_day),
        coverage_steps(features, ["account_id"], "event_name", "metric_date", FEATURE_WINDOWS, cfg.last_day),
        seen.selectExpr(*_KEYS, "1L AS activity_rows", "n_events AS events"),
        by_account.selectExpr(
            "account_id",
            "session_date AS metric_date",
            "1L AS session_rows",
            "n_sessions AS sessions",
            "total_session_time_seconds AS session_seconds",
        ),
        # Anchors mark the first official day of each account.
        accounts.selectExpr("account_id", f"{first_day} AS metric_date", "1L AS anchors").filter(f"metric_date <= {last}"),
    ]
    per_day = aggregate(union_measures(parts, _KEYS, _MEASURES), _KEYS, *[f"sum({m}) AS {m}" for m in _MEASURES])
    return fill_days(per_day, ["account_id"], "metric_date", _MEASURES, cfg.last_day)


def _rolling(days: DataFrame, cfg: Config) -> DataFrame:
    """Trailing sums on the gap-free calendar, cut to the official spine."""
    week, month = trailing(_ORDER, 7), trailing(_ORDER, 30)
    rolled = days.selectExpr(
        *_KEYS,
        *[f"sum({n}) OVER ({_ORDER}) AS {n}" for n in (*USER_WINDOWS, *FEATURE_WINDOWS)],
        f"count(nullif(activity_rows, 0L)) OVER {week} AS active_days_7d",
        f"count(nullif(activity_rows, 0L)) OVER {month} AS active_days_30d",
        f"sum(activity_rows) OVER {month} AS activity_rows_30d",
        f"sum(session_rows) OVER {month} AS session_rows_30d",
        "events",
        "sessions AS sessions_daily",
        f"sum(sessions) OVER {week} AS sessions_7d",
        f"sum(sessions) OVER {month} AS sessions_30d",
        "session_seconds AS seconds_daily",
        f"sum(session_seconds) OVER {week} AS seconds_7d",
        f"sum(session_seconds) OVER {month} AS seconds_30d",
        # 0 before the first official day, and always for accounts with
        # sessions but no tracked event.
        f"sum(anchors) OVER ({_ORDER}) AS anchors",
    )
    return rolled.filter(f"anchors > 0 AND metric_date >= {day_literal(cfg.spine_start)}")


def _volume_columns(cfg: Config) -> list[str]:
    """Event volume and session sums.

    Literal: the volume counts pairs of 30-day activity and session rows, and
    session sums repeat once per activity row; the pair count is the product
    of both row counts, each at least 1. Documented: sums of the days. In an
    account with a large share of all users that product of session and
    activity counts outgrows a long, hence the decimals.
    """
    fanout = "greatest(activity_rows_30d, 1L)"
    if cfg.documented:
        columns, repeat = ["events AS n_events_daily"], "1L"
    else:
        columns, repeat = [f"{fanout} * greatest(session_rows_30d, 1L) AS n_events_daily"], fanout
    for span in ("daily", "7d", "30d"):
        count = f"sessions_{span}" if cfg.documented else f"CAST(CAST(sessions_{span} AS DECIMAL(19,0)) * {repeat} AS DECIMAL(38,0))"
        columns.append(f"{count} AS n_sessions_{span}")
        columns.append(f"CAST(seconds_{span} AS DOUBLE) * {repeat} / 60D AS minutes_{span}")
    return columns


def _change_ratio(now: str, before: str) -> str:
    return f"IF({before} > 0, {safe_ratio(now, before, 2)}, 1D)"


def account_metrics_daily(daily: DataFrame, sessions: DataFrame, accounts: DataFrame, cfg: Config, since: date | None = None) -> DataFrame:
    """One row per account and day from first seen through yesterday.

    ``since`` limits the output to that day and later and the input to the
    60 days before it; rows are the same as without it.
    """
    lowest = None if since is None else since - timedelta(days=LONGEST_LAG)
    rolled = _rolling(_account_days(daily, sessions, accounts, cfg, lowest), cfg)
    base = rolled.selectExpr(
        *_KEYS, *USER_WINDOWS, *FEATURE_WINDOWS, "active_days_7d", "active_days_30d", *_volume_columns(cfg)
    )
    lagged = base.selectExpr(
        "*",
        f"sum(n_events_daily) OVER {trailing(_ORDER, 7)} AS volume_7d",
        f"lag(wau, 7) OVER ({_ORDER}) AS wau_before",
        f"lag(minutes_7d, 7) OVER ({_ORDER}) AS minutes_before",
        f"lag(n_sessions_7d, 7) OVER ({_ORDER}) AS n_sessions_before",
        *trend_columns(list(USER_WINDOWS), _ORDER, TREND_SPANS),
    )
    lagged = lagged.selectExpr("*", f"lag(volume_7d, 7) OVER ({_ORDER}) AS volume_before")
    signals = lagged.selectExpr(
        *_KEYS,
        "dau",
        "wau",
        "mau",
        f"{flag('dau > 0')} AS is_active_daily",
        f"{flag('wau > 0')} AS is_active_weekly",
        f"{flag('mau > 0')} AS is_active_monthly",
        "n_events_daily",
        "distinct_features_used_30d",
        "active_days_7d",
        "active_days_30d",
        "n_sessions_daily",
        f"{round_half_up('minutes_daily', 2)} AS time_on_platform_minutes_daily",
        "n_sessions_7d",
        f"{round_half_up('minutes_7d', 2)} AS time_on_platform_minutes_7d",
        "n_sessions_30d",
        f"{round_half_up('minutes_30d', 2)} AS time_on_platform_minutes_30d",
        f"{safe_ratio('minutes_7d', 'active_days_7d', 2)} AS avg_daily_time_on_platform_minutes_7d",
        f"{safe_ratio('minutes_30d', 'active_days_30d', 2)} AS avg_daily_time_on_platform_minutes_30d",
        f"{safe_ratio('n_sessions_7d', 'active_days_7d', 2)} AS avg_daily_sessions_7d",
        f"{safe_ratio('n_sessions_30d', 'active_days_30d', 2)} AS avg_daily_sessions_30d",
        "wau - wau_before AS net_new_users_7d",
        f"{_change_ratio('volume_7d', 'volume_before')} AS volume_change_ratio_7d",
        f"{_change_ratio('minutes_7d', 'minutes_before')} AS time_on_platform_change_ratio_7d",
        f"{_change_ratio('n_sessions_7d', 'n_sessions_before')} AS session_frequency_change_ratio_7d",
        f"{safe_ratio('active_days_7d', 'active_days_30d', 2)} AS account_stickiness_ratio",
        f"coalesce({safe_ratio('dau', 'mau', 2)}, 0D) AS user_stickiness_ratio",
        f"{flag('mau > 0 AND wau = 0')} AS is_dormant_risk",
        *[f"{n}_trend_{k}d" for n in USER_WINDOWS for k in TREND_SPANS],
    )
    scored = signals.selectExpr(
        "*",
        f"{health_segment('mau', 'wau', 'volume_change_ratio_7d', 'user_stickiness_ratio')} AS health_segment",
        f"{health_score('user_stickiness_ratio', 'volume_change_ratio_7d', 'active_days_7d')} AS health_score",
    )
    return scored if since is None else scored.filter(f"metric_date >= {day_literal(since)}")

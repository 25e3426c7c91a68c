"""Counts and de-duplication over event streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def deduplicate(events: DataFrame, delay: str = "1 hour", key: str = "event_id", at: str = "event_at") -> DataFrame:
    """Drop repeated deliveries that arrive within ``delay`` of each other."""
    return events.withWatermark(at, delay).dropDuplicatesWithinWatermark([key])


def daily_counts(events: DataFrame, key: str, delay: str = "1 hour", at: str = "event_at") -> DataFrame:
    """Events per ``key`` (account or user) and day, emitted when it closes."""
    days = events.withWatermark(at, delay).groupBy(F.window(at, "1 day"), key)
    return days.agg(F.expr("count(*) AS n_events")).selectExpr("to_date(window.start) AS event_date", key, "n_events")


def sliding_actives(events: DataFrame, days: int, delay: str = "1 hour", at: str = "event_at") -> DataFrame:
    """Users and accounts active in the ``days`` up to each day, exactly.

    Two chained aggregations: one row per window and user or account, kept in
    state until the window closes, and the count of these rows.
    """
    watermarked = events.withWatermark(at, delay)
    named = watermarked.selectExpr(
        at, "inline(array(struct('user' AS kind, user_id AS who), struct('account' AS kind, account_id AS who)))"
    )
    once = named.groupBy(F.window(at, f"{days} days", "1 day"), "kind", "who").agg(F.expr("count(*) AS n"))
    closed = once.groupBy("window").agg(
        F.expr("count(IF(kind = 'user', who, NULL)) AS active_users"),
        F.expr("count(IF(kind = 'account', who, NULL)) AS active_accounts"),
    )
    return closed.selectExpr("date_sub(to_date(window.end), 1) AS metric_date", "active_users", "active_accounts")


def approx_sliding_actives(events: DataFrame, days: int, delay: str = "1 hour", at: str = "event_at", error: float = 0.01) -> DataFrame:
    """The same with sketches: far less state, ``error`` is the relative standard deviation."""
    windows = events.withWatermark(at, delay).groupBy(F.window(at, f"{days} days", "1 day"))
    return windows.agg(
        F.approx_count_distinct("user_id", error).alias("approx_users"),
        F.approx_count_distinct("account_id", error).alias("approx_accounts"),
    ).selectExpr("date_sub(to_date(window.end), 1) AS metric_date", "approx_users", "approx_accounts")

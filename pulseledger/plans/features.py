"""Feature (event name) usage per account and month."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..config import Config
from ..functions import aggregate, month_of, round_half_up, safe_ratio


USAGE_COLUMNS = (
    "metric_month", "account_id", "event_name", "monthly_event_volume", "monthly_active_users_on_feature", "account_mau",
)


def feature_usage_monthly(daily: DataFrame, cfg: Config) -> DataFrame:
    """One row per account, event name and month with use.

    Literal: the previous volume is that of the previous month *with* use.
    Documented: of the previous calendar month, 0 if unused.
    """
    return usage_changes(monthly_usage(daily, cfg), cfg)


def monthly_usage(daily: DataFrame, cfg: Config) -> DataFrame:
    """Volume and users per month, from days that cover whole months."""
    monthly = daily.filter("account_id IS NOT NULL").selectExpr(
        f"{month_of('activity_date')} AS metric_month", "account_id", "event_name", "user_id", "n_events"
    )
    # Distinct users cost no Expand: the first grouping has one row per user.
    per_user = aggregate(monthly, ["metric_month", "account_id", "event_name", "user_id"], "sum(n_events) AS n_events")
    usage = aggregate(
        per_user,
        ["metric_month", "account_id", "event_name"],
        "sum(n_events) AS monthly_event_volume",
        "count(user_id) AS monthly_active_users_on_feature",
    )
    if cfg.min_monthly_feature_events > 0:
        usage = usage.filter(f"monthly_event_volume >= {cfg.min_monthly_feature_events}")
    members = per_user.select("metric_month", "account_id", "user_id").distinct()
    totals = aggregate(members, ["metric_month", "account_id"], "count(user_id) AS account_mau")
    return usage.join(totals, ["account_id", "metric_month"], "left").select(*USAGE_COLUMNS)


def usage_changes(usage: DataFrame, cfg: Config) -> DataFrame:
    """Penetration, first month and change against earlier months of the feature."""
    feature = "PARTITION BY account_id, event_name"
    in_order = f"({feature} ORDER BY metric_month)"
    previous = f"lag(monthly_event_volume) OVER {in_order}"
    if cfg.documented:
        before = f"lag(metric_month) OVER {in_order}"
        previous = (
            f"CASE WHEN {before} = add_months(metric_month, -1) THEN {previous} WHEN {before} IS NOT NULL THEN 0L END"
        )
    compared = usage.selectExpr(
        *USAGE_COLUMNS,
        f"{safe_ratio('monthly_active_users_on_feature', 'account_mau', 2)} AS feature_penetration_rate",
        f"min(metric_month) OVER ({feature}) AS first_used_month",
        f"{previous} AS prev_month_volume",
    )
    change = f"{safe_ratio('monthly_event_volume - prev_month_volume', 'prev_month_volume')} * 100"
    return compared.selectExpr("*", f"IF(prev_month_volume > 0, {round_half_up(change, 1)}, NULL) AS mom_change_pct")

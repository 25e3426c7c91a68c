"""Alerts, trend extracts and account reviews on top of the metric tables."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Config
from ..functions import aggregate, day_literal, flag, name, round_half_up, safe_ratio, text_literal

# Alert thresholds.
CHURN_RATIO_BELOW = 0.5
CHURN_MIN_WAU = 2
EXPANSION_RATIO_ABOVE = 1.5
EXPANSION_MIN_WAU = 5
ALERT_ROWS = 5
# Feature pattern thresholds.
CORE_PENETRATION_ABOVE = 0.5
LOW_PENETRATION_BELOW = 0.1
EXPANDING_PCT_ABOVE = 20
DECLINING_PCT_BELOW = -20


def churn_alerts(
    account_daily: DataFrame, cfg: Config, drop: float = CHURN_RATIO_BELOW, min_wau: int = CHURN_MIN_WAU, k: int = ALERT_ROWS
) -> DataFrame:
    """The ``k`` still active accounts with the steepest drop yesterday."""
    at_risk = account_daily.filter(
        f"metric_date = {day_literal(cfg.last_day)} AND account_id IS NOT NULL AND is_active_monthly = 1"
        f" AND volume_change_ratio_7d > 0 AND volume_change_ratio_7d < {drop} AND wau >= {min_wau}"
    )
    percent = round_half_up("(1 - volume_change_ratio_7d) * 100", 0)
    rows = at_risk.selectExpr(
        "account_id", "volume_change_ratio_7d", "active_days_7d", "wau", "mau", f"CAST({percent} AS BIGINT) AS drop_pct"
    )
    return rows.orderBy(F.asc("volume_change_ratio_7d"), F.asc("account_id")).limit(k)


def expansion_alerts(
    account_daily: DataFrame,
    cfg: Config,
    growth: float = EXPANSION_RATIO_ABOVE,
    min_wau: int = EXPANSION_MIN_WAU,
    k: int = ALERT_ROWS,
) -> DataFrame:
    """The ``k`` larger accounts with the strongest growth yesterday."""
    growing = account_daily.filter(
        f"metric_date = {day_literal(cfg.last_day)} AND account_id IS NOT NULL"
        f" AND volume_change_ratio_7d > {growth} AND wau >= {min_wau}"
    )
    percent = round_half_up("(volume_change_ratio_7d - 1) * 100", 0)
    rows = growing.selectExpr("account_id", "volume_change_ratio_7d", "wau", f"CAST({percent} AS BIGINT) AS growth_pct")
    return rows.orderBy(F.desc("volume_change_ratio_7d"), F.asc("account_id")).limit(k)


def latest_days(metrics: DataFrame, n: int = 10) -> DataFrame:
    """The newest ``n`` rows of a daily metric table."""
    return metrics.orderBy(F.desc("metric_date")).limit(n)


def account_trend(account_daily: DataFrame, cfg: Config, account_id: str | None = None, days: int = 30) -> DataFrame:
    """Health metrics of the last ``days`` days with week-over-week change.

    ``account_daily`` should reach 7 days further back.
    """
    compared = {
        "mau": "mau",
        "wau": "wau",
        "user_stickiness_ratio": "stickiness",
        "active_days_7d": "active_days",
        "distinct_features_used_30d": "features",
    }
    rows = account_daily.filter(f"metric_date > {day_literal(cfg.last_day - timedelta(days=days + 7))}")
    if account_id is not None:
        rows = rows.filter(f"account_id = {text_literal(account_id)}")

    def direction(metric: str) -> str:
        change = f"{metric} - lag({metric}, 7) OVER (PARTITION BY account_id ORDER BY metric_date)"
        return f"CASE signum({change}) WHEN 1 THEN 'up' WHEN -1 THEN 'down' WHEN 0 THEN 'flat' END"

    trend = rows.selectExpr(
        "metric_date",
        "account_id",
        "health_segment",
        "health_score",
        "dau",
        *compared,
        "net_new_users_7d",
        "volume_change_ratio_7d",
        "is_dormant_risk",
        *[f"{direction(metric)} AS {short}_direction" for metric, short in compared.items()],
    )
    return trend.filter(f"metric_date > {day_literal(cfg.last_day - timedelta(days=days))}")


def champions(user_snapshot: DataFrame, k: int = 3) -> DataFrame:
    """The ``k`` top-ranked users of every account."""
    return user_snapshot.filter(f"usage_rank_in_account <= {k}")


def lifecycle_counts(user_snapshot: DataFrame) -> DataFrame:
    return aggregate(user_snapshot, ["metric_date", "user_lifecycle_status"], "count(*) AS n_users")


def user_segments(
    user_snapshot: DataFrame, champion_ranks: int = 1, power_active_days: int = 10, power_features: int = 10
) -> DataFrame:
    """0/1 segment flags per user.

    Power user: active on at least ``power_active_days`` of 14 days with at
    least ``power_features`` feature uses in 30 days.
    """
    segments = {
        "is_champion": f"usage_rank_in_account <= {champion_ranks} AND is_active_monthly = 1",
        "is_admin": "is_admin_proxy = 1",
        "is_power_user": f"active_days_last_14 >= {power_active_days} AND distinct_features_used_30d >= {power_features}",
        "is_at_risk": "user_lifecycle_status = 'Dormant' OR (is_active_monthly = 1 AND is_active_weekly = 0)",
        "is_churned": "user_lifecycle_status = 'Churned'",
    }
    return user_snapshot.selectExpr(
        "user_id", "latest_account_id", "user_lifecycle_status", *[f"{flag(c)} AS {s}" for s, c in segments.items()]
    )


def license_utilization(user_snapshot: DataFrame) -> DataFrame:
    """Monthly active and inactive share of each account's users."""
    counts = aggregate(
        user_snapshot.withColumnRenamed("latest_account_id", "account_id"),
        ["account_id"],
        "count(*) AS total_users",
        "count(nullif(is_active_monthly, 0)) AS monthly_active_users",
    )
    inactive = "(total_users - monthly_active_users)"
    return counts.selectExpr(
        "*",
        f"{inactive} AS inactive_users",
        f"{safe_ratio('monthly_active_users', 'total_users', 4)} AS license_utilization",
        f"{safe_ratio(inactive, 'total_users', 4)} AS inactive_share",
    )


def feature_patterns(feature_monthly: DataFrame, cfg: Config, months: int = 6, near_zero: float = 0.05) -> DataFrame:
    """One row per account and feature, judged in the month of the last day.

    Abandoned: used earlier, and now unused or at most ``near_zero`` of the
    earlier peak. New: first used in the current month.
    """
    current = day_literal(cfg.last_day.replace(day=1))
    recent = feature_monthly.filter(f"metric_month > add_months({current}, {-months})")

    def now(column: str) -> str:
        return f"max(IF(metric_month = {current}, {column}, NULL))"

    def peak(column: str) -> str:
        return f"max(IF(metric_month < {current}, {column}, NULL))"

    # At most ``months`` rows per group.
    summary = aggregate(
        recent,
        ["account_id", "event_name"],
        "max(metric_month) AS last_used_month",
        "min(first_used_month) AS first_used_month",
        f"coalesce({now('monthly_event_volume')}, 0L) AS current_volume",
        f"coalesce({now('monthly_active_users_on_feature')}, 0L) AS current_users",
        f"{now('feature_penetration_rate')} AS current_penetration",
        f"{now('mom_change_pct')} AS mom_change_pct",
        f"{peak('monthly_event_volume')} AS prior_peak_volume",
        f"{peak('monthly_active_users_on_feature')} AS prior_peak_users",
    )
    patterns = {
        "is_core": f"current_penetration > {CORE_PENETRATION_ABOVE}",
        "is_expanding": f"mom_change_pct > {EXPANDING_PCT_ABOVE}",
        "is_declining": f"mom_change_pct < {DECLINING_PCT_BELOW}",
        "is_abandoned": f"current_volume <= prior_peak_volume * {near_zero}D",
        "is_low_penetration": f"current_penetration < {LOW_PENETRATION_BELOW}",
        "is_new_adoption": f"first_used_month = {current}",
    }
    return summary.selectExpr(
        "*",
        f"CAST(months_between({current}, last_used_month) AS BIGINT) AS months_since_last_use",
        *[f"{flag(c)} AS {p}" for p, c in patterns.items()],
    )


def account_playbook(
    account_daily: DataFrame,
    user_snapshot: DataFrame,
    patterns: DataFrame,
    cfg: Config,
    high_score: float = 70,
    min_declining_core: int = 2,
) -> DataFrame:
    """Churn, expansion and recovery signals per account, as of yesterday.

    ``account_daily`` must hold the last spine day and the day a week before.
    """
    last, week_ago = day_literal(cfg.last_day), day_literal(cfg.last_day - timedelta(days=7))
    now = (
        "health_segment", "health_score", "volume_change_ratio_7d", "is_dormant_risk",
        "net_new_users_7d", "user_stickiness_ratio", "wau_trend_7d", "active_days_7d",
    )
    before = ("volume_change_ratio_7d", "active_days_7d", "user_stickiness_ratio")
    accounts = aggregate(
        account_daily.filter(f"metric_date IN ({last}, {week_ago})"),
        ["account_id"],
        *[f"max(IF(metric_date = {last}, {n}, NULL)) AS {n}" for n in now],
        *[f"max(IF(metric_date = {week_ago}, {n}, NULL)) AS {n}_before" for n in before],
    )
    key_user = "(usage_rank_in_account = 1 OR is_admin_proxy = 1)"
    users = aggregate(
        user_snapshot.withColumnRenamed("latest_account_id", "account_id"),
        ["account_id"],
        f"count_if({key_user} AND user_lifecycle_status IN ('Dormant', 'Churned')) AS quiet_key_users",
        "count_if(user_lifecycle_status = 'Resurrected') AS resurrected_users",
    )
    features = aggregate(
        patterns,
        ["account_id"],
        "count_if(is_core = 1 AND is_declining = 1) AS declining_core_features",
        "count_if(is_low_penetration = 1) AS low_penetration_features",
        "count_if(is_new_adoption = 1) AS new_features",
    )
    joined = accounts.join(users, "account_id", "left").join(features, "account_id", "left")

    churn = {
        "churn_critical_segment": "health_segment LIKE 'Critical%'",
        "churn_low_volume": f"volume_change_ratio_7d < {CHURN_RATIO_BELOW}",
        "churn_quiet_key_user": "quiet_key_users > 0",
        "churn_core_features_declining": f"declining_core_features >= {min_declining_core}",
        "churn_dormant_flag": "is_dormant_risk = 1",
    }
    expansion = {
        "expansion_user_momentum": "net_new_users_7d > 0",
        "expansion_healthy": f"health_segment = 'Healthy' AND health_score >= {high_score}",
        "expansion_low_penetration": "low_penetration_features > 0",
        "expansion_sticky_growth": "user_stickiness_ratio >= 0.4 AND wau_trend_7d > 0",
    }
    recovery = {
        "recovery_volume": "volume_change_ratio_7d >= 0.9 AND volume_change_ratio_7d > volume_change_ratio_7d_before",
        "recovery_engagement": "active_days_7d > active_days_7d_before AND user_stickiness_ratio > user_stickiness_ratio_before",
        "recovery_new_features": "new_features > 0",
        "recovery_returning_users": "resurrected_users > 0",
    }
    flagged = joined.selectExpr(
        "account_id",
        "health_segment",
        "health_score",
        *[f"{flag(c)} AS {s}" for s, c in {**churn, **expansion, **recovery}.items()],
    )
    return flagged.selectExpr(
        "*",
        f"{' + '.join(churn)} AS churn_signals",
        f"{' + '.join(expansion)} AS expansion_signals",
        f"{' + '.join(recovery)} AS recovery_signals",
    )


def stitch_coverage(staged: DataFrame) -> DataFrame:
    """Total rows, distinct users and distinct anonymous ids.

    Grouped by both ids first, so the double distinct expands few rows.
    """
    pairs = aggregate(staged, ["user_id", "anonymous_id"], "count(*) AS n")
    return aggregate(
        pairs,
        [],
        "coalesce(sum(n), 0L) AS total_tracks",
        "count(DISTINCT user_id) AS tracks_with_user_id",
        "count(DISTINCT anonymous_id) AS tracks_with_anonymous_id",
    )


def source_profile(df: DataFrame, cfg: Config) -> DataFrame:
    """Row count, time range and missing accounts of a raw relation."""
    at = name(cfg.event_time_fields[0])
    group = [c for c in df.columns if c.lower() == cfg.group_id_field.lower()]
    missing = f"count_if({name(group[0])} IS NULL)" if group else "count(*)"
    return aggregate(
        df, [], "count(*) AS n_rows", f"min({at}) AS first_at", f"max({at}) AS last_at", f"{missing} AS n_without_account"
    )


def events_per_day(df: DataFrame, at: str = "event_at") -> DataFrame:
    return aggregate(df.selectExpr(f"to_date({at}) AS event_date"), ["event_date"], "count(*) AS event_count")

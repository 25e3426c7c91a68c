"""Product-wide daily actives and trends."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..config import Config
from ..functions import aggregate, day_literal, safe_ratio
from ..operators.rolling import coverage_steps, fill_days, trend_columns, union_measures

USER_WINDOWS = {"dau": 1, "wau": 7, "mau": 30}
ACCOUNT_WINDOWS = {"daa": 1, "waa": 7, "maa": 30}
TREND_SPANS = (7, 14, 30)
TREND_COLUMNS = [*USER_WINDOWS, *ACCOUNT_WINDOWS]


def product_actives(daily: DataFrame, cfg: Config) -> DataFrame:
    """Active users and accounts per day.

    Literal: only days with activity in their trailing 30 days. Documented:
    every day of the spine, idle ones with zeros.
    """
    seen = daily.filter(f"activity_date <= {day_literal(cfg.last_day)}")
    users = seen.filter("user_id IS NOT NULL").select("user_id", "activity_date").distinct()
    accounts = seen.filter("account_id IS NOT NULL").select("account_id", "activity_date").distinct()
    parts = [
        coverage_steps(users, [], "user_id", "activity_date", USER_WINDOWS, cfg.last_day),
        coverage_steps(accounts, [], "account_id", "activity_date", ACCOUNT_WINDOWS, cfg.last_day),
    ]
    if cfg.documented and cfg.spine_start <= cfg.last_day:
        parts.append(daily.sparkSession.range(1).selectExpr(f"{day_literal(cfg.spine_start)} AS activity_date"))
    steps = union_measures(parts, ["activity_date"], TREND_COLUMNS)
    per_day = aggregate(steps, ["activity_date"], *[f"sum({n}) AS {n}" for n in TREND_COLUMNS])

    # From here on there is one row per calendar day, so windows without a
    # partition key are small.
    days = fill_days(per_day, [], "activity_date", TREND_COLUMNS, cfg.last_day)
    totals = days.selectExpr(
        "activity_date AS metric_date", *[f"sum({n}) OVER (ORDER BY activity_date) AS {n}" for n in TREND_COLUMNS]
    )
    on_spine = totals.filter(f"metric_date >= {day_literal(cfg.spine_start)}")
    return on_spine if cfg.documented else on_spine.filter("maa > 0")


def product_metrics_daily(daily: DataFrame, cfg: Config) -> DataFrame:
    """Actives, stickiness and velocities per day.

    Literal velocities look back a number of rows, which skips idle days;
    with documented semantics rows and days are the same.
    """
    return product_trends(product_actives(daily, cfg))


def product_trends(actives: DataFrame) -> DataFrame:
    """Metrics that follow from the actives of all days, one row per day."""
    return actives.selectExpr(
        "metric_date",
        *TREND_COLUMNS,
        f"coalesce({safe_ratio('dau', 'mau', 2)}, 0D) AS user_stickiness_ratio",
        f"coalesce({safe_ratio('daa', 'maa', 2)}, 0D) AS account_stickiness_ratio",
        *trend_columns(TREND_COLUMNS, "ORDER BY metric_date", TREND_SPANS),
    )

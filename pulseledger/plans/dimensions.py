"""Account and user dimensions, from the daily roll-up."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame

from ..config import Config
from ..functions import aggregate, calendar_days_between, instant

SEAT_DAYS = 30


def membership(daily: DataFrame) -> DataFrame:
    """(account, user) pairs with first and last event; both dimensions
    aggregate this small relation instead of the events."""
    return aggregate(daily, ["account_id", "user_id"], "min(first_at) AS first_at", "max(last_at) AS last_at")


def _ages(cfg: Config) -> list[str]:
    now = instant(cfg.as_of_utc)
    return [f"{calendar_days_between(f'{seen}_seen_at', now)} AS days_since_{seen}_seen" for seen in ("first", "last")]


def dim_accounts(daily: DataFrame, cfg: Config) -> DataFrame:
    """One row per account.

    A seat is a user with an event on a day that begins no earlier than 30
    days before ``as_of``, so day -30 itself counts only at midnight.
    """
    cutoff = instant(cfg.as_of_utc - timedelta(days=SEAT_DAYS))
    per_account = aggregate(
        membership(daily).filter("account_id IS NOT NULL"),
        ["account_id"],
        "min(first_at) AS first_seen_at",
        "max(last_at) AS last_seen_at",
        "count(user_id) AS lifetime_unique_users",
        f"count(IF(CAST(to_date(last_at) AS TIMESTAMP) >= {cutoff}, user_id, NULL)) AS current_active_seats",
    )
    return per_account.selectExpr("*", *_ages(cfg))


def dim_users(daily: DataFrame, cfg: Config) -> DataFrame:
    """One row per known user; equal times: the larger account id is latest."""
    per_user = aggregate(
        membership(daily).filter("user_id IS NOT NULL"),
        ["user_id"],
        "min(first_at) AS first_seen_at",
        "max(last_at) AS last_seen_at",
        "count(account_id) AS lifetime_accounts_distinct",
        "max_by(account_id, struct(last_at, account_id)) AS latest_account_id",
    )
    return per_user.selectExpr("*", *_ages(cfg))


def enrich_users(users_dim: DataFrame, profiles: DataFrame) -> DataFrame:
    """Add email and sign-up time of the raw users relation, where known."""
    wanted = [c for c in ("email", "created_at") if c in profiles.columns]
    known = aggregate(profiles, ["user_id"], *[f"max({c}) AS {c}" for c in wanted])
    return users_dim.join(known, "user_id", "left")


def enrich_accounts(accounts_dim: DataFrame, profiles: DataFrame) -> DataFrame:
    """Add the name of the raw groups relation, where known."""
    wanted = [c for c in ("name", "created_at") if c in profiles.columns]
    known = aggregate(profiles, ["group_id"], *[f"max({c}) AS {c}" for c in wanted])
    return accounts_dim.join(known.withColumnRenamed("group_id", "account_id"), "account_id", "left")

"""Mergeable distinct counts: HyperLogLog sketches stored per day, united for any span.

Opt-in, where exact counts over arbitrary spans cost too much: a sketch has a
fixed size however many users it has seen, and the sketches of days, or of
accounts, unite without the events. The standard error is 1.04 / sqrt(2 ** PRECISION).
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame

from ..functions import aggregate, day_literal

PRECISION = 12
STANDARD_ERROR = 1.04 / 2 ** (PRECISION / 2)


def daily_sketches(daily: DataFrame) -> DataFrame:
    """(account_id, activity_date, users, features): sketches of the daily roll-up."""
    return aggregate(
        daily,
        ["account_id", "activity_date"],
        f"hll_sketch_agg(user_id, {PRECISION}) AS users",
        f"hll_sketch_agg(event_name, {PRECISION}) AS features",
    )


def united_estimates(sketches: DataFrame, keys: Sequence[str], first: date, last: date) -> DataFrame:
    """Estimated distinct users and features per ``keys`` from ``first`` through ``last``."""
    span = sketches.filter(f"activity_date BETWEEN {day_literal(first)} AND {day_literal(last)}")
    return aggregate(
        span,
        keys,
        "hll_sketch_estimate(hll_union_agg(users)) AS approx_users",
        "hll_sketch_estimate(hll_union_agg(features)) AS approx_features",
    )

"""Scoring expressions over already computed metric columns."""

from __future__ import annotations

# Segment thresholds and score weights.
USAGE_DROP_BELOW = 0.5
DECLINE_BELOW = 0.9
GROWTH_ABOVE = 1.1
LOW_STICKINESS_BELOW = 0.2
HIGH_STICKINESS_FROM = 0.4
STICKINESS_POINTS = 40
VOLUME_POINTS = 40
VOLUME_RATIO_CEILING = 1.5
FREQUENCY_POINTS_PER_DAY = 4
FREQUENCY_DAYS_CEILING = 5
MAX_SCORE = 100


def health_segment(mau: str, wau: str, volume_ratio: str, stickiness: str) -> str:
    """Account class; the first rule that holds wins."""
    rules = {
        "Critical - Dormant": f"{mau} > 0 AND {wau} = 0",
        "Critical - Usage Drop": f"{volume_ratio} < {USAGE_DROP_BELOW}D",
        "At-Risk": f"{stickiness} < {LOW_STICKINESS_BELOW}D OR {volume_ratio} < {DECLINE_BELOW}D",
        "Healthy": f"{stickiness} >= {HIGH_STICKINESS_FROM}D OR {volume_ratio} > {GROWTH_ABOVE}D",
    }
    return "CASE " + " ".join(f"WHEN {rule} THEN '{label}'" for label, rule in rules.items()) + " ELSE 'Stable' END"


def health_score(stickiness: str, volume_ratio: str, active_days_7d: str) -> str:
    """0 to 100: stickiness, week-over-week volume and active days."""
    points = (
        f"coalesce({stickiness}, 0D) * {STICKINESS_POINTS}"
        f" + least({volume_ratio}, {VOLUME_RATIO_CEILING}D) * {VOLUME_POINTS}"
        f" + least({active_days_7d}, {FREQUENCY_DAYS_CEILING}) * {FREQUENCY_POINTS_PER_DAY}"
    )
    return f"least({MAX_SCORE}D, {points})"


def lifecycle_status(is_first_day: str, days_today: str, days_30: str, days_30_before: str) -> str:
    """User state from active days today, in 30 days, and in 30 days as of
    the day before (null or 0: none)."""
    return f"""CASE WHEN {is_first_day} THEN 'New'
        WHEN {days_today} > 0 AND coalesce({days_30_before}, 0) = 0 THEN 'Resurrected'
        WHEN {days_30} = 0 THEN 'Churned'
        WHEN {days_today} > 0 THEN 'Active'
        ELSE 'Dormant' END"""

"""Column documentation, kept with the table schema."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import aggregate, name, text_literal

# Meaning of each output column. Names shared by several relations mean the
# same in each.
COLUMN_DOCS: dict[str, str] = {
    "account_id": "Account (customer organisation) the row belongs to.",
    "user_id": "Person the row belongs to, after identity stitching.",
    "metric_date": "UTC day the metrics describe; windows end on it.",
    "first_seen_at": "Time of the first event inside the look-back.",
    "last_seen_at": "Time of the last event inside the look-back.",
    "lifetime_unique_users": "Distinct users with any event of the account.",
    "current_active_seats": "Distinct users of the account seen in the 30 days before the run.",
    "lifetime_accounts_distinct": "Distinct accounts the user acted in.",
    "latest_account_id": "Account of the user's last event.",
    "days_since_first_seen": "Calendar days from the first event to the run.",
    "days_since_last_seen": "Calendar days from the last event to the run.",
    "session_id": "Key of the session: md5 of user and session index.",
    "user_session_index": "Position of the session in the user's history, from 0.",
    "session_start_at": "Time of the first event of the session.",
    "session_end_at": "Time of the last event of the session.",
    "session_duration_seconds": "Seconds from first to last event; 0 for one event.",
    "events_in_session": "Number of events in the session.",
    "dau": "Distinct users active on the day.",
    "wau": "Distinct users active in the 7 days ending on the day.",
    "mau": "Distinct users active in the 30 days ending on the day.",
    "daa": "Distinct accounts active on the day.",
    "waa": "Distinct accounts active in the 7 days ending on the day.",
    "maa": "Distinct accounts active in the 30 days ending on the day.",
    "user_stickiness_ratio": "Daily over monthly active users; 0 without monthly users.",
    "account_stickiness_ratio": "Product: daily over monthly active accounts. Account: active days of 7 over active days of 30.",
    "is_active_daily": "1 if active on the day.",
    "is_active_weekly": "1 if active in the 7 days ending on the day.",
    "is_active_monthly": "1 if active in the 30 days ending on the day.",
    "n_events_daily": "Event volume of the day; see the README for the literal reading.",
    "distinct_features_used_30d": "Breadth of use over 30 days.",
    "active_days_7d": "Days with activity among the last 7.",
    "active_days_30d": "Days with activity among the last 30.",
    "n_sessions_daily": "Sessions started on the day.",
    "n_sessions_7d": "Sessions started in the last 7 days.",
    "n_sessions_30d": "Sessions started in the last 30 days.",
    "time_on_platform_minutes_daily": "Session minutes of the day.",
    "time_on_platform_minutes_7d": "Session minutes of the last 7 days.",
    "time_on_platform_minutes_30d": "Session minutes of the last 30 days.",
    "avg_daily_time_on_platform_minutes_7d": "Session minutes per active day, 7 days.",
    "avg_daily_time_on_platform_minutes_30d": "Session minutes per active day, 30 days.",
    "avg_daily_sessions_7d": "Sessions per active day, 7 days.",
    "avg_daily_sessions_30d": "Sessions per active day, 30 days.",
    "net_new_users_7d": "Weekly active users less those a week before.",
    "volume_change_ratio_7d": "Event volume of the week over that of the week before; 1 without a base.",
    "time_on_platform_change_ratio_7d": "Session minutes of the week over the week before; 1 without a base.",
    "session_frequency_change_ratio_7d": "Sessions of the week over the week before; 1 without a base.",
    "is_dormant_risk": "1 if active within 30 days and silent for 7.",
    "health_segment": "Critical - Dormant, Critical - Usage Drop, At-Risk, Healthy or Stable.",
    "health_score": "0 to 100 from stickiness, volume ratio and active days.",
    "metric_month": "First day of the month the row describes.",
    "event_name": "Name of the tracked event, taken as the feature.",
    "monthly_event_volume": "Events of the feature in the month.",
    "monthly_active_users_on_feature": "Distinct users of the feature in the month.",
    "account_mau": "Distinct users of the account in the month.",
    "feature_penetration_rate": "Share of the account's users who used the feature.",
    "first_used_month": "First month the account used the feature.",
    "prev_month_volume": "Volume of the previous month with use.",
    "mom_change_pct": "Volume change against that month in percent.",
    "active_days_last_7": "Days the user was active among the last 7.",
    "active_days_last_14": "Days the user was active among the last 14.",
    "n_events_monthly": "Events of the user in 30 days.",
    "n_sessions_monthly": "Sessions of the user in 30 days.",
    "avg_session_duration_minutes_monthly": "Average session minutes over 30 days.",
    "avg_session_length_monthly": "Average events per session over 30 days.",
    "usage_rank_in_account": "Rank by 30-day events within the account; 1 is the champion.",
    "is_admin_proxy": "1 if first seen on the account's first day.",
    "user_lifecycle_status": "New, Resurrected, Churned, Active or Dormant.",
}
COLUMN_DOCS.update(
    {
        f"{name}_trend_{days}d": f"Average change per day of {name} over {days} rows back."
        for name in ("dau", "wau", "mau", "daa", "waa", "maa")
        for days in (7, 14, 30)
    }
)


def with_docs(df: DataFrame, docs: Mapping[str, str] = COLUMN_DOCS) -> DataFrame:
    """Attach comments to the columns that have one; tables keep them."""
    return df.select(
        *[
            F.col(f.name).alias(f.name, metadata={**f.metadata, "comment": docs[f.name]}) if f.name in docs else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def column_comments(df: DataFrame) -> dict[str, str]:
    return {f.name: f.metadata["comment"] for f in df.schema.fields if "comment" in f.metadata}


def filled_columns(df: DataFrame, relation: str) -> DataFrame:
    """(relation, column_name, comment, n_filled): the documented columns and in
    how many rows they have a value."""
    found = list(column_comments(df).items())
    counts = aggregate(df, [], *[f"count({name(c)}) AS c{i}" for i, (c, _) in enumerate(found)])
    entries = ", ".join(
        f"named_struct('relation', {text_literal(relation)}, 'column_name', {text_literal(c)}, 'comment', {text_literal(text)}, 'n_filled', c{i})"
        for i, (c, text) in enumerate(found)
    )
    return counts.selectExpr(f"inline(array({entries}))")

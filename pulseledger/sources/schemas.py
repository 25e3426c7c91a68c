"""Declared columns of the raw customer-data-platform relations."""

from __future__ import annotations

from pyspark.sql import types as T


def _schema(strings: str, timestamps: str) -> T.StructType:
    fields = [T.StructField(name, T.StringType()) for name in strings.split()]
    fields += [T.StructField(name, T.TimestampType()) for name in timestamps.split()]
    return T.StructType(fields)


TRACKS = _schema(
    "id user_id anonymous_id context_group_id event event_text",
    "timestamp received_at sent_at",
)
PAGES = _schema(
    "id user_id anonymous_id context_group_id name url title"
    " properties_title properties_path properties_url properties_referrer properties_search",
    "timestamp received_at sent_at",
)
IDENTIFIES = _schema("id user_id anonymous_id", "timestamp received_at sent_at")
USERS = _schema("id user_id email context_group_id", "created_at received_at sent_at")
GROUPS = _schema("id group_id name", "created_at received_at sent_at")

RAW_SCHEMAS = {
    "tracks": TRACKS,
    "pages": PAGES,
    "identifies": IDENTIFIES,
    "users": USERS,
    "groups": GROUPS,
}

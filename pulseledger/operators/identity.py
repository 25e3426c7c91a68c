"""Identity resolution, account back-fill and the staged event relations.

Two maps, each one row per key, drive the stitching: anonymous id -> last
user, and user -> last account. They can be applied at event grain
(``stage_tracks``, ``stage_pages``) or after a roll-up
(``activity.stitched_daily``); the second way shuffles far less.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame

from ..config import Config
from ..functions import aggregate, instant, name, optional_col

TRACK_COLUMNS = (
    "event_id", "anonymous_id", "original_user_id", "user_id",
    "original_account_id", "account_id", "event_name", "event_at",
)
PAGE_COLUMNS = (
    "page_id", "anonymous_id", "original_user_id", "user_id", "original_account_id", "account_id", "page_name",
    "page_viewed_at", "page_title", "page_path", "page_url", "page_referrer", "page_search",
)


def event_time(cfg: Config) -> str:
    columns = [name(c) for c in cfg.event_time_fields]
    return columns[0] if len(columns) == 1 else f"coalesce({', '.join(columns)})"


def within_lookback(df: DataFrame, cfg: Config, days: int) -> DataFrame:
    """Rows not older than ``days`` before ``as_of``; pushed to the scan."""
    oldest = instant(cfg.as_of_utc - timedelta(days=days))
    return df.filter(f"{event_time(cfg)} >= {oldest}")


def last_seen(seen: DataFrame, key: str, value: str) -> DataFrame:
    """Per ``key`` the ``value`` seen last and when; equal times: the larger value.

    ``seen`` has (key, value, seen_at), also results of earlier calls: what was
    seen last in several parts follows from the last of each part.

    The first aggregate has only (key, value, max time) and so combines on
    the map side by hashing: a key with very many rows leaves each task as
    one row per distinct value.
    """
    pairs = aggregate(seen, [key, value], "max(seen_at) AS seen_at")
    last = aggregate(pairs, [key], f"max(struct(seen_at, {value})) AS last")
    return last.selectExpr(key, f"last.{value} AS {value}", "last.seen_at AS seen_at")


def seen_identities(identifies: DataFrame, cfg: Config) -> DataFrame:
    """(anonymous_id, user_id, seen_at) of identify calls with a user."""
    known = within_lookback(identifies, cfg, cfg.identity_lookback_days).filter("user_id IS NOT NULL")
    return known.selectExpr(
        f"{optional_col(identifies, cfg.anonymous_id_field)} AS anonymous_id", "CAST(user_id AS STRING) AS user_id", f"{event_time(cfg)} AS seen_at"
    )


def resolve_identity(identifies: DataFrame, cfg: Config) -> DataFrame:
    """(anonymous_id, master_user_id): last identified user per anonymous id."""
    return identity_map(last_seen(seen_identities(identifies, cfg), "anonymous_id", "user_id"))


def identity_map(last_identities: DataFrame) -> DataFrame:
    return last_identities.selectExpr("anonymous_id", "user_id AS master_user_id")


def account_map(last_accounts: DataFrame) -> DataFrame:
    return last_accounts.selectExpr("user_id", "account_id AS latest_account_id")


def map_user_account(tracks: DataFrame, cfg: Config) -> DataFrame:
    """(user_id, latest_account_id): last explicit account per user.

    Empty where the account column is absent.
    """
    seen = within_lookback(tracks, cfg, cfg.tracks_lookback_days).selectExpr(
        "CAST(user_id AS STRING) AS user_id",
        f"{optional_col(tracks, cfg.group_id_field)} AS account_id",
        f"{event_time(cfg)} AS seen_at",
    )
    return account_map(last_seen(seen.filter("user_id IS NOT NULL AND account_id IS NOT NULL"), "user_id", "account_id"))


def _own_ids(df: DataFrame, cfg: Config) -> list[str]:
    device = optional_col(df, cfg.anonymous_id_field) if cfg.enable_identity_stitching else "CAST(NULL AS STRING)"
    return [
        f"{device} AS anonymous_id",
        "CAST(user_id AS STRING) AS original_user_id",
        f"{optional_col(df, cfg.group_id_field)} AS original_account_id",
    ]


def canonical_tracks(tracks: DataFrame, cfg: Config) -> DataFrame:
    """Look-back filter and canonical column names, before any stitching."""
    return within_lookback(tracks, cfg, cfg.tracks_lookback_days).selectExpr(
        "CAST(id AS STRING) AS event_id",
        *_own_ids(tracks, cfg),
        "event AS event_name",
        f"{event_time(cfg)} AS event_at",
    )


def canonical_pages(pages: DataFrame, cfg: Config) -> DataFrame:
    """As ``canonical_tracks``; every page attribute may be missing."""
    attributes = {
        "page_title": cfg.page_title_field,
        "page_path": cfg.page_path_field,
        "page_url": cfg.page_url_field,
        "page_referrer": cfg.page_referrer_field,
        "page_search": cfg.page_search_field,
    }
    return within_lookback(pages, cfg, cfg.pages_lookback_days).selectExpr(
        "CAST(id AS STRING) AS page_id",
        *_own_ids(pages, cfg),
        f"{optional_col(pages, 'name')} AS page_name",
        f"{event_time(cfg)} AS page_viewed_at",
        *[f"{optional_col(pages, source)} AS {target}" for target, source in attributes.items()],
    )


def lookup_map(identity_map: DataFrame, account_map: DataFrame) -> DataFrame:
    """Both maps as one: (is_anonymous, lookup_id) -> found user and account.

    An anonymous id leads to its master user and that user's last account; a
    user id leads to the user's last account.
    """
    by_device = identity_map.join(account_map, identity_map["master_user_id"] == account_map["user_id"], "left")
    by_device = by_device.filter("anonymous_id IS NOT NULL").selectExpr(
        "true AS is_anonymous",
        "anonymous_id AS lookup_id",
        "master_user_id AS found_user_id",
        "latest_account_id AS found_account_id",
    )
    by_user = account_map.selectExpr(
        "false AS is_anonymous",
        "user_id AS lookup_id",
        "user_id AS found_user_id",
        "latest_account_id AS found_account_id",
    )
    return by_device.unionByName(by_user)


# Rows a look-up could change: user unknown but device known, or user known
# but account unknown. Their look-up id is never null.
NEEDS_LOOKUP = """(original_user_id IS NULL AND anonymous_id IS NOT NULL)
    OR (original_user_id IS NOT NULL AND original_account_id IS NULL)"""


def keep_own_identity(rows: DataFrame) -> DataFrame:
    """User and account as recorded; drops rows without an account."""
    return rows.filter("original_account_id IS NOT NULL").selectExpr(
        "*", "original_user_id AS user_id", "original_account_id AS account_id"
    )


def look_up_identity(rows: DataFrame, lookup: DataFrame) -> DataFrame:
    """Identity for rows that need a look-up; drops account orphans.

    One left join; its right side has one row per key, so rows cannot
    multiply, and no key is null, so none pile up on one task. The optimizer
    decides by size whether the map is broadcast, and splits a skewed key (a
    device or user with very many rows) otherwise.
    """
    keyed = rows.selectExpr(
        "*",
        "original_user_id IS NULL AS is_anonymous",
        "coalesce(original_user_id, anonymous_id) AS lookup_id",
    )
    found = keyed.join(lookup, ["is_anonymous", "lookup_id"], "left").selectExpr(
        *rows.columns,
        "coalesce(original_user_id, found_user_id) AS user_id",
        "coalesce(original_account_id, found_account_id) AS account_id",
    )
    return found.filter("account_id IS NOT NULL")


def _stage(rows: DataFrame, lookup: DataFrame | None, cfg: Config) -> DataFrame:
    """Rows that no look-up could change pass through without a shuffle."""
    if not cfg.enable_identity_stitching:
        return keep_own_identity(rows)
    if lookup is None:
        raise ValueError("identity stitching needs the look-up map")
    direct = keep_own_identity(rows.filter(f"NOT ({NEEDS_LOOKUP})"))
    return direct.unionByName(look_up_identity(rows.filter(NEEDS_LOOKUP), lookup))


def stage_tracks(tracks: DataFrame, lookup: DataFrame | None, cfg: Config) -> DataFrame:
    """One row per track event that belongs to an account.

    ``lookup`` is the result of ``lookup_map``, or None without stitching.
    """
    return _stage(canonical_tracks(tracks, cfg), lookup, cfg).select(*TRACK_COLUMNS)


def stage_pages(pages: DataFrame, lookup: DataFrame | None, cfg: Config) -> DataFrame:
    """One row per page view that belongs to an account."""
    return _stage(canonical_pages(pages, cfg), lookup, cfg).select(*PAGE_COLUMNS)

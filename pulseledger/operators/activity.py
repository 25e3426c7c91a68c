"""Roll-ups of staged events: the grain that every metric relation reads.

``daily``: (account, user, day, event name) with count and first/last time.
``minutes``: (user, clock minute, account) with count and first/last time;
enough to sessionize exactly, see ``sessions``.

``raw_rollup``: the same measures before any stitching, per own ids, minute and
event name. One scan of the raw relations gives it; the account map and both
roll-ups above follow from it, and it is what an incremental build keeps.

All combine on the map side, so a key holding a large share of the rows
leaves each task as one row per group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..config import Config
from ..functions import aggregate, minute_start, union_all
from . import identity

DAILY_KEYS = ("account_id", "user_id", "activity_date", "event_name")
OWN_IDS = ("anonymous_id", "original_user_id", "original_account_id")
RAW_KEYS = (*OWN_IDS, "activity_date", "minute", "event_name", "is_page")
_MEASURES = ("n_events", "first_at", "last_at")


def _merge(df: DataFrame, *keys: str) -> DataFrame:
    return aggregate(df, keys, "sum(n_events) AS n_events", "min(first_at) AS first_at", "max(last_at) AS last_at")


def _single_events(df: DataFrame, time: str, *columns: str) -> DataFrame:
    return df.selectExpr(*columns, "1L AS n_events", f"{time} AS first_at", f"{time} AS last_at")


def daily(staged_tracks: DataFrame) -> DataFrame:
    """Daily roll-up of staged tracks."""
    rows = _single_events(staged_tracks, "event_at", "account_id", "user_id", "to_date(event_at) AS activity_date", "event_name")
    return _merge(rows, *DAILY_KEYS)


def _attach(rows: DataFrame, grain: tuple[str, ...], lookup: DataFrame | None, cfg: Config) -> DataFrame:
    """Identity for rows of (own ids, grain, measures).

    Rows needing a look-up are first merged per own ids and grain: a device
    that sent a third of all events joins as a few rows per day.
    """
    keep = ["user_id", "account_id", *grain, *_MEASURES]
    if not cfg.enable_identity_stitching:
        return identity.keep_own_identity(rows).select(*keep)
    if lookup is None:
        raise ValueError("identity stitching needs the look-up map")
    known = identity.keep_own_identity(rows.filter(f"NOT ({identity.NEEDS_LOOKUP})"))
    # The device is irrelevant once the user is known.
    unknown = rows.filter(identity.NEEDS_LOOKUP).selectExpr(
        "IF(original_user_id IS NULL, anonymous_id, NULL) AS anonymous_id", *OWN_IDS[1:], *grain, *_MEASURES
    )
    found = identity.look_up_identity(_merge(unknown, *OWN_IDS, *grain), lookup)
    return known.select(*keep).unionByName(found.select(*keep))


def stitched_daily(tracks: DataFrame, lookup: DataFrame | None, cfg: Config) -> DataFrame:
    """Same result as ``daily(stage_tracks(...))``, rolled up before the join."""
    rows = _single_events(
        identity.canonical_tracks(tracks, cfg), "event_at", *OWN_IDS, "to_date(event_at) AS activity_date", "event_name"
    )
    return _merge(_attach(rows, ("activity_date", "event_name"), lookup, cfg), *DAILY_KEYS)


def _minutes(rows: DataFrame) -> DataFrame:
    """Merge to one row per (user, minute, account).

    With the account among the keys all buffers are fixed-width, so this
    hashes; sessions merge the overlapping spans of several accounts.
    """
    return _merge(rows, "user_id", "minute", "account_id")


def minutes(events: DataFrame) -> DataFrame:
    """Minute roll-up of rows with user_id, account_id and event_at."""
    return _minutes(_single_events(events, "event_at", "user_id", "account_id", f"{minute_start('event_at')} AS minute"))


def stitched_minutes(tracks: DataFrame, pages: DataFrame | None, lookup: DataFrame | None, cfg: Config) -> DataFrame:
    """Minute roll-up of raw tracks, and pages if the settings include them."""

    def rows(df: DataFrame, time: str) -> DataFrame:
        return _single_events(df, time, *OWN_IDS, f"{minute_start(time)} AS minute")

    inputs = [rows(identity.canonical_tracks(tracks, cfg), "event_at")]
    if cfg.include_pages_in_sessions:
        if pages is None:
            raise ValueError("include_pages_in_sessions needs the pages relation")
        inputs.append(rows(identity.canonical_pages(pages, cfg), "page_viewed_at"))
    return _minutes(_attach(union_all(inputs), ("minute",), lookup, cfg))


def raw_rollup(tracks: DataFrame, pages: DataFrame | None, cfg: Config) -> DataFrame:
    """Un-stitched roll-up of tracks, and pages if the settings include them."""

    def rows(df: DataFrame, time: str, event: str, is_page: str) -> DataFrame:
        # The device is irrelevant once the user is known.
        device = "IF(original_user_id IS NULL, anonymous_id, NULL) AS anonymous_id"
        keys = [device, *OWN_IDS[1:], f"to_date({time}) AS activity_date", f"{minute_start(time)} AS minute"]
        return _single_events(df, time, *keys, f"{event} AS event_name", f"{is_page} AS is_page")

    inputs = [rows(identity.canonical_tracks(tracks, cfg), "event_at", "event_name", "false")]
    if cfg.include_pages_in_sessions:
        if pages is None:
            raise ValueError("include_pages_in_sessions needs the pages relation")
        inputs.append(rows(identity.canonical_pages(pages, cfg), "page_viewed_at", "CAST(NULL AS STRING)", "true"))
    return _merge(union_all(inputs), *RAW_KEYS)


def _daily_rows(raw: DataFrame, lookup: DataFrame | None, cfg: Config) -> DataFrame:
    rows = raw.filter("NOT is_page").select(*OWN_IDS, "activity_date", "event_name", *_MEASURES)
    return _attach(rows, ("activity_date", "event_name"), lookup, cfg)


def daily_from_raw(raw: DataFrame, lookup: DataFrame | None, cfg: Config) -> DataFrame:
    """Daily roll-up of an un-stitched one; same as ``stitched_daily``."""
    return _merge(_daily_rows(raw, lookup, cfg), *DAILY_KEYS)


def daily_against(raw: DataFrame, lookup: DataFrame | None, cfg: Config, before: DataFrame) -> DataFrame:
    """``daily_from_raw`` beside an earlier daily roll-up, in one grouping.

    One row per key with the measures and, prefixed with ``old_``, those of
    ``before``; null where a side does not have the key.
    """
    none, old = (["CAST(NULL AS BIGINT)", *["CAST(NULL AS TIMESTAMP)"] * 2], [f"old_{m}" for m in _MEASURES])
    now = _daily_rows(raw, lookup, cfg).selectExpr(*DAILY_KEYS, *_MEASURES, *[f"{n} AS {o}" for n, o in zip(none, old, strict=True)])
    then = before.selectExpr(
        *DAILY_KEYS, *[f"{n} AS {m}" for n, m in zip(none, _MEASURES, strict=True)], *[f"{m} AS {o}" for m, o in zip(_MEASURES, old, strict=True)]
    )
    merges = [f"{how}({p}{m}) AS {p}{m}" for p in ("", "old_") for how, m in zip(("sum", "min", "max"), _MEASURES, strict=True)]
    return aggregate(now.unionByName(then), DAILY_KEYS, *merges)


def daily_now(compared: DataFrame) -> DataFrame:
    """The daily roll-up in a result of ``daily_against``."""
    return compared.filter("n_events IS NOT NULL").select(*DAILY_KEYS, *_MEASURES)


def daily_differing(compared: DataFrame) -> DataFrame:
    """Its rows that are new or changed, and those that are gone as they were."""
    sides = [f"IF({p}n_events IS NULL, NULL, struct({', '.join(f'{p}{m} AS {m}' for m in _MEASURES)}, {gone} AS gone))" for p, gone in (("", "false"), ("old_", "true"))]
    changed = compared.filter(f"NOT ({' AND '.join(f'{m} <=> old_{m}' for m in _MEASURES)})")
    rows = changed.selectExpr(*DAILY_KEYS, f"explode(filter(array({', '.join(sides)}), s -> s IS NOT NULL)) AS side")
    return rows.select(*DAILY_KEYS, "side.*")


def minutes_from_raw(raw: DataFrame, lookup: DataFrame | None, cfg: Config) -> DataFrame:
    """Minute roll-up of an un-stitched one; same as ``stitched_minutes``."""
    return _minutes(_attach(raw.select(*OWN_IDS, "minute", *_MEASURES), ("minute",), lookup, cfg))


def seen_accounts(raw: DataFrame) -> DataFrame:
    """(user_id, account_id, seen_at): accounts that users were seen with."""
    known = raw.filter("NOT is_page AND original_user_id IS NOT NULL AND original_account_id IS NOT NULL")
    return known.selectExpr("original_user_id AS user_id", "original_account_id AS account_id", "last_at AS seen_at")

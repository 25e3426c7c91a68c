from datetime import datetime

import pytest
from helpers import frame, tuples

from pulseledger.operators import activity, identity

TRACKS = "id string, user_id string, anonymous_id string, context_group_id string, event string, timestamp timestamp"
IDENTIFIES = "id string, user_id string, anonymous_id string, timestamp timestamp"

TRACK_ROWS = [
    ("t1", "u1", "d1", "acme", "login", "2024-01-10 09:00:00"),
    ("t2", "u1", "d1", "beta", "login", "2024-01-11 09:00:00"),
    ("t3", None, "d1", None, "view", "2024-01-09 09:00:00"),  # device of u2, last seen in gamma
    ("t4", "u2", "d1", "gamma", "login", "2024-01-12 09:00:00"),
    ("t5", "u1", "d9", None, "click", "2024-01-12 10:00:00"),  # own user wins over the device
    ("t6", None, "d2", None, "view", "2024-01-12 10:00:00"),  # never identified: orphan
    ("t7", None, "d2", "acme", "view", "2024-01-12 10:00:00"),  # account known, user not
    ("t8", None, None, "acme", "view", "2024-01-12 10:00:00"),
    ("t9", "u3", "d3", None, "view", "2024-01-12 10:00:00"),  # user without any account: orphan
    ("t10", None, "d1", "acme", "view", "2024-01-12 10:00:00"),  # explicit account is kept
    ("t11", "u1", "d1", "old", "login", "2022-01-01 00:00:00"),  # outside the look-back
]
IDENTIFY_ROWS = [
    ("i1", "u1", "d1", "2024-01-01 00:00:00"),
    ("i2", "u2", "d1", "2024-01-02 00:00:00"),
    ("i3", None, "d2", "2024-01-02 00:00:00"),
    ("i4", "u9", "d2", "2022-01-02 00:00:00"),
]


@pytest.fixture
def raw(spark):
    return frame(spark, TRACKS, TRACK_ROWS), frame(spark, IDENTIFIES, IDENTIFY_ROWS)


def lookup(raw, cfg):
    tracks, identifies = raw
    return identity.lookup_map(identity.resolve_identity(identifies, cfg), identity.map_user_account(tracks, cfg))


def test_maps_are_last_touch(raw, cfg):
    tracks, identifies = raw
    assert tuples(identity.resolve_identity(identifies, cfg)) == [("d1", "u2")]
    assert tuples(identity.map_user_account(tracks, cfg)) == [("u1", "beta"), ("u2", "gamma")]


def test_equal_times_resolve_to_the_larger_value(spark, cfg):
    rows = [("i1", "ub", "d", "2024-01-01 00:00:00"), ("i2", "ua", "d", "2024-01-01 00:00:00")]
    assert tuples(identity.resolve_identity(frame(spark, IDENTIFIES, rows), cfg)) == [("d", "ub")]


EXPECTED = [
    ("t1", "u1", "acme"),
    ("t10", "u2", "acme"),
    ("t2", "u1", "beta"),
    ("t3", "u2", "gamma"),
    ("t4", "u2", "gamma"),
    ("t5", "u1", "beta"),
    ("t7", None, "acme"),
    ("t8", None, "acme"),
]


def test_stitching(raw, cfg):
    staged = identity.stage_tracks(raw[0], lookup(raw, cfg), cfg)
    assert tuples(staged, "event_id", "user_id", "account_id") == EXPECTED
    assert staged.columns == list(identity.TRACK_COLUMNS)
    own = tuples(staged, "event_id", "original_user_id", "original_account_id")
    assert ("t3", None, None) in own and ("t5", "u1", None) in own


def test_stitching_off(raw, cfg):
    off = cfg.replace(enable_identity_stitching=False)
    staged = identity.stage_tracks(raw[0], None, off)
    assert [r[0] for r in tuples(staged, "event_id")] == ["t1", "t10", "t2", "t4", "t7", "t8"]
    assert tuples(staged.select("anonymous_id").distinct()) == [(None,)]


def test_rolling_up_before_the_join_changes_nothing(raw, cfg):
    tracks = raw[0]
    for c in (cfg, cfg.replace(enable_identity_stitching=False)):
        found = lookup(raw, c) if c.enable_identity_stitching else None
        staged = identity.stage_tracks(tracks, found, c)
        early = activity.stitched_daily(tracks, found, c)
        assert tuples(early.select(*activity.daily(staged).columns)) == tuples(activity.daily(staged))
        minutes = activity.stitched_minutes(tracks, None, found, c)
        assert tuples(minutes) == tuples(activity.minutes(staged))


def test_missing_account_column(spark, raw, cfg):
    tracks = raw[0].drop("context_group_id")
    accounts = identity.map_user_account(tracks, cfg)
    assert accounts.count() == 0
    found = identity.lookup_map(identity.resolve_identity(raw[1], cfg), accounts)
    assert identity.stage_tracks(tracks, found, cfg).count() == 0


def test_renamed_columns(raw, cfg):
    tracks = raw[0].withColumnsRenamed({"context_group_id": "Org", "anonymous_id": "visitor"})
    identifies = raw[1].withColumnRenamed("anonymous_id", "visitor")
    renamed = cfg.replace(group_id_field="org", anonymous_id_field="visitor")
    staged = identity.stage_tracks(tracks, lookup((tracks, identifies), renamed), renamed)
    assert tuples(staged, "event_id", "user_id", "account_id") == EXPECTED


def test_fallback_event_time(spark, raw, cfg):
    tracks = raw[0].selectExpr("*", "IF(id = 't1', TIMESTAMP'2024-01-05 00:00:00', NULL) AS original_timestamp")
    c = cfg.replace(event_time_fields=("original_timestamp", "timestamp"), enable_identity_stitching=False)
    staged = identity.stage_tracks(tracks, None, c)
    times = dict(tuples(staged, "event_id", "event_at"))
    assert times["t1"] == datetime(2024, 1, 5) and times["t2"] == datetime(2024, 1, 11, 9)


def test_pages_without_optional_columns(spark, raw, cfg):
    pages = raw[0].selectExpr("id", "user_id", "anonymous_id", "context_group_id", "timestamp", "'u' AS properties_url")
    staged = identity.stage_pages(pages, lookup(raw, cfg), cfg)
    assert staged.columns == list(identity.PAGE_COLUMNS)
    row = staged.filter("page_id = 't3'").first()
    assert (row.user_id, row.account_id, row.page_name, row.page_title, row.page_url) == ("u2", "gamma", None, None, "u")


def test_lookback_reaches_the_scan(spark, raw, cfg, tmp_path):
    raw[0].write.parquet(str(tmp_path / "tracks"))
    staged = identity.stage_tracks(
        spark.read.parquet(str(tmp_path / "tracks")), None, cfg.replace(enable_identity_stitching=False)
    )
    plan = staged._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(timestamp" in plan
    assert "anonymous_id" not in plan.split("ReadSchema")[-1]

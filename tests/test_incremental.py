"""Incremental builds equal full builds over all batches, and touch only what a batch can change."""

import os
import random
from datetime import datetime, timedelta

import pytest
from helpers import tuples

from pulseledger.config import Config
from pulseledger.operators import activity
from pulseledger.plans import incremental, pipeline
from pulseledger.sources import files

TRACKS = "id string, user_id string, anonymous_id string, context_group_id string, event string, timestamp timestamp"
PAGES = "id string, user_id string, anonymous_id string, context_group_id string, name string, timestamp timestamp"
IDENTIFIES = "id string, user_id string, anonymous_id string, timestamp timestamp"
START = datetime(2024, 1, 1)


def config(day, **more):
    return Config(as_of=START + timedelta(days=day, hours=6), enable_identity_stitching=True, spine_start=datetime(2023, 12, 28).date(), **more)


def random_raw(rng, n):
    """Rows of tracks and identifies; devices change hands, accounts come late."""
    tracks, identifies = [], []
    for i in range(n):
        user = rng.choice([None, None, "u0", "u0", "u1", "u2", "u3", "u4"])
        account = rng.choice([None, None, "a", "b", "c"]) if user else rng.choice([None, None, None, "a"])
        at = START + timedelta(minutes=rng.randrange(0, 60 * 24 * 40) // 9 * 9)
        tracks.append((f"t{i}", user, rng.choice([None, "d0", "d1", "d2", "d3"]), account, rng.choice(["x", "y", "z"]), at))
    for i in range(12):
        at = START + timedelta(hours=rng.randrange(0, 24 * 40))
        identifies.append((f"i{i}", rng.choice(["u0", "u1", "u2", "new"]), rng.choice(["d0", "d1", "d2", "d3"]), at))
    return tracks, identifies


def inputs(spark, tracks, identifies, pages=None):
    return pipeline.Inputs(
        spark.createDataFrame(tracks, TRACKS),
        spark.createDataFrame(pages, PAGES) if pages is not None else None,
        spark.createDataFrame(identifies, IDENTIFIES),
    )


def contents(built):
    return {name: tuples(df.select(*sorted(df.columns))) for name, df in built.items() if not name.startswith(("int_", "stg_segment"))}


@pytest.mark.parametrize(("seed", "with_pages"), [(1, False), (2, True)])
def test_batches_equal_a_full_build(spark, tmp_path, seed, with_pages):
    rng = random.Random(seed)
    tracks, identifies = random_raw(rng, 400)
    pages = [(f"p{t[0]}", *t[1:4], "home", t[5] + timedelta(minutes=25)) for t in tracks[::4]] if with_pages else None
    more = {"include_pages_in_sessions": with_pages, "semantics": "documented" if with_pages else "literal"}
    # Each row is due on its day; a quarter comes one batch late, identifies also two.
    ends = (33, 38, 40, 45)

    def batch(rows, late):
        out = [[] for _ in ends]
        for row in rows:
            due = next(n for n, end in enumerate(ends) if row[-1] < START + timedelta(days=end))
            out[min(len(ends) - 2, due + rng.choice([0, 0, 0, *late]))].append(row)
        return out

    parts = zip(batch(tracks, [1]), batch(identifies, [1, 2]), batch(pages, [1]) if pages else [None] * len(ends), ends)
    store = str(tmp_path / "store")
    for number, (own_tracks, own_identifies, own_pages, day) in enumerate(parts):
        # The last batch is empty: only the calendar goes on.
        own = inputs(spark, own_tracks, own_identifies, own_pages if own_pages is not None or not pages else [])
        built = incremental.build_incremental(own, config(day, **more), store, number)
    full = pipeline.build(inputs(spark, tracks, identifies, pages), config(ends[-1], **more), str(tmp_path / "full"))
    got, expected = contents(built), contents(full)
    assert got.keys() == expected.keys()
    for name in expected:
        assert got[name] == expected[name], name


def test_without_stitching(spark, tmp_path):
    tracks, _ = random_raw(random.Random(11), 150)
    plain = dict(enable_identity_stitching=False)
    store = str(tmp_path / "store")
    for number, rows in enumerate((tracks[::2], tracks[1::2])):
        built = incremental.build_incremental(pipeline.Inputs(spark.createDataFrame(rows, TRACKS)), config(40 + number).replace(**plain), store, number)
    full = pipeline.build(pipeline.Inputs(spark.createDataFrame(tracks, TRACKS)), config(41).replace(**plain), str(tmp_path / "full"))
    assert contents(built) == contents(full)


def test_an_interrupted_batch_is_taken_up_again(spark, tmp_path, monkeypatch):
    tracks, identifies = random_raw(random.Random(5), 200)
    cut = START + timedelta(days=30)
    early, late = [r for r in tracks if r[-1] < cut][::2], [r for r in tracks if r[-1] >= cut] + [r for r in tracks if r[-1] < cut][1::2]
    store = str(tmp_path / "store")
    incremental.build_incremental(inputs(spark, early, identifies[::2]), config(30), store, "one")
    second = inputs(spark, late, identifies[1::2])
    for name in ("_update_accounts", "_update_membership"):
        with monkeypatch.context() as patched:
            patched.setattr(incremental, name, lambda *args: 1 / 0)
            with pytest.raises(ZeroDivisionError):
                incremental.build_incremental(second, config(40), store, "two")
    for _ in range(2):
        built = incremental.build_incremental(second, config(40), store, "two")
    full = pipeline.build(inputs(spark, tracks, identifies), config(40), str(tmp_path / "full"))
    assert contents(built) == contents(full)


def written(folder):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(folder) for f in names if f.endswith(".parquet")}


def days_written(before, after, table, key):
    return sorted({p.split(f"{key}=")[1][:10] for p in after if f"/{table}/" in p and before.get(p) != after[p]})


def test_a_day_in_order_touches_only_its_partitions(spark, tmp_path):
    tracks, identifies = random_raw(random.Random(7), 300)
    cut = START + timedelta(days=38)
    store = str(tmp_path / "store")
    early = [r for r in tracks if r[-1] < cut]
    # The day's users are new ones and need no look-up, so no older row moves.
    day = [(f"n{i}", f"n{i % 3}", None, "a", "x", cut + timedelta(hours=i)) for i in range(20)]
    incremental.build_incremental(inputs(spark, early, identifies), config(38), store, 0)
    before = written(store)
    incremental.build_incremental(inputs(spark, day, []), config(39), store, 1)
    after = written(store)
    assert days_written(before, after, "int_daily_activity", "activity_date") == ["2024-02-08"]
    assert days_written(before, after, "int_raw_activity", "activity_date") == ["2024-02-08"]
    assert days_written(before, after, "fct_sessions", "session_date") == ["2024-02-08"]
    assert days_written(before, after, "fct_account_metrics_daily", "metric_date") == ["2024-02-08"]
    assert days_written(before, after, "fct_account_feature_usage_monthly", "metric_month") == ["2024-02-01"]
    with pytest.raises(ValueError, match="back in time"):
        incremental.build_incremental(inputs(spark, [], []), config(30), store, 2)


def test_first_batch_must_be_complete(spark, tmp_path):
    files.write_text(spark, str(tmp_path / "store/_batches/first"), "0")
    with pytest.raises(RuntimeError, match="not complete"):
        incremental.build_incremental(inputs(spark, [], []), config(1), str(tmp_path / "store"), 1)


def test_a_build_reads_raw_tracks_once(spark, tmp_path):
    tracks, identifies = random_raw(random.Random(9), 100)
    raw = inputs(spark, tracks, identifies)
    rows = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            rows.add(batch.num_rows)
            yield batch

    seen = pipeline.Inputs(raw.tracks.mapInArrow(counted, raw.tracks.schema), None, raw.identifies)
    pipeline.build(seen, config(40), str(tmp_path / "tables"))
    assert rows.value == len(tracks)


def test_daily_rows_are_compared_in_one_grouping(spark):
    cfg = config(40)
    tracks, identifies = random_raw(random.Random(9), 200)

    def daily(rows):
        return activity.daily_from_raw(activity.raw_rollup(inputs(spark, rows, identifies).tracks, None, plain), None, plain)

    plain = cfg.replace(enable_identity_stitching=False, include_pages_in_sessions=False)
    before, now = daily(tracks[:150]), daily(tracks[50:])
    raw = activity.raw_rollup(inputs(spark, tracks[50:], identifies).tracks, None, plain)
    compared = activity.daily_against(raw, None, plain, before)
    found = activity.daily_differing(compared)
    wanted = now.exceptAll(before).selectExpr("*", "false AS gone").unionByName(before.exceptAll(now).selectExpr("*", "true AS gone"))
    assert found.count() > 0 and sorted(map(repr, found.collect())) == sorted(map(repr, wanted.collect()))
    assert sorted(map(repr, activity.daily_now(compared).collect())) == sorted(map(repr, now.collect()))
    # What differs follows row by row.
    stored = spark.createDataFrame(compared.collect(), compared.schema)
    assert "Exchange" not in activity.daily_differing(stored)._jdf.queryExecution().executedPlan().toString()

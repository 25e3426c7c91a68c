import random
from datetime import datetime, timedelta

import pytest
from helpers import frame, ts, tuples

from pulseledger.operators.sessions import (
    combine_events,
    events_since,
    sessionize,
    sessionize_incremental,
)

EVENTS = "user_id string, account_id string, event_at timestamp"


def numbered(df):
    return tuples(df, "user_id", "user_session_index", "events_in_session", "session_duration_seconds")


def events(spark, rows):
    return frame(spark, EVENTS, [(u, "acct", t) for u, t in rows])


def test_basic_grouping(spark):
    rows = [("A", "10:00"), ("A", "10:10"), ("A", "11:10"), ("B", "14:00")]
    assert numbered(sessionize(events(spark, rows))) == [("A", 0, 2, 600), ("A", 1, 1, 0), ("B", 0, 1, 0)]


def test_gap_of_exactly_the_timeout_stays(spark):
    assert numbered(sessionize(events(spark, [("A", "10:00"), ("A", "10:30")]))) == [("A", 0, 2, 1800)]
    assert len(numbered(sessionize(events(spark, [("A", "10:00"), ("A", "10:31")])))) == 2


def test_minute_boundaries_count_not_elapsed_time(spark):
    # 30 min 1 s apart but 31 boundaries; and 30 min 58 s apart, 30 boundaries.
    assert len(numbered(sessionize(events(spark, [("A", "10:00:59"), ("A", "10:31:00")])))) == 2
    assert len(numbered(sessionize(events(spark, [("A", "10:00:01"), ("A", "10:30:59")])))) == 1


def test_users_are_separate(spark):
    rows = [("A", "10:00"), ("B", "10:05"), ("A", "10:10"), ("B", "10:15")]
    assert [r[:3] for r in numbered(sessionize(events(spark, rows)))] == [("A", 0, 2), ("B", 0, 2)]


@pytest.mark.parametrize(
    ("tracks", "pages", "expected"),
    [
        (["10:00", "10:20"], ["10:10", "11:00"], [("A", 0, 3, 1200), ("A", 1, 1, 0)]),
        ([], ["10:00", "10:15", "11:00"], [("A", 0, 2, 900), ("A", 1, 1, 0)]),
        (["10:00", "10:10", "10:20"], ["10:05", "10:15"], [("A", 0, 5, 1200)]),
    ],
)
def test_tracks_with_pages(spark, tracks, pages, expected):
    track_rows = events(spark, [("A", t) for t in tracks])
    page_rows = events(spark, [("A", t) for t in pages]).withColumnRenamed("event_at", "page_viewed_at")
    assert numbered(sessionize(combine_events(track_rows, page_rows))) == expected


def test_account_is_that_of_the_first_event(spark):
    rows = [("A", "y", "10:00"), ("A", "x", "10:05"), ("B", "z", "10:00"), ("B", "w", "10:00")]
    got = tuples(sessionize(frame(spark, EVENTS, rows)), "user_id", "account_id")
    # B's events tie; the smaller account id wins.
    assert got == [("A", "y"), ("B", "w")]


def test_null_users_form_one_sequence_unless_dropped(spark):
    rows = [(None, "x", "10:00"), (None, "y", "10:10"), ("A", "x", "10:00")]
    df = frame(spark, EVENTS, rows)
    assert tuples(sessionize(df), "user_id", "events_in_session") == [("A", 1), (None, 2)]
    assert tuples(sessionize(df, drop_null_user=True), "user_id") == [("A",)]


def test_zero_timeout(spark):
    rows = [("A", "10:00:05"), ("A", "10:00:50"), ("A", "10:01:00")]
    assert [r[:3] for r in numbered(sessionize(events(spark, rows), 0))] == [("A", 0, 2), ("A", 1, 1)]


def plain_sessions(rows, timeout):
    """Reference computation, event by event."""
    out = []
    for user in sorted({r[0] for r in rows}, key=repr):
        mine = sorted((t, a) for u, a, t in rows if u == user)
        index, current = -1, []
        for t, a in mine:
            minute = t.replace(second=0, microsecond=0)
            if not current or (minute - current[-1][0].replace(second=0, microsecond=0)).total_seconds() > timeout * 60:
                index += 1
                current = []
                out.append([user, index, t, t, 0, a])
            current.append((t, a))
            out[-1][3], out[-1][4] = t, out[-1][4] + 1
    return sorted((tuple(r) for r in out), key=repr)


def random_rows(rng, n, users=5):
    start = datetime(2024, 1, 1)
    names = [f"u{i}" for i in range(users)] + [None]
    # A third of the events belongs to u0.
    return [
        (
            "u0" if rng.random() < 0.33 else rng.choice(names),
            rng.choice("xyz"),
            start + timedelta(seconds=rng.randrange(0, 86400 * 4) // rng.choice([1, 60, 600]) * 7 % (86400 * 4)),
        )
        for _ in range(n)
    ]


def got_sessions(df):
    columns = ("user_id", "user_session_index", "session_start_at", "session_end_at", "events_in_session", "account_id")
    return tuples(df, *columns)


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("timeout", [5, 30])
def test_equals_event_by_event_computation(spark, seed, timeout):
    rows = random_rows(random.Random(seed), 600)
    df = spark.createDataFrame(rows, EVENTS)
    assert got_sessions(sessionize(df, timeout)) == plain_sessions(rows, timeout)


@pytest.mark.parametrize("seed", [3, 4, 5])
def test_incremental_equals_full_with_late_events(spark, seed):
    rng = random.Random(seed)
    rows = random_rows(rng, 500)
    first = [r for r in rows if rng.random() < 0.6]
    rest = list(rows)
    for r in first:
        rest.remove(r)
    stored = sessionize(spark.createDataFrame(first, EVENTS))
    merged = sessionize_incremental(stored, spark.createDataFrame(rest, EVENTS))
    assert got_sessions(merged) == plain_sessions(rows, 30)
    full = sessionize(spark.createDataFrame(rows, EVENTS))
    assert tuples(merged, "session_id", "user_id") == tuples(full, "session_id", "user_id")


def test_incremental_into_an_empty_table(spark):
    rows = random_rows(random.Random(6), 50)
    df = spark.createDataFrame(rows, EVENTS)
    empty = sessionize(df.limit(0))
    assert got_sessions(sessionize_incremental(empty, df)) == plain_sessions(rows, 30)


def test_events_since(spark):
    df = events(spark, [("A", "10:00"), ("A", "10:20"), ("A", "12:00")])
    stored = sessionize(df.filter("event_at < TIMESTAMP'2024-01-01 11:00:00'"))
    assert tuples(events_since(df, stored), "event_at") == [(ts("10:00"),), (ts("10:20"),), (ts("12:00"),)]
    assert events_since(df, stored.limit(0)).count() == 3

"""The stored session table: state per user, what a batch reads, users computed anew."""

import random
from datetime import datetime, timedelta

import pytest
from helpers import frame, tuples

from pulseledger.operators import activity
from pulseledger.operators.sessions import SESSION_COLUMNS, number_from, sessionize
from pulseledger.sources import files, session_store, sinks

EVENTS = "user_id string, account_id string, event_at timestamp"


def events(spark, rows):
    return frame(spark, EVENTS, [(u, "acct", t) for u, t in rows])


def stored(spark, path):
    return tuples(session_store.read_sessions(spark, path).select(*SESSION_COLUMNS))


def full(df):
    return tuples(sessionize(df).select(*SESSION_COLUMNS))


def state(spark, path):
    found = spark.read.parquet(f"{path}_users").collect()
    return {r.user_id: (r.last_index, r.last_end_at, r.start_days) for r in found}


def expected_state(df):
    out = {}
    for r in sessionize(df).orderBy("user_session_index").collect():
        days = out.get(r.user_id, (0, 0, []))[2]
        out[r.user_id] = (r.user_session_index, r.session_end_at, sorted({*days, r.session_start_at.date()}))
    return out


def random_events(spark, rng, n):
    start = datetime(2024, 1, 1)
    users = [f"u{i}" for i in range(6)] + [None]
    rows = [
        ("u0" if rng.random() < 0.33 else rng.choice(users), rng.choice("xyz"), start + timedelta(minutes=rng.randrange(0, 1440 * 9) // 7 * 7))
        for _ in range(n)
    ]
    return rows, spark.createDataFrame(rows, EVENTS)


@pytest.mark.parametrize("seed", [1, 2])
def test_batches_in_any_order_equal_a_full_computation(spark, tmp_path, seed):
    rng = random.Random(seed)
    rows, _ = random_events(spark, rng, 500)
    path, seen = str(tmp_path / "sessions"), []
    for number in range(4):
        batch = [r for r in rows if rng.random() < (0.4, 0.5, 0.6, 1)[number] and r not in seen]
        seen += batch
        session_store.upsert_sessions(spark.createDataFrame(batch, EVENTS), path, number)
        df = spark.createDataFrame(seen, EVENTS)
        assert stored(spark, path) == full(df)
        assert state(spark, path) == expected_state(df)


def spoil(folder):
    """Make every file of a folder unreadable."""
    found = list(folder.glob("*.parquet"))
    assert found
    for f in found:
        f.write_bytes(b"not parquet")


def test_a_batch_reads_only_the_days_and_buckets_it_can_change(spark, tmp_path):
    path = str(tmp_path / "sessions")
    first = [("A", f"2024-01-0{d} 10:00:00") for d in range(1, 8)] + [("B", "2024-01-07 09:00:00"), ("B", "2024-01-07 12:00:00")]
    session_store.upsert_sessions(events(spark, first), path, 0)
    buckets = {r.user_id: r.bucket for r in spark.read.parquet(f"{path}_users").collect()}
    assert buckets["A"] != buckets["B"]
    for day in range(1, 7):
        spoil(tmp_path / "sessions" / f"session_date=2024-01-0{day}")
    spoil(tmp_path / "sessions_users" / f"bucket={buckets['A']}")
    # B goes on, and has a late event on its only day.
    second = [("B", "2024-01-07 12:20:00"), ("B", "2024-01-07 10:30:00"), ("B", "2024-01-09 08:00:00")]
    session_store.upsert_sessions(events(spark, second), path, 1)
    table = session_store.read_sessions(spark, path).filter("session_date >= DATE'2024-01-07'").select(*SESSION_COLUMNS)
    wanted = sessionize(events(spark, first + second)).filter("session_start_at >= TIMESTAMP'2024-01-07 00:00:00'")
    assert tuples(table) == tuples(wanted.select(*SESSION_COLUMNS))


def test_a_user_whose_last_session_is_over_reads_no_day(spark, tmp_path):
    path = str(tmp_path / "sessions")
    first = [("A", "2024-01-01 10:00:00"), ("A", "2024-01-02 10:00:00")]
    session_store.upsert_sessions(events(spark, first), path, 0)
    for day in (1, 2):
        spoil(tmp_path / "sessions" / f"session_date=2024-01-0{day}")
    session_store.upsert_sessions(events(spark, [("A", "2024-01-03 10:00:00")]), path, 1)
    found = session_store.read_sessions(spark, path).filter("session_date = DATE'2024-01-03'").first()
    assert found.user_session_index == 2


def test_a_session_over_midnight_is_found(spark, tmp_path):
    path = str(tmp_path / "sessions")
    first = [("A", "2024-01-01 23:50:00"), ("A", "2024-01-02 00:10:00"), ("A", "2024-01-02 10:00:00"), ("A", "2023-12-30 10:00:00")]
    late = [("A", "2024-01-02 00:15:00")]
    session_store.upsert_sessions(events(spark, first), path, 0)
    session_store.upsert_sessions(events(spark, late), path, 1)
    assert stored(spark, path) == full(events(spark, first + late))


def test_state_is_made_for_a_table_written_as_a_whole(spark, tmp_path):
    path = str(tmp_path / "sessions")
    first, second = [("A", "2024-01-01 10:00:00"), ("B", "2024-01-02 10:00:00")], [("A", "2024-01-01 09:45:00"), ("C", "2024-01-01 09:00:00")]
    session_store.upsert_sessions(events(spark, second), path, 0)
    # Replacing the table forgets the state and the logs of the old one.
    sinks.write_sessions(sessionize(events(spark, first)), path)
    session_store.upsert_sessions(events(spark, second), path, 0)
    assert stored(spark, path) == full(events(spark, first + second))


def test_users_computed_anew(spark, tmp_path):
    """Events of an unknown user turn out to be A's; B loses all of its own to C."""
    path = str(tmp_path / "sessions")
    old = [(None, "2024-01-01 10:00:00"), (None, "2024-01-05 10:00:00"), ("A", "2024-01-01 10:20:00"), ("A", "2024-01-03 10:00:00"), ("B", "2024-01-02 10:00:00"), ("D", "2024-01-02 10:00:00")]
    session_store.upsert_sessions(events(spark, old), path, 0)
    now = [("A", "2024-01-01 10:00:00"), (None, "2024-01-05 10:00:00"), ("A", "2024-01-01 10:20:00"), ("A", "2024-01-03 10:00:00"), ("C", "2024-01-02 10:00:00"), ("D", "2024-01-02 10:00:00")]
    batch = [("D", "2024-01-02 10:10:00"), ("A", "2024-01-03 10:10:00")]
    every = activity.minutes(events(spark, now + batch))
    days = []

    def minutes(of):
        days.extend(of)
        return every.filter("user_id IS NULL OR user_id IN ('A', 'B', 'C')")

    users = spark.createDataFrame([("A",), ("B",), ("C",), (None,)], "user_id string")
    for _ in range(2):
        session_store.update_sessions(activity.minutes(events(spark, batch)), path, 1, again=session_store.Again(users, minutes))
        assert stored(spark, path) == full(events(spark, now + batch))
        assert state(spark, path) == expected_state(events(spark, now + batch))
    assert {d.day for d in days} == {1, 2, 3, 5}


def test_a_batch_makes_no_calls_for_earlier_batches(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "sessions")
    calls = []
    for name in ("exists", "delete"):
        real = getattr(files, name)
        monkeypatch.setattr(files, name, lambda s, p, real=real: (calls.append(p), real(s, p))[1])
    counts = []
    for number in range(4):
        calls.clear()
        session_store.upsert_sessions(events(spark, [("A", f"2024-01-0{number + 1} 10:00:00")]), path, number)
        counts.append(len(calls))
    assert counts[2] == counts[3]
    assert files.exists(spark, f"{path}_log/batch=0/applied") and not files.exists(spark, f"{path}_log/batch=0/rows")


def test_a_batch_that_is_done_writes_no_day_again(spark, tmp_path):
    path = str(tmp_path / "sessions")
    for _ in range(2):
        session_store.upsert_sessions(events(spark, [("A", "2024-01-01 10:00:00")]), path, 0)
        times = {f: f.stat().st_mtime_ns for f in tmp_path.rglob("*.parquet")}
        session_store.upsert_sessions(events(spark, [("A", "2024-01-01 10:00:00")]), path, 0)
        assert {f: f.stat().st_mtime_ns for f in tmp_path.rglob("*.parquet")} == times
    assert stored(spark, path) == full(events(spark, [("A", "2024-01-01 10:00:00")]))


def test_sessions_are_numbered_without_a_second_shuffle(spark):
    rows = [("A", "2024-01-01 10:00:00", 5), ("A", "2024-01-01 12:00:00", 7), ("A", "2024-01-01 12:10:00", 7), (None, "2024-01-01 10:00:00", 0)]
    spans = frame(spark, "user_id string, first_at timestamp, span_index long", rows).selectExpr(
        "user_id", "first_at", "first_at AS last_at", "1L AS n_events", "'x' AS account_id", "span_index"
    )
    found = number_from(spans, 30)
    assert [(r.user_id, r.user_session_index, r.events_in_session) for r in found.orderBy("user_id", "user_session_index").collect()] == [
        (None, 0, 1),
        ("A", 5, 1),
        ("A", 6, 2),
    ]
    assert found._jdf.queryExecution().sparkPlan().toString().count("Join") == 0
    assert number_from(spans, 30)._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1

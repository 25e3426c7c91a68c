from datetime import timedelta

import pytest
from helpers import frame, tuples

from pulseledger import streaming
from pulseledger.operators.sessions import SESSION_COLUMNS, sessionize
from pulseledger.sources import files
from pulseledger.streaming import sessions

EVENTS = "event_id string, user_id string, account_id string, event_at timestamp"

BATCHES = [
    [("e1", "A", "x", "2024-01-01 10:00:00"), ("e2", "A", "y", "2024-01-01 10:30:30"), ("e3", "B", "x", "2024-01-01 10:00:59")],
    [("e4", "B", "x", "2024-01-01 10:31:00"), ("e5", "A", "x", "2024-01-01 12:00:00"), ("e1", "A", "x", "2024-01-01 10:00:00")],
    [("e6", "C", "x", "2024-01-03 00:00:00"), ("e7", "A", "x", "2024-01-01 10:45:00")],
]


def arriving(spark, tmp_path):
    """A stream of one file per batch."""
    folder = str(tmp_path / "in")
    for i, rows in enumerate(BATCHES):
        frame(spark, EVENTS, rows).coalesce(1).write.mode("append").parquet(f"{folder}/batch={i}")
    schema = spark.read.parquet(f"{folder}/batch=0").schema
    return streaming.read_stream(spark, f"{folder}/batch=*", schema, max_files=1).select("event_id", "user_id", "account_id", "event_at")


def drain(stream, tmp_path, name):
    out = str(tmp_path / name)
    streaming.emit_sessions(stream, out, f"{out}_state", once=True).awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(out)


def test_closed_sessions_equal_batch(spark, cfg, tmp_path):
    got = drain(streaming.streaming_sessions(arriving(spark, tmp_path), cfg), tmp_path, "out")
    in_order = [r for rows in BATCHES for r in rows if r[0] not in ("e7", "e6")]
    expected = sessionize(frame(spark, EVENTS, in_order))
    columns = ("user_id", "session_start_at", "session_end_at", "events_in_session", "account_id")
    stream_rows = [r for r in tuples(got, *columns)]
    for row in tuples(expected, *columns):
        if row[0] == "B":  # no late event touches B
            assert row in stream_rows
    assert not [r for r in stream_rows if r[0] == "C"]  # still open


def test_deduplication(spark, tmp_path):
    got = drain(streaming.deduplicate(arriving(spark, tmp_path), "3 days"), tmp_path, "unique")
    assert [r[0] for r in tuples(got, "event_id")] == ["e1", "e2", "e3", "e4", "e5", "e6", "e7"]


def test_daily_counts(spark, tmp_path):
    got = drain(streaming.daily_counts(arriving(spark, tmp_path), "account_id"), tmp_path, "counts")
    assert tuples(got, "account_id", "n_events") == [("x", 6), ("y", 1)]


def test_sliding_actives(spark, tmp_path):
    got = drain(streaming.approx_sliding_actives(arriving(spark, tmp_path), 7), tmp_path, "actives")
    assert tuples(got.filter("metric_date = DATE'2024-01-01'"), "approx_users", "approx_accounts") == [(2, 2)]


def test_upserts_take_late_events_in(spark, cfg, tmp_path):
    path = str(tmp_path / "table")
    streaming.upsert_sessions_stream(arriving(spark, tmp_path), path, f"{path}_state", cfg, once=True).awaitTermination()
    everything = frame(spark, EVENTS, [r for rows in BATCHES for r in rows])
    got = tuples(spark.read.parquet(path).select(*SESSION_COLUMNS))
    assert got == tuples(sessionize(everything).select(*SESSION_COLUMNS))


def test_late_rows_are_set_aside_and_merged_later(spark, cfg, tmp_path, monkeypatch):
    path = str(tmp_path / "table")
    stream = arriving(spark, tmp_path)
    streaming.upsert_sessions_stream(stream, path, f"{path}_state", cfg, once=True, delay=timedelta(hours=1)).awaitTermination()
    rows = [r for batch in BATCHES for r in batch]

    def table():
        return tuples(spark.read.parquet(path).select(*SESSION_COLUMNS))

    def full(kept):
        return tuples(sessionize(frame(spark, EVENTS, kept)).select(*SESSION_COLUMNS))

    # When e7 (10:45) came, 12:00 had been seen; e1 came twice, but in time.
    late = streaming.late_rows(spark, path, stream.schema)
    assert [(r.event_id, r.batch) for r in late.collect()] == [("e7", 2)]
    assert table() == full([r for r in rows if r[0] != "e7"])
    with monkeypatch.context() as patched:
        patched.setattr(files, "delete", lambda *args: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            streaming.reconcile_late(spark, path, stream.schema, cfg)
    assert streaming.reconcile_late(spark, path, stream.schema, cfg) == 1
    assert table() == full(rows)
    assert streaming.reconcile_late(spark, path, stream.schema, cfg) == 0
    assert table() == full(rows)


def test_a_repeated_batch_is_split_in_the_same_way(spark, cfg, tmp_path):
    path = str(tmp_path / "table")
    first, second = (frame(spark, EVENTS, rows) for rows in (BATCHES[1], [("x", "A", "a", "2024-01-01 09:00:00"), ("y", "A", "a", "2024-01-04 09:00:00")]))
    for number, batch in enumerate((first, second, second)):
        kept = sessions._set_late_aside(batch, path, min(number, 1), timedelta(hours=1))
        assert kept.count() == (3, 1, 1)[number]
    assert streaming.late_rows(spark, path, first.schema).count() == 1

import json
import re
from datetime import date
from pathlib import Path

import pytest
from helpers import frame, tuples

from pulseledger import catalog
from pulseledger.config import Config
from pulseledger.operators import docs, quality
from pulseledger.operators.sessions import SESSION_COLUMNS, sessionize
from pulseledger.plans import accounts, pipeline
from pulseledger.session import materialize, shared_dir
from pulseledger.sources import readers, schemas, session_store, sinks, testdata

SF = "/root/testdata/sf0.001"
EVENTS = "user_id string, account_id string, event_at timestamp"

TRACKS_CSV = """id,user_id,anonymous_id,context_group_id,event,event_text,timestamp,received_at,sent_at
t1,u1,d1,acme,login,Log in,2024-01-10 09:00:00,2024-01-10 09:00:01,2024-01-10 09:00:00
t2,,d1,,view,View,2024-01-10 09:10:00,2024-01-10 09:10:01,2024-01-10 09:10:00
"""
PAGES_CSV = "id,user_id,anonymous_id,context_group_id,url,title,timestamp\np1,u1,d1,acme,/,Home,2024-01-10 09:05:00\n"
IDENTIFIES_CSV = "id,user_id,anonymous_id,timestamp\ni1,u1,d1,2024-01-10 08:00:00\n"


@pytest.fixture
def seeds(tmp_path):
    for name, text in (("tracks", TRACKS_CSV), ("pages", PAGES_CSV), ("identifies", IDENTIFIES_CSV)):
        (tmp_path / f"{name}.csv").write_text(text)
    return tmp_path


def seed_config(cfg, seeds):
    return cfg.replace(sources={n: f"{seeds}/{n}.csv" for n in ("tracks", "pages", "identifies")}, include_pages_in_sessions=True)


def test_seed_types_and_absent_columns(spark, cfg, seeds):
    c = seed_config(cfg, seeds)
    tracks = readers.read_tracks(spark, c)
    assert dict(tracks.dtypes)["timestamp"] == "timestamp" and tracks.first().user_id == "u1"
    assert tracks.filter("id = 't2'").first().user_id is None
    assert "name" not in readers.read_pages(spark, c).columns


def test_malformed_seed_fails(spark, tmp_path):
    (tmp_path / "bad.csv").write_text("id,timestamp\nt1,yesterday\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        readers.read_seed(spark, str(tmp_path / "bad.csv"), schemas.TRACKS).collect()


def test_build_from_seeds(spark, cfg, seeds):
    c = seed_config(cfg, seeds)
    written = pipeline.build(pipeline.Inputs.read(spark, c), c, str(seeds / "out"))
    session = written["fct_sessions"].first()
    assert (session.user_id, session.events_in_session, session.session_duration_seconds) == ("u1", 3, 600)
    assert written["stg_segment_pages"].first().page_name is None
    assert spark.sql("SELECT count(*) FROM fct_account_metrics_daily").first()[0] == 21
    stored = spark.read.parquet(str(seeds / "out" / "fct_account_metrics_daily"))
    assert docs.column_comments(stored)["dau"] == docs.COLUMN_DOCS["dau"]
    report = quality.run_checks(written)
    assert {r.n_violations for r in report.collect()} == {0}


def test_build_without_stitching(spark, cfg, seeds):
    c = seed_config(cfg, seeds).replace(enable_identity_stitching=False, include_pages_in_sessions=False)
    written = pipeline.build(pipeline.Inputs.read(spark, c), c, str(seeds / "plain"))
    assert "stg_identity_resolution" not in written and "stg_segment_pages" not in written
    assert written["stg_segment_tracks"].count() == 1


def test_every_output_column_is_documented(spark):

    for key in ("account_health", "user_snapshot", "product_trends", "feature_usage", "sessions", "dim_accounts", "dim_users"):
        missing = set(catalog.QUERIES[key](spark, SF).columns) - set(docs.COLUMN_DOCS)
        assert not missing, (key, missing)



def test_source_locations():
    c = Config(as_of=catalog.MAIN.as_of, source_database="db", source_schema="s", sources={"pages": "page_views", "users": "/x/u"})
    assert readers.source_location(c, "tracks") == "db.s.tracks"
    assert readers.source_location(c, "pages") == "db.s.page_views"
    assert readers.source_location(c, "users") == "/x/u"


def test_table_and_file_sources(spark, cfg, tmp_path):
    rows = [("g1", "acme", "Acme"), ("g2", "beta", "Beta")]
    df = frame(spark, "id string, group_id string, name string", rows)
    sinks.register(df, "crm_groups")
    assert tuples(readers.read_groups(spark, cfg.replace(sources={"groups": "crm_groups"}))) == rows
    for fmt in ("orc", "json", "parquet"):
        df.write.format(fmt).save(str(tmp_path / f"g.{fmt}"))
        read = readers.read_groups(spark, cfg.replace(sources={"groups": str(tmp_path / f"g.{fmt}")}))
        assert tuples(read, "id", "group_id", "name") == rows
    users = testdata.TestTables(spark, SF).users
    users.write.parquet(str(tmp_path / "users.parquet"))
    assert readers.read_users(spark, cfg.replace(sources={"users": str(tmp_path / "users.parquet")})).count() == users.count()


def test_config_rejects_nonsense():
    with pytest.raises(ValueError):
        Config(as_of=catalog.MAIN.as_of, semantics="guess")
    with pytest.raises(ValueError):
        Config(as_of=catalog.MAIN.as_of, session_timeout_minutes=-1)


def test_partitioned_table_is_pruned(spark, tmp_path):
    df = spark.range(100).selectExpr("id", "date_add(DATE'2024-01-01', CAST(id % 5 AS INT)) AS d")
    table = sinks.write_table(df, str(tmp_path / "t"), ["d"])
    plan = table.filter("d = DATE'2024-01-02'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(d" in plan
    assert table.filter("d = DATE'2024-01-02'").count() == 20


def test_alert_file(spark, tmp_path):
    sinks.write_alerts(spark.range(3).selectExpr("concat('a', id) AS account_id", "id AS wau"), str(tmp_path / "alerts"))
    lines = [json.loads(x) for f in Path(tmp_path / "alerts").glob("*.json") for x in f.read_text().splitlines()]
    assert sorted(x["account_id"] for x in lines) == ["a0", "a1", "a2"]


def test_materialize_uses_the_named_folder(spark):
    df = materialize(spark.range(5), "five")
    assert df.count() == 5 and df.inputFiles()[0].startswith(f"file://{shared_dir(spark)}")


def test_shared_folder_is_required_on_a_cluster():
    class Cluster:
        conf = type("Conf", (), {"get": staticmethod(lambda key, default=None: None)})
        sparkContext = type("Context", (), {"master": "yarn"})

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(Cluster())


def events(spark, rows):
    return frame(spark, EVENTS, [(u, "acct", t) for u, t in rows])


def stored(spark, path):
    return tuples(spark.read.parquet(path).select(*SESSION_COLUMNS))


def test_upsert_moves_sessions_between_days_and_repeats_safely(spark, tmp_path):
    path = str(tmp_path / "sessions")
    first = [("A", "2024-01-01 23:20:00"), ("A", "2024-01-02 00:10:00"), ("B", "2024-01-01 10:00:00"), ("B", "2024-01-03 10:00:00")]
    late = [("A", "2024-01-01 23:45:00"), ("B", "2024-01-02 09:00:00"), (None, "2024-01-01 01:00:00")]
    sinks.upsert_sessions(events(spark, first), path, 0)
    assert (tmp_path / "sessions" / "session_date=2024-01-02").exists()
    # The late event joins A's two sessions, which leaves Jan 2 to B alone.
    sinks.upsert_sessions(events(spark, late), path, 1)
    expected = tuples(sessionize(events(spark, first + late)).select(*SESSION_COLUMNS))
    assert stored(spark, path) == expected
    sinks.upsert_sessions(events(spark, late), path, 1)
    assert stored(spark, path) == expected


def test_upsert_drops_an_emptied_day(spark, tmp_path):
    path = str(tmp_path / "sessions")
    first = [("A", "2024-01-01 23:20:00"), ("A", "2024-01-02 00:10:00")]
    late = [("A", "2024-01-01 23:45:00")]
    sinks.upsert_sessions(events(spark, first), path, 0)
    sinks.upsert_sessions(events(spark, late), path, 1)
    assert stored(spark, path) == tuples(sessionize(events(spark, first + late)).select(*SESSION_COLUMNS))
    days = {r[0] for r in spark.read.parquet(path).select("session_date").distinct().collect()}
    assert days == {date(2024, 1, 1)}


def test_upsert_recovers_from_an_interrupted_copy(spark, tmp_path):
    path = str(tmp_path / "sessions")
    first, second = [("A", "2024-01-01 10:00:00")], [("A", "2024-01-01 10:10:00"), ("B", "2024-01-02 10:00:00")]
    sinks.upsert_sessions(events(spark, first), path, 0)
    sinks.upsert_sessions(events(spark, second), path, 1)
    expected = stored(spark, path)
    # As if the copy had written Jan 1 and not Jan 2.
    for f in (tmp_path / "sessions" / "session_date=2024-01-02").glob("*.parquet"):
        f.unlink()
    sinks.upsert_sessions(events(spark, second), path, 1)
    assert stored(spark, path) == expected


def test_batches_repeat_safely_from_the_first_on(spark, tmp_path):
    path = str(tmp_path / "sessions")
    first, second = [("A", "2024-01-01 10:00:00")], [("A", "2024-01-01 10:00:00"), ("B", "2024-01-02 10:00:00")]
    sinks.upsert_sessions(events(spark, first).limit(0), path, 0)
    assert sinks.read_sessions(spark, path).count() == 0
    for _ in range(2):
        sinks.upsert_sessions(events(spark, first), path, 1)
    for _ in range(2):
        sinks.upsert_sessions(events(spark, second), path, 2)
    expected = tuples(sessionize(events(spark, first + second)).select(*SESSION_COLUMNS))
    assert stored(spark, path) == expected
    # A batch whose log was reduced to its marker is done.
    assert not (tmp_path / "sessions_log" / "batch=1" / "rows").exists()
    sinks.upsert_sessions(events(spark, first), path, 1)
    assert stored(spark, path) == expected


def test_a_crash_between_log_and_copy_loses_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "sessions")
    rows = [("A", "2024-01-01 10:00:00"), ("B", "2024-01-02 10:00:00")]
    with monkeypatch.context() as patched:
        patched.setattr(session_store, "_copy", lambda *args: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            sinks.upsert_sessions(events(spark, rows), path, 0)
    sinks.upsert_sessions(events(spark, rows), path, 0)
    assert stored(spark, path) == tuples(sessionize(events(spark, rows)).select(*SESSION_COLUMNS))


def test_stored_sessions_are_pruned_by_start_day(spark, tmp_path):
    table = sinks.write_sessions(sessionize(events(spark, [("A", "2024-01-01 10:00:00"), ("A", "2024-01-05 10:00:00")])), str(tmp_path / "s"))
    recent = accounts.daily_sessions(table).filter("session_date > DATE'2024-01-02'")
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*session_date", plan)
    assert recent.count() == 1


def test_checks(spark):
    df = frame(spark, "id string, n int", [("a", 1), ("a", -1), (None, 2), (None, None)])
    assert quality.check_not_null(df, "id").count() == 2
    assert tuples(quality.check_unique(df, "id")) == [("a", 2)]
    assert tuples(quality.check_expr(df, "n >= 0"), "n") == [(-1,)]
    suite = quality.Suite("t", ("id", "n"), ("id",), ("n >= 0",))
    report = {(r.check_name, r.subject): r.n_violations for r in quality.run_suite(df, suite).collect()}
    assert report == {("not_null", "id"): 2, ("not_null", "n"): 1, ("expression", "n >= 0"): 1, ("unique", "id"): 1}


def test_checks_read_a_relation_once_unless_values_repeat(spark):
    rows = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            rows.add(batch.num_rows)
            yield batch

    def report(df):
        rows.value = 0
        seen = df.mapInArrow(counted, df.schema)
        suite = quality.Suite("t", ("id", "n"), ("id", "n"), ("n >= 0", "n < 100"))
        return {(r.check_name, r.subject): r.n_violations for r in quality.run_suite(seen, suite).collect()}, rows.value

    healthy = frame(spark, "id string, n int", [(f"k{i}", i) for i in range(50)])
    assert report(healthy) == ({("not_null", "id"): 0, ("not_null", "n"): 0, ("expression", "n >= 0"): 0, ("expression", "n < 100"): 0, ("unique", "id"): 0, ("unique", "n"): 0}, 50)
    spoiled = frame(spark, "id string, n int", [("a", 1), ("a", 2), ("a", 3), ("b", 3), (None, None), (None, -1)])
    found, _ = report(spoiled)
    assert found == {("not_null", "id"): 2, ("not_null", "n"): 1, ("expression", "n >= 0"): 1, ("expression", "n < 100"): 0, ("unique", "id"): 1, ("unique", "n"): 1}
    assert report(healthy.limit(0))[0][("unique", "id")] == 0

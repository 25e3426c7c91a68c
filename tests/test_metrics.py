import random
import re
from datetime import date, datetime, timedelta

import pytest
from helpers import frame, ts, tuples

from pulseledger.functions import aggregate, date_spine
from pulseledger.operators import activity
from pulseledger.operators.ranking import rank_descending
from pulseledger.operators.rolling import coverage_steps, fill_days
from pulseledger.operators.sessions import sessionize
from pulseledger.plans import accounts, dimensions, features, product, signals, users

STAGED = "user_id string, account_id string, event_name string, event_at timestamp"


def staged(spark, rows):
    return frame(spark, STAGED, [(u, a, "e", t) for u, a, t in rows])


def test_dim_accounts(spark, cfg):
    rows = [("A", "acct_001", "10:00"), ("B", "acct_001", "11:00"), ("C", "acct_002", "12:00"), (None, "acct_002", "13:00")]
    got = tuples(
        dimensions.dim_accounts(activity.daily(staged(spark, rows)), cfg),
        "account_id", "first_seen_at", "last_seen_at", "lifetime_unique_users", "days_since_last_seen",
    )
    assert got == [("acct_001", ts("10:00"), ts("11:00"), 2, 30), ("acct_002", ts("12:00"), ts("13:00"), 1, 30)]


def test_dim_users(spark, cfg):
    rows = [("A", "acct_001", "10:00"), ("B", "acct_001", "11:00"), ("B", "acct_002", "12:00")]
    got = tuples(
        dimensions.dim_users(activity.daily(staged(spark, rows)), cfg),
        "user_id", "first_seen_at", "last_seen_at", "latest_account_id", "lifetime_accounts_distinct",
    )
    assert got == [("A", ts("10:00"), ts("10:00"), "acct_001", 1), ("B", ts("11:00"), ts("12:00"), "acct_002", 2)]


def test_seats_count_the_oldest_day_only_at_midnight(spark, cfg):
    rows = [("A", "x", "2024-01-01 10:00:00")]
    df = activity.daily(staged(spark, rows))
    seats = [
        dimensions.dim_accounts(df, cfg.replace(as_of=datetime(2024, 1, 31, h))).first().current_active_seats for h in (0, 1)
    ]
    assert seats == [1, 0]


def test_profiles_enrich(spark, cfg):
    df = activity.daily(staged(spark, [("A", "x", "10:00")]))
    people = frame(spark, "user_id string, email string", [("A", "a@x")])
    groups = frame(spark, "group_id string, name string", [("x", "Acme")])
    assert dimensions.enrich_users(dimensions.dim_users(df, cfg), people).first().email == "a@x"
    assert dimensions.enrich_accounts(dimensions.dim_accounts(df, cfg), groups).first().name == "Acme"


def test_date_spine_excludes_its_end(spark):
    days = [r[0] for r in tuples(date_spine(spark, date(2024, 1, 30), date(2024, 2, 2)))]
    assert days == [date(2024, 1, 30), date(2024, 1, 31), date(2024, 2, 1)]
    assert date_spine(spark, date(2024, 2, 2), date(2024, 2, 2)).count() == 0


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_rolling_distinct_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    start, last = date(2024, 1, 1), date(2024, 3, 15)
    rows = {
        (rng.choice("ab"), f"u{rng.randrange(6)}", start + timedelta(days=rng.randrange(60))) for _ in range(rng.choice([20, 90]))
    }
    windows = {"d1": 1, "d7": 7, "d30": 30}
    df = spark.createDataFrame(sorted(rows), "k string, u string, d date")
    steps = coverage_steps(df, ["k"], "u", "d", windows, last)
    per_day = aggregate(steps, ["k", "d"], *[f"sum({n}) AS {n}" for n in windows])
    days = fill_days(per_day, ["k"], "d", list(windows), last)
    got = days.selectExpr("k", "d", *[f"sum({n}) OVER (PARTITION BY k ORDER BY d) AS {n}" for n in windows]).collect()
    assert {r.k for r in got} == {k for k, _, _ in rows}
    for r in got:
        for n, length in windows.items():
            seen = {u for k, u, d in rows if k == r.k and r.d - timedelta(days=length) < d <= r.d}
            assert r[n] == len(seen), (r, n)
    for k in {r.k for r in got}:
        mine = sorted(r.d for r in got if r.k == k)
        assert mine[-1] == last and len(mine) == (last - mine[0]).days + 1


def test_rank_equals_row_number_in_a_hot_group(spark):
    df = spark.range(3000).selectExpr(
        "concat('u', id) AS u", "IF(id % 3 = 0, 'hot', concat('g', id % 7)) AS g", "IF(id % 5 = 0, id % 11, 0L) AS n"
    )
    ranked = rank_descending(df, "g", "n", "u", "rank")
    plain = df.selectExpr("*", "row_number() OVER (PARTITION BY g ORDER BY n DESC, md5(u), u) AS rank")
    assert tuples(ranked.selectExpr("u", "g", "n", "CAST(rank AS INT) AS rank")) == tuples(plain)


def history(spark, cfg, rows):
    df = staged(spark, rows)
    daily = activity.daily(df)
    return daily, sessionize(df), dimensions.dim_accounts(daily, cfg), dimensions.dim_users(daily, cfg)


def test_since_changes_no_row(spark, cfg):
    rng = random.Random(7)
    rows = [
        (f"u{rng.randrange(8)}", f"a{rng.randrange(3)}", str(datetime(2023, 9, 1) + timedelta(minutes=rng.randrange(60 * 24 * 150))))
        for _ in range(400)
    ] + [("u9", "quiet", "2023-09-05 10:00:00")]
    daily, sessions, dim_a, _ = history(spark, cfg, rows)
    since = cfg.last_day - timedelta(days=4)
    full = accounts.account_metrics_daily(daily, sessions, dim_a, cfg).filter(f"metric_date >= DATE'{since}'")
    cut = accounts.account_metrics_daily(daily, sessions, dim_a, cfg, since)
    assert tuples(cut) == tuples(full) and cut.count() == 20


def test_account_without_recent_activity(spark, cfg):
    daily, sessions, dim_a, _ = history(spark, cfg, [("A", "x", "2023-11-01 10:00:00")])
    last = accounts.account_metrics_daily(daily, sessions, dim_a, cfg).filter("metric_date = DATE'2024-01-30'").first()
    assert (last.mau, last.n_events_daily, last.n_sessions_30d, last.user_stickiness_ratio) == (0, 1, 0, 0.0)
    assert last.avg_daily_sessions_7d is None and last.volume_change_ratio_7d == 1.0
    assert (last.health_segment, last.health_score) == ("At-Risk", 40.0)


def test_dormant_segment(spark, cfg):
    daily, sessions, dim_a, _ = history(spark, cfg, [("A", "x", "2024-01-10 10:00:00")])
    last = accounts.account_metrics_daily(daily, sessions, dim_a, cfg).filter("metric_date = DATE'2024-01-30'").first()
    assert (last.health_segment, last.is_dormant_risk, last.wau, last.mau) == ("Critical - Dormant", 1, 0, 1)


def test_literal_session_sums_of_a_huge_account(spark, cfg):
    day = date(2024, 1, 30)
    columns = "account_id string, metric_date date, " + ", ".join(
        f"{c} bigint" for c in ("activity_rows_30d", "session_rows_30d", "events", "sessions_30d", "seconds_30d")
    )
    huge = spark.createDataFrame([("x", day, 9 * 10**10, 30, 5, 27 * 10**9, 10**13)], columns)
    for span in ("daily", "7d"):
        huge = huge.selectExpr("*", f"sessions_30d AS sessions_{span}", f"seconds_30d AS seconds_{span}")
    row = huge.selectExpr(*accounts._volume_columns(cfg)).first()
    assert int(row.n_sessions_30d) == 27 * 10**9 * 9 * 10**10 and row.n_events_daily == 27 * 10**11
    assert row.minutes_30d == pytest.approx(1.5e22)


def test_first_seen_on_the_run_day_has_no_rows(spark, cfg):
    daily, sessions, dim_a, dim_u = history(spark, cfg, [("A", "x", "2024-01-31 10:00:00")])
    assert accounts.account_metrics_daily(daily, sessions, dim_a, cfg).count() == 0
    assert users.user_metrics_latest(daily, sessions, dim_u, dim_a, cfg).count() == 0
    assert product.product_metrics_daily(daily, cfg).count() == 0


def test_lifecycle(spark, cfg):
    rows = [
        ("new", "x", "2024-01-30 10:00:00"),
        ("back", "x", "2023-11-01 10:00:00"),
        ("back", "x", "2024-01-30 10:00:00"),
        ("gone", "x", "2023-11-01 10:00:00"),
        ("active", "x", "2024-01-20 10:00:00"),
        ("active", "x", "2024-01-30 10:00:00"),
        ("dormant", "x", "2024-01-20 10:00:00"),
    ]
    daily, sessions, dim_a, dim_u = history(spark, cfg, rows)
    snap = users.user_metrics_latest(daily, sessions, dim_u, dim_a, cfg)
    assert dict(tuples(snap, "user_id", "user_lifecycle_status")) == {
        "new": "New", "back": "Resurrected", "gone": "Churned", "active": "Active", "dormant": "Dormant",
    }
    assert {r.user_id for r in snap.filter("is_admin_proxy = 1").collect()} == {"back", "gone"}
    segments = {r.user_id: r for r in signals.user_segments(snap).collect()}
    assert segments["dormant"].is_at_risk == 1 and segments["gone"].is_churned == 1
    use = signals.license_utilization(snap).first()
    assert (use.total_users, use.monthly_active_users, use.inactive_users, use.license_utilization) == (5, 4, 1, 0.8)


def test_documented_user_snapshot(spark, cfg):
    rows = [
        ("A", "x", "login", "2024-01-29 10:00:00"),
        ("A", "x", "login", "2024-01-30 10:00:00"),
        ("A", "x", "login", "2024-01-30 10:10:00"),
        ("A", "x", "save", "2024-01-30 12:00:00"),
    ]
    df = frame(spark, STAGED, rows)
    daily = activity.daily(df)
    args = (daily, sessionize(df), dimensions.dim_users(daily, cfg), dimensions.dim_accounts(daily, cfg))
    literal = users.user_metrics_latest(*args, cfg).first()
    documented = users.user_metrics_latest(*args, cfg.replace(semantics="documented")).first()
    # Sessions: one of 0 min on the 29th; 10 min and 0 min on the 30th.
    assert (literal.distinct_features_used_30d, literal.avg_session_duration_minutes_monthly) == (3, 2.5)
    assert documented.distinct_features_used_30d == 2
    assert documented.avg_session_duration_minutes_monthly == pytest.approx(10 / 3)
    assert documented.avg_session_length_monthly == pytest.approx(4 / 3)


def test_feature_month_change(spark, cfg):
    rows = [("A", "x", "f", "2023-11-05 10:00:00")] * 4 + [("A", "x", "f", "2024-01-05 10:00:00")] * 6
    daily = activity.daily(frame(spark, STAGED, rows))
    literal = features.feature_usage_monthly(daily, cfg).filter("metric_month = DATE'2024-01-01'").first()
    assert (literal.prev_month_volume, literal.mom_change_pct, literal.first_used_month) == (4, 50.0, date(2023, 11, 1))
    documented = features.feature_usage_monthly(daily, cfg.replace(semantics="documented"))
    january = documented.filter("metric_month = DATE'2024-01-01'").first()
    assert (january.prev_month_volume, january.mom_change_pct) == (0, None)
    limited = features.feature_usage_monthly(daily, cfg.replace(min_monthly_feature_events=5))
    assert [r.first_used_month for r in limited.collect()] == [date(2024, 1, 1)]


def test_abandoned_feature(spark, cfg):
    rows = [("A", "x", "f", "2023-12-05 10:00:00")] * 4 + [("A", "x", "g", "2024-01-05 10:00:00")]
    monthly = features.feature_usage_monthly(activity.daily(frame(spark, STAGED, rows)), cfg)
    got = {r.event_name: r for r in signals.feature_patterns(monthly, cfg).collect()}
    assert (got["f"].is_abandoned, got["f"].months_since_last_use, got["f"].prior_peak_volume) == (1, 1, 4)
    assert (got["g"].is_abandoned, got["g"].is_new_adoption, got["g"].is_core) == (0, 1, 1)


def test_alert_thresholds(spark, cfg):
    columns = (
        "metric_date date, account_id string, volume_change_ratio_7d double, active_days_7d bigint, wau bigint,"
        " mau bigint, is_active_monthly int"
    )
    day = date(2024, 1, 30)
    rows = [(day, f"a{i}", i / 20, 3, 2 + i % 6, 9, 1) for i in range(0, 45)]
    rows += [(date(2024, 1, 29), "old", 0.1, 3, 9, 9, 1), (day, "idle", 0.1, 3, 9, 9, 0), (day, "tiny", 0.1, 3, 1, 9, 1)]
    df = spark.createDataFrame(rows, columns)
    churn = signals.churn_alerts(df, cfg).collect()
    assert [(r.account_id, r.drop_pct) for r in churn] == [("a1", 95), ("a2", 90), ("a3", 85), ("a4", 80), ("a5", 75)]
    growth = signals.expansion_alerts(df, cfg, k=2).collect()
    assert [(r.account_id, r.growth_pct) for r in growth] == [("a41", 105), ("a40", 100)]


def test_no_nested_loop_join_in_metric_plans(spark, cfg):
    daily, sessions, dim_a, dim_u = history(spark, cfg, [("A", "x", "10:00")])
    for df in (
        accounts.account_metrics_daily(daily, sessions, dim_a, cfg),
        product.product_metrics_daily(daily, cfg),
        users.user_metrics_latest(daily, sessions, dim_u, dim_a, cfg),
    ):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan and "Python" not in plan


def test_account_windows_share_one_exchange(spark, cfg, tmp_path):
    daily, sessions, dim_a, _ = history(spark, cfg, [("A", "x", "10:00")])
    parts = {}
    for name, df in (("daily", daily), ("sessions", sessions), ("dim_a", dim_a)):
        df.write.parquet(str(tmp_path / name))
        parts[name] = spark.read.parquet(str(tmp_path / name))
    df = accounts.account_metrics_daily(parts["daily"], parts["sessions"], parts["dim_a"], cfg)
    plan = df._jdf.queryExecution().executedPlan().toString()
    # One exchange by account alone: gap filling and every window use it.
    assert len(re.findall(r"Exchange hashpartitioning\(account_id#\d+, \d+\)", plan)) == 1

"""DuckDB statements that state each catalogue query's result independently.

They work at event grain, with calendar joins and row windows, and share no
method with the Spark plans. Every statement starts from the same derived raw
relations (FIXTURES.md §3).
"""

from __future__ import annotations

from datetime import date, timedelta

from .config import Config
from .functions.columns import KEY_NULL_TOKEN

TREND_SPANS = (7, 14, 30)


def _round(expr: str, digits: int) -> str:
    return f"CAST(round(CAST({expr} AS DECIMAL(28,10)), {digits}) AS DOUBLE)"


def _big(expr: str) -> str:
    return f"CAST({expr} AS BIGINT)"


def _flag(condition: str) -> str:
    return f"CAST(CASE WHEN {condition} THEN 1 ELSE 0 END AS BIGINT)"


def _ts(cfg: Config, days_before: int = 0) -> str:
    moment = cfg.as_of_utc.replace(tzinfo=None) - timedelta(days=days_before)
    return f"TIMESTAMP '{moment}'"


def _day(day: date) -> str:
    return f"DATE '{day}'"


def raw(cfg: Config, stretch: int) -> list[str]:
    day_zero = "TIMESTAMP '2024-01-01'"

    def time(shift: str = "0") -> str:
        return (
            f"make_timestamp(epoch_us({day_zero}) + (epoch_us(ts) - epoch_us({day_zero})"
            f" - moved * 86400000000 + CAST({shift} AS BIGINT) * 60000000) * {stretch})"
        )

    return [
        f"""ev AS (
          SELECT event_id AS e, user_id AS u,
                 CASE WHEN event_type = 'click' AND event_id % 10 = 7 AND ts >= TIMESTAMP '2024-01-27' THEN 'share' ELSE event_type END AS event,
                 {time()} AS tm, {time("CASE WHEN event_id % 2 = 0 THEN 40 ELSE 0 END")} AS page_tm,
                 event_type = 'view' AND event_id % 3 = 0 AS is_anon
          FROM (SELECT *, CASE WHEN user_id % 7 = 3 THEN 11 * CAST(floor(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) / 11) AS BIGINT)
                  WHEN user_id % 20 IN (13, 14) THEN 19 * CAST(floor(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) / 19) AS BIGINT)
                  WHEN user_id % 20 = 7 AND ts >= TIMESTAMP '2024-01-24' AND ts < TIMESTAMP '2024-01-29 08:00:00' THEN 11
                  ELSE 0 END AS moved FROM events))""",
        """raw_tracks AS (
          SELECT 't' || e AS id, e, event, tm, page_tm,
                 CASE WHEN NOT is_anon THEN 'u' || u END AS user_id,
                 CASE WHEN event = 'view' AND e % 30 = 0 THEN 'anon_x' || e
                      ELSE 'anon_' || CAST(floor(u / 2) AS BIGINT) END AS anon,
                 CASE WHEN event = 'view' AND e % 60 = 0 THEN 'acct_' || (u % 20)
                      WHEN is_anon OR e % 5 = 0 THEN NULL
                      WHEN e % 50 = 1 THEN 'acct_' || ((u + 1) % 20)
                      ELSE 'acct_' || (u % 20) END AS account_id
          FROM ev)""",
        """raw_pages AS (
          SELECT 'p' || t.e AS id, t.event AS name, t.page_tm AS tm, t.user_id, t.anon, t.account_id, p.url
          FROM raw_tracks t LEFT JOIN pages p ON p.page_id = t.e % (SELECT count(*) FROM pages)
          WHERE t.event = 'view')""",
        """raw_identifies AS (
          SELECT 'i' || e AS id, user_id, anon, tm FROM raw_tracks WHERE event = 'signup' AND user_id IS NOT NULL)""",
        f"recent_tracks AS (SELECT * FROM raw_tracks WHERE tm >= {_ts(cfg, cfg.tracks_lookback_days)})",
        f"recent_pages AS (SELECT * FROM raw_pages WHERE tm >= {_ts(cfg, cfg.pages_lookback_days)})",
        f"""idmap AS (
          SELECT anon, last(user_id ORDER BY tm, user_id) AS master
          FROM raw_identifies WHERE tm >= {_ts(cfg, cfg.identity_lookback_days)} GROUP BY anon)""",
        """acctmap AS (
          SELECT user_id AS u2, last(account_id ORDER BY tm, account_id) AS latest
          FROM recent_tracks WHERE user_id IS NOT NULL AND account_id IS NOT NULL GROUP BY user_id)""",
    ]


def _staged(name: str, source: str, extra: str, stitch: bool) -> str:
    if not stitch:
        return f"""{name} AS (
          SELECT id, CAST(NULL AS VARCHAR) AS anon, user_id AS original_user_id, user_id,
                 account_id AS original_account_id, account_id, {extra}, tm
          FROM {source} r WHERE account_id IS NOT NULL)"""
    return f"""{name} AS (
          SELECT * FROM (
            SELECT id, r.anon, user_id AS original_user_id, coalesce(user_id, master) AS user_id,
                   account_id AS original_account_id, coalesce(account_id, latest) AS account_id, {extra}, tm
            FROM {source} r
            LEFT JOIN idmap ON idmap.anon = r.anon
            LEFT JOIN acctmap ON u2 = coalesce(user_id, master))
          WHERE account_id IS NOT NULL)"""


def staged(cfg: Config) -> list[str]:
    return [
        _staged("stg", "recent_tracks", "event", cfg.enable_identity_stitching),
        _staged("stg_pages", "recent_pages", "name, url", cfg.enable_identity_stitching),
    ]


def sessions(cfg: Config) -> list[str]:
    events = "SELECT user_id, account_id, tm FROM stg"
    if cfg.include_pages_in_sessions:
        events += " UNION ALL SELECT user_id, account_id, tm FROM stg_pages"
    return [
        f"""marked AS (
          SELECT user_id, account_id, tm,
                 CASE WHEN date_diff('minute', lag(tm) OVER w, tm) > {cfg.session_timeout_minutes} THEN 1 ELSE 0 END AS opens
          FROM ({events}) WINDOW w AS (PARTITION BY user_id ORDER BY tm))""",
        "numbered AS (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY tm) AS idx FROM marked)",
        f"""sess AS (
          SELECT md5(coalesce(user_id, '{KEY_NULL_TOKEN}') || '-' || CAST(idx AS BIGINT)) AS session_id,
                 user_id, {_big('idx')} AS user_session_index,
                 min(tm) AS session_start_at, max(tm) AS session_end_at,
                 {_big("date_diff('second', min(tm), max(tm))")} AS session_duration_seconds,
                 {_big('count(*)')} AS events_in_session,
                 first(account_id ORDER BY tm, account_id) AS account_id
          FROM numbered GROUP BY user_id, idx)""",
    ]


def dims(cfg: Config) -> list[str]:
    ages = ", ".join(
        f"{_big(f'date_diff({chr(39)}day{chr(39)}, CAST({agg}(tm) AS DATE), {_day(cfg.today)})')} AS days_since_{name}_seen"
        for agg, name in (("min", "first"), ("max", "last"))
    )
    return [
        f"""dim_a AS (
          SELECT account_id, min(tm) AS first_seen_at, max(tm) AS last_seen_at,
                 {_big('count(DISTINCT user_id)')} AS lifetime_unique_users,
                 {_big(f"count(DISTINCT user_id) FILTER (WHERE CAST(CAST(tm AS DATE) AS TIMESTAMP) >= {_ts(cfg, 30)})")} AS current_active_seats,
                 {ages}
          FROM stg GROUP BY account_id)""",
        f"""dim_u AS (
          SELECT user_id, min(tm) AS first_seen_at, max(tm) AS last_seen_at,
                 {_big('count(DISTINCT account_id)')} AS lifetime_accounts_distinct,
                 last(account_id ORDER BY tm, account_id) AS latest_account_id,
                 {ages}
          FROM stg WHERE user_id IS NOT NULL GROUP BY user_id)""",
        f"calendar AS (SELECT CAST(unnest(generate_series({_day(cfg.spine_start)}, {_day(cfg.last_day)}, INTERVAL 1 DAY)) AS DATE) AS d)",
    ]


def _trends(names: list[str], order: str) -> str:
    return ", ".join(
        _round(f"({n} - lag({n}, {k}) OVER ({order})) / {k}.0", 2) + f" AS {n}_trend_{k}d" for n in names for k in TREND_SPANS
    )


def product(cfg: Config) -> list[str]:
    counts = ", ".join(
        f"{_big(f'count(DISTINCT {who}) FILTER (WHERE CAST(tm AS DATE) > d - {n})')} AS {p}a{kind}"
        for who, kind in (("user_id", "u"), ("account_id", "a"))
        for p, n in (("d", 1), ("w", 7), ("m", 30))
    )
    join = "LEFT" if cfg.documented else "INNER"
    return [
        f"""prod0 AS (
          SELECT d AS metric_date, {counts}
          FROM calendar {join} JOIN stg ON CAST(tm AS DATE) > d - 30 AND CAST(tm AS DATE) <= d GROUP BY d)""",
        f"""prod AS (
          SELECT metric_date, dau, wau, mau, daa, waa, maa,
                 CASE WHEN mau > 0 THEN {_round('dau / mau', 2)} ELSE 0.0 END AS user_stickiness_ratio,
                 CASE WHEN maa > 0 THEN {_round('daa / maa', 2)} ELSE 0.0 END AS account_stickiness_ratio,
                 {_trends(['dau', 'wau', 'mau', 'daa', 'waa', 'maa'], 'ORDER BY metric_date')}
          FROM prod0)""",
    ]


def account(cfg: Config) -> list[str]:
    act = "a.day"
    distinct = []
    for name, n in (("dau", 1), ("wau", 7), ("mau", 30)):
        distinct.append(f"{_big(f'count(DISTINCT a.user_id) FILTER (WHERE {act} > s.d - {n})')} AS {name}")
    for n in (7, 30):
        distinct.append(f"{_big(f'count(DISTINCT {act}) FILTER (WHERE {act} > s.d - {n})')} AS active_days_{n}d")
    distinct.append(f"{_big('count(DISTINCT a.event)')} AS distinct_features_used_30d")
    spans = (("daily", 1), ("7d", 7), ("30d", 30))
    if cfg.documented:
        pairs = f"SELECT s.d, s.account_id, {', '.join(distinct)} FROM spine_a s LEFT JOIN act a ON a.account_id = s.account_id AND a.day > s.d - 30 AND a.day <= s.d GROUP BY s.d, s.account_id"
        sums = ", ".join(
            f"coalesce(sum(sd.n) FILTER (WHERE sd.day > s.d - {n}), 0) AS ns_{name}, coalesce(sum(sd.sec) FILTER (WHERE sd.day > s.d - {n}), 0) / 60.0 AS min_{name}"
            for name, n in spans
        )
        rolled = f"""(
          SELECT p.*, ss.* EXCLUDE (d, account_id), coalesce(v.n, 0) AS n_events_daily
          FROM ({pairs}) p
          JOIN (SELECT s.d, s.account_id, {sums} FROM spine_a s
                LEFT JOIN sess_d sd ON sd.account_id = s.account_id AND sd.day > s.d - 30 AND sd.day <= s.d
                GROUP BY s.d, s.account_id) ss ON ss.d = p.d AND ss.account_id = p.account_id
          LEFT JOIN (SELECT CAST(tm AS DATE) AS day, account_id, count(*) AS n FROM stg GROUP BY ALL) v
            ON v.day = p.d AND v.account_id = p.account_id)"""
    else:
        sums = ", ".join(
            f"coalesce(sum(sd.n) FILTER (WHERE sd.day > s.d - {n}), 0) AS ns_{name}, coalesce(sum(sd.sec) FILTER (WHERE sd.day > s.d - {n}), 0) / 60.0 AS min_{name}"
            for name, n in spans
        )
        rolled = f"""(
          SELECT s.d, s.account_id, {', '.join(distinct)}, count(*) AS n_events_daily, {sums}
          FROM spine_a s
          LEFT JOIN act a ON a.account_id = s.account_id AND a.day > s.d - 30 AND a.day <= s.d
          LEFT JOIN sess_d sd ON sd.account_id = s.account_id AND sd.day > s.d - 30 AND sd.day <= s.d
          GROUP BY s.d, s.account_id)"""

    def ratio(now: str, before: str) -> str:
        return f"CASE WHEN {before} > 0 THEN {_round(f'{now} / {before}', 2)} ELSE 1.0 END"

    w = "PARTITION BY account_id ORDER BY d"
    return [
        "act AS (SELECT DISTINCT CAST(tm AS DATE) AS day, account_id, user_id, event FROM stg)",
        """sess_d AS (
          SELECT CAST(session_start_at AS DATE) AS day, account_id, count(*) AS n, sum(session_duration_seconds) AS sec
          FROM sess WHERE account_id IS NOT NULL GROUP BY ALL)""",
        "spine_a AS (SELECT d, account_id FROM calendar JOIN dim_a ON d >= CAST(first_seen_at AS DATE))",
        f"""acct0 AS (
          SELECT *, sum(n_events_daily) OVER (PARTITION BY account_id ORDER BY d ROWS 6 PRECEDING) AS vol FROM {rolled})""",
        f"""acct1 AS (
          SELECT *, lag(vol, 7) OVER ({w}) AS vol_b, lag(wau, 7) OVER ({w}) AS wau_b,
                 lag(min_7d, 7) OVER ({w}) AS min_b, lag(ns_7d, 7) OVER ({w}) AS ns_b,
                 {_trends(['dau', 'wau', 'mau'], w)}
          FROM acct0)""",
        f"""acct2 AS (
          SELECT d AS metric_date, account_id, dau, wau, mau,
                 {_flag('dau > 0')} AS is_active_daily, {_flag('wau > 0')} AS is_active_weekly, {_flag('mau > 0')} AS is_active_monthly,
                 {_big('n_events_daily')} AS n_events_daily, distinct_features_used_30d, active_days_7d, active_days_30d,
                 {', '.join(f"{_big(f'ns_{n}')} AS n_sessions_{n}, {_round(f'min_{n}', 2)} AS time_on_platform_minutes_{n}" for n, _ in spans)},
                 {', '.join(f"{_round(f'min_{n} / nullif(active_days_{n}, 0)', 2)} AS avg_daily_time_on_platform_minutes_{n}, {_round(f'ns_{n} / nullif(active_days_{n}, 0)', 2)} AS avg_daily_sessions_{n}" for n in ('7d', '30d'))},
                 {_big('wau - wau_b')} AS net_new_users_7d,
                 {ratio('vol', 'vol_b')} AS volume_change_ratio_7d,
                 {ratio('min_7d', 'min_b')} AS time_on_platform_change_ratio_7d,
                 {ratio('ns_7d', 'ns_b')} AS session_frequency_change_ratio_7d,
                 {_round('active_days_7d / nullif(active_days_30d, 0)', 2)} AS account_stickiness_ratio,
                 CASE WHEN mau > 0 THEN {_round('dau / mau', 2)} ELSE 0.0 END AS user_stickiness_ratio,
                 {_flag('mau > 0 AND wau = 0')} AS is_dormant_risk,
                 {', '.join(f'{n}_trend_{k}d' for n in ('dau', 'wau', 'mau') for k in TREND_SPANS)}
          FROM acct1)""",
        # The segment rules and score weights of the metric definition.
        """acct AS (
          SELECT *, CASE WHEN mau > 0 AND wau = 0 THEN 'Critical - Dormant'
                         WHEN volume_change_ratio_7d < 0.5 THEN 'Critical - Usage Drop'
                         WHEN user_stickiness_ratio < 0.2 OR volume_change_ratio_7d < 0.9 THEN 'At-Risk'
                         WHEN user_stickiness_ratio >= 0.4 OR volume_change_ratio_7d > 1.1 THEN 'Healthy'
                         ELSE 'Stable' END AS health_segment,
                 round(CAST(least(100.0, 40 * user_stickiness_ratio + 40 * least(volume_change_ratio_7d, 1.5)
                       + 4 * least(active_days_7d, 5)) AS DOUBLE), 6) AS health_score
          FROM acct2)""",
    ]


def feature(cfg: Config) -> list[str]:
    having = f"HAVING count(*) >= {cfg.min_monthly_feature_events}" if cfg.min_monthly_feature_events else ""
    w = "PARTITION BY account_id, event_name ORDER BY metric_month"
    previous = f"lag(vol) OVER ({w})"
    if cfg.documented:
        before = f"lag(metric_month) OVER ({w})"
        previous = f"CASE WHEN {before} = metric_month - INTERVAL 1 MONTH THEN {previous} WHEN {before} IS NOT NULL THEN 0 END"
    return [
        f"""fu0 AS (
          SELECT CAST(date_trunc('month', tm) AS DATE) AS metric_month, account_id, event AS event_name,
                 count(*) AS vol, count(DISTINCT user_id) AS nu
          FROM stg GROUP BY ALL {having})""",
        "fu1 AS (SELECT CAST(date_trunc('month', tm) AS DATE) AS m, account_id AS acc, count(DISTINCT user_id) AS mau FROM stg GROUP BY ALL)",
        f"fu2 AS (SELECT *, {previous} AS pv, min(metric_month) OVER (PARTITION BY account_id, event_name) AS fm FROM fu0 LEFT JOIN fu1 ON m = metric_month AND acc = account_id)",
        f"""fu AS (
          SELECT metric_month, account_id, event_name, {_big('vol')} AS monthly_event_volume,
                 {_big('nu')} AS monthly_active_users_on_feature, {_big('mau')} AS account_mau,
                 {_round('nu / nullif(mau, 0)', 2)} AS feature_penetration_rate, fm AS first_used_month,
                 {_big('pv')} AS prev_month_volume,
                 CASE WHEN pv > 0 THEN {_round('(vol - pv) / pv * 100', 1)} END AS mom_change_pct
          FROM fu2)""",
    ]


def user(cfg: Config) -> list[str]:
    w = "PARTITION BY user_id ORDER BY d ROWS"
    minutes, per_session, breadth = "min30", "ev30", "f30"
    if cfg.documented:
        month = f"BETWEEN greatest(d - 29, CAST(l.first_seen_at AS DATE), {_day(cfg.spine_start)}) AND d"
        mine = f"FROM sess WHERE sess.user_id = l.user_id AND CAST(session_start_at AS DATE) {month}"
        minutes = f"(SELECT sum(session_duration_seconds) / count(*) / 60.0 {mine})"
        per_session = f"(SELECT sum(events_in_session) / count(*) {mine})"
        breadth = f"(SELECT count(DISTINCT event) FROM stg WHERE stg.user_id = l.user_id AND CAST(tm AS DATE) {month})"
    return [
        """ua AS (
          SELECT CAST(tm AS DATE) AS activity_date, user_id, count(*) AS n_events, count(DISTINCT event) AS n_features
          FROM stg WHERE user_id IS NOT NULL GROUP BY ALL)""",
        """us AS (
          SELECT CAST(session_start_at AS DATE) AS session_date, user_id, count(*) AS n_sessions,
                 sum(session_duration_seconds) / count(*) / 60.0 AS avg_min, sum(events_in_session) / count(*) AS avg_ev
          FROM sess WHERE user_id IS NOT NULL GROUP BY ALL)""",
        """ud AS (
          SELECT d, u.user_id, u.first_seen_at, u.latest_account_id, coalesce(n_events, 0) AS n,
                 coalesce(n_features, 0) AS f, CASE WHEN n_events > 0 THEN 1 ELSE 0 END AS active,
                 coalesce(n_sessions, 0) AS ns, avg_min, avg_ev
          FROM dim_u u JOIN calendar ON d >= CAST(u.first_seen_at AS DATE)
          LEFT JOIN ua ON ua.user_id = u.user_id AND activity_date = d
          LEFT JOIN us ON us.user_id = u.user_id AND session_date = d)""",
        f"""uw AS (
          SELECT *, max(active) OVER ({w} 6 PRECEDING) AS a7, max(active) OVER ({w} 29 PRECEDING) AS a30,
                 sum(active) OVER ({w} 6 PRECEDING) AS l7, sum(active) OVER ({w} 13 PRECEDING) AS l14,
                 sum(n) OVER ({w} 29 PRECEDING) AS n30, sum(f) OVER ({w} 29 PRECEDING) AS f30,
                 sum(ns) OVER ({w} 29 PRECEDING) AS ns30, avg(avg_min) OVER ({w} 29 PRECEDING) AS min30,
                 avg(avg_ev) OVER ({w} 29 PRECEDING) AS ev30
          FROM ud)""",
        "ul AS (SELECT *, lag(a30) OVER (PARTITION BY user_id ORDER BY d) AS before, max(d) OVER (PARTITION BY user_id) AS newest FROM uw)",
        f"""snap AS (
          SELECT d AS metric_date, l.user_id, latest_account_id, {_big('n')} AS n_events_daily,
                 {_big('active')} AS is_active_daily, {_big('a7')} AS is_active_weekly, {_big('a30')} AS is_active_monthly,
                 {_big('l7')} AS active_days_last_7, {_big('l14')} AS active_days_last_14,
                 {_big('n30')} AS n_events_monthly, {_big('ns')} AS n_sessions_daily, {_big('ns30')} AS n_sessions_monthly,
                 {_round(minutes, 6)} AS avg_session_duration_minutes_monthly,
                 {_round(per_session, 6)} AS avg_session_length_monthly,
                 row_number() OVER (PARTITION BY latest_account_id ORDER BY n30 DESC, md5(l.user_id), l.user_id) AS usage_rank_in_account,
                 {_flag('CAST(l.first_seen_at AS DATE) = CAST(a.first_seen_at AS DATE)')} AS is_admin_proxy,
                 {_big(breadth)} AS distinct_features_used_30d,
                 CASE WHEN d = CAST(l.first_seen_at AS DATE) THEN 'New'
                      WHEN active = 1 AND coalesce(before, 0) = 0 THEN 'Resurrected'
                      WHEN a30 = 0 THEN 'Churned' WHEN active = 1 THEN 'Active' ELSE 'Dormant' END AS user_lifecycle_status
          FROM ul l LEFT JOIN dim_a a ON a.account_id = latest_account_id WHERE d = newest)""",
    ]


def statement(select: str, cfg: Config, stretch: int = 1, more: list[str] | None = None) -> str:
    ctes = [
        *raw(cfg, stretch), *staged(cfg), *sessions(cfg), *dims(cfg), *product(cfg),
        *account(cfg), *feature(cfg), *user(cfg), *(more or []),
    ]
    needed = _reachable(ctes, select)
    return "WITH " + ",\n".join(needed) + "\n" + select


def _reachable(ctes: list[str], select: str) -> list[str]:
    """Only the CTEs the statement uses, so that each stays readable."""
    import re

    kept: list[str] = []
    text = select
    for cte in reversed(ctes):
        name = cte.split(" AS ", 1)[0].strip()
        if re.search(rf"\b{name}\b", text):
            kept.append(cte)
            text += " " + cte.split(" AS ", 1)[1]
    return kept[::-1]

"""Named queries over the test tables, each with its independent SQL twin."""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import oracle, streaming
from .config import DOCUMENTED, Config
from .functions import aggregate, date_spine, name, round_half_up, union_all
from .functions.columns import KEY_NULL_TOKEN
from .operators import bitmaps, docs, identity, quality
from .operators import sketches as sketch
from .operators.sessions import SESSION_COLUMNS, events_since, sessionize, sessionize_incremental, sessionize_recent
from .plans import accounts as account_plans
from .plans import dimensions, incremental, product, signals, users
from .plans.pipeline import Inputs, Relations
from .session import configure, materialize, scratch_path, shared_dir
from .sources import readers, sinks, testdata

MAIN = Config(
    as_of=datetime(2024, 1, 31, 12),
    enable_identity_stitching=True,
    spine_start=date(2023, 12, 20),
)
# Events spread over six months, for month-over-month and 30-day comparisons.
LONG = MAIN.replace(as_of=datetime(2024, 6, 20, 12))
LONG_STRETCH = 6
DIGITS = 6


@dataclass
class Query:
    """``run`` builds the result from the relations of the settings; ``shared``
    names the relations that are written once because several others, all
    needed for this result, read them."""

    run: Callable[[Relations, SparkSession, str], DataFrame]
    select: str | None
    cfg: Config = MAIN
    stretch: int = 1
    more: list[str] = field(default_factory=list)
    shared: tuple[str, ...] = ()

    def __call__(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        configure(spark)
        inputs = testdata.TestTables(spark, sf_dir, self.stretch)

        def share(df: DataFrame, name: str) -> DataFrame:
            return materialize(df, name) if name in self.shared else df

        return comparable(self.run(Relations(inputs, self.cfg, share), spark, sf_dir))

    def sql(self) -> str | None:
        return None if self.select is None else oracle.statement(self.select, self.cfg, self.stretch, self.more)


def comparable(df: DataFrame) -> DataFrame:
    """Types and precision that another engine can be compared with."""
    conversions = {
        "timestamp": "CAST({} AS TIMESTAMP_NTZ)",
        "int": "CAST({} AS BIGINT)",
        "decimal(38,0)": "CAST({} AS BIGINT)",
        "double": round_half_up("{}", DIGITS),
    }
    return df.selectExpr(*[f"{conversions.get(kind, '{}').format(name(c))} AS {name(c)}" for c, kind in df.dtypes])


def _columns(names: str) -> list[str]:
    return names.split()


ACCOUNT_ACTIVES = _columns(
    "metric_date account_id dau wau mau is_active_daily is_active_weekly is_active_monthly"
)
ACCOUNT_BREADTH = _columns("metric_date account_id distinct_features_used_30d active_days_7d active_days_30d")
ACCOUNT_SESSIONS = _columns(
    "metric_date account_id n_events_daily n_sessions_daily time_on_platform_minutes_daily n_sessions_7d"
    " time_on_platform_minutes_7d n_sessions_30d time_on_platform_minutes_30d avg_daily_time_on_platform_minutes_7d"
    " avg_daily_time_on_platform_minutes_30d avg_daily_sessions_7d avg_daily_sessions_30d"
)
ACCOUNT_SIGNALS = _columns(
    "metric_date account_id net_new_users_7d volume_change_ratio_7d time_on_platform_change_ratio_7d"
    " session_frequency_change_ratio_7d account_stickiness_ratio user_stickiness_ratio is_dormant_risk"
)
ACCOUNT_TRENDS = ["metric_date", "account_id"] + [
    f"{n}_trend_{k}d" for n in ("dau", "wau", "mau") for k in account_plans.TREND_SPANS
]


def _account(columns: list[str], cfg: Config = MAIN, stretch: int = 1) -> Query:
    return Query(lambda r, spark, d: r.account_daily.select(*columns), f"SELECT {', '.join(columns)} FROM acct", cfg, stretch)


def _since(r: Relations, days: int) -> DataFrame:
    return r.account_daily_since(r.cfg.last_day - timedelta(days=days - 1))


def _trend_sql(cfg: Config, days: int) -> str:
    compared = {
        "mau": "mau", "wau": "wau", "user_stickiness_ratio": "stickiness",
        "active_days_7d": "active_days", "distinct_features_used_30d": "features",
    }
    w = "(PARTITION BY account_id ORDER BY metric_date)"
    directions = ", ".join(
        f"CASE sign({n} - lag({n}, 7) OVER {w}) WHEN 1 THEN 'up' WHEN -1 THEN 'down' WHEN 0 THEN 'flat' END AS {s}_direction"
        for n, s in compared.items()
    )
    return f"""SELECT * FROM (
      SELECT metric_date, account_id, health_segment, health_score, dau, {', '.join(compared)}, net_new_users_7d,
             volume_change_ratio_7d, is_dormant_risk, {directions} FROM acct)
      WHERE metric_date > DATE '{cfg.last_day - timedelta(days=days)}'"""


SEGMENTS_SQL = """SELECT user_id, latest_account_id, user_lifecycle_status,
  CAST(usage_rank_in_account = 1 AND is_active_monthly = 1 AS BIGINT) AS is_champion,
  is_admin_proxy AS is_admin,
  CAST(active_days_last_14 >= 10 AND distinct_features_used_30d >= 10 AS BIGINT) AS is_power_user,
  CAST(user_lifecycle_status = 'Dormant' OR (is_active_monthly = 1 AND is_active_weekly = 0) AS BIGINT) AS is_at_risk,
  CAST(user_lifecycle_status = 'Churned' AS BIGINT) AS is_churned
  FROM snap"""

LICENSE_SQL = """SELECT latest_account_id AS account_id, count(*) AS total_users,
  CAST(sum(is_active_monthly) AS BIGINT) AS monthly_active_users,
  CAST(count(*) - sum(is_active_monthly) AS BIGINT) AS inactive_users,
  CAST(round(CAST(avg(is_active_monthly) AS DECIMAL(28,10)), 4) AS DOUBLE) AS license_utilization,
  CAST(round(CAST(avg(1 - is_active_monthly) AS DECIMAL(28,10)), 4) AS DOUBLE) AS inactive_share
  FROM snap GROUP BY latest_account_id"""


def _patterns_cte(cfg: Config) -> str:
    cur = f"DATE '{cfg.last_day.replace(day=1)}'"
    return f"""pat AS (
      SELECT k.account_id, k.event_name, k.last_used_month, k.first_used_month,
        coalesce(c.monthly_event_volume, 0) AS current_volume,
        coalesce(c.monthly_active_users_on_feature, 0) AS current_users,
        c.feature_penetration_rate AS current_penetration, c.mom_change_pct,
        k.prior_peak_volume, k.prior_peak_users,
        date_diff('month', k.last_used_month, {cur}) AS months_since_last_use,
        {oracle._flag('c.feature_penetration_rate > 0.5')} AS is_core,
        {oracle._flag('c.mom_change_pct > 20')} AS is_expanding,
        {oracle._flag('c.mom_change_pct < -20')} AS is_declining,
        {oracle._flag('coalesce(c.monthly_event_volume, 0) <= 0.05 * k.prior_peak_volume')} AS is_abandoned,
        {oracle._flag('c.feature_penetration_rate < 0.1')} AS is_low_penetration,
        {oracle._flag(f'k.first_used_month = {cur}')} AS is_new_adoption
      FROM (SELECT account_id, event_name, max(metric_month) AS last_used_month, min(first_used_month) AS first_used_month,
                   max(monthly_event_volume) FILTER (WHERE metric_month < {cur}) AS prior_peak_volume,
                   max(monthly_active_users_on_feature) FILTER (WHERE metric_month < {cur}) AS prior_peak_users
            FROM fu WHERE metric_month > {cur} - INTERVAL 6 MONTH GROUP BY ALL) k
      LEFT JOIN fu c ON c.account_id = k.account_id AND c.event_name = k.event_name AND c.metric_month = {cur})"""


def _playbook_sql(cfg: Config) -> str:
    last, before = cfg.last_day, cfg.last_day - timedelta(days=7)
    f = oracle._flag
    return f"""SELECT *,
      churn_critical_segment + churn_low_volume + churn_quiet_key_user + churn_core_features_declining + churn_dormant_flag AS churn_signals,
      expansion_user_momentum + expansion_healthy + expansion_low_penetration + expansion_sticky_growth AS expansion_signals,
      recovery_volume + recovery_engagement + recovery_new_features + recovery_returning_users AS recovery_signals
    FROM (SELECT n.account_id, n.health_segment, n.health_score,
      {f("n.health_segment LIKE 'Critical%'")} AS churn_critical_segment,
      {f("n.volume_change_ratio_7d < 0.5")} AS churn_low_volume,
      {f("EXISTS (SELECT 1 FROM snap s WHERE s.latest_account_id = n.account_id AND (usage_rank_in_account = 1 OR is_admin_proxy = 1) AND user_lifecycle_status IN ('Dormant', 'Churned'))")} AS churn_quiet_key_user,
      {f("(SELECT count(*) FROM pat p WHERE p.account_id = n.account_id AND is_core = 1 AND is_declining = 1) >= 2")} AS churn_core_features_declining,
      {f("n.is_dormant_risk = 1")} AS churn_dormant_flag,
      {f("n.net_new_users_7d > 0")} AS expansion_user_momentum,
      {f("n.health_segment = 'Healthy' AND n.health_score >= 70")} AS expansion_healthy,
      {f("EXISTS (SELECT 1 FROM pat p WHERE p.account_id = n.account_id AND is_low_penetration = 1)")} AS expansion_low_penetration,
      {f("n.user_stickiness_ratio >= 0.4 AND n.wau_trend_7d > 0")} AS expansion_sticky_growth,
      {f("n.volume_change_ratio_7d >= 0.9 AND n.volume_change_ratio_7d > b.volume_change_ratio_7d")} AS recovery_volume,
      {f("n.active_days_7d > b.active_days_7d AND n.user_stickiness_ratio > b.user_stickiness_ratio")} AS recovery_engagement,
      {f("EXISTS (SELECT 1 FROM pat p WHERE p.account_id = n.account_id AND is_new_adoption = 1)")} AS recovery_new_features,
      {f("EXISTS (SELECT 1 FROM snap s WHERE s.latest_account_id = n.account_id AND user_lifecycle_status = 'Resurrected')")} AS recovery_returning_users
      FROM acct n LEFT JOIN acct b ON b.account_id = n.account_id AND b.metric_date = DATE '{before}'
      WHERE n.metric_date = DATE '{last}')"""


def _churn_sql(cfg: Config, drop: float, min_wau: int) -> str:
    return f"""SELECT account_id, volume_change_ratio_7d, active_days_7d, wau, mau,
      CAST(round(CAST((1 - volume_change_ratio_7d) * 100 AS DECIMAL(28,10))) AS BIGINT) AS drop_pct
      FROM acct WHERE metric_date = DATE '{cfg.last_day}' AND volume_change_ratio_7d > 0 AND volume_change_ratio_7d < {drop}
        AND is_active_monthly = 1 AND wau >= {min_wau} ORDER BY volume_change_ratio_7d, account_id LIMIT 5"""


def _expansion_sql(cfg: Config, growth: float, min_wau: int) -> str:
    return f"""SELECT account_id, volume_change_ratio_7d, wau,
      CAST(round(CAST((volume_change_ratio_7d - 1) * 100 AS DECIMAL(28,10))) AS BIGINT) AS growth_pct
      FROM acct WHERE metric_date = DATE '{cfg.last_day}' AND volume_change_ratio_7d > {growth} AND wau >= {min_wau}
      ORDER BY volume_change_ratio_7d DESC, account_id LIMIT 5"""


def _quality_relations(r: Relations) -> dict[str, DataFrame]:
    return {
        "stg_segment_tracks": r.share(r.tracks, "tracks"),
        "stg_identity_resolution": r.identity_map,
        "fct_sessions": r.sessions,
        "dim_accounts": r.dim_accounts,
        "dim_users": r.dim_users,
        "fct_product_metrics_daily": r.product_daily,
        "fct_account_metrics_daily": r.account_daily,
        "fct_user_metrics_daily": r.user_latest,
    }


# Rows spoiled in the same way by both engines: (key column, column, set to).
_SPOILED = {
    "stg_segment_tracks": ("event_id", "event_name", "NULL"),
    "stg_identity_resolution": ("anonymous_id", "master_user_id", "NULL"),
    "fct_sessions": ("user_session_index", "events_in_session", "0"),
    "dim_accounts": ("account_id", "account_id", "NULL"),
    "dim_users": ("user_id", "user_id", "'same'"),
    "fct_product_metrics_daily": ("dau", "metric_date", "DATE '2024-01-01'"),
    "fct_account_metrics_daily": ("account_id", "metric_date", "NULL"),
    "fct_user_metrics_daily": ("user_id", "user_id", "NULL"),
}
_IS_SPOILED = "length(CAST({} AS STRING)) % 2 = 0"


def _spoiled(r: Relations) -> dict[str, DataFrame]:
    out = {}
    for table, df in _quality_relations(r).items():
        key, column, value = _SPOILED[table]
        kind = df.schema[column].dataType.simpleString()
        rule = F.expr(f"IF({_IS_SPOILED.format(key)}, CAST({value} AS {kind}), {column})")
        out[table] = df.withColumn(column, rule)
    return out


QUALITY_TABLES = {
    "stg_segment_tracks": "(SELECT id AS event_id, event AS event_name, tm AS event_at FROM stg)",
    "stg_identity_resolution": "(SELECT anon AS anonymous_id, master AS master_user_id FROM idmap)",
    "fct_sessions": "sess",
    "dim_accounts": "dim_a",
    "dim_users": "dim_u",
    "fct_product_metrics_daily": "prod",
    "fct_account_metrics_daily": "acct",
    "fct_user_metrics_daily": "snap",
}
# The expected checks, stated independently of operators/quality.py.
EXPECTED_CHECKS = """
stg_segment_tracks not_null event_id; stg_segment_tracks not_null event_name; stg_segment_tracks not_null event_at
stg_segment_tracks unique event_id
stg_identity_resolution not_null anonymous_id; stg_identity_resolution not_null master_user_id; stg_identity_resolution unique anonymous_id
fct_sessions not_null session_id; fct_sessions not_null user_id; fct_sessions not_null account_id
fct_sessions not_null session_start_at; fct_sessions not_null session_end_at; fct_sessions unique session_id
fct_sessions expression session_duration_seconds >= 0; fct_sessions expression session_end_at >= session_start_at
fct_sessions expression events_in_session >= 1
dim_accounts not_null account_id; dim_accounts unique account_id
dim_users not_null user_id; dim_users unique user_id
fct_product_metrics_daily unique metric_date
fct_account_metrics_daily not_null metric_date; fct_account_metrics_daily not_null account_id
fct_user_metrics_daily not_null metric_date; fct_user_metrics_daily not_null user_id
"""


def _quality_sql(spoil: bool = False) -> str:
    parts = []
    for line in EXPECTED_CHECKS.replace(";", "\n").strip().splitlines():
        relation, kind, subject = line.split(maxsplit=2)
        source = QUALITY_TABLES[relation]
        if spoil:
            key, column, value = _SPOILED[relation]
            rule = f"CASE WHEN {_IS_SPOILED.format(key).replace('STRING', 'VARCHAR')} THEN {value} ELSE {column} END AS {column}"
            source = f"(SELECT * REPLACE ({rule}) FROM {source})"
        failing = {
            "not_null": f"SELECT count(*) FROM {source} WHERE {subject} IS NULL",
            "expression": f"SELECT count(*) FROM {source} WHERE NOT ({subject})",
            "unique": f"SELECT count(*) FROM (SELECT {subject} FROM {source} WHERE {subject} IS NOT NULL GROUP BY {subject} HAVING count(*) > 1)",
        }[kind]
        parts.append(f"SELECT '{relation}' AS relation, '{kind}' AS check_name, '{subject}' AS subject, ({failing}) AS n_violations")
    return "\nUNION ALL ".join(parts)


def _alert_file(r: Relations, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts written as JSON lines and read back."""
    alerts = signals.expansion_alerts(_since(r, 1), r.cfg)
    path = scratch_path(spark, "alerts")
    sinks.write_alerts(alerts, path)
    return spark.read.schema(alerts.schema).json(path)


def _reread(r: Relations, spark: SparkSession, kind: str) -> Relations:
    """The raw relations written as files and read through the source layer."""
    places = {}
    for name in ("tracks", "pages", "identifies"):
        places[name] = f"{scratch_path(spark, name)}.{kind}"
        raw = getattr(r.inputs, name)
        if kind == "csv":
            # CSV seeds hold whole seconds.
            raw = raw.withColumn("timestamp", F.date_trunc("second", "timestamp"))
            raw.write.option("header", True).option("timestampFormat", readers.TIMESTAMP_FORMAT).csv(places[name])
        else:
            raw.write.parquet(places[name])
    cfg = r.cfg.replace(sources=places)
    return Relations(Inputs.read(spark, cfg), cfg, r.share)


def _enriched(r: Relations, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users and accounts with names from the optional sources, read back."""
    places = {}
    for name in ("users", "groups"):
        places[name] = f"{scratch_path(spark, name)}.parquet"
        getattr(r.inputs, name).write.parquet(places[name])
    cfg = r.cfg.replace(sources=places)
    people = dimensions.enrich_users(r.dim_users, readers.read_users(spark, cfg))
    accounts = dimensions.enrich_accounts(r.dim_accounts, readers.read_groups(spark, cfg))
    return people.selectExpr("'user' AS kind", "user_id AS id", "email AS name").unionByName(
        accounts.selectExpr("'account' AS kind", "account_id AS id", "name")
    )


def _split_incrementally(r: Relations, late: bool) -> DataFrame:
    """Sessions of the first part, then the rest merged in as one batch."""
    events = r.tracks.select("event_id", "user_id", "account_id", "event_at")
    first = "event_at < TIMESTAMP'2024-01-20 00:00:00'"
    if late:
        # A fifth of the earlier events arrives with the batch.
        first += " AND pmod(xxhash64(event_id), 5) <> 0"
    timeout = r.cfg.session_timeout_minutes
    stored = r.share(sessionize(events.filter(first), timeout), "sessions")
    return sessionize_incremental(stored, events.filter(f"NOT ({first})"), timeout)


def _event_stream(r: Relations, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged tracks of the events table read as a stream of files."""
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    # A glob, because a stream cannot be opened on a single file.
    events = streaming.read_stream(spark, f"{sf_dir}/events*.parquet", schema)
    return identity.stage_tracks(testdata.derive_tracks(events), r.lookup, r.cfg)


def _drain(stream: DataFrame, spark: SparkSession, name: str) -> DataFrame:
    """Run a stream over what has arrived; its output as a table."""
    out = scratch_path(spark, name)
    streaming.emit_sessions(stream, out, f"{out}_state", once=True).awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


def _streamed_sessions(r: Relations, spark: SparkSession, sf_dir: str) -> DataFrame:
    closed = streaming.streaming_sessions(_event_stream(r, spark, sf_dir), r.cfg)
    return _drain(closed, spark, "stream-sessions")


def _streamed_counts(key: str) -> Callable[[Relations, SparkSession, str], DataFrame]:
    def run(r: Relations, spark: SparkSession, sf_dir: str) -> DataFrame:
        counts = streaming.daily_counts(_event_stream(r, spark, sf_dir), key)
        return _drain(counts, spark, "stream-counts")

    return run


def _streamed_once(r: Relations, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event delivered twice, then de-duplicated."""
    events = _event_stream(r, spark, sf_dir)
    unique = streaming.deduplicate(events.unionByName(events))
    return _drain(unique, spark, "stream-unique")


def _streamed_actives(r: Relations, spark: SparkSession, sf_dir: str) -> DataFrame:
    actives = streaming.sliding_actives(_event_stream(r, spark, sf_dir), 7)
    return _drain(actives, spark, "stream-actives")


def _approx_actives(r: Relations, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per closed window, whether the sketch is within five errors of the exact count."""
    events = _event_stream(r, spark, sf_dir)
    approx = _drain(streaming.approx_sliding_actives(events, 7), spark, "stream-approx")
    exact = _streamed_actives(r, spark, sf_dir)
    near = "abs(approx_{0} - active_{0}) <= 1 + 0.05 * active_{0}"
    return approx.join(exact, "metric_date").selectExpr(
        "metric_date", f"{near.format('users')} AS users_near", f"{near.format('accounts')} AS accounts_near"
    )


def _batches(r: Relations) -> list[DataFrame]:
    """Staged tracks in three parts, a tenth of each part late by one."""
    events = r.share(r.tracks.select("event_id", "user_id", "account_id", "event_at"), "events")
    day = "datediff(event_at, DATE'2024-01-01')"
    batch = f"least(2, {day} div 10 + IF(pmod(xxhash64(event_id), 10) = 0, 1, 0))"
    return [events.filter(f"{batch} = {number}") for number in range(3)]


def _upserted_sessions(r: Relations, spark: SparkSession, sf_dir: str) -> DataFrame:
    """The session table after three batches."""
    table = scratch_path(spark, "session-table")
    for number, batch in enumerate(_batches(r)):
        sinks.upsert_sessions(batch, table, number, r.cfg.session_timeout_minutes)
    return sinks.read_sessions(spark, table).select(*SESSION_COLUMNS)


def _upserted_again(r: Relations, spark: SparkSession, sf_dir: str) -> DataFrame:
    """An empty first batch; every batch delivered twice, the first once more at the end."""
    table = scratch_path(spark, "session-table")
    batches = _batches(r)
    for number, batch in enumerate([batches[0].limit(0), *batches]):
        for _ in range(2):
            sinks.upsert_sessions(batch, table, number, r.cfg.session_timeout_minutes)
    sinks.upsert_sessions(batches[0], table, 1, r.cfg.session_timeout_minutes)
    return sinks.read_sessions(spark, table).select(*SESSION_COLUMNS)


def _upserted_stream(r: Relations, spark: SparkSession, sf_dir: str) -> DataFrame:
    """The session table kept by a stream over the files of several parts, a few a batch."""
    folder, table = scratch_path(spark, "arriving"), scratch_path(spark, "session-table")
    schema = "event_id string, user_id string, account_id string, event_at timestamp"
    for batch in _batches(r):
        batch.write.mode("append").parquet(folder)
    # The upsert takes events in any arrival order, so files of several parts may share a micro-batch.
    arriving = streaming.read_stream(spark, folder, spark.createDataFrame([], schema).schema, max_files=8)
    streaming.upsert_sessions_stream(arriving, table, f"{table}_state", r.cfg, once=True).awaitTermination()
    return sinks.read_sessions(spark, table).select(*SESSION_COLUMNS)


def _late_rows_reconciled(r: Relations, spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream that sets rows aside which are a day late; these merged afterwards."""
    folder, table = scratch_path(spark, "arriving"), scratch_path(spark, "session-table")
    schema = spark.createDataFrame([], "event_id string, user_id string, account_id string, event_at timestamp").schema
    for batch in _batches(r):
        batch.write.mode("append").parquet(folder)
    arriving = streaming.read_stream(spark, folder, schema, max_files=8)
    streaming.upsert_sessions_stream(arriving, table, f"{table}_state", r.cfg, once=True, delay=timedelta(days=1)).awaitTermination()
    streaming.reconcile_late(spark, table, schema, r.cfg)
    return sinks.read_sessions(spark, table).select(*SESSION_COLUMNS)


def _recent_sessions(r: Relations, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored up to January 25, for every third user only to the 10th; then brought up to date, twice."""
    events = r.share(r.tracks.select("event_id", "user_id", "account_id", "event_at"), "events")
    until = "IF(pmod(hash(user_id), 3) = 0, TIMESTAMP'2024-01-10 00:00:00', TIMESTAMP'2024-01-25 00:00:00')"
    timeout = r.cfg.session_timeout_minutes
    stored = r.share(sessionize(events.filter(f"event_at <= {until}"), timeout), "sessions")
    return sessionize_recent(r.share(sessionize_recent(stored, events, timeout), "sessions"), events, timeout)


def _raw_batches(r: Relations) -> list[tuple[Inputs, Config]]:
    """All raw relations in three batches, each with its own ``as_of``.

    A tenth of the tracks and a third of the identifies come one batch late;
    the third batch is the last day.
    """

    def part(df: DataFrame, number: int, late_share: int) -> DataFrame:
        due = "CASE WHEN timestamp < TIMESTAMP'2024-01-24 00:00:00' THEN 0 WHEN timestamp < TIMESTAMP'2024-01-30 00:00:00' THEN 1 ELSE 2 END"
        return df.filter(f"least(2, {due} + IF(pmod(xxhash64(id), {late_share}) = 0, 1, 0)) = {number}")

    days = (datetime(2024, 1, 24), datetime(2024, 1, 30, 6), r.cfg.as_of)
    return [
        (
            Inputs(part(r.inputs.tracks, n, 10), part(r.inputs.pages, n, 10) if r.cfg.include_pages_in_sessions else None, part(r.inputs.identifies, n, 3)),
            r.cfg.replace(as_of=days[n]),
        )
        for n in range(3)
    ]


def _built_incrementally(table: str, *columns: str) -> Callable[[Relations, SparkSession, str], DataFrame]:
    """A table of the store after three batches."""

    def run(r: Relations, spark: SparkSession, sf_dir: str) -> DataFrame:
        batches = _raw_batches(r)
        # Several queries read one store; the batches are done once and after that recognised.
        folder = f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/store-{_digest(sf_dir, r.cfg)}"
        for number, (inputs, cfg) in enumerate(batches):
            built = incremental.build_incremental(inputs, cfg, folder, number)
        return built[table].select(*columns) if columns else built[table]

    return run


def _digest(*parts: object) -> str:
    return hashlib.md5(repr(parts).encode()).hexdigest()


def _masked_actives(r: Relations, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Actives of the last three days from stored masks and one new day at a time.

    Every ninth row of the days before arrives on the last day.
    """
    keys = ["account_id", "user_id"]
    seen = r.daily.filter("user_id IS NOT NULL").select(*keys, "activity_date").distinct()
    late = "pmod(hash(user_id, activity_date), 9) = 0"
    start, last = r.cfg.last_day - timedelta(days=3), r.cfg.last_day
    masks = bitmaps.activity_masks(seen.filter(f"activity_date <= DATE'{start}' AND NOT ({late})"), keys, "activity_date", start)
    masks = sinks.write_table(masks, scratch_path(spark, "masks"))
    for k in range(1, 4):
        day = start + timedelta(days=k)
        new = seen.filter(f"activity_date = DATE'{day}' OR (activity_date < DATE'{day}' AND {late})" if day == last else f"activity_date = DATE'{day}' AND NOT ({late})")
        masks = bitmaps.advance_masks(masks, new, keys, "activity_date", day - timedelta(days=1), day)
        masks = sinks.write_table(masks, scratch_path(spark, "masks"))
    counts = bitmaps.masked_actives(masks, ["account_id"], account_plans.USER_WINDOWS)
    days = r.dim_accounts.filter(f"to_date(first_seen_at) <= DATE'{last}'").select("account_id").join(counts, "account_id", "left")
    names = list(account_plans.USER_WINDOWS)
    return days.selectExpr(f"DATE'{last}' AS metric_date", "account_id", *[f"coalesce({n}, 0L) AS {n}" for n in names])


def _sketched_actives(r: Relations, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether united daily sketches are within five errors of the exact counts,
    per account and in all, for three spans."""
    sketches = sinks.write_table(sketch.daily_sketches(r.daily), scratch_path(spark, "sketches"), ["activity_date"])
    last = r.cfg.last_day
    out = []
    for days in (7, 30, 365):
        first = last - timedelta(days=days - 1)
        span = r.daily.filter(f"activity_date BETWEEN DATE'{first}' AND DATE'{last}'")
        for keys in (["account_id"], []):
            exact = aggregate(span, keys, "count(DISTINCT user_id) AS users", "count(DISTINCT event_name) AS features")
            approx = sketch.united_estimates(sketches, keys, first, last)
            both = exact.join(approx, keys) if keys else exact.join(approx, F.expr("true"))
            near = f"abs(approx_{{0}} - {{0}}) <= 1 + {5 * sketch.STANDARD_ERROR} * {{0}}"
            out.append(both.selectExpr(
                f"{days}L AS days", "account_id" if keys else "'all' AS account_id",
                f"{near.format('users')} AS users_near", f"{near.format('features')} AS features_near",
            ))
    return union_all(out)


def _sketched_sql(cfg: Config) -> str:
    parts = []
    for days in (7, 30, 365):
        span = f"CAST(tm AS DATE) BETWEEN DATE '{cfg.last_day - timedelta(days=days - 1)}' AND DATE '{cfg.last_day}'"
        parts.append(f"SELECT DISTINCT CAST({days} AS BIGINT) AS days, account_id, true AS users_near, true AS features_near FROM stg WHERE {span}")
        parts.append(f"SELECT CAST({days} AS BIGINT), 'all', true, true")
    return "\nUNION ALL ".join(parts)


DOCUMENTED_TABLES = {"dim_accounts": "dim_a", "dim_users": "dim_u", "fct_product_metrics_daily": "prod", "fct_account_metrics_daily": "acct"}


def _column_comments(r: Relations, spark: SparkSession, sf_dir: str) -> DataFrame:
    """(relation, column_name, comment, n_filled) of written tables, from the schema they are read back with."""
    relations = {"dim_accounts": r.dim_accounts, "dim_users": r.dim_users, "fct_product_metrics_daily": r.product_daily, "fct_account_metrics_daily": r.account_daily}
    return union_all([docs.filled_columns(sinks.write_table(docs.with_docs(df), scratch_path(spark, name)), name) for name, df in relations.items()])


def _comments_sql() -> str:
    def listed(select: str) -> list[str]:
        return select.split(" FROM ")[0].removeprefix("SELECT").replace(",", " ").split()

    trends = [f"{n}_trend_{k}d" for n in product.TREND_COLUMNS for k in product.TREND_SPANS]
    columns = {
        "dim_accounts": listed(DIM_A_SQL),
        "dim_users": listed(DIM_U_SQL),
        "fct_product_metrics_daily": ["metric_date", *product.TREND_COLUMNS, "user_stickiness_ratio", "account_stickiness_ratio", *trends],
        "fct_account_metrics_daily": dict.fromkeys(
            [*ACCOUNT_ACTIVES, *ACCOUNT_BREADTH, *ACCOUNT_SESSIONS, *ACCOUNT_SIGNALS, *ACCOUNT_TRENDS, "health_segment", "health_score"]
        ),
    }
    parts = []
    for relation, names in columns.items():
        for column in names:
            if column in docs.COLUMN_DOCS:
                comment = docs.COLUMN_DOCS[column].replace("'", "''")
                counted = f"count({column}) AS n_filled FROM {DOCUMENTED_TABLES[relation]}"
                parts.append(f"SELECT '{relation}' AS relation, '{column}' AS column_name, '{comment}' AS comment, {counted}")
    return "\nUNION ALL ".join(parts)


def _registered_view(r: Relations, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged events read by the name of their view."""
    sinks.register(r.tracks, "staged_events_view")
    return spark.sql("SELECT account_id, event_name, count(*) AS n_events FROM staged_events_view GROUP BY account_id, event_name")


SESSION_SQL = (
    "SELECT session_id, user_id, user_session_index, session_start_at, session_end_at, session_duration_seconds,"
    " events_in_session, account_id FROM sess"
)
STREAM_SESSION_SQL = f"""SELECT md5(coalesce(user_id, '{KEY_NULL_TOKEN}') || '-' || epoch_us(session_start_at)) AS session_key,
  user_id, session_start_at, session_end_at, session_duration_seconds, events_in_session, account_id FROM sess
  WHERE date_trunc('minute', session_end_at) + INTERVAL 30 MINUTE
        <= (SELECT date_trunc('minute', max(tm)) - INTERVAL 1 HOUR FROM stg)"""
STG_SQL = (
    "SELECT id AS event_id, anon AS anonymous_id, original_user_id, user_id, original_account_id, account_id,"
    " event AS event_name, tm AS event_at FROM stg"
)
# Windows of 7 days that the watermark, one hour behind the newest event, has passed.
ACTIVES_SQL = """SELECT CAST(d AS DATE) AS metric_date, count(DISTINCT user_id) AS active_users, count(DISTINCT account_id) AS active_accounts
  FROM (SELECT unnest(generate_series(min(CAST(tm AS DATE)), max(CAST(tm AS DATE)) + 6, INTERVAL 1 DAY)) AS d, max(tm) AS newest FROM stg)
  JOIN stg ON CAST(tm AS DATE) > d - INTERVAL 7 DAY AND CAST(tm AS DATE) <= d
  WHERE d + INTERVAL 1 DAY <= newest - INTERVAL 1 HOUR GROUP BY d"""
NULLS = "CAST(NULL AS VARCHAR)"
PAGES_SQL = (
    f"SELECT id AS page_id, anon AS anonymous_id, original_user_id, user_id, original_account_id, account_id,"
    f" name AS page_name, tm AS page_viewed_at, {NULLS} AS page_title, {NULLS} AS page_path, url AS page_url,"
    f" {NULLS} AS page_referrer, {NULLS} AS page_search FROM stg_pages"
)
DIM_A_SQL = (
    "SELECT account_id, first_seen_at, last_seen_at, lifetime_unique_users, current_active_seats,"
    " days_since_first_seen, days_since_last_seen FROM dim_a"
)
DIM_U_SQL = (
    "SELECT user_id, first_seen_at, last_seen_at, lifetime_accounts_distinct, latest_account_id,"
    " days_since_first_seen, days_since_last_seen FROM dim_u"
)
SNAP_SQL = "SELECT * FROM snap"
FU_SQL = "SELECT * FROM fu"
DAY_FEB_5, DAY_FEB_20 = datetime(2024, 2, 5, 12), datetime(2024, 2, 20, 12)
SHORT_LOOKBACK = MAIN.replace(tracks_lookback_days=10, identity_lookback_days=10, pages_lookback_days=10)
WITH_PAGES = MAIN.replace(include_pages_in_sessions=True)
UNSTITCHED = MAIN.replace(enable_identity_stitching=False)
GROWTH_DAY = MAIN.replace(as_of=datetime(2024, 1, 16, 12))
LIFECYCLE_SQL = "SELECT metric_date, user_lifecycle_status, count(*) AS n_users FROM snap GROUP BY ALL"


def _build() -> dict[str, Query]:
    q: dict[str, Query] = {}
    q["stage_tracks"] = Query(lambda r, s, d: r.tracks, STG_SQL)
    q["stage_tracks_unstitched"] = Query(lambda r, s, d: r.tracks, STG_SQL, UNSTITCHED)
    q["stage_pages"] = Query(lambda r, s, d: r.pages, PAGES_SQL)
    q["stage_pages_unstitched"] = Query(lambda r, s, d: r.pages, PAGES_SQL, UNSTITCHED)
    q["identity_map"] = Query(lambda r, s, d: r.identity_map, "SELECT anon AS anonymous_id, master AS master_user_id FROM idmap")
    q["user_account_map"] = Query(lambda r, s, d: r.account_map, "SELECT u2 AS user_id, latest AS latest_account_id FROM acctmap")
    q["lookback_filter"] = Query(lambda r, s, d: r.tracks, STG_SQL, SHORT_LOOKBACK)
    q["daily_activity"] = Query(
        lambda r, s, d: r.daily,
        "SELECT account_id, user_id, CAST(tm AS DATE) AS activity_date, event AS event_name, count(*) AS n_events,"
        " min(tm) AS first_at, max(tm) AS last_at FROM stg GROUP BY ALL",
    )
    q["sessions"] = Query(lambda r, s, d: r.sessions, SESSION_SQL)
    q["sessions_unstitched"] = Query(lambda r, s, d: r.sessions, SESSION_SQL, UNSTITCHED)
    q["sessions_with_pages"] = Query(lambda r, s, d: r.sessions, SESSION_SQL, WITH_PAGES)
    q["sessions_timeout_60"] = Query(lambda r, s, d: r.sessions, SESSION_SQL, MAIN.replace(session_timeout_minutes=60))
    q["sessions_timeout_600_with_pages"] = Query(
        lambda r, s, d: r.sessions, SESSION_SQL, MAIN.replace(session_timeout_minutes=600, include_pages_in_sessions=True)
    )
    q["session_ids"] = Query(
        lambda r, s, d: r.sessions.select("session_id", "user_id", "user_session_index"),
        "SELECT session_id, user_id, user_session_index FROM sess",
    )
    q["sessions_incremental"] = Query(lambda r, s, d: _split_incrementally(r, False), SESSION_SQL)
    q["sessions_incremental_late"] = Query(lambda r, s, d: _split_incrementally(r, True), SESSION_SQL)
    q["sessions_upsert_table"] = Query(_upserted_sessions, SESSION_SQL)
    q["sessions_upsert_repeated"] = Query(_upserted_again, SESSION_SQL)
    q["sessions_upsert_stream"] = Query(_upserted_stream, SESSION_SQL)
    q["sessions_late_rows"] = Query(_late_rows_reconciled, SESSION_SQL)
    q["sessions_recent"] = Query(_recent_sessions, SESSION_SQL)
    q["sessions_restitched"] = Query(_built_incrementally("fct_sessions", *SESSION_COLUMNS), SESSION_SQL)
    q["sessions_restitched_with_pages"] = Query(_built_incrementally("fct_sessions", *SESSION_COLUMNS), SESSION_SQL, WITH_PAGES)
    q["incremental_account_health"] = Query(_built_incrementally("fct_account_metrics_daily"), "SELECT * FROM acct")
    q["incremental_product_trends"] = Query(_built_incrementally("fct_product_metrics_daily"), "SELECT * FROM prod")
    q["incremental_feature_usage"] = Query(_built_incrementally("fct_account_feature_usage_monthly"), FU_SQL)
    q["incremental_user_snapshot"] = Query(_built_incrementally("fct_user_metrics_daily"), SNAP_SQL)
    q["incremental_dim_accounts"] = Query(_built_incrementally("dim_accounts"), DIM_A_SQL)
    q["incremental_dim_users"] = Query(_built_incrementally("dim_users"), DIM_U_SQL)
    q["sessions_streaming"] = Query(_streamed_sessions, STREAM_SESSION_SQL)
    for key in ("account_id", "user_id"):
        q[f"daily_counts_streaming_{key.split('_')[0]}"] = Query(
            _streamed_counts(key),
            f"SELECT CAST(tm AS DATE) AS event_date, {key}, count(*) AS n_events FROM stg"
            f" WHERE CAST(tm AS DATE) + INTERVAL 1 DAY <= (SELECT max(tm) - INTERVAL 1 HOUR FROM stg) GROUP BY ALL",
        )
    q["deduplicated_streaming"] = Query(_streamed_once, STG_SQL)
    q["sliding_actives_streaming"] = Query(_streamed_actives, f"SELECT * FROM ({ACTIVES_SQL})")
    q["approx_actives"] = Query(
        _approx_actives, f"SELECT metric_date, true AS users_near, true AS accounts_near FROM ({ACTIVES_SQL})"
    )
    q["dim_accounts"] = Query(lambda r, s, d: r.dim_accounts, DIM_A_SQL)
    q["dim_users"] = Query(lambda r, s, d: r.dim_users, DIM_U_SQL)
    q["dim_users_enriched"] = Query(
        lambda r, s, d: dimensions.enrich_users(r.dim_users, r.inputs.users),
        "SELECT dim_u.*, c_name AS email FROM dim_u LEFT JOIN customer ON user_id = 'u' || c_custkey",
    )
    q["dim_accounts_enriched"] = Query(
        lambda r, s, d: dimensions.enrich_accounts(r.dim_accounts, r.inputs.groups),
        "SELECT dim_a.*, n_name AS name FROM dim_a LEFT JOIN nation ON account_id = 'acct_' || n_nationkey",
    )
    q["sessions_partitioned_table"] = Query(
        lambda r, s, d: sinks.write_sessions(r.sessions, scratch_path(s, "sessions")).filter(
            "session_date BETWEEN DATE'2024-01-05' AND DATE'2024-01-11'"
        ),
        "SELECT *, CAST(session_start_at AS DATE) AS session_date FROM sess"
        " WHERE CAST(session_start_at AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-11'",
    )
    q["sessions_newest_events"] = Query(
        lambda r, s, d: events_since(
            r.tracks, sessionize(r.tracks.filter("event_at < TIMESTAMP'2024-01-25 00:00:00'"), r.cfg.session_timeout_minutes),
            r.cfg.session_timeout_minutes,
        ),
        STG_SQL + " WHERE tm >= (SELECT max(tm) - INTERVAL 30 MINUTE FROM stg WHERE tm < TIMESTAMP '2024-01-25')",
    )
    q["date_spine"] = Query(
        lambda r, s, d: date_spine(s, r.cfg.spine_start, r.cfg.today)
        .join(r.daily.selectExpr("activity_date AS date_day", "1L AS seen").distinct(), "date_day", "left")
        .selectExpr("date_day", "coalesce(seen, 0L) AS has_activity"),
        "SELECT d AS date_day, CAST(EXISTS (SELECT 1 FROM stg WHERE CAST(tm AS DATE) = d) AS BIGINT) AS has_activity FROM calendar",
    )
    q["account_spine"] = Query(
        lambda r, s, d: account_plans.account_spine(r.dim_accounts, r.cfg), "SELECT d AS metric_date, account_id FROM spine_a"
    )
    actives = "metric_date, dau, wau, mau, daa, waa, maa"
    q["product_actives"] = Query(lambda r, s, d: product.product_actives(r.daily, r.cfg), f"SELECT {actives} FROM prod")
    q["product_trends"] = Query(lambda r, s, d: r.product_daily, "SELECT * FROM prod")
    q["product_trends_idle_days"] = Query(lambda r, s, d: r.product_daily, "SELECT * FROM prod", MAIN.replace(as_of=datetime(2024, 4, 1)))
    q["product_trends_long"] = Query(lambda r, s, d: r.product_daily, "SELECT * FROM prod", LONG, LONG_STRETCH)
    q["product_trends_documented"] = Query(
        lambda r, s, d: r.product_daily, "SELECT * FROM prod", MAIN.replace(semantics=DOCUMENTED)
    )
    q["product_latest_days"] = Query(
        lambda r, s, d: signals.latest_days(r.product_daily.select("metric_date", "dau", "mau", "user_stickiness_ratio")),
        "SELECT metric_date, dau, mau, user_stickiness_ratio FROM prod ORDER BY metric_date DESC LIMIT 10",
    )
    q["account_actives"] = _account(ACCOUNT_ACTIVES)
    q["account_actives_masks"] = Query(
        _masked_actives, f"SELECT metric_date, account_id, dau, wau, mau FROM acct WHERE metric_date = DATE '{MAIN.last_day}'"
    )
    q["sketched_actives"] = Query(_sketched_actives, f"SELECT * FROM ({_sketched_sql(MAIN)})")
    q["column_comments"] = Query(_column_comments, f"SELECT * FROM ({_comments_sql()})")
    q["registered_view"] = Query(_registered_view, "SELECT account_id, event AS event_name, count(*) AS n_events FROM stg GROUP BY ALL")
    q["account_breadth_frequency"] = _account(ACCOUNT_BREADTH)
    q["account_sessions_literal"] = _account(ACCOUNT_SESSIONS)
    q["account_sessions_documented"] = _account(ACCOUNT_SESSIONS, MAIN.replace(semantics=DOCUMENTED))
    q["account_sessions_with_pages"] = _account(ACCOUNT_SESSIONS, WITH_PAGES)
    q["account_signals"] = _account(ACCOUNT_SIGNALS)
    q["account_trends"] = _account(ACCOUNT_TRENDS)
    everything = Query(lambda r, s, d: r.account_daily, "SELECT * FROM acct")
    q["account_health"] = everything
    q["account_health_long"] = Query(everything.run, everything.select, LONG, LONG_STRETCH)
    q["account_health_documented"] = Query(everything.run, everything.select, MAIN.replace(semantics=DOCUMENTED))
    q["account_health_late_spine"] = Query(
        everything.run, everything.select, MAIN.replace(spine_start=date(2024, 1, 10), include_pages_in_sessions=True)
    )
    q["account_health_yesterday"] = Query(
        lambda r, s, d: _since(r, 1), f"SELECT * FROM acct WHERE metric_date = DATE '{LONG.last_day}'", LONG, LONG_STRETCH
    )
    q["feature_usage"] = Query(lambda r, s, d: r.feature_monthly, FU_SQL)
    q["feature_usage_long"] = Query(lambda r, s, d: r.feature_monthly, FU_SQL, LONG, LONG_STRETCH)
    q["feature_usage_documented"] = Query(
        lambda r, s, d: r.feature_monthly, FU_SQL, LONG.replace(semantics=DOCUMENTED, min_monthly_feature_events=4), LONG_STRETCH
    )
    q["feature_usage_min10"] = Query(
        lambda r, s, d: r.feature_monthly, FU_SQL, LONG.replace(min_monthly_feature_events=10), LONG_STRETCH
    )
    q["feature_patterns"] = Query(
        lambda r, s, d: signals.feature_patterns(r.feature_monthly, r.cfg),
        "SELECT * FROM pat", LONG, LONG_STRETCH, [_patterns_cte(LONG)],
    )
    q["user_daily_activity"] = Query(lambda r, s, d: users.user_daily_activity(r.daily), "SELECT * FROM ua")
    q["user_daily_sessions"] = Query(
        lambda r, s, d: users.user_daily_sessions(r.sessions),
        "SELECT session_date, user_id, n_sessions, CAST(round(CAST(avg_min AS DECIMAL(28,10)), 6) AS DOUBLE) AS"
        " avg_session_duration_minutes, CAST(round(CAST(avg_ev AS DECIMAL(28,10)), 6) AS DOUBLE) AS avg_events_per_session FROM us",
    )
    snapshot = Query(lambda r, s, d: r.user_latest, SNAP_SQL)
    q["user_snapshot"] = snapshot
    q["user_snapshot_long"] = Query(snapshot.run, SNAP_SQL, LONG, LONG_STRETCH)
    q["user_snapshot_late_spine"] = Query(
        snapshot.run, SNAP_SQL, MAIN.replace(spine_start=date(2024, 1, 10), include_pages_in_sessions=True)
    )
    q["user_snapshot_documented"] = Query(snapshot.run, SNAP_SQL, MAIN.replace(semantics=DOCUMENTED))
    q["user_snapshot_early"] = Query(snapshot.run, SNAP_SQL, MAIN.replace(as_of=datetime(2024, 1, 3, 12)))
    q["champions_topk"] = Query(
        lambda r, s, d: signals.champions(r.user_latest, 3).select(
            "latest_account_id", "user_id", "usage_rank_in_account", "n_events_monthly"
        ),
        "SELECT latest_account_id, user_id, usage_rank_in_account, n_events_monthly FROM snap WHERE usage_rank_in_account <= 3",
    )
    q["lifecycle_counts"] = Query(lambda r, s, d: signals.lifecycle_counts(r.user_latest), LIFECYCLE_SQL)
    q["lifecycle_counts_dormant"] = Query(q["lifecycle_counts"].run, LIFECYCLE_SQL, MAIN.replace(as_of=DAY_FEB_5))
    q["lifecycle_counts_churned"] = Query(q["lifecycle_counts"].run, LIFECYCLE_SQL, MAIN.replace(as_of=DAY_FEB_20))
    q["churn_alerts"] = Query(
        lambda r, s, d: signals.churn_alerts(_since(r, 1), r.cfg), _churn_sql(LONG, 0.5, 2), LONG, LONG_STRETCH
    )
    q["churn_alerts_wide"] = Query(
        lambda r, s, d: signals.churn_alerts(_since(r, 1), r.cfg, drop=0.95), _churn_sql(LONG, 0.95, 2), LONG, LONG_STRETCH
    )
    q["expansion_alerts"] = Query(
        lambda r, s, d: signals.expansion_alerts(_since(r, 1), r.cfg), _expansion_sql(GROWTH_DAY, 1.5, 5), GROWTH_DAY
    )
    q["alert_file"] = Query(_alert_file, _expansion_sql(GROWTH_DAY, 1.5, 5), GROWTH_DAY)
    q["account_trend_30d"] = Query(
        lambda r, s, d: signals.account_trend(_since(r, 37), r.cfg), _trend_sql(LONG, 30), LONG, LONG_STRETCH
    )
    q["user_segments"] = Query(lambda r, s, d: signals.user_segments(r.user_latest), SEGMENTS_SQL)
    q["user_segments_churned"] = Query(q["user_segments"].run, SEGMENTS_SQL, MAIN.replace(as_of=DAY_FEB_20))
    q["license_utilization"] = Query(lambda r, s, d: signals.license_utilization(r.user_latest), LICENSE_SQL, MAIN.replace(as_of=DAY_FEB_20))
    q["account_playbook"] = Query(
        lambda r, s, d: signals.account_playbook(
            _since(r, 8), r.user_latest, signals.feature_patterns(r.feature_monthly, r.cfg), r.cfg
        ),
        _playbook_sql(LONG), LONG, LONG_STRETCH, [_patterns_cte(LONG)],
    )
    q["stitch_coverage"] = Query(
        lambda r, s, d: signals.stitch_coverage(r.tracks),
        "SELECT count(*) AS total_tracks, count(DISTINCT user_id) AS tracks_with_user_id,"
        " count(DISTINCT anon) AS tracks_with_anonymous_id FROM stg",
    )
    q["source_profile"] = Query(
        lambda r, s, d: signals.source_profile(r.inputs.tracks, r.cfg),
        "SELECT count(*) AS n_rows, min(tm) AS first_at, max(tm) AS last_at, count(*) - count(account_id) AS n_without_account FROM raw_tracks",
    )
    q["events_per_day"] = Query(
        lambda r, s, d: signals.events_per_day(r.tracks),
        "SELECT CAST(tm AS DATE) AS event_date, count(*) AS event_count FROM stg GROUP BY ALL",
    )
    q["quality_report"] = Query(lambda r, s, d: quality.run_checks(_quality_relations(r)), _quality_sql())
    q["quality_report_spoiled"] = Query(lambda r, s, d: quality.run_checks(_spoiled(r)), _quality_sql(spoil=True))
    q["sources_parquet"] = Query(lambda r, s, d: _reread(r, s, "parquet").sessions, SESSION_SQL, WITH_PAGES)
    q["sources_csv"] = Query(
        lambda r, s, d: _reread(r, s, "csv").tracks, STG_SQL.replace("tm AS event_at", "date_trunc('second', tm) AS event_at")
    )
    q["sources_users_groups"] = Query(
        _enriched,
        "SELECT 'user' AS kind, user_id AS id, c_name AS name FROM dim_u LEFT JOIN customer ON user_id = 'u' || c_custkey"
        " UNION ALL SELECT 'account', account_id, n_name FROM dim_a LEFT JOIN nation ON account_id = 'acct_' || n_nationkey",
    )
    return q


_DAILY_READERS = (
    "product_", "feature_", "account_actives", "account_breadth", "account_sessions", "account_signals", "account_trend",
    "account_health", "churn_alerts", "expansion_alerts", "alert_file", "user_snapshot", "champions_topk",
    "lifecycle_counts", "user_segments", "license_utilization",
)


def _share(queries: dict[str, Query]) -> dict[str, Query]:
    for key, query in queries.items():
        if key.startswith(_DAILY_READERS):
            query.shared = ("lookup", "daily", "user_days")
        elif key.startswith("sessions_incremental"):
            query.shared = ("lookup", "sessions")
    for key in ("sessions_upsert_table", "sessions_upsert_repeated", "sessions_upsert_stream", "sessions_late_rows", "sessions_recent"):
        queries[key].shared = ("events", "sessions")
    for key in ("account_actives_masks", "sketched_actives", "column_comments"):
        queries[key].shared = ("lookup", "daily", "sessions")
    for key in ("account_playbook", "quality_report", "quality_report_spoiled"):
        queries[key].shared = ("lookup", "tracks", "daily", "sessions", "user_days")
    return queries


QUERIES = _share(_build())
FLAGSHIP = "account_health"


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return {name: query.sql() for name, query in QUERIES.items() if query.select is not None}

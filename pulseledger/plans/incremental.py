"""Incremental build: only what a batch of raw events can change is computed and swapped.

Beside the tables of ``pipeline.build`` a store keeps

* ``int_raw_activity``: the un-stitched roll-up by day and batch,
* ``int_last_identity`` and ``int_last_account``: what was seen last per device and
  per user, and when, which merges with a batch's own,
* ``int_lookup_days``: the days on which a device or user has rows that need a look-up,
* ``int_membership``: first and last event per account and user.

**Retraction.** A late identify, or a user's later account, changes look-ups. The
rows of the changed devices and users are found by their days; the user they
belonged to before and the one they belong to now are computed anew in the
session table, everyone else is merged by the upsert.

**Dirty days.** Days with new or moved rows are rolled up again and compared with
the stored roll-up. Each (account, day) that differs, or whose sessions do,
makes the account's next 60 days dirty: windows of 30 days and lags of up to 30
days reach no further. Days that the calendar has gained are computed for
all accounts. Only these rows are computed, only their partitions swapped.

A batch is planned completely in ``_batches/batch=<id>`` before any table changes,
and every step after that can be repeated, so an interrupted batch is taken up
again under its id, and a batch that is done stays done.

A store keeps every event since its first batch. Results are those of a full
build over all batches with a look-back that covers them, at the latest
``as_of``; to forget old events, build anew.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Config
from ..functions import aggregate, day_literal
from ..operators import activity, identity
from ..operators.docs import with_docs
from ..operators.sessions import SESSION_COLUMNS, SESSION_DATE
from ..session import configure, materialize, side_by_side
from ..sources import files, session_store
from . import accounts as account_plans
from . import dimensions, features, pipeline, product, users

# A change on a day shows in the metrics of this many days, itself included.
ACCOUNT_REACH = account_plans.LONGEST_WINDOW + account_plans.LONGEST_LAG
PRODUCT_REACH = max(product.USER_WINDOWS.values())
_LOOKUP_KEYS = "original_user_id IS NULL AS is_anonymous", "coalesce(original_user_id, anonymous_id) AS lookup_id"


class Store:
    """Folders of a store, and its tables by name."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def path(self, table: str) -> str:
        return f"{self.folder}/{table}"

    def read(self, table: str) -> DataFrame:
        return self.spark.read.parquet(self.path(table))

    def replace(self, table: str, df: DataFrame, keep: str | None = None) -> DataFrame:
        """Write a table that ``df`` may read itself, through a copy at ``keep``."""
        if keep is not None:
            df = files.stored(df, keep)
        with_docs(df).write.mode("overwrite").parquet(self.path(table))
        return self.read(table)


def build_incremental(inputs: pipeline.Inputs, cfg: Config, out_dir: str, batch_id: int | str) -> dict[str, DataFrame]:
    """Bring the store at ``out_dir`` up to date with a batch of raw events.

    ``inputs`` has only the events that are new. The first batch must have
    some and is a full build; a later one may be empty, for a later ``as_of``.
    Returns the tables by name.
    """
    spark = configure(inputs.tracks.sparkSession)
    store = Store(spark, out_dir)
    log = store.path(f"_batches/batch={batch_id}")
    if not files.exists(spark, f"{log}/applied"):
        first = files.read_text(spark, store.path("_batches/first"))
        if first in (None, str(batch_id)):
            _start(store, inputs, cfg, batch_id)
        else:
            if not files.exists(spark, store.path(f"_batches/batch={first}/applied")):
                raise RuntimeError(f"the store's first batch, {first}, is not complete")
            if cfg.last_day.isoformat() < files.read_text(spark, store.path("_batches/last_day")):
                raise ValueError("as_of must not go back in time")
            if not files.exists(spark, f"{log}/planned"):
                _plan(store, inputs, cfg, log)
                files.mark(spark, f"{log}/planned")
            _apply(store, cfg, log, batch_id)
        files.write_text(spark, store.path("_batches/last_day"), cfg.last_day.isoformat())
        files.mark(spark, f"{log}/applied")
        _forget_previous(store, log)
    return tables(store)


def tables(store: Store) -> dict[str, DataFrame]:
    """The metric tables of a store."""
    names = [table for step in pipeline.STEPS for table, _ in step.values() if files.exists(store.spark, store.path(table))]
    return {name: store.read(name).select(*SESSION_COLUMNS) if name == "fct_sessions" else store.read(name) for name in names}


def _forget_previous(store: Store, log: str) -> None:
    latest = store.path("_batches/latest")
    before = files.read_text(store.spark, latest)
    if before is not None and before != log:
        files.delete(store.spark, f"{before}/plan")
    files.write_text(store.spark, latest, log)


def _start(store: Store, inputs: pipeline.Inputs, cfg: Config, batch_id: int | str) -> None:
    """First batch: a full build, and the state that later batches need."""
    files.write_text(store.spark, store.path("_batches/first"), str(batch_id))
    raw = pipeline.write_raw(activity.raw_rollup(inputs.tracks, inputs.pages, cfg), store.folder)
    if cfg.enable_identity_stitching:
        store.replace("int_last_identity", identity.last_seen(identity.seen_identities(inputs.identifies, cfg), "anonymous_id", "user_id"))
        store.replace("int_last_account", identity.last_seen(activity.seen_accounts(raw), "user_id", "account_id"))
        _append(_lookup_days(raw), store.path("int_lookup_days"), ["batch"], batch_id)
    pipeline.build_from_raw(inputs, cfg, store.folder, raw)
    store.replace("int_membership", dimensions.membership(store.read("int_daily_activity")))


def _lookup_days(raw: DataFrame) -> DataFrame:
    return raw.filter(identity.NEEDS_LOOKUP).selectExpr(*_LOOKUP_KEYS, "activity_date").distinct()


def _days_of(df: DataFrame, column: str = "activity_date") -> list[date]:
    """Distinct days of a relation: at most one per day of the calendar."""
    return [row[0] for row in df.select(column).distinct().collect()]


def _on(days: Iterable[date], column: str = "activity_date"):
    return F.col(column).isin(list(days))


def _raw(store: Store) -> DataFrame:
    return store.read(pipeline.RAW_TABLE).select(*activity.RAW_KEYS, "n_events", "first_at", "last_at")


# --- planning: nothing is changed yet --------------------------------------------


def _plan(store: Store, inputs: pipeline.Inputs, cfg: Config, log: str) -> None:
    """Write what the batch changes: new rows, look-ups, moved users, daily rows."""
    spark, plan = store.spark, f"{log}/plan"
    new = files.stored(activity.raw_rollup(inputs.tracks, inputs.pages, cfg), f"{plan}/raw")
    lookup, moved_days = None, []
    if cfg.enable_identity_stitching:
        lookup, moved_days = _changed_lookups(store, inputs, cfg, new, plan)
    days = sorted({*_days_of(new), *moved_days})
    every = _raw(store).filter(_on(days)).unionByName(new.select(*activity.RAW_KEYS, "n_events", "first_at", "last_at"))
    before = store.read("int_daily_activity").filter(_on(days))
    daily = files.stored(activity.daily_against(every, lookup, cfg, before), f"{plan}/daily")
    differing = files.stored(activity.daily_differing(daily), f"{plan}/differing")
    first_days = store.read("dim_accounts").selectExpr("account_id", "to_date(first_seen_at) AS old_first")
    side_by_side(
        lambda: files.stored(first_days.join(differing, "account_id", "left_semi"), f"{plan}/first_days"),
        lambda: files.stored(spark.createDataFrame([(d,) for d in days], "activity_date date"), f"{plan}/days"),
    )


def _changed_lookups(store: Store, inputs: pipeline.Inputs, cfg: Config, new: DataFrame, plan: str) -> tuple[DataFrame, list[date]]:
    """The new look-up map, and the days on which rows change their user or account."""
    old_identity, old_account = store.read("int_last_identity"), store.read("int_last_account")
    seen = old_identity.unionByName(identity.seen_identities(inputs.identifies, cfg))
    seen_account = old_account.unionByName(activity.seen_accounts(new))
    last_identity, last_account = side_by_side(
        lambda: files.stored(identity.last_seen(seen, "anonymous_id", "user_id"), f"{plan}/identity"),
        lambda: files.stored(identity.last_seen(seen_account, "user_id", "account_id"), f"{plan}/account"),
    )
    lookup = files.stored(_lookup(last_identity, last_account), f"{plan}/lookup")

    old = _lookup(old_identity, old_account).withColumnsRenamed({"found_user_id": "old_user_id", "found_account_id": "old_account_id"})
    changed = lookup.join(old, ["is_anonymous", "lookup_id"], "left")
    changed = changed.filter("NOT (found_user_id <=> old_user_id AND found_account_id <=> old_account_id)")
    with_rows = store.spark.read.schema("is_anonymous boolean, lookup_id string, activity_date date").parquet(store.path("int_lookup_days")).distinct()
    moved = files.stored(changed.join(with_rows, ["is_anonymous", "lookup_id"]), f"{plan}/moved")
    # A row has its own user if it has one, also before the look-up knew it.
    owner = "IF(is_anonymous, {}, lookup_id) AS user_id"
    owners = moved.selectExpr(owner.format("old_user_id")).union(moved.selectExpr(owner.format("found_user_id"))).distinct()
    _, days = side_by_side(lambda: files.stored(owners, f"{plan}/owners"), lambda: _days_of(moved))
    return lookup, days


def _lookup(last_identity: DataFrame, last_account: DataFrame) -> DataFrame:
    return identity.lookup_map(identity.identity_map(last_identity), identity.account_map(last_account))


# --- applying: every step can be repeated ----------------------------------------


def _apply(store: Store, cfg: Config, log: str, batch_id: int | str) -> None:
    spark, plan = store.spark, f"{log}/plan"
    days = _days_of(spark.read.parquet(f"{plan}/days"))
    since = date.fromisoformat(files.read_text(spark, store.path("_batches/last_day"))) + timedelta(days=1)
    new = spark.read.parquet(f"{plan}/raw")
    daily = activity.daily_now(spark.read.parquet(f"{plan}/daily"))
    differing = spark.read.parquet(f"{plan}/differing")
    lookup = None
    steps = [
        lambda: _append(new, store.path(pipeline.RAW_TABLE), ["activity_date", "batch"], batch_id),
        lambda: files.swap_partitions(daily, store.path("int_daily_activity"), "activity_date", days, "account_id"),
    ]
    if cfg.enable_identity_stitching:
        lookup = spark.read.parquet(f"{plan}/lookup")
        last_identity, last_account = spark.read.parquet(f"{plan}/identity"), spark.read.parquet(f"{plan}/account")
        steps += [
            lambda: _append(_lookup_days(new), store.path("int_lookup_days"), ["batch"], batch_id),
            lambda: store.replace("int_last_identity", last_identity),
            lambda: store.replace("int_last_account", last_account),
            lambda: store.replace("stg_identity_resolution", identity.identity_map(last_identity)),
            lambda: store.replace("stg_user_account_mapping", identity.account_map(last_account)),
        ]
    side_by_side(*steps)
    side_by_side(
        lambda: _update_sessions(store, cfg, new, lookup, days, plan, batch_id),
        lambda: _update_dimensions(store, cfg, differing, plan),
        lambda: _update_product(store, cfg, min([*days, since]), plan),
        lambda: _update_features(store, cfg, days, plan),
    )
    side_by_side(lambda: _update_accounts(store, cfg, differing, since, plan, batch_id), lambda: _update_users(store, cfg))


def _update_users(store: Store, cfg: Config) -> None:
    """The snapshot reads the last 31 days of the tables."""
    dims = store.read("dim_users"), store.read("dim_accounts")
    store.replace("fct_user_metrics_daily", users.user_metrics_latest(_daily(store), _sessions(store), *dims, cfg, materialize))


def _update_dimensions(store: Store, cfg: Config, differing: DataFrame, plan: str) -> None:
    members = _update_membership(store, differing, plan)
    side_by_side(
        lambda: store.replace("dim_accounts", dimensions.dim_accounts(members, cfg)),
        lambda: store.replace("dim_users", dimensions.dim_users(members, cfg)),
    )


def _append(df: DataFrame, target: str, partition_by: list[str], batch_id: int | str) -> None:
    """Add a batch's rows; again for the same batch changes nothing."""
    rows = df.withColumn("batch", F.lit(f"batch-{batch_id}"))
    writer = rows.hint("rebalance", *[F.col(c) for c in partition_by]).write.mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(target)


def _daily(store: Store) -> DataFrame:
    return store.read("int_daily_activity").select(*activity.DAILY_KEYS, "n_events", "first_at", "last_at")


def _sessions(store: Store) -> DataFrame:
    return session_store.read_sessions(store.spark, store.path("fct_sessions")).select(*SESSION_COLUMNS, SESSION_DATE)


def _update_sessions(
    store: Store, cfg: Config, new: DataFrame, lookup: DataFrame | None, days: list[date], plan: str, batch_id: int | str
) -> None:
    """Merge the batch's minutes; users who lost or gained old rows are computed anew."""
    again = None
    if lookup is not None:
        owners = store.spark.read.parquet(f"{plan}/owners")

        def minutes(used: Iterable[date]) -> DataFrame:
            rows = _raw(store).filter(_on({*used, *days}))
            theirs = owners.withColumnRenamed("user_id", "owner")
            return activity.minutes_from_raw(rows, lookup, cfg).join(theirs, F.expr("user_id <=> owner"), "left_semi")

        if not owners.isEmpty():
            again = session_store.Again(owners, minutes)
    batch = activity.minutes_from_raw(new, lookup, cfg)
    session_store.update_sessions(batch, store.path("fct_sessions"), batch_id, cfg.session_timeout_minutes, again)


def _update_membership(store: Store, differing: DataFrame, plan: str) -> DataFrame:
    """First and last events merge, but for pairs that lost some: these are computed anew."""
    added = differing.filter("NOT gone")
    now = added.selectExpr(*[f"{k} AS now_{k}" for k in activity.DAILY_KEYS], "first_at AS now_first", "last_at AS now_last")
    same_key = " AND ".join(f"{k} <=> now_{k}" for k in activity.DAILY_KEYS)
    lost = differing.filter("gone").join(now, F.expr(f"{same_key} AND now_first <= first_at AND now_last >= last_at"), "left_anti")
    lost = files.stored(lost.selectExpr("account_id AS lost_account", "user_id AS lost_user").distinct(), f"{plan}/lost")
    merged = store.read("int_membership").unionByName(added.select("account_id", "user_id", "first_at", "last_at"))
    if not lost.isEmpty():
        is_lost = F.expr("account_id <=> lost_account AND user_id <=> lost_user")
        anew = _daily(store).join(lost, is_lost, "left_semi").select(*merged.columns)
        merged = merged.join(lost, is_lost, "left_anti").unionByName(anew)
    return store.replace("int_membership", dimensions.membership(merged), f"{plan}/membership")


def _update_product(store: Store, cfg: Config, first: date, plan: str) -> None:
    """Actives from the first changed day on; trends of the small table of days."""
    first = max(first, cfg.spine_start)
    seen = _daily(store).filter(f"activity_date >= {day_literal(first - timedelta(days=PRODUCT_REACH - 1))}")
    actives = product.product_actives(seen, cfg.replace(spine_start=first))
    earlier = store.read("fct_product_metrics_daily").filter(f"metric_date < {day_literal(first)}").select(*actives.columns)
    store.replace("fct_product_metrics_daily", product.product_trends(earlier.unionByName(actives)), f"{plan}/product")


def _update_features(store: Store, cfg: Config, days: list[date], plan: str) -> None:
    """Months with changed days, and what later months say about earlier ones."""
    if not days:
        return
    months = sorted({d.replace(day=1) for d in days})
    in_months = " OR ".join(f"activity_date BETWEEN {day_literal(m)} AND last_day({day_literal(m)})" for m in months)
    usage = features.monthly_usage(_daily(store).filter(in_months), cfg)
    others = store.read("fct_account_feature_usage_monthly").select(*features.USAGE_COLUMNS).filter(~_on(months, "metric_month"))
    changed = features.usage_changes(others.unionByName(usage), cfg).filter(f"metric_month >= {day_literal(months[0])}")
    rows = files.stored(changed, f"{plan}/features")
    swapped = {*months, *_days_of(rows, "metric_month")}
    files.swap_partitions(with_docs(rows), store.path("fct_account_feature_usage_monthly"), "metric_month", swapped, "account_id")


def _dirty_ranges(store: Store, cfg: Config, differing: DataFrame, plan: str, batch_id: int | str) -> DataFrame:
    """(dirty_account, low, high): the days of each account whose metrics may differ.

    Where an account's first day moves, the days between the old and the new one
    come or go; of an account that is gone, all later days go.
    """
    removed, changed = (
        part.selectExpr("account_id", "to_date(session_start_at) AS day", "session_duration_seconds", "1 AS one")
        for part in session_store.replaced_and_new(store.spark, store.path("fct_sessions"), batch_id)
    )
    moved = removed.exceptAll(changed).unionByName(changed.exceptAll(removed))
    touched = differing.selectExpr("account_id", "activity_date AS day").unionByName(moved.select("account_id", "day"))
    spans = aggregate(touched.filter("account_id IS NOT NULL"), ["account_id"], "min(day) AS first_dirty", "max(day) AS last_dirty")
    before = store.spark.read.parquet(f"{plan}/first_days")
    now = store.read("dim_accounts").selectExpr("account_id", "to_date(first_seen_at) AS new_first")
    joined = spans.join(before, "account_id", "left").join(now, "account_id", "left")
    last = day_literal(cfg.last_day)
    reached = f"greatest(date_add(last_dirty, {ACCOUNT_REACH - 1}), old_first, new_first)"
    ranges = joined.selectExpr(
        "account_id AS dirty_account",
        f"greatest(first_dirty, {day_literal(cfg.spine_start)}) AS low",
        f"IF(new_first IS NULL, {last}, least({reached}, {last})) AS high",
    )
    return files.stored(ranges.filter("low <= high"), f"{plan}/ranges")


def _update_accounts(store: Store, cfg: Config, differing: DataFrame, since: date, plan: str, batch_id: int | str) -> None:
    """Rows of dirty accounts and days, and of days that the calendar has gained."""
    ranges = _dirty_ranges(store, cfg, differing, plan, batch_id)
    dirty = [row[0] for row in ranges.selectExpr("explode(sequence(low, high)) AS day").distinct().collect()]
    since = max(since, cfg.spine_start)
    gained = [since + timedelta(days=k) for k in range((cfg.last_day - since).days + 1)]
    days = {*dirty, *gained}
    if not days:
        return
    daily, sessions, accounts = _daily(store), _sessions(store), store.read("dim_accounts")
    parts = []
    if gained:
        parts.append(account_plans.account_metrics_daily(daily, sessions, accounts, cfg, since))
    late = [d for d in dirty if d < since]
    if late:
        of = F.expr("account_id = dirty_account")
        own = [df.join(ranges, of, "left_semi") for df in (daily, sessions, accounts)]
        again = account_plans.account_metrics_daily(*own, cfg, min(late)).filter(f"metric_date < {day_literal(since)}")
        wanted = again.join(ranges, F.expr("account_id = dirty_account AND metric_date BETWEEN low AND high"), "left_semi")
        parts.append(wanted)
    stored = store.read("fct_account_metrics_daily").select(*parts[0].columns)
    old = stored.filter(_on(days, "metric_date")).filter(f"metric_date < {day_literal(since)}")
    kept = old.join(ranges, F.expr("account_id = dirty_account AND metric_date BETWEEN low AND high"), "left_anti")
    for part in parts:
        kept = kept.unionByName(part)
    rows = files.stored(kept, f"{plan}/accounts")
    files.swap_partitions(with_docs(rows), store.path("fct_account_metrics_daily"), "metric_date", days, "account_id")

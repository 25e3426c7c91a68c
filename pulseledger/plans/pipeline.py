"""All relations of a run, lazily or written as tables."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import date
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Config
from ..operators import activity, identity
from ..operators.docs import with_docs
from ..operators.sessions import SESSION_COLUMNS, sessionize_minutes
from ..session import Share, configure, keep_lazy, materialize
from ..sources import readers, sinks
from . import accounts as account_plans
from . import dimensions, features, product, users


@dataclass(frozen=True)
class Inputs:
    """Raw relations; ``pages`` and ``identifies`` only if the settings use them."""

    tracks: DataFrame
    pages: DataFrame | None = None
    identifies: DataFrame | None = None

    @staticmethod
    def read(spark: SparkSession, cfg: Config) -> Inputs:
        return Inputs(
            readers.read_tracks(spark, cfg),
            readers.read_pages(spark, cfg) if cfg.include_pages_in_sessions else None,
            readers.read_identifies(spark, cfg) if cfg.enable_identity_stitching else None,
        )


class Relations:
    """The relations of one run as lazy DataFrames, each built on first use.

    ``share`` is applied to relations with several readers (the look-up map,
    the daily roll-up, ..): ``session.materialize`` writes them once, the
    default recomputes them per reader. With ``raw``, the written un-stitched
    roll-up, all relations but the staged events are made from it and the raw
    tracks and pages are not read again.
    """

    def __init__(self, inputs: Inputs, cfg: Config, share: Share = keep_lazy, raw: DataFrame | None = None):
        self.inputs = inputs
        self.cfg = cfg
        self.share = share
        self.raw = raw

    @cached_property
    def identity_map(self) -> DataFrame | None:
        if not self.cfg.enable_identity_stitching:
            return None
        if self.inputs.identifies is None:
            raise ValueError("identity stitching needs the identifies relation")
        return identity.resolve_identity(self.inputs.identifies, self.cfg)

    @cached_property
    def account_map(self) -> DataFrame | None:
        if not self.cfg.enable_identity_stitching:
            return None
        if self.raw is not None:
            return identity.account_map(identity.last_seen(activity.seen_accounts(self.raw), "user_id", "account_id"))
        return identity.map_user_account(self.inputs.tracks, self.cfg)

    @cached_property
    def lookup(self) -> DataFrame | None:
        if not self.cfg.enable_identity_stitching:
            return None
        return self.share(identity.lookup_map(self.identity_map, self.account_map), "lookup")

    @cached_property
    def tracks(self) -> DataFrame:
        """Staged tracks at event grain."""
        return identity.stage_tracks(self.inputs.tracks, self.lookup, self.cfg)

    @cached_property
    def pages(self) -> DataFrame:
        """Staged page views at event grain."""
        return identity.stage_pages(self.inputs.pages, self.lookup, self.cfg)

    @cached_property
    def daily(self) -> DataFrame:
        if self.raw is not None:
            return self.share(activity.daily_from_raw(self.raw, self.lookup, self.cfg), "daily")
        return self.share(activity.stitched_daily(self.inputs.tracks, self.lookup, self.cfg), "daily")

    @cached_property
    def sessions(self) -> DataFrame:
        if self.raw is not None:
            minutes = activity.minutes_from_raw(self.raw, self.lookup, self.cfg)
        else:
            pages = self.inputs.pages if self.cfg.include_pages_in_sessions else None
            minutes = activity.stitched_minutes(self.inputs.tracks, pages, self.lookup, self.cfg)
        return self.share(sessionize_minutes(minutes, self.cfg.session_timeout_minutes), "sessions")

    @cached_property
    def dim_accounts(self) -> DataFrame:
        return dimensions.dim_accounts(self.daily, self.cfg)

    @cached_property
    def dim_users(self) -> DataFrame:
        return dimensions.dim_users(self.daily, self.cfg)

    @cached_property
    def product_daily(self) -> DataFrame:
        return product.product_metrics_daily(self.daily, self.cfg)

    @cached_property
    def account_daily(self) -> DataFrame:
        return self.account_daily_since(None)

    def account_daily_since(self, since: date | None) -> DataFrame:
        return account_plans.account_metrics_daily(self.daily, self.sessions, self.dim_accounts, self.cfg, since)

    @cached_property
    def feature_monthly(self) -> DataFrame:
        return features.feature_usage_monthly(self.daily, self.cfg)

    @cached_property
    def user_latest(self) -> DataFrame:
        return users.user_metrics_latest(
            self.daily, self.sessions, self.dim_users, self.dim_accounts, self.cfg, self.share
        )


RAW_TABLE = "int_raw_activity"

# Relation -> output table and the partition column readers filter by. The
# relations of one step need only earlier steps, so their jobs run side by
# side and small ones fill the gaps of large ones.
STEPS = (
    {"identity_map": ("stg_identity_resolution", None), "account_map": ("stg_user_account_mapping", None)},
    {"daily": ("int_daily_activity", "activity_date"), "sessions": ("fct_sessions", sinks.SESSION_DATE)},
    {
        "dim_accounts": ("dim_accounts", None),
        "dim_users": ("dim_users", None),
        "product_daily": ("fct_product_metrics_daily", None),
        "feature_monthly": ("fct_account_feature_usage_monthly", "metric_month"),
    },
    {
        "account_daily": ("fct_account_metrics_daily", "metric_date"),
        "user_latest": ("fct_user_metrics_daily", None),
    },
)


def build(inputs: Inputs, cfg: Config, out_dir: str) -> dict[str, DataFrame]:
    """Write every relation under ``out_dir``; returns them by table name.

    Raw tracks and pages are read once, for the un-stitched roll-up; each
    relation is written once and read back by the ones built on it. All are
    registered as views, the staged events included.
    """
    configure(inputs.tracks.sparkSession)
    raw = write_raw(activity.raw_rollup(inputs.tracks, inputs.pages, cfg), out_dir)
    return build_from_raw(inputs, cfg, out_dir, raw)


def write_raw(rollup: DataFrame, out_dir: str) -> DataFrame:
    """Write the un-stitched roll-up of the first batch."""
    target = f"{out_dir.rstrip('/')}/{RAW_TABLE}"
    return sinks.write_table(rollup.withColumn("batch", F.lit("first")), target, ["activity_date", "batch"]).select(*rollup.columns)


def build_from_raw(inputs: Inputs, cfg: Config, out_dir: str, raw: DataFrame) -> dict[str, DataFrame]:
    """As ``build``, from the written un-stitched roll-up."""

    def share(df: DataFrame, name: str) -> DataFrame:
        # The other shared relations are among the tables.
        return materialize(df, name) if name in ("lookup", "user_days") else df

    relations = Relations(inputs, cfg, share, raw)
    written: dict[str, DataFrame] = {}

    def write(attribute: str, table: str, partition: str | None) -> DataFrame | None:
        df = getattr(relations, attribute)
        if df is None:
            return None
        target = f"{out_dir.rstrip('/')}/{table}"
        if attribute == "sessions":
            stored = sinks.write_sessions(with_docs(df), target)
        else:
            stored = sinks.write_table(with_docs(df), target, [partition] if partition else [])
        return stored if attribute == "sessions" else stored.select(*df.columns)

    with ThreadPoolExecutor(max_workers=max(len(step) for step in STEPS)) as pool:
        for step in STEPS:
            # Used by both relations of the next step; built once, here.
            if "daily" in step:
                relations.lookup  # noqa: B018
            pending = {a: pool.submit(write, a, *target) for a, target in step.items()}
            for attribute, (table, _) in step.items():
                stored = pending[attribute].result()
                if stored is not None:
                    setattr(relations, attribute, stored)
                    if attribute == "sessions":
                        # Readers in the build prune by the start day.
                        stored = stored.select(*SESSION_COLUMNS)
                    written[table] = sinks.register(stored, table)
    written["stg_segment_tracks"] = sinks.register(relations.tracks, "stg_segment_tracks")
    if inputs.pages is not None:
        written["stg_segment_pages"] = sinks.register(relations.pages, "stg_segment_pages")
    return written

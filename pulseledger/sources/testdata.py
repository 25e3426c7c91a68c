"""Raw relations derived from the star-schema test tables.

The test tables have no accounts, anonymous ids or null users; FIXTURES.md §3
derives them from ``events`` by arithmetic on the ids. ``stretch`` multiplies
every event's distance from the first day, so that a month of events becomes
several (monthly comparisons need more than one month).
"""

from __future__ import annotations

from datetime import datetime
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from ..functions import instant

DAY_ZERO = datetime(2024, 1, 1)

_ANONYMOUS = "(event_type = 'view' AND event_id % 3 = 0)"
_TS = "CAST(ts AS TIMESTAMP)"


def _day(day: int, hour: int = 0) -> str:
    return f"(unix_micros({_TS}) >= unix_micros({instant(DAY_ZERO)}) + {(day * 24 + hour) * 3_600_000_000}L)"


# Times are moved, no event is dropped. Churned users: everything within the
# first 11 days. Dormant accounts: within the first 19. Returning users: nothing in
# the days before the last morning of January.
_MOVED_DAYS = f"""CASE WHEN user_id % 7 = 3 THEN 11 * CAST(floor(datediff({_TS}, {instant(DAY_ZERO)}) / 11) AS INT)
    WHEN user_id % 20 IN (13, 14) THEN 19 * CAST(floor(datediff({_TS}, {instant(DAY_ZERO)}) / 19) AS INT)
    WHEN user_id % 20 = 7 AND {_day(23)} AND NOT {_day(28, 8)} THEN 11 ELSE 0 END"""


def _time(stretch: int, shift_minutes: str = "0") -> str:
    origin = f"unix_micros({instant(DAY_ZERO)})"
    since = f"(unix_micros({_TS}) - {origin} - ({_MOVED_DAYS}) * 86400000000L + ({shift_minutes}) * 60000000L)"
    return f"timestamp_micros({origin} + {since} * {stretch})"


def derive_tracks(events: DataFrame, stretch: int = 1, prefix: str = "t", shift_minutes: str = "0") -> DataFrame:
    """Tracks from event rows; works on a stream as well."""
    return events.selectExpr(
        f"concat('{prefix}', event_id) AS id",
        f"IF({_ANONYMOUS}, NULL, concat('u', user_id)) AS user_id",
        "IF(event_type = 'view' AND event_id % 30 = 0, concat('anon_x', event_id),"
        " concat('anon_', CAST(floor(user_id / 2) AS BIGINT))) AS anonymous_id",
        "CASE WHEN event_type = 'view' AND event_id % 60 = 0 THEN concat('acct_', user_id % 20)"
        f" WHEN {_ANONYMOUS} OR event_id % 5 = 0 THEN NULL"
        " WHEN event_id % 50 = 1 THEN concat('acct_', (user_id + 1) % 20)"
        " ELSE concat('acct_', user_id % 20) END AS context_group_id",
        f"IF(event_type = 'click' AND event_id % 10 = 7 AND {_day(26)}, 'share', event_type) AS event",
        f"{_time(stretch, shift_minutes)} AS timestamp",
        "event_id AS event_number",
    )


class TestTables:
    """Raw relations over one folder of test tables, built on first use."""

    __test__ = False

    def __init__(self, spark: SparkSession, sf_dir: str, stretch: int = 1):
        self.spark = spark
        self.sf_dir = sf_dir
        self.stretch = stretch

    def _table(self, table: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{table}.parquet")

    @cached_property
    def _events(self) -> DataFrame:
        return self._table("events")

    @cached_property
    def tracks(self) -> DataFrame:
        return derive_tracks(self._events, self.stretch).drop("event_number")

    @cached_property
    def pages(self) -> DataFrame:
        urls = self._table("pages").selectExpr("page_id", "url")
        # Every second page view is 40 minutes later than its track.
        views = derive_tracks(self._events, self.stretch, "p", "IF(event_id % 2 = 0, 40, 0)").filter("event = 'view'")
        numbered = views.withColumn("page_id", views["event_number"] % urls.selectExpr("count(*)").scalar())
        return numbered.join(urls, "page_id", "left").selectExpr(
            "id", "user_id", "anonymous_id", "context_group_id", "event AS name", "timestamp", "url AS properties_url"
        )

    @cached_property
    def identifies(self) -> DataFrame:
        signups = derive_tracks(self._events, self.stretch, prefix="i").filter("event = 'signup' AND user_id IS NOT NULL")
        return signups.select("id", "user_id", "anonymous_id", "timestamp")

    @cached_property
    def users(self) -> DataFrame:
        """Optional enrichment: customers as user profiles."""
        return self._table("customer").selectExpr(
            "concat('profile_', c_custkey) AS id", "concat('u', c_custkey) AS user_id", "c_name AS email"
        )

    @cached_property
    def groups(self) -> DataFrame:
        """Optional enrichment: nations as account profiles."""
        return self._table("nation").selectExpr(
            "concat('group_', n_nationkey) AS id", "concat('acct_', n_nationkey) AS group_id", "n_name AS name"
        )

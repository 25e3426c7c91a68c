"""Run settings: every knob the relations depend on, plus an explicit clock."""

from __future__ import annotations

import dataclasses
from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import date, datetime, timedelta, timezone

LITERAL = "literal"
DOCUMENTED = "documented"


@dataclass(frozen=True)
class Config:
    """Settings of one run.

    ``as_of`` replaces the wall clock: look-backs, ages, the end of the date
    spine and "yesterday" all derive from it, so a run can be repeated.
    ``semantics`` chooses between what the metric SQL computes ("literal")
    and what its column documentation promises ("documented") where the two
    differ; see README.
    """

    as_of: datetime

    session_timeout_minutes: int = 30
    include_pages_in_sessions: bool = False

    enable_identity_stitching: bool = False
    anonymous_id_field: str = "anonymous_id"
    group_id_field: str = "context_group_id"
    event_time_fields: tuple[str, ...] = ("timestamp",)
    page_title_field: str = "properties_title"
    page_path_field: str = "properties_path"
    page_url_field: str = "properties_url"
    page_referrer_field: str = "properties_referrer"
    page_search_field: str = "properties_search"

    identity_lookback_days: int = 365
    tracks_lookback_days: int = 365
    pages_lookback_days: int = 365

    min_monthly_feature_events: int = 0
    spine_start: date = date(2023, 1, 1)
    semantics: str = LITERAL

    source_database: str | None = None
    source_schema: str | None = None
    # source name -> table name, or a path ("/x/tracks.parquet", "s3a://..")
    sources: Mapping[str, str] = field(default_factory=dict)

    def __post_init__(self) -> None:
        if self.semantics not in (LITERAL, DOCUMENTED):
            raise ValueError(f"semantics must be '{LITERAL}' or '{DOCUMENTED}', not {self.semantics!r}")
        if self.session_timeout_minutes < 0:
            raise ValueError("session_timeout_minutes must not be negative")
        for name in ("identity_lookback_days", "tracks_lookback_days", "pages_lookback_days"):
            if getattr(self, name) < 0:
                raise ValueError(f"{name} must not be negative")

    @property
    def as_of_utc(self) -> datetime:
        """``as_of`` as an aware instant; naive values are taken as UTC."""
        if self.as_of.tzinfo is None:
            return self.as_of.replace(tzinfo=timezone.utc)
        return self.as_of.astimezone(timezone.utc)

    @property
    def today(self) -> date:
        return self.as_of_utc.date()

    @property
    def last_day(self) -> date:
        """Last day of the date spine: its end is exclusive, so yesterday."""
        return self.today - timedelta(days=1)

    @property
    def documented(self) -> bool:
        return self.semantics == DOCUMENTED

    def replace(self, **changes) -> Config:
        return dataclasses.replace(self, **changes)

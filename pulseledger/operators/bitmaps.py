"""Activity bitmaps: trailing distinct counts from one stored mask per entity.

A mask holds the last MASK_DAYS days of an entity, bit k for the day k days
before the mask's day. A new day shifts every mask and adds its bits; events that
come late set the bit of their day. Membership of any trailing window up to
MASK_DAYS is a bit test, so a day costs one pass over the masks and its own rows,
whatever the windows. The masks of parts of the data combine by OR.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import DataFrame

from ..functions import aggregate, day_literal

MASK_DAYS = 60
_ALL = (1 << MASK_DAYS) - 1


def activity_masks(days: DataFrame, keys: Sequence[str], day: str, as_of: date) -> DataFrame:
    """(keys, mask) on ``as_of`` of rows (keys, day); days out of reach are left out.

    The last of ``keys`` is the entity. Several rows a day count once.
    """
    age = f"datediff({day_literal(as_of)}, {day})"
    reached = days.filter(f"{age} BETWEEN 0 AND {MASK_DAYS - 1}")
    return aggregate(reached, keys, f"bit_or(shiftleft(1L, {age})) AS mask")


def advance_masks(masks: DataFrame, days: DataFrame, keys: Sequence[str], day: str, before: date, as_of: date) -> DataFrame:
    """Masks on ``as_of`` from those on ``before`` and rows that have come since,
    late ones included. Entities without a day in reach are dropped."""
    elapsed = (as_of - before).days
    if elapsed < 0:
        raise ValueError("masks cannot go back in time")
    moved = f"shiftleft(mask, {elapsed}) & {_ALL}L" if elapsed < MASK_DAYS else "0L"
    shifted = masks.selectExpr(*keys, f"{moved} AS mask")
    both = shifted.unionByName(activity_masks(days, keys, day, as_of))
    return aggregate(both, keys, "bit_or(mask) AS mask").filter("mask <> 0")


def masked_actives(masks: DataFrame, keys: Sequence[str], windows: Mapping[str, int]) -> DataFrame:
    """Per ``keys`` the number of entities active in each trailing window."""
    too_long = [n for n, days in windows.items() if days > MASK_DAYS]
    if too_long:
        raise ValueError(f"masks hold {MASK_DAYS} days, too few for {too_long}")
    return aggregate(masks, keys, *[f"count_if(mask & {(1 << days) - 1}L <> 0) AS {n}" for n, days in windows.items()])

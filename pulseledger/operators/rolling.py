"""Trailing distinct counts and other day-grain building blocks.

Counting distinct entities in a sliding window by joining a calendar to the
events costs one copy of each row per window day. Here each entity adds +1
where it becomes counted and -1 where it stops; a running sum of these steps
is the exact count. There are at most two steps per entity, window length and
uninterrupted stretch of activity.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import DataFrame

from ..functions import day_literal, each_day, round_half_up, union_all


def _over(keys: Sequence[str], order: str) -> str:
    partition = f"PARTITION BY {', '.join(keys)} " if keys else ""
    return f"{partition}ORDER BY {order}"


def coverage_steps(days: DataFrame, keys: Sequence[str], entity: str, day: str, windows: Mapping[str, int], last_day: date) -> DataFrame:
    """Steps (keys, day, one column per window) of distinct ``entity`` counts.

    ``days`` has one row per (keys, entity, day). ``windows`` names each
    trailing length in days: an entity active on day d counts on
    [d, d + length). Steps after ``last_day`` are left out.
    """
    timeline = _over([*keys, entity], day)
    neighbours = days.selectExpr(
        *keys, day, f"lag({day}) OVER ({timeline}) AS before", f"lead({day}) OVER ({timeline}) AS after"
    )

    def step(at: str, values: Mapping[str, str]) -> str:
        fields = ", ".join(f"'{n}', {values.get(n, '0L')}" for n in windows)
        return f"named_struct('{day}', {at}, {fields})"

    enters = {n: f"IF(before IS NULL OR date_add(before, {days}) <= {day}, 1L, 0L)" for n, days in windows.items()}
    leaves = [
        step(f"date_add({day}, {days})", {n: f"IF(after IS NULL OR after >= date_add({day}, {days}), -1L, 0L)"})
        for n, days in windows.items()
    ]
    steps = f"array({', '.join([step(day, enters), *leaves])})"
    exploded = neighbours.selectExpr(*keys, f"inline({steps})")
    changes = " OR ".join(f"{n} <> 0" for n in windows)
    return exploded.filter(f"({changes}) AND {day} <= {day_literal(last_day)}")


def union_measures(parts: Sequence[DataFrame], keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Union of frames that each have the keys and some of the measures."""
    padded = []
    for part in parts:
        present = set(part.columns)
        padded.append(part.selectExpr(*keys, *[m if m in present else f"0L AS {m}" for m in measures]))
    return union_all(padded)


def fill_days(df: DataFrame, keys: Sequence[str], day: str, measures: Sequence[str], last_day: date) -> DataFrame:
    """One row per day from each key's first row through ``last_day``.

    Added days have measures of 0. Input: at most one row per (keys, day).
    Uses the same partitioning as later windows over the keys.
    """
    until = f"coalesce(date_sub(lead({day}) OVER ({_over(keys, day)}), 1), {day_literal(last_day)})"
    spans = df.selectExpr(*keys, *measures, f"{day} AS own_day", f"{until} AS until_day")
    days = spans.selectExpr(*keys, *measures, "own_day", f"{each_day('own_day', 'until_day')} AS {day}")
    return days.selectExpr(*keys, day, *[f"IF({day} = own_day, {m}, 0L) AS {m}" for m in measures])


def trailing(order: str, days: int) -> str:
    """Window of the current row and the ``days`` - 1 rows before it."""
    return f"({order} ROWS BETWEEN {days - 1} PRECEDING AND CURRENT ROW)"


def trend_columns(names: Sequence[str], order: str, spans: Sequence[int]) -> list[str]:
    """Change per row against 7, 14, .. rows earlier, two decimals."""
    return [
        f"{round_half_up(f'({n} - lag({n}, {k}) OVER ({order})) / {k}D', 2)} AS {n}_trend_{k}d" for n in names for k in spans
    ]

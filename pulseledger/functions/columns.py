"""SQL expression helpers: time arithmetic, guarded ratios, keys, calendars.

Each returns expression text for ``selectExpr``, ``expr`` or ``filter``; the
arguments are column names or expressions. Only built-in functions are used,
so everything stays inside code generation.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession

# Fixed value: stands for a null part in the session key.
KEY_NULL_TOKEN = "_dbt_utils_surrogate_key_null_"


def instant(moment: datetime) -> str:
    """A timestamp constant; naive values are UTC."""
    if moment.tzinfo is None:
        moment = moment.replace(tzinfo=timezone.utc)
    epoch = datetime(1970, 1, 1, tzinfo=timezone.utc)
    return f"timestamp_micros({(moment - epoch) // timedelta(microseconds=1)}L)"


def day_literal(day: date) -> str:
    return f"DATE'{day.isoformat()}'"


def text_literal(value: str) -> str:
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def name(column: str) -> str:
    """A column name, quoted."""
    return "`" + column.replace("`", "``") + "`"


def minute_start(ts: str) -> str:
    """Start of the clock minute, in epoch seconds (long)."""
    return f"(unix_seconds({ts}) - pmod(unix_seconds({ts}), 60))"


def minute_diff(earlier: str, later: str) -> str:
    """Minute boundaries crossed: 10:00:59 to 10:31:00 counts 31."""
    return f"(({minute_start(later)} - {minute_start(earlier)}) div 60)"


def second_diff(earlier: str, later: str) -> str:
    """Second boundaries crossed."""
    return f"(unix_seconds({later}) - unix_seconds({earlier}))"


def calendar_days_between(earlier: str, later: str) -> str:
    return f"CAST(datediff(to_date({later}), to_date({earlier})) AS BIGINT)"


def month_of(day: str) -> str:
    return f"trunc({day}, 'month')"


def round_half_up(value: str, digits: int) -> str:
    """Decimal rounding, so that 4.405 held as 4.40499999 rounds like 4.405."""
    return f"CAST(round(CAST({value} AS DECIMAL(38,10)), {digits}) AS DOUBLE)"


def safe_ratio(numerator: str, denominator: str, digits: int | None = None) -> str:
    """Fractional division, null where the denominator is 0 or null."""
    ratio = f"(CAST({numerator} AS DOUBLE) / nullif(CAST({denominator} AS DOUBLE), 0D))"
    return ratio if digits is None else round_half_up(ratio, digits)


def flag(condition: str) -> str:
    """1 where the condition holds, else 0."""
    return f"IF({condition}, 1, 0)"


def surrogate_key(*parts: str) -> str:
    """md5 over the parts joined by '-', nulls replaced by a fixed token."""
    filled = ", ".join(f"coalesce(CAST({p} AS STRING), '{KEY_NULL_TOKEN}')" for p in parts)
    return f"md5(concat_ws('-', {filled}))"


def optional_col(df: DataFrame, column: str, dtype: str = "STRING") -> str:
    """The column cast to ``dtype``, or a typed null where ``df`` lacks it."""
    for present in df.columns:
        if present.lower() == column.lower():
            return f"CAST({name(present)} AS {dtype})"
    return f"CAST(NULL AS {dtype})"


def each_day(first: str, last: str) -> str:
    """Generator: one row per day, both ends included; none if reversed."""
    return f"explode(IF({first} <= {last}, sequence({first}, {last}), NULL))"


def date_spine(spark: SparkSession, start: date, end_exclusive: date) -> DataFrame:
    """Calendar: ``start`` inclusive, ``end_exclusive`` exclusive."""
    last = day_literal(end_exclusive - timedelta(days=1))
    return spark.range(1).selectExpr(f"{each_day(day_literal(start), last)} AS date_day")

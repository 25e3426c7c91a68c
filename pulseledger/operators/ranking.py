"""Row numbers inside groups of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import aggregate

# Hex digits of the tie digest that split a group: 256 parts.
_PREFIX_DIGITS = 2


def rank_descending(df: DataFrame, group: str, value: str, tie: str, out: str) -> DataFrame:
    """Add ``out``: 1, 2, .. per ``group`` by ``value`` descending.

    Equal values are ordered by md5 of ``tie``, then ``tie``. The digest is
    uniform, so a group holding a large share of the rows (one account with
    most users, most of them with the same value) is numbered in parts: each
    part counts its own rows and starts after the rows of the parts before
    it. The only window over a whole group sees one row per distinct value
    and digest prefix.
    """
    rows = df.selectExpr("*", f"md5({tie}) AS _digest", f"left(md5({tie}), {_PREFIX_DIGITS}) AS _part")
    keys = [group, value, "_part"]
    sizes = aggregate(rows, keys, "count(*) AS _size")
    before = f"PARTITION BY {group} ORDER BY {value} DESC, _part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    starts = sizes.selectExpr(
        f"{group} AS _group", f"{value} AS _value", "_part AS _of_part", f"coalesce(sum(_size) OVER ({before}), 0L) AS _start"
    )
    within = f"row_number() OVER (PARTITION BY {', '.join(keys)} ORDER BY _digest, {tie}) AS _position"
    numbered = rows.selectExpr("*", within)
    ranked = numbered.join(starts, F.expr(f"{group} <=> _group AND {value} <=> _value AND _part = _of_part"), "left")
    return ranked.selectExpr(*df.columns, f"_start + _position AS {out}")

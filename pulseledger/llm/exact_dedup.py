"""Exact de-duplication by two-pass Bloom filtering, built-in functions only.

Pass 1 counts rows per bit position of a Bloom filter and keeps, as bitmaps,
the positions that two rows or more have set. Pass 2 tests every row against
these bitmaps: a row with an unset position is certainly unique and passes
straight through; only possibly repeated rows shuffle, to be grouped exactly.

Defined cases: texts are equal if identical after lower-casing A-Z; null counts
as empty, and all empty texts are one group. The largest id of a group stays; a
null id is smaller than any other. Of rows that also share the id, one stays.
Other columns are carried along untouched, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, UPPER, materialize, shuffled

BITS_PER_ROW = 16
# Bitmaps of at most this size are broadcast; their size is known beforehand.
BROADCAST_BYTES = 64 << 20
_BITMAP_BITS = 8 * 4096  # of one bitmap_construct_agg value


def normalized(text: str) -> str:
    """SQL for the text that equality is judged on."""
    return f"translate(coalesce(`{text}`, ''), '{UPPER}', '{LOWER}')"


def filter_bits(n_rows: int) -> int:
    """Size of the filter: a power of two, 16 bits a row at least."""
    return max(_BITMAP_BITS, 1 << (BITS_PER_ROW * max(n_rows, 1) - 1).bit_length())


def _positions(digest: str, bits: int) -> list[str]:
    return [f"pmod(xxhash64({digest}, {k}), {bits}L) + 1" for k in (1, 2)]


def repeated_bitmaps(digests: DataFrame, bits: int) -> DataFrame:
    """Pass 1: (bucket, bitmap) of the positions set at least twice.

    Counts combine on the map side, so a frequent text leaves each task once.
    """
    positions = digests.selectExpr(f"explode(array({', '.join(_positions('digest', bits))})) AS position")
    repeated = positions.groupBy("position").count().filter("count > 1")
    return repeated.groupBy(F.expr("bitmap_bucket_number(position) AS bucket")).agg(
        F.expr("bitmap_construct_agg(bitmap_bit_position(position)) AS bitmap")
    )


def mark_repeated(rows: DataFrame, bitmaps: DataFrame, bits: int, digest: str, flag: str) -> DataFrame:
    """Pass 2: add ``flag``, true where both positions of the digest are set."""
    small = bits // 8 <= BROADCAST_BYTES
    out = rows
    tests = []
    for k, position in enumerate(_positions(digest, bits)):
        bucket, bitmap = f"{flag}_bucket{k}", f"{flag}_bitmap{k}"
        side = bitmaps.toDF(bucket, bitmap)
        out = out.withColumn(f"{flag}_at{k}", F.expr(position))
        joined = out.withColumn(f"{flag}_key{k}", F.expr(f"bitmap_bucket_number({flag}_at{k})"))
        out = joined.join(F.broadcast(side) if small else shuffled(side), F.col(f"{flag}_key{k}") == F.col(bucket), "left")
        bit = f"bitmap_bit_position({flag}_at{k})"
        byte = f"CAST(conv(hex(substring({bitmap}, CAST({bit} DIV 8 AS INT) + 1, 1)), 16, 10) AS INT)"
        tests.append(f"coalesce(getbit({byte}, CAST({bit} % 8 AS INT)), 0) = 1")
    return out.withColumn(flag, F.expr(" AND ".join(tests))).select(*[F.col(f"`{c}`") for c in rows.columns], flag)


def _digests(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.selectExpr(
        f"`{id_col}` AS id", f"unhex(sha2({normalized(text_col)}, 256)) AS digest", "monotonically_increasing_id() AS row_no"
    )


def duplicate_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256."""
    digests = materialize(_digests(docs, id_col, text_col), "digests")
    bits = filter_bits(digests.count())
    bitmaps = materialize(repeated_bitmaps(digests, bits), "bitmaps")
    marked = mark_repeated(digests, bitmaps, bits, "digest", "maybe")
    unique = marked.filter("NOT maybe").selectExpr(
        "id", "id AS keep_id", "1L AS group_size", "true AS kept", "lower(hex(digest)) AS text_sha256"
    )
    possible = materialize(marked.filter("maybe").drop("maybe"), "possible")
    # One row per distinct text leaves each task. The table is written so that
    # the join below shuffles both sides itself and a hot text can be split.
    groups = possible.groupBy("digest").agg(
        F.expr("max(struct(id, row_no)) AS keep"), F.expr("count(*) AS group_size")
    )
    groups = materialize(groups.withColumnRenamed("digest", "group_digest"), "groups")
    grouped = possible.join(groups, F.col("digest") == F.col("group_digest")).selectExpr(
        "id", "keep.id AS keep_id", "group_size", "row_no = keep.row_no AS kept", "lower(hex(digest)) AS text_sha256"
    )
    return unique.unionByName(grouped)


def drop_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, with all their columns.

    Unique rows never shuffle; of the others each task sends on one row per
    distinct text.
    """
    names = docs.columns
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    id_, text = (f"c{names.index(c)}" for c in (id_col, text_col))
    rows = plain.withColumn("digest", F.expr(f"unhex(sha2({normalized(text)}, 256))"))
    digests = materialize(rows.select("digest"), "digests")
    bits = filter_bits(digests.count())
    bitmaps = materialize(repeated_bitmaps(digests, bits), "bitmaps")
    marked = mark_repeated(rows, bitmaps, bits, "digest", "maybe")
    unique = marked.filter("NOT maybe").select(*plain.columns)
    every = ", ".join(plain.columns)
    best = marked.filter("maybe").groupBy("digest").agg(
        F.expr(f"max_by(struct({every}), struct({id_}, xxhash64({every}))) AS kept")
    )
    return unique.unionByName(best.select("kept.*")).toDF(*names)

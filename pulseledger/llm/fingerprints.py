"""Document fingerprints: a homomorphic multiset hash of paragraphs.

The fingerprint is a wide vector of 32-bit lanes. Each paragraph (line) is hashed
to such a vector and the vectors of a document are added modulo 2**32. Sums do
not depend on order, and a paragraph is inserted or deleted by adding or
subtracting its vector, without the rest of the text.

A paragraph's vector has two parts. DIGEST_LANES lanes are pseudo-random from a
digest of the whole paragraph: documents with the same paragraphs, in any order,
have equal sums, others practically never. SKETCH_LANES lanes count the
paragraph's 16-byte windows, each added as +1 or -1 to one lane; the squared
length of a difference of two sketches estimates how many windows two documents
don't share, which gives the likeness 1 - |a - b|**2 / (|a|**2 + |b|**2).

Defined cases: a null text is empty, and an empty text has one empty paragraph.
A paragraph below 16 bytes is one window. A sum of 2**32 equal paragraphs
wraps around, and so does the likeness from 2**31 equal windows on. The likeness of equal fingerprints is 1.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_texts, map_batches, mix64

DIGEST_LANES = 64
SKETCH_LANES = 256
LANES = DIGEST_LANES + SKETCH_LANES
_WINDOW = 16
# Rows a bucket of neighbouring ids should hold, see with_next().
BUCKET_ROWS = 500
MAX_BUCKETS = 20_000


def _paragraph_digest(paragraph: bytes) -> np.ndarray:
    return np.frombuffer(hashlib.shake_128(paragraph).digest(4 * DIGEST_LANES), "<u4")


def _sketch(text: bytes) -> np.ndarray:
    """Signed counts of the windows that lie within one paragraph."""
    n = len(text)
    out = np.zeros(SKETCH_LANES, np.int64)
    feeds = np.flatnonzero(np.frombuffer(text, np.uint8) == 10)
    starts, ends = np.append(0, feeds + 1), np.append(feeds, n)
    parts = []
    if n >= _WINDOW:
        words = np.empty(n - 7, np.uint64)  # the 8 bytes at each offset
        for k in range(8):
            view = np.frombuffer(text, "<u8", count=(n - k) // 8, offset=k)
            words[k::8] = view
        count = n - _WINDOW + 1
        hashed = mix64(words[:count] * np.uint64(0x9E3779B97F4A7C15) ^ words[8 : 8 + count])
        crossing = np.zeros(n + 1, np.int32)  # windows that contain a line feed
        np.add.at(crossing, np.maximum(feeds - _WINDOW + 1, 0), 1)
        np.add.at(crossing, feeds + 1, -1)
        parts.append(hashed[np.cumsum(crossing)[:count] == 0])
    short = [text[s:e] for s, e in zip(starts, ends, strict=True) if e - s < _WINDOW]
    if short:
        parts.append(np.array([int.from_bytes(hashlib.blake2b(p, digest_size=8).digest(), "little") for p in short], np.uint64))
    for hashed in parts:
        lane = (hashed >> np.uint64(56)).astype(np.int64)
        positive = (hashed >> np.uint64(32)) & np.uint64(1) == 1
        out += np.bincount(lane[positive], minlength=SKETCH_LANES) - np.bincount(lane[~positive], minlength=SKETCH_LANES)
    return out


def vector(text: bytes) -> np.ndarray:
    """Sum of the vectors of the paragraphs of a text."""
    digest = np.zeros(DIGEST_LANES, np.uint32)
    for paragraph in text.split(b"\n"):
        digest += _paragraph_digest(paragraph)
    return np.concatenate([digest, _sketch(text).astype(np.uint32)])


def insert(state: np.ndarray, paragraphs: bytes) -> np.ndarray:
    """The sum after paragraphs (separated by line feeds) were added."""
    return state + vector(paragraphs)


def delete(state: np.ndarray, paragraphs: bytes) -> np.ndarray:
    """The sum after paragraphs were taken out."""
    return state - vector(paragraphs)


def to_text(state: np.ndarray) -> str:
    return state.astype("<u4").tobytes().hex()


def from_text(fingerprint: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(fingerprint), "<u4").copy()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """0 (nothing in common) to 1 (equal)."""
    if np.array_equal(a, b):
        return 1.0
    x, y = (v[DIGEST_LANES:].view(np.int32).astype(np.float64) for v in (a, b))
    both = float(x @ x + y @ y)
    return float(np.clip(1.0 - ((x - y) @ (x - y)) / both, 0.0, 1.0)) if both else 0.0


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fingerprint) of every row."""
    def run(batch: pa.RecordBatch) -> dict:
        return {"id": batch.column(0), "fingerprint": [to_text(vector(t)) for t in byte_texts(batch.column(1))]}

    return map_batches(docs.selectExpr(f"CAST(`{id_col}` AS BIGINT) AS id", f"`{text_col}` AS text"), run, "id long, fingerprint string")


def half_replaced(text: str, donor: str) -> str:
    """The last half of the characters replaced by the donor's first ones."""
    half = len(text) // 2
    return text[: len(text) - half] + donor[:half]


def edited_vector(text: str, edited: str, state: np.ndarray) -> np.ndarray:
    """The fingerprint of the edited text, from that of the text: shared leading
    paragraphs stay, the others are deleted and the new ones inserted."""
    if text == edited:
        return state
    same = min(len(text), len(edited)) - len(text) // 2
    kept = text.rfind("\n", 0, max(same, 0)) + 1
    return insert(delete(state, text[kept:].encode()), edited[kept:].encode())


def _with_buckets(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, int]:
    """(id, text, bucket, borrowed): buckets of neighbouring ids, each with the
    first document of the next one as a borrowed last row.

    The driver sees the bucket bounds only. Bounds are distinct ids, so equal
    ids share a bucket; null ids come last, in a bucket of their own.
    """
    rows = docs.selectExpr(f"CAST(`{id_col}` AS BIGINT) AS id", f"coalesce(`{text_col}`, '') AS text")
    ids = rows.filter("id IS NOT NULL").select("id")
    n = ids.count()
    wanted = max(1, min(MAX_BUCKETS, n // BUCKET_ROWS))
    steps = [k / wanted for k in range(1, wanted)]
    bounds = sorted({int(b) for b in ids.approxQuantile("id", steps, 0.1 / wanted)}, reverse=True) if steps else []
    # Bucket k holds the ids from bounds[k] up to the bound before it.
    n_buckets = len(bounds) + 1
    number = F.expr(f"{len(bounds)} - ({_below('id', bounds[::-1])})")

    def place(df: DataFrame) -> DataFrame:
        return df.withColumn("bucket", F.when(F.col("id").isNull(), F.lit(n_buckets)).otherwise(number).cast("int"))

    placed = place(rows)
    firsts = place(rows.select("id")).groupBy("bucket").agg(F.max("id").alias("id"))
    present = {r[0]: r[1] for r in firsts.collect()}
    order = sorted(present)
    if not order:
        return placed.withColumn("borrowed", F.lit(False)), 1
    lends = [(present[order[(k + 1) % len(order)]], order[k]) for k in range(len(order))]
    spark = docs.sparkSession
    lenders = spark.createDataFrame(lends, "lend_id long, borrower int")
    # Of rows with the same id the first in order is lent; ties are cut below.
    lent = rows.join(F.broadcast(lenders), F.expr("id <=> lend_id")).groupBy("borrower").agg(
        F.expr("max_by(struct(id, text), struct(xxhash64(text), text)) AS row")
    )
    lent = lent.selectExpr("row.id AS id", "row.text AS text", "borrower AS bucket", "true AS borrowed")
    return placed.withColumn("borrowed", F.lit(False)).unionByName(lent), len(order)


def _below(column: str, bounds: list[int]) -> str:
    """SQL for the number of bounds at or below a value, as a balanced tree."""
    if len(bounds) == 1:
        return f"IF({column} >= {bounds[0]}L, 1, 0)"
    if not bounds:
        return "0"
    middle = len(bounds) // 2
    return f"IF({column} >= {bounds[middle]}L, {middle + 1} + ({_below(column, bounds[middle + 1:])}), {_below(column, bounds[:middle])})"


def edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text, see half_replaced;
    the donor is the next document by descending id (after the last: the first).

    Rows with equal ids follow each other by the hash of their text.
    """
    rows, n_buckets = _with_buckets(docs, id_col, text_col)
    n_tasks = max(n_buckets // 4, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ordered = rows.repartition(n_tasks, "bucket").sortWithinPartitions(
        "bucket", "borrowed", F.col("id").desc_nulls_last(), F.expr("xxhash64(text)").desc(), F.col("text").desc()
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None  # bucket, id, text, vector
        for batch in batches:
            out: dict[str, list] = {f.name: [] for f in _EDITS}
            for bucket, id_, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                state = vector(text.encode())
                if before is not None and before[0] == bucket:
                    _, own_id, own, own_state = before
                    edited = half_replaced(own, text)
                    edited_state = edited_vector(own, edited, own_state)
                    row = (
                        own_id, len(own), hashlib.sha256(edited.encode()).hexdigest(), to_text(own_state),
                        to_text(edited_state), likeness(own_state, edited_state), likeness(own_state, state),
                    )
                    for name, value in zip(out, row, strict=True):
                        out[name].append(value)
                before = (bucket, id_, text, state)
            yield pa.RecordBatch.from_pydict(out, schema=_EDITS)

    return ordered.select("bucket", "id", "text").mapInArrow(
        run,
        "id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string,"
        " near_edited double, near_next double",
    )


_EDITS = pa.schema(
    [("id", pa.int64()), ("n_chars", pa.int64())]
    + [(n, pa.string()) for n in ("edited_sha256", "fingerprint", "edited_fingerprint")]
    + [(n, pa.float64()) for n in ("near_edited", "near_next")]
)

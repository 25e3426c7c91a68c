"""Session settings, batch helpers and text hashing shared by the operators.

Text rules used throughout: a null text is the empty text; white space is
``[\\x20\\x09-\\x0D]``, what ``bytes.split`` splits at; only A-Z are lower-cased.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ..session import discard, materialize, scratch_path  # noqa: F401  (re-exported)

SPACES = "\x20\t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Rows and bytes of an Arrow batch: a Python worker holds a batch several times over.
BATCH_ROWS = 1000
BATCH_BYTES = "8m"
# Intermediates are written tables, so a finished query's shuffle files have no more readers.
CLEAN_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_BASE = np.uint64(0x9E3779B97F4A7C55)
_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))
_SPACE = np.zeros(256, bool)
_SPACE[list(SPACES.encode())] = True
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def prepare(spark: SparkSession) -> SparkSession:
    """Runtime settings the operators rely on; cluster sizing is left alone."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    spark.conf.set(CLEAN_SHUFFLES, "true")
    return spark


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/documents.parquet")


def shuffled(side: DataFrame) -> DataFrame:
    """A side of a join that grows with the input, to be dealt by key and never broadcast.

    Spark would size it by its compressed files, and what an explode or a join makes by
    the rows before it: a table of a few MB can need more than the driver has.
    """
    return side.hint("merge")


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], dict | Iterator[dict]], schema: str) -> DataFrame:
    """Apply ``fn`` to every Arrow batch; it returns columns, or several lots of them."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            out = fn(batch)
            for columns in [out] if isinstance(out, dict) else out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[f.name], type=f.type, from_pandas=True) for f in arrow], schema=arrow
                )

    return df.mapInArrow(run, schema)


def byte_texts(column: pa.Array) -> list[bytes]:
    """The texts of a string column as UTF-8; null is empty."""
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def mix64(h: np.ndarray) -> np.ndarray:
    """Finalizer of the well-known splitmix64 generator."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _grown(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, 2 * len(_powers[0]), 1 << 14)
        for i, base in enumerate((_BASE, _INVERSE)):
            factors = np.full(size, base)
            factors[0] = 1
            _powers[i] = np.multiply.accumulate(factors)
    return _powers[0], _powers[1]


def word_bounds(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Start and end offsets of the words in a UTF-8 text."""
    inside = ~_SPACE[np.frombuffer(data, np.uint8)]
    edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    return edges[::2], edges[1::2]


def word_hashes(data: bytes, bounds: tuple[np.ndarray, np.ndarray] | None = None) -> np.ndarray:
    """A 64-bit hash of every word, in order: a polynomial in the word's bytes
    modulo 2**64, taken from running sums of the whole text."""
    return prefix_hashes(data, [None], bounds)[0]


def prefix_hashes(
    data: bytes, lengths: list[int | None], bounds: tuple[np.ndarray, np.ndarray] | None = None
) -> list[np.ndarray]:
    """For each length, hashes of the words cut to so many bytes (None: whole);
    ``bounds``: those of the words, if they are known."""
    starts, ends = bounds or word_bounds(data)
    if not len(starts):
        return [np.zeros(0, np.uint64) for _ in lengths]
    powers, inverses = _grown(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((np.frombuffer(data, np.uint8).astype(np.uint64) + np.uint64(1)) * powers[: len(data)], out=sums[1:])
    first, scale = sums[starts], inverses[starts]
    return [mix64((sums[ends if n is None else np.minimum(ends, starts + n)] - first) * scale) for n in lengths]


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """The distinct hashes of all runs of ``size`` words, sorted; with fewer
    words the whole sequence is one shingle, without words there is none."""
    if not len(words):
        return words
    size = min(size, len(words))
    n = len(words) - size + 1
    out = np.full(n, np.uint64(size))
    for k in range(size):
        out = mix64(out * np.uint64(0xD6E8FEB86659FD93) + words[k : k + n])
    return np.unique(out)

"""Exact removal of long repeated byte strings with suffix arrays over shards.

A string of MATCH bytes that occurs twice has, at both places, the same smallest
hash among its GRAM-byte substrings (its minimizer). Runs of neighbouring
MATCH-byte windows with the same minimizer form a piece, so that every window of
the corpus is in exactly one piece and equal windows are in pieces with the same
key. Pieces with a key of their own cannot repeat and are dropped.

What is left is sorted: equal pieces are merged (all their windows repeat), and
pieces that share a key but differ go to shards by key, where an external induced
sort (induced_sort.py) finds the windows that occur twice. A key that too many
different pieces share, such as the edge of a frequent passage, is first refined
by minimizers of another hash, which keeps shards bounded.

Defined cases: a null text is empty. Rows that are equal in id and text are
separate documents. Strings are judged on the input, so all copies go.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import _grown, byte_texts, map_batches, materialize, mix64
from .induced_sort import ExternalSorter
from .jaccard_join import _rows

MATCH = 200
GRAM = 32
# Longer texts are read in stretches of this size, which share no window.
MAX_TEXT = 1 << 23
_PLACE = (1 << 24) - 1
# Different pieces that may share a key in a shard, and bytes of a shard.
MAX_PIECES = 5_000
SHARD_BYTES = 2 << 20
MAX_ROUNDS = 16
# Documents whose pieces are read again by a broadcast of their places.
BROADCAST_PIECES = 1_000_000

_PIECE = "id long, text_hash long, start int, n int, key long, content long"


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest of each ``width`` consecutive values, from minima of blocks."""
    n = len(values)
    blocks = -(-n // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = values
    grid = padded.reshape(blocks, width)
    forward = np.minimum.accumulate(grid, axis=1).ravel()
    backward = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(backward[: n - width + 1], forward[width - 1 : n])


def pieces(text: bytes, seed: int = 0, match: int = MATCH, gram: int = GRAM):
    """Pieces of a text as arrays: start, number of windows, key, content hash."""
    n = len(text)
    if n < match:
        return tuple(np.zeros(0, kind) for kind in (np.int64, np.int64, np.uint64, np.uint64))
    if n > MAX_TEXT:
        step = MAX_TEXT - match + 1
        parts = [(at, pieces(text[at : at + MAX_TEXT], seed, match, gram)) for at in range(0, n - match + 1, step)]
        whole = [np.concatenate(columns) for columns in zip(*(p for _, p in parts), strict=True)]
        whole[0] = np.concatenate([p[0] + at for at, p in parts])
        return tuple(whole)
    return _cut(text, np.zeros(n - match + 1, np.int64), seed, match, gram)[1:]


def _cut(data: bytes, owner: np.ndarray, seed: int, match: int, gram: int):
    """Pieces of the windows of ``data`` as arrays: owner, start, number of
    windows, key, content hash. ``owner`` has a number per window; windows of
    different owners are in different pieces, those below 0 in none."""
    n = len(data)
    powers, inverses = _grown(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((np.frombuffer(data, np.uint8).astype(np.uint64) + np.uint64(1)) * powers[:n], out=sums[1:])
    grams = mix64((sums[gram:] - sums[:-gram]) * inverses[: n - gram + 1] + np.uint64(seed))
    # 40 bits of the hash, then the place: the leftmost of equal hashes wins.
    placed = (grams & ~np.uint64(_PLACE)) | np.arange(len(grams), dtype=np.uint64)
    at = (_sliding_min(placed, match - gram + 1) & np.uint64(_PLACE)).astype(np.int64)
    starts = np.flatnonzero(np.append(True, (at[1:] != at[:-1]) | (owner[1:] != owner[:-1])))
    sizes = np.diff(np.append(starts, len(at)))
    kept = owner[starts] >= 0
    starts, sizes = starts[kept], sizes[kept]
    ends = starts + sizes + match - 1
    content = mix64((sums[ends] - sums[starts]) * inverses[starts] + sizes.astype(np.uint64))
    return owner[starts], starts, sizes, grams[at[starts]], content


def _first_pieces(rows: DataFrame) -> DataFrame:
    def run(batch: pa.RecordBatch) -> dict:
        parts: list[list] = [[], [], [], [], [], []]
        for id_, hash_, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), byte_texts(batch.column(2)), strict=True):
            start, n, key, content = pieces(text)
            parts[0] += [id_] * len(start)
            parts[1].append(np.full(len(start), hash_, np.int64))
            for part, values in zip(parts[2:], (start, n, key.view(np.int64), content.view(np.int64)), strict=True):
                part.append(values)
        joined = [parts[0]] + [np.concatenate(p) if p else np.zeros(0, np.int64) for p in parts[1:]]
        return dict(zip(("id", "text_hash", "start", "n", "key", "content"), joined, strict=True))

    return map_batches(rows.select("id", "text_hash", "text"), run, _PIECE)


def _sort_out(found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of pieces (id, text_hash, start, n, key, content, known): those whose
    windows all repeat, and those that the windows of another may match.

    ``known`` pieces stand for windows already found to repeat. Of equal pieces
    one goes on, as known, if its key has others that are not equal.
    """
    often = materialize(found.groupBy("key").count().filter("count > 1").selectExpr("key AS often_key"), "keys")
    found = materialize(found.join(often, F.expr("key = often_key"), "left_semi"), "shared-pieces")
    classes = found.groupBy("key", "n", "content").agg(
        F.expr("count(*) > 1 OR max(known) AS repeats"), F.expr("min(struct(id, text_hash, start)) AS place")
    )
    classes = materialize(classes, "piece-classes")
    repeats = materialize(classes.filter("repeats").selectExpr("key AS k", "n AS m", "content AS c"), "repeats")
    covered = found.filter("NOT known").join(repeats, F.expr("key = k AND n = m AND content = c"), "left_semi")
    mixed = classes.groupBy("key").agg(F.expr("count(*) AS n_classes"), F.expr("count_if(NOT repeats) AS n_single"))
    mixed = materialize(mixed.filter("n_classes > 1 AND n_single > 0").selectExpr("key AS mixed_key", "n_classes"), "mixed")
    open_ = classes.join(mixed, F.expr("key = mixed_key")).selectExpr("place.*", "n", "key", "repeats AS known", "n_classes")
    return materialize(covered.select("id", "text_hash", "start", "n"), "covered"), materialize(open_, "open-pieces")


def _with_bytes(open_: DataFrame, rows: DataFrame) -> DataFrame:
    """The bytes of open pieces, read from their texts."""
    wanted = open_.groupBy("id", "text_hash").agg(F.collect_list(F.struct("start", "n", "key", "known")).alias("wanted"))
    wanted = wanted.toDF("w_id", "w_hash", "wanted")
    if open_.count() <= BROADCAST_PIECES:
        wanted = F.broadcast(wanted)
    # Rows equal in id and text are read once.
    texts = rows.join(wanted, F.expr("id <=> w_id AND text_hash = w_hash")).dropDuplicates(["id", "text_hash"])

    def run(batch: pa.RecordBatch) -> dict:
        out: dict[str, list] = {k: [] for k in ("id", "text_hash", "start", "n", "key", "known", "bytes")}
        for id_, hash_, text, pieces_ in zip(
            batch.column(0).to_pylist(), batch.column(1).to_pylist(), byte_texts(batch.column(2)), batch.column(3).to_pylist(), strict=True
        ):
            for p in pieces_:
                cut = text[p["start"] : p["start"] + p["n"] + MATCH - 1]
                for name, value in zip(out, (id_, hash_, p["start"], p["n"], p["key"], p["known"], cut), strict=True):
                    out[name].append(value)
        return out

    schema = "id long, text_hash long, start int, n int, key long, known boolean, bytes binary"
    return materialize(map_batches(texts.select("id", "text_hash", "text", "wanted"), run, schema), "piece-bytes")


def _refined(open_: DataFrame, seed: int) -> DataFrame:
    """Pieces cut again by minimizers of another hash within the same key."""

    def run(batch: pa.RecordBatch) -> dict:
        """All pieces of a batch at once, as one string of bytes."""
        ids, hashes, start, key, known, parts = (batch.column(i).to_pylist() for i in range(6))
        lengths = np.array([len(d) for d in parts], np.int64)
        data = b"".join(parts)
        # Of each piece the windows that lie within it, then those that do not.
        number = np.repeat(np.arange(len(parts)), lengths)
        begins = np.cumsum(lengths) - lengths
        inside = np.arange(len(data)) - begins[number] <= lengths[number] - MATCH
        owner = np.where(inside, number, -1)[: len(data) - MATCH + 1]
        of, at, n, keys, content = _cut(data, owner, seed, MATCH, GRAM)
        keys = mix64(keys ^ np.array(key, np.int64).view(np.uint64)[of])
        return {
            "id": [ids[i] for i in of], "text_hash": np.array(hashes, np.int64)[of],
            "start": np.array(start, np.int64)[of] + at - begins[of], "n": n, "key": keys.view(np.int64),
            "content": content.view(np.int64), "known": np.array(known, bool)[of],
            "bytes": [data[a : a + m + MATCH - 1] for a, m in zip(at.tolist(), n.tolist(), strict=True)],
        }

    rows = open_.select("id", "text_hash", "start", "key", "known", "bytes")
    return materialize(map_batches(rows, run, _PIECE + ", known boolean, bytes binary"), "refined")


def _repeated_windows(data: list[bytes]) -> list[np.ndarray]:
    """For each piece, which of its windows occur again in the shard."""
    text = np.concatenate([np.append(np.frombuffer(d, np.uint8) + np.uint8(1), np.uint8(0)) for d in data])
    positions, prefixes = ExternalSorter(text, MATCH).sort()
    long_ = np.flatnonzero(prefixes >= MATCH)
    flags = np.zeros(len(text), bool)
    flags[positions[long_]] = True
    flags[positions[long_ - 1]] = True
    edges = np.cumsum([0] + [len(d) + 1 for d in data])
    return [flags[a : b - 1] for a, b in zip(edges[:-1], edges[1:], strict=True)]


def _sorted_shards(open_: DataFrame) -> DataFrame:
    """(id, text_hash, start, n): runs of repeated windows, by induced sorting."""
    total = open_.selectExpr("coalesce(sum(length(bytes)), 0)").head()[0]
    n_shards = max(1, -(-total // SHARD_BYTES))
    tasks = max(n_shards, int(open_.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rows = open_.selectExpr(f"pmod(xxhash64(key), {n_shards}) AS shard", "id", "text_hash", "start", "known", "bytes")
    rows = rows.repartition(tasks, "shard").sortWithinPartitions("shard")

    def finish(held: list[tuple]) -> dict:
        out: dict[str, list] = {"id": [], "text_hash": [], "start": [], "n": []}
        for (id_, hash_, start, known, _), flags in zip(held, _repeated_windows([h[4] for h in held]), strict=True):
            if known or not flags.any():
                continue
            edges = np.flatnonzero(np.diff(flags, prepend=False, append=False))
            for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
                for name, value in zip(out, (id_, hash_, start + a, b - a), strict=True):
                    out[name].append(value)
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("id", pa.int64()), ("text_hash", pa.int64()), ("start", pa.int32()), ("n", pa.int32())])
        shard, held = None, []
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(6)), strict=True):
                if held and row[0] != shard:
                    yield pa.RecordBatch.from_pydict(finish(held), schema=schema)
                    held = []
                shard = row[0]
                held.append(row[1:])
        if held:
            yield pa.RecordBatch.from_pydict(finish(held), schema=schema)

    return materialize(rows.mapInArrow(run, "id long, text_hash long, start int, n int"), "sorted")


def repeated_windows(rows: DataFrame) -> DataFrame:
    """(id, text_hash, start, n): runs of windows that occur elsewhere too."""
    found = materialize(_first_pieces(rows), "pieces").withColumn("known", F.lit(False))
    covered, open_ = _sort_out(found)
    data = _with_bytes(open_, rows)
    parts = [covered]
    for seed in range(1, MAX_ROUNDS):
        # The first refinement also drops most edges of passages; more follow
        # only while a key is too frequent.
        finer = _refined(data, seed)
        covered, open_ = _sort_out(finer.drop("bytes"))
        parts.append(covered)
        places = ["id", "text_hash", "start"]
        chosen = open_.selectExpr(*places, "n AS n_", "known AS known_", "n_classes").withColumnsRenamed({p: f"{p}_" for p in places})
        same = F.expr("id <=> id_ AND text_hash = text_hash_ AND start = start_ AND n = n_")
        data = finer.join(chosen, same).selectExpr(*places, "n", "key", "known_ AS known", "bytes", "n_classes")
        data = materialize(data.dropDuplicates([*places, "n"]), "open-bytes")
        most = data.selectExpr("coalesce(max(n_classes), 0)").head()[0]
        if most <= MAX_PIECES:
            break
    parts.append(_sorted_shards(data))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept) of every row; ``kept`` has the
    bytes that are left, which need not be valid UTF-8."""
    rows = _rows(docs, id_col, text_col)
    runs = repeated_windows(rows).groupBy("id", "text_hash").agg(F.collect_list(F.struct("start", "n")).alias("runs"))
    runs = runs.toDF("r_id", "r_hash", "runs")
    joined = rows.join(runs, F.expr("id <=> r_id AND text_hash = r_hash"), "left")

    def run(batch: pa.RecordBatch) -> dict:
        out: dict[str, list] = {"id": batch.column(0), "n_bytes": [], "n_removed": [], "n_spans": [], "kept": []}
        for text, found in zip(byte_texts(batch.column(1)), batch.column(2).to_pylist(), strict=True):
            parts, at, gone, spans = [], 0, 0, 0
            stop = -1
            for start, n in sorted((r["start"], r["n"]) for r in found or []):
                if start > stop:  # a new span; touching spans are one
                    parts.append(text[at:start])
                    spans += 1
                    stop = start
                end = max(stop, start + n + MATCH - 1)
                gone += end - stop
                stop = at = end
            parts.append(text[at:])
            for name, value in zip(("n_bytes", "n_removed", "n_spans", "kept"), (len(text), gone, spans, b"".join(parts)), strict=True):
                out[name].append(value)
        return out

    return map_batches(joined.select("id", "text", "runs"), run, "id long, n_bytes long, n_removed long, n_spans long, kept binary")

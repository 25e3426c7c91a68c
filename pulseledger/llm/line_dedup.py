"""Incremental line de-duplication with sharded cuckoo filters and exact reference counts.

An exact table counts, for every line key, the documents that contain it. Keys
that reach the threshold are common: their lines are dropped everywhere. Common
keys are spread over shards by their hash, and a shard keeps a cuckoo filter and
the exact keys. A line first asks the filter, which rules out nearly all lines;
what it lets through is looked up exactly. Cuckoo filters can delete, so taking
documents out again lowers the counts and withdraws keys that fall below the
threshold: the index after adding and removing documents is as if they had
never been there.

Defined cases: a null or empty text is one empty line. The key of a line is the
line stripped of ``[\\x20\\x09-\\x0D]`` at both ends and lower-cased (A-Z); lines
with an empty key always stay. A document counts once per key, and repeated
rows count as separate documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, UPPER, materialize, mix64

MIN_DOCS = 10
KEYS_PER_SHARD = 1 << 15
# Lines probed together with one copy of a shard's filter.
LINES_PER_GROUP = 50_000
_SLOTS = 4
_KICKS = 500


class CuckooFilter:
    """16-bit fingerprints in buckets of four; supports insert and delete.

    Keys are 64-bit hashes. A key's two buckets are the exclusive or of each
    other with the hash of its fingerprint. Inserting the same key twice stores
    it twice; delete takes one copy out.
    """

    def __init__(self, table: np.ndarray):
        self.table = table  # (buckets, slots), 0 is free

    @classmethod
    def sized(cls, keys: int) -> CuckooFilter:
        buckets = 1 << max(2, int(np.ceil(np.log2(max(keys, 1) / (_SLOTS * 0.8) + 1))))
        return cls(np.zeros((buckets, _SLOTS), np.uint16))

    @classmethod
    def from_bytes(cls, data: bytes) -> CuckooFilter:
        return cls(np.frombuffer(data, "<u2").reshape(-1, _SLOTS).copy())

    def to_bytes(self) -> bytes:
        return self.table.astype("<u2").tobytes()

    def _places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        hashed = mix64(np.asarray(keys, np.uint64))
        mark = (hashed >> np.uint64(48)).astype(np.uint16)
        mark[mark == 0] = 1
        mask = np.uint64(len(self.table) - 1)
        first = hashed & mask
        return mark, first.astype(np.int64), (first ^ (mix64(mark.astype(np.uint64)) & mask)).astype(np.int64)

    def contains(self, keys: np.ndarray) -> np.ndarray:
        mark, first, second = self._places(keys)
        found = (self.table[first] == mark[:, None]) | (self.table[second] == mark[:, None])
        return found.any(axis=1)

    def insert(self, keys: np.ndarray) -> bool:
        """False if the filter is full; it must then be built anew, larger."""
        rng = np.random.Generator(np.random.PCG64(len(self.table)))
        for mark, *buckets in zip(*self._places(keys), strict=True):
            at = buckets[0]
            for bucket in buckets:
                free = np.flatnonzero(self.table[bucket] == 0)
                if len(free):
                    self.table[bucket, free[0]] = mark
                    break
            else:
                for _ in range(_KICKS):
                    slot = rng.integers(_SLOTS)
                    mark, self.table[at, slot] = self.table[at, slot], mark
                    at ^= int(mix64(np.array([mark], np.uint64))[0]) & (len(self.table) - 1)
                    free = np.flatnonzero(self.table[at] == 0)
                    if len(free):
                        self.table[at, free[0]] = mark
                        break
                else:
                    return False
        return True

    def delete(self, keys: np.ndarray) -> None:
        """Only for keys that were inserted."""
        for mark, *buckets in zip(*self._places(keys), strict=True):
            for bucket in buckets:
                held = np.flatnonzero(self.table[bucket] == mark)
                if len(held):
                    self.table[bucket, held[0]] = 0
                    break


def _line_keys(lines: str) -> str:
    """SQL for the keys of an array of lines, each 16 bytes; null for an empty key.

    Step by step, because a lambda computes what it names twice two times.
    ``translate`` looks every character up, so it is left to lines beyond ASCII.
    """
    stripped = f"transform({lines}, l -> trim(BOTH '\\t\\n\\u000b\\u000c\\r ' FROM l))"
    lowered = f"transform({stripped}, l -> IF(octet_length(l) = length(l), lower(l), translate(l, '{UPPER}', '{LOWER}')))"
    return f"transform({lowered}, l -> IF(octet_length(l) = 0, NULL, unhex(md5(l))))"


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text, text_hash): id and hash together name a row; rows alike in
    both are alike in their lines."""
    rows = docs.selectExpr(f"`{id_col}` AS id", f"coalesce(`{text_col}`, '') AS text")
    return rows.withColumn("text_hash", F.expr("xxhash64(text)"))


def _keys(rows: DataFrame) -> DataFrame:
    """(id, text_hash, key): the distinct keys of every row."""
    keys = _line_keys("split(text, '\\n')")
    keys = f"array_distinct(filter({keys}, k -> k IS NOT NULL))"
    return rows.selectExpr("id", "text_hash", f"explode({keys}) AS key")


def _hashes(keys: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(k[:8] for k in keys), "<u8")


def _shard(n: int) -> str:
    return f"CAST(pmod(xxhash64(key), {n}) AS INT)"


_SHARD_SCHEMA = "shard int, filter binary, keys binary"


def _split(keys: bytes | None) -> list[bytes]:
    return [keys[i : i + 16] for i in range(0, len(keys or b""), 16)]


def _changed_shard(filters: pd.DataFrame, changes: pd.DataFrame) -> pd.DataFrame:
    """A shard after keys have become common or have ceased to be."""
    shard = int((filters if len(filters) else changes)["shard"].iloc[0])
    keys = set(_split(filters["keys"].iloc[0])) if len(filters) else set()
    gone = {bytes(k) for k in changes.loc[changes["change"] < 0, "key"]} & keys
    new = {bytes(k) for k in changes.loc[changes["change"] > 0, "key"]} - keys
    after = sorted((keys - gone) | new)
    stored = CuckooFilter.from_bytes(filters["filter"].iloc[0]) if len(filters) else CuckooFilter.sized(2 * len(new))
    stored.delete(_hashes(sorted(gone)))
    if not stored.insert(_hashes(sorted(new))):
        size = 2 * len(after)
        while not (stored := CuckooFilter.sized(size)).insert(_hashes(after)):
            size *= 2
    return pd.DataFrame({"shard": [shard], "filter": [stored.to_bytes()], "keys": [b"".join(after)]})


@dataclass(frozen=True)
class LineIndex:
    """``counts``: (key, n_docs) of all keys; ``shards``: (shard, filter, keys)
    of the common ones."""

    counts: DataFrame
    shards: DataFrame
    n_shards: int
    min_docs: int

    @classmethod
    def build(cls, docs: DataFrame, min_docs: int = MIN_DOCS, id_col: str = "doc_id", text_col: str = "text") -> LineIndex:
        keys = _keys(_rows(docs, id_col, text_col))
        counts = materialize(keys.groupBy("key").agg(F.count("*").alias("n_docs")), "line-counts")
        common = counts.filter(f"n_docs >= {min_docs}")
        n_shards = max(1, -(-common.count() // KEYS_PER_SHARD))
        empty = docs.sparkSession.createDataFrame([], _SHARD_SCHEMA)
        index = cls(counts, empty, n_shards, min_docs)
        return cls(counts, index._with_changes(common.selectExpr("key", "1 AS change")), n_shards, min_docs)

    def _with_changes(self, changes: DataFrame) -> DataFrame:
        sharded = changes.selectExpr(f"{_shard(self.n_shards)} AS shard", "key", "change")
        cogroup = self.shards.groupBy("shard").cogroup(sharded.groupBy("shard"))
        return materialize(cogroup.applyInPandas(_changed_shard, _SHARD_SCHEMA), "line-shards")

    def add(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> LineIndex:
        """The index after documents came in."""
        return self._moved(docs, 1, id_col, text_col)

    def remove(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> LineIndex:
        """The index after documents, which must be counted in it, went."""
        return self._moved(docs, -1, id_col, text_col)

    def _moved(self, docs: DataFrame, sign: int, id_col: str, text_col: str) -> LineIndex:
        keys = _keys(_rows(docs, id_col, text_col))
        delta = keys.groupBy("key").agg((sign * F.count("*")).alias("moved"))
        merged = self.counts.join(delta, "key", "full").selectExpr(
            "key", "coalesce(n_docs, 0L) AS n_before", "coalesce(n_docs, 0L) + coalesce(moved, 0L) AS n_docs"
        )
        merged = materialize(merged, "line-counts")
        now, before = (f"CAST({n} >= {self.min_docs} AS INT)" for n in ("n_docs", "n_before"))
        changes = merged.selectExpr("key", f"{now} - {before} AS change").filter("change <> 0")
        counts = merged.filter("n_docs > 0").select("key", "n_docs")
        return LineIndex(counts, self._with_changes(changes), self.n_shards, self.min_docs)

    def common_keys(self, lines: DataFrame) -> DataFrame:
        """Those of the (id, text_hash, key) rows whose key is common.

        Lines of a shard are dealt to as many groups as its line count needs,
        each with a copy of the shard; a frequent key so has many groups. In a
        group the shard comes first, then lines stream past it.
        """
        spark = lines.sparkSession
        load = self.counts.groupBy(F.expr(f"{_shard(self.n_shards)} AS load_shard")).agg(
            F.expr(f"CAST(ceil(sum(n_docs) / {LINES_PER_GROUP}) AS INT) AS n_groups")
        )
        load = materialize(load, "line-load")
        # One row per shard of KEYS_PER_SHARD common keys.
        placed = lines.withColumn("shard", F.expr(_shard(self.n_shards))).join(
            F.broadcast(load), F.expr("shard = load_shard")
        )
        nothing = "CAST(NULL AS BINARY)"
        asked = placed.selectExpr(
            "shard", "CAST(pmod(xxhash64(id, text_hash), n_groups) AS INT) AS part", "1 AS kind",
            "id", "text_hash", "key", f"{nothing} AS filter",
        )
        held = self.shards.join(F.broadcast(load), F.expr("shard = load_shard")).selectExpr(
            "shard", "explode(sequence(0, n_groups - 1)) AS part", "0 AS kind",
            f"CAST(NULL AS {lines.schema['id'].dataType.simpleString()}) AS id", "0L AS text_hash", "keys AS key", "filter",
        )
        n_tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * self.n_shards)
        dealt = held.unionByName(asked).repartition(n_tasks, "shard", "part").sortWithinPartitions("shard", "part", "kind")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            place, stored, exact = None, None, frozenset()
            for batch in batches:
                place_of = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
                kinds = batch.column(2).to_pylist()
                keys = batch.column(5).to_pylist()
                hits: list[int] = []
                start = 0
                for i in [*(j for j, kind in enumerate(kinds) if kind == 0), len(kinds)]:
                    asking = [j for j in range(start, i) if place_of[j] == place]
                    if asking and stored is not None:
                        passed = stored.contains(_hashes([keys[j] for j in asking]))
                        hits += [j for j, ok in zip(asking, passed, strict=True) if ok and keys[j] in exact]
                    if i < len(kinds):
                        place = place_of[i]
                        stored = CuckooFilter.from_bytes(batch.column(6)[i].as_py())
                        exact = frozenset(_split(keys[i]))
                    start = i + 1
                if hits:
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(c).take(pa.array(hits)) for c in (3, 4, 5)], names=["id", "text_hash", "key"]
                    )

        kind = lines.schema["id"].dataType.simpleString()
        return dealt.select("shard", "part", "kind", "id", "text_hash", "key", "filter").mapInArrow(
            run, f"id {kind}, text_hash long, key binary"
        )

    def kept_lines(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """(id, n_lines, n_dropped, text) of every row without its common lines."""
        rows = _rows(docs, id_col, text_col)
        hits = self.common_keys(_keys(rows)).groupBy("id", "text_hash").agg(F.collect_set("key").alias("common"))
        hits = hits.toDF("hit_id", "hit_hash", "common")
        joined = rows.join(hits, F.expr("id <=> hit_id AND text_hash = hit_hash"), "left")
        marked = f"zip_with(lines, {_line_keys('lines')}, (l, k) -> IF(coalesce(array_contains(common, k), false), NULL, l))"
        out = joined.selectExpr("id", "text", "split(text, '\\n') AS lines", "common").selectExpr(
            "id", "text", "size(lines) AS n", f"IF(common IS NULL, NULL, filter({marked}, l -> l IS NOT NULL)) AS stay"
        )
        return out.selectExpr(
            "id", "CAST(n AS BIGINT) AS n_lines", "CAST(IF(stay IS NULL, 0, n - size(stay)) AS BIGINT) AS n_dropped",
            "IF(stay IS NULL, text, array_join(stay, '\\n')) AS text",
        )

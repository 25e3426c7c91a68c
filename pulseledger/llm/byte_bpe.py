"""Byte-level BPE encoding and decoding by overlapping chunks.

A text of more than ``CHUNK`` characters is cut into slices that overlap by
``OVERLAP``. Each slice is split into pre-tokens from its own start, in
parallel and without knowing whether a pre-token really starts there. What the
pattern matches depends only on the text from the match on, so two scans agree
for good from the first boundary they have in common. The stitch looks for that
boundary in the overlap of neighbours; the text between two stitches is a piece
that starts and ends with a pre-token, and pieces are encoded in parallel, each
with the ``MARGIN`` characters after it in sight.

Where neighbours have no boundary in common (the overlap lies within one very
long pre-token), the text from the last stitch on is one piece: exact, but
encoded by one task. Boundaries in the last ``MARGIN`` characters of a slice
are not used, because the pattern may look so far ahead.

Encoding merges, within each match of the pattern, the adjacent pair of lowest
rank first and the left one of equals; decoding concatenates the bytes of ids.

Defined cases: a null text is empty and has no ids. Ids of any type, null and
repeated ones too, pass through; every row gives one row. The pattern must not
look back and not look more than ``MARGIN`` - 1 characters past a match, except
along one run of white space that reaches the slice's end.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from functools import lru_cache
from itertools import chain, takewhile

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, materialize

CHUNK = 32_768
OVERLAP = 2_048
MARGIN = 4
# Pre-tokens kept with their ids by a Python worker; the store is emptied when full.
CACHED_WORDS = 500_000
# Bytes of a pre-token up to which scanning all pairs beats a heap.
SHORT = 100
NO_RANK = 1 << 60


class ByteLevelModel:
    """Ranks of byte strings and the pattern that splits a text before merging."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines)}
        if any(bytes([b]) not in self.ranks for b in range(256)):
            raise ValueError("every single byte needs a rank")
        self.bytes_of = {rank: token for token, rank in self.ranks.items()}
        self.names = {rank: str(rank) for rank in self.bytes_of}
        self.pattern = regex.compile(pattern)
        self._known = _PreTokens(self)

    def merged(self, piece: bytes) -> list[int]:
        """Ids of one pre-token."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        return self._merged_short(piece) if len(piece) <= SHORT else self._merged_long(piece)

    def _merged_short(self, piece: bytes) -> list[int]:
        """Looks for the lowest rank among all pairs before each merge."""
        rank = self.ranks.get
        starts = list(range(len(piece) + 1))
        pairs = [rank(piece[i : i + 2], NO_RANK) for i in range(len(piece) - 1)]
        while pairs and (lowest := min(pairs)) != NO_RANK:
            i = pairs.index(lowest)
            del starts[i + 1], pairs[i]
            if i < len(pairs):
                pairs[i] = rank(piece[starts[i] : starts[i + 2]], NO_RANK)
            if i:
                pairs[i - 1] = rank(piece[starts[i - 1] : starts[i + 1]], NO_RANK)
        return [rank(piece[a:b]) for a, b in zip(starts, starts[1:])]

    def _merged_long(self, piece: bytes) -> list[int]:
        """Keeps the pairs in a heap, so time grows little more than the length."""
        ranks, n = self.ranks, len(piece)
        after, before = list(range(1, n + 2)), list(range(-1, n))
        heap = [(r, i) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
        heapq.heapify(heap)
        gone = bytearray(n + 1)
        while heap:
            rank, i = heapq.heappop(heap)
            if gone[i] or (middle := after[i]) >= n:
                continue
            end = after[middle]
            if ranks.get(piece[i:end]) != rank:
                continue  # one of the two has merged since
            gone[middle] = 1
            after[i] = end
            if end < n:
                before[end] = i
                joined = ranks.get(piece[i : after[end]])
                if joined is not None:
                    heapq.heappush(heap, (joined, i))
            if i:
                joined = ranks.get(piece[before[i] : end])
                if joined is not None:
                    heapq.heappush(heap, (joined, before[i]))
        out, i = [], 0
        while i < n:
            out.append(ranks[piece[i : after[i]]])
            i = after[i]
        return out

    def boundaries(self, text: str) -> list[int]:
        """Ends of the pre-tokens of a text, in order."""
        return [m.end() for m in self.pattern.finditer(text)]

    def _found(self, text: str, ahead: str = "") -> list[tuple[list[int], str, bytes]]:
        """The pre-tokens of a text or of a piece; ``ahead`` is what follows a
        piece, for the pattern to look at."""
        if len(self._known) > CACHED_WORDS:
            self._known.clear()
        if ahead:
            matches = self.pattern.finditer(text + ahead)
            words = [m.group() for m in takewhile(lambda m: m.start() < len(text), matches)]
        else:
            words = self.pattern.findall(text)
        return list(map(self._known.__getitem__, words))

    def encode(self, text: str | None, ahead: str = "") -> list[int]:
        """Ids of a text, or of a piece of one that ends with a pre-token."""
        return list(chain.from_iterable([ids for ids, _, _ in self._found(text or "", ahead)]))

    def decode(self, ids) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))

    def round_trip(self, text: str) -> tuple[int, str, str]:
        """As ``digests`` of the ids of a whole text; ids are written and decoded
        once for each pre-token, whose bytes are those of its ids."""
        found = self._found(text)
        ids = " ".join([names for _, names, _ in found])
        back = b"".join([data for _, _, data in found])
        return ids.count(" ") + 1 if ids else 0, hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(back).hexdigest()

    def digests(self, ids: list[int]) -> tuple[int, str, str]:
        """(number of ids, digest of the ids as text, digest of the decoded bytes)."""
        text = " ".join(map(self.names.__getitem__, ids))
        return len(ids), hashlib.sha256(text.encode()).hexdigest(), hashlib.sha256(self.decode(ids)).hexdigest()


class _PreTokens(dict):
    """Pre-tokens with their ids, these as text and decoded, each made when first seen."""

    def __init__(self, model: ByteLevelModel):
        self.model = model

    def __missing__(self, word: str) -> tuple[tuple[int, ...], str, bytes]:
        model = self.model
        ids = tuple(model.merged(word.encode()))
        found = ids, " ".join([model.names[i] for i in ids]), model.decode(ids)
        if len(word) <= 64:
            self[word] = found
        return found


@lru_cache(maxsize=2)
def load(path: str, pattern: str) -> ByteLevelModel:
    """The model of a file, once per worker process."""
    return ByteLevelModel(path, pattern)


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))


def _slices(texts: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """(key, id, part, start, text): overlapping slices, dealt over all tasks."""
    kind = texts.schema["id"].dataType.simpleString()

    def cut(batch: pa.RecordBatch):
        for row in batch.to_pylist():
            text = row["text"]
            parts = range(-(-len(text) // chunk))
            yield {
                "key": [row["key"]] * len(parts),
                "id": [row["id"]] * len(parts),
                "part": list(parts),
                "start": [i * chunk for i in parts],
                "text": [text[i * chunk : (i + 1) * chunk + overlap] for i in parts],
            }

    keyed = texts.withColumn("key", F.monotonically_increasing_id()).select("key", "id", "text")
    slices = map_batches(keyed, cut, f"key long, id {kind}, part int, start long, text string")
    return slices.repartition("key", "part")


def _marks(slices: DataFrame, path: str, pattern: str, chunk: int, overlap: int) -> DataFrame:
    """Boundaries of each slice's own scan in its first and in its last overlap,
    as offsets in the whole text."""

    def scan(batch: pa.RecordBatch) -> dict:
        model = load(path, pattern)
        starts = batch.column("start").to_pylist()
        heads, tails = [], []
        for start, text in zip(starts, batch.column("text").to_pylist()):
            ends = [0, *model.boundaries(text)]
            heads.append([start + e for e in ends if e <= overlap])
            tails.append([start + e for e in ends if chunk <= e <= len(text) - MARGIN])
        return {"key": batch.column("key"), "part": batch.column("part"), "start": starts, "head": heads, "tail": tails}

    return map_batches(
        slices.select("key", "part", "start", "text"), scan, "key long, part int, start long, head array<long>, tail array<long>"
    )


def _stitched(marks: DataFrame) -> DataFrame:
    """(key, part, low, high, piece): the range of the text that each slice
    contributes, and the piece that it belongs to."""
    order = "(PARTITION BY key ORDER BY part)"
    met = marks.selectExpr("key", "part", "start", f"array_min(array_intersect(lag(tail) OVER {order}, head)) AS cut")
    # After a stitch that failed, later ones may agree on a wrong boundary.
    sound = met.selectExpr("key", "part", "start", f"IF(bool_and(part = 0 OR cut IS NOT NULL) OVER {order}, cut, NULL) AS cut")
    return sound.selectExpr(
        "key",
        "part",
        "coalesce(cut, start) AS low",
        f"lead(coalesce(cut, start)) OVER {order} AS high",
        f"count(cut) OVER {order} AS piece",
    )


def pieces(texts: DataFrame, path: str, pattern: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """(key, id, piece, text, ahead): texts cut where pre-tokens end, each with
    the characters that follow it."""
    if not MARGIN < overlap < chunk:
        raise ValueError("the overlap must be larger than the margin and smaller than a chunk")
    slices = materialize(_slices(texts, chunk, overlap), "slices")
    stitched = _stitched(_marks(slices, path, pattern, chunk, overlap))
    cuts = materialize(stitched.selectExpr("*", "count(*) OVER (PARTITION BY key, piece) AS n_slices"), "stitches")
    length = "int(coalesce(high, low + length(text)) - low)"
    parts = slices.join(cuts, ["key", "part"]).selectExpr(
        "key",
        "id",
        "piece",
        "n_slices",
        "part",
        f"substring(text, int(low - start + 1), {length}) AS text",
        f"substring(text, int(low - start + 1) + {length}, {MARGIN}) AS ahead",
    )
    whole = parts.filter("n_slices = 1").select("key", "id", "piece", "text", "ahead")
    joined = parts.filter("n_slices > 1").groupBy("key", "id", "piece")
    joined = joined.agg(F.expr("array_sort(collect_list(struct(part, text, ahead))) AS parts"))
    return whole.unionByName(
        joined.selectExpr("key", "id", "piece", "array_join(transform(parts, p -> p.text), '') AS text", "element_at(parts, -1).ahead AS ahead")
    )


def _long_ids(texts: DataFrame, path: str, pattern: str, chunk: int, overlap: int) -> DataFrame:
    """(id, ids) of the texts that are cut."""
    kind = texts.schema["id"].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> dict:
        model = load(path, pattern)
        out = {c: batch.column(c) for c in ("key", "id", "piece")}
        texts = zip(batch.column("text").to_pylist(), batch.column("ahead").to_pylist())
        return out | {"ids": [model.encode(*t) for t in texts]}

    found = map_batches(pieces(texts, path, pattern, chunk, overlap), run, f"key long, id {kind}, piece long, ids array<int>")
    whole = found.groupBy("key", "id").agg(F.expr("array_sort(collect_list(struct(piece, ids))) AS pieces"))
    return whole.selectExpr("id", "flatten(transform(pieces, p -> p.ids)) AS ids")


def _parts(docs: DataFrame, id_col: str, text_col: str, chunk: int) -> tuple[DataFrame, DataFrame]:
    rows = _rows(docs, id_col, text_col)
    return rows.filter(F.length("text") <= chunk), rows.filter(F.length("text") > chunk)


def with_ids(
    docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", chunk: int = CHUNK, overlap: int = OVERLAP
) -> DataFrame:
    """(id, ids) of every row."""
    short, long = _parts(docs, id_col, text_col, chunk)
    kind = short.schema["id"].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> dict:
        model = load(path, pattern)
        return {"id": batch.column("id"), "ids": [model.encode(t) for t in batch.column("text").to_pylist()]}

    return map_batches(short, run, f"id {kind}, ids array<int>").unionByName(_long_ids(long, path, pattern, chunk, overlap))


def decoded(ids: DataFrame, path: str, pattern: str) -> DataFrame:
    """(id, data): the bytes of (id, ids); null ids give no bytes."""
    kind = ids.schema["id"].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> dict:
        model = load(path, pattern)
        return {"id": batch.column("id"), "data": [model.decode(i or []) for i in batch.column("ids").to_pylist()]}

    return map_batches(ids.select("id", "ids"), run, f"id {kind}, data binary")


def round_trips(
    docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", chunk: int = CHUNK, overlap: int = OVERLAP
) -> DataFrame:
    """Encode every text and decode its ids: id, n_tokens, ids_sha256, decoded_sha256."""
    short, long = _parts(docs, id_col, text_col, chunk)
    schema = f"id {short.schema['id'].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string"

    def columns(ids: pa.Array, found: list[tuple[int, str, str]]) -> dict:
        n, encoded, back = zip(*found)
        return {"id": ids, "n_tokens": n, "ids_sha256": encoded, "decoded_sha256": back}

    def of_texts(batch: pa.RecordBatch) -> dict:
        model = load(path, pattern)
        return columns(batch.column("id"), [model.round_trip(t) for t in batch.column("text").to_pylist()])

    def of_ids(batch: pa.RecordBatch) -> dict:
        model = load(path, pattern)
        return columns(batch.column("id"), [model.digests(i) for i in batch.column("ids").to_pylist()])

    return map_batches(short, of_texts, schema).unionByName(map_batches(_long_ids(long, path, pattern, chunk, overlap), of_ids, schema))

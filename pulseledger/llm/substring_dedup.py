"""Substring de-duplication of paragraphs: MinHash banding, exact check, components.

Units are paragraphs, and windows of MIN_WORDS words of the whole word sequence of a
document, whatever its line feeds. A paragraph is a line of at least MIN_WORDS
words, or shorter lines that follow each other: they are gathered until they have
as many words and the last word's hash is even, so that equal lines fall in step
again after a difference; what is left over goes to the paragraph before it.
Windows start at words chosen by their content (the smallest hash among
MIN_WORDS neighbours), so any 2 * MIN_WORDS equal words contain the same window.

Paragraphs are compared as sets of 5-word shingles. MinHash values in BANDS bands of
ROWS make sets of similarity 0.8 collide with probability 0.998; colliding ones
are verified by exact Jaccard similarity, and links are gathered in components.
Most sets that collide are far apart; the parities of the shingles in 256 cells tell so
without their texts (a lower bound of the difference, so no link is lost).
Windows link if their words are equal. A common run that holds a repeated window
goes on for less than MIN_WORDS words before its first and after its last one; so all
windows that begin less than MIN_WORDS words from a repeated one are compared as
well, which covers the run to its ends.

Paragraphs are decided first: of each component the first (by id, then place) stays.
Windows that lie wholly in removed paragraphs go with them; they only tell that the
words around them repeat. Of another window's copies the first that no removed paragraph touches stays,
and the others go; a window whose copies all touch removed paragraphs is not removed
on its own account. So every word that goes with a window, or with a paragraph of which an equal one
stays, is left somewhere: its copy lies in an earlier place that no removed
paragraph touches, and either stays or has a copy in turn. What a near copy has
of its own goes with it.

Defined cases: a null text is empty; short lines between longer ones with less than
MIN_WORDS words together are no paragraph, only part of windows. Words are
lower-cased (A-Z). Units of one document can repeat each other.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import _grown, byte_texts, discard, map_batches, materialize, mix64, shuffled, word_bounds, word_hashes
from .components import by_label
from .jaccard_join import BROADCAST_IDS, _rows, linked_sets
from .suffix_dedup import _sliding_min

MIN_WORDS = 25
WORDS, PERCENT = 5, 80
BANDS, ROWS = 9, 3
_FACTORS = mix64(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64)) | np.uint64(1)
# Bytes of texts that are worked on as one array.
_LOT_BYTES = 1 << 18
_LINE = "id long, text_hash long, start int, stop int, n int, d1 long, d2 long, odd array<long>, bands array<long>"
_WINDOW = "id long, text_hash long, start int, stop int, d1 long, d2 long, touched boolean"
_SPANS = "array_sort(collect_set(struct(start, stop)))"


def _bands(shingles: np.ndarray, starts: np.ndarray | None = None) -> np.ndarray:
    """One 64-bit value per band and set, as (sets, bands); the sets lie one
    after the other and begin at ``starts``."""
    starts = np.zeros(1, np.int64) if starts is None else starts
    low = np.stack([np.minimum.reduceat(shingles * f, starts) for f in _FACTORS])
    out = np.repeat(np.arange(BANDS, dtype=np.uint64)[:, None], len(starts), axis=1)
    for k in range(ROWS):
        out = mix64(out * np.uint64(0xD6E8FEB86659FD93) + low[k::ROWS])
    return out.view(np.int64).T


def _sequence_hashes(words: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` words from each start."""
    powers, inverses = _grown(len(words) + 1)
    sums = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * powers[: len(words)], out=sums[1:])
    return mix64((sums[starts + size] - sums[starts]) * inverses[starts])


@dataclass(frozen=True)
class Words:
    """Words of several texts: byte starts, stops and hashes, all texts after each other;
    of each text the first byte and the number of the first word, and those of the end."""

    data: bytes
    starts: np.ndarray
    stops: np.ndarray
    hashes: np.ndarray
    bytes_at: np.ndarray
    words_at: np.ndarray


def _words(texts: list[bytes]) -> Words:
    data = b"\n".join(texts).lower()
    starts, stops = bounds = word_bounds(data)
    bytes_at = np.cumsum([0, *(len(t) + 1 for t in texts)])
    return Words(data, starts, stops, word_hashes(data, bounds), bytes_at, np.searchsorted(starts, bytes_at))


def _lots(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    """Ranges of the texts with _LOT_BYTES bytes or the one that passes them."""
    first = size = 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= _LOT_BYTES:
            yield first, i + 1
            first, size = i + 1, 0
    if first < len(texts):
        yield first, len(texts)


def _paragraphs(lot: Words) -> Iterator[tuple[int, list[tuple[int, int]]]]:
    """The number of each text with paragraphs, and these as ranges of the lot's words."""
    feeds = np.flatnonzero(np.frombuffer(lot.data, np.uint8) == 10)
    edges = np.unique(np.searchsorted(lot.starts, np.concatenate([[0], feeds, [len(lot.data)]])))
    even = (lot.hashes[edges[1:] - 1] & np.uint64(1) == 0).tolist()
    its = np.searchsorted(edges, lot.words_at).tolist()
    edges = edges.tolist()
    for i, (first, last) in enumerate(zip(its, its[1:], strict=False)):
        if first < last and edges[last] - edges[first] >= MIN_WORDS:
            yield i, _gathered(edges[first : last + 1], even[first:last])


def _gathered(edges: list[int], even: list[bool]) -> list[tuple[int, int]]:
    """Paragraphs of the lines of a text that lie between ``edges``, as ranges of words;
    ``even``: whether the hash of a line's last word is even."""
    found: list[tuple[int, int]] = []
    first = grown = None  # begin of the open paragraph; whether the last one is of the same run

    def close(end: int) -> None:
        if first is not None and end - first >= MIN_WORDS:
            found.append((first, end))
        elif first is not None and grown:
            found[-1] = (found[-1][0], end)

    for begin, end, ends in zip(edges, edges[1:], even, strict=False):
        if end - begin >= MIN_WORDS:
            close(begin)
            found.append((begin, end))
            first = grown = None
            continue
        first = begin if first is None else first
        if ends and end - first >= MIN_WORDS:
            found.append((first, end))
            first, grown = None, True
    close(edges[-1])
    return found


def _odd_counts(shingles: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Of 256 cells of the hashes those with an odd number of a set's shingles, as
    (sets, 4) words of bits. Two sets differ by as many shingles at least as
    they have different bits."""
    bits = np.uint64(1) << ((shingles >> np.uint64(56)) & np.uint64(63))
    word = shingles >> np.uint64(62)
    quarters = [np.bitwise_xor.reduceat(np.where(word == k, bits, np.uint64(0)), starts) for k in range(4)]
    return np.stack(quarters, axis=1).view(np.int64)


def line_units(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """Paragraphs of the texts: number of the text, start, stop, n, d1, d2, odd counts,
    bands; d1 and d2 are sums over the distinct shingles, so that equal sets have
    equal digests."""
    lot = _words(texts)
    words = lot.hashes
    lines = [(i, *line) for i, some in _paragraphs(lot) for line in some]
    if not lines:
        none = np.zeros(0, np.int64)
        return *(none for _ in range(6)), none.reshape(0, 4), none.reshape(0, BANDS)
    text, first, last = np.array(lines).T
    shingles = np.zeros(len(words) - WORDS + 1, np.uint64)
    for k in range(WORDS):
        shingles = mix64(shingles * np.uint64(0xD6E8FEB86659FD93) + words[k : k + len(shingles)])
    counts = last - first - WORDS + 1
    line = np.repeat(np.arange(len(lines)), counts)
    begins = np.cumsum(counts) - counts
    own = shingles[np.arange(len(line)) - begins[line] + first[line]]
    order = np.argsort(own)
    order = order[np.argsort(line[order].astype(np.uint16 if len(lines) < 1 << 16 else np.int64), kind="stable")]
    own, line = own[order], line[order]
    distinct = np.append(True, (own[1:] != own[:-1]) | (line[1:] != line[:-1]))
    own, line = own[distinct], line[distinct]
    begins = np.searchsorted(line, np.arange(len(lines)))
    sizes = np.diff(np.append(begins, len(line)))
    d1, d2 = (np.add.reduceat(mix64(own ^ np.uint64(c)), begins).view(np.int64) for c in (0x1D8E4E27C47D124F, 0xEB44ACCAB455D165))
    start, stop = lot.starts[first] - lot.bytes_at[text], lot.stops[last - 1] - lot.bytes_at[text]
    return text, start, stop, sizes, d1, d2, _odd_counts(own, begins), _bands(own, begins)


def _windows(starts: np.ndarray, stops: np.ndarray, words: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, ...]:
    """start, stop, d1, d2 of the windows that begin at the given words."""
    d1 = _sequence_hashes(words, at, MIN_WORDS)
    d2 = _sequence_hashes(mix64(words ^ np.uint64(0xA0761D6478BD642F)), at, MIN_WORDS)
    return starts[at], stops[at + MIN_WORDS - 1], d1.view(np.int64), d2.view(np.int64)


def _texts_of(lot: Words, at: np.ndarray) -> np.ndarray:
    """The numbers of the texts that the words ``at`` belong to."""
    return np.searchsorted(lot.words_at, at, side="right") - 1


def _left(lot: Words, at: np.ndarray, gone: np.ndarray, margin: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Of the windows that begin at the words ``at`` those that, with ``margin`` words
    of their text on both sides, are not wholly in the spans ``gone`` (bytes of the
    lot, disjoint, from word to word), and whether they touch one."""
    steps = np.zeros(len(lot.starts) + 1, np.int64)
    edges = np.searchsorted(lot.starts, gone)
    np.add.at(steps, edges[:, 0], 1)
    np.add.at(steps, edges[:, 1], -1)
    before = np.append(0, np.cumsum(np.cumsum(steps[:-1])))
    text = _texts_of(lot, at)
    first, last = np.maximum(at - margin, lot.words_at[text]), np.minimum(at + MIN_WORDS + margin, lot.words_at[text + 1])
    at = at[before[last] - before[first] < last - first]
    return at, before[at + MIN_WORDS] > before[at]


def _covered(first: np.ndarray, last: np.ndarray, n: int) -> np.ndarray:
    """The numbers below ``n`` that lie in a range from ``first`` to before ``last``."""
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, first, 1)
    np.add.at(steps, last, -1)
    return np.flatnonzero(np.cumsum(steps[:-1]))


def _placed(lot: Words, at: np.ndarray, *more: np.ndarray) -> tuple[np.ndarray, ...]:
    """Number of the text, start, stop, d1, d2 of the windows that begin at the words ``at``, and more."""
    text = _texts_of(lot, at)
    start, stop, d1, d2 = _windows(lot.starts, lot.stops, lot.hashes, at)
    return text, start - lot.bytes_at[text], stop - lot.bytes_at[text], d1, d2, *more


def window_units(lot: Words, gone: np.ndarray) -> tuple[np.ndarray, ...]:
    """Windows of the texts of at least twice their size, but for those that lie
    MIN_WORDS - 1 words deep in the spans ``gone``: number of the text, start, stop,
    d1, d2, whether they touch one."""
    words = lot.hashes
    long = np.diff(lot.words_at) >= 2 * MIN_WORDS
    if not long.any():
        return *(np.zeros(0, np.int64) for _ in range(5)), np.zeros(0, bool)
    # The smallest hash of each MIN_WORDS neighbours, the leftmost if equal,
    # where as many words of the text follow.
    place = np.uint64((1 << 26) - 1)
    placed = (words & ~place) | np.arange(len(words), dtype=np.uint64)
    lowest = (_sliding_min(placed, MIN_WORDS) & place).astype(np.int64)
    lowest = lowest[_covered(lot.words_at[:-1][long], lot.words_at[1:][long] - 2 * MIN_WORDS + 2, len(lowest))]
    # Those deep in a span have no neighbour that is left.
    at, touched = _left(lot, lowest[np.append(True, lowest[1:] != lowest[:-1])], gone, MIN_WORDS - 1)
    return _placed(lot, at, touched)


def near_windows(lot: Words, begins: np.ndarray, gone: np.ndarray) -> tuple[np.ndarray, ...]:
    """All windows that begin less than MIN_WORDS words from those at the lot's bytes
    ``begins`` and are not wholly in the spans ``gone``: number of the text, start, stop,
    d1, d2, whether they touch a span, and whether it is one of those at ``begins``."""
    own = np.searchsorted(lot.starts, begins)
    text = _texts_of(lot, own)
    last = np.minimum(own + MIN_WORDS, lot.words_at[text + 1] - MIN_WORDS + 1)
    at = _covered(np.maximum(own - MIN_WORDS + 1, lot.words_at[text]), last, len(lot.starts))
    at, touched = _left(lot, at, gone)
    given = np.zeros(len(lot.starts), bool)
    given[own] = True
    return _placed(lot, at, touched, given[at])


def _line_rows(rows: DataFrame) -> DataFrame:
    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        names = [part.split()[0] for part in _LINE.split(", ")]
        texts = byte_texts(batch.column(2))
        for first, last in _lots(texts):
            at, *columns, odd, bands = line_units(texts[first:last])
            rows = pa.array(at + first)
            yield dict(zip(names, (batch.column(0).take(rows), batch.column(1).take(rows), *columns, _lists(odd), _lists(bands)), strict=True))

    return map_batches(rows.select("id", "text_hash", "text"), run, _LINE)


def _lists(rows: np.ndarray) -> pa.Array:
    """Rows of an array as a list column."""
    n, width = rows.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * width, pa.int32()), pa.array(rows.ravel()))


def _at_texts(rows: DataFrame, places: DataFrame, how: str) -> DataFrame:
    """Texts with what ``places`` has of their (id, text_hash), at most one row each."""
    named = places.withColumnsRenamed({"id": "at_id", "text_hash": "at_hash"})
    spans = sum((F.coalesce(F.size(c), F.lit(0)) for c in named.columns if c not in ("at_id", "at_hash")), F.lit(0))
    n_spans = named.agg(F.sum(spans)).head()[0] or 0
    side = F.broadcast(named) if n_spans <= BROADCAST_IDS else shuffled(named)
    return rows.join(side, F.expr("id <=> at_id AND text_hash = at_hash"), how).drop("at_id", "at_hash")


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Row number and value of everything in a list column; a struct is a row of its fields."""
    values = column.flatten()
    if pa.types.is_struct(values.type):
        return pc.list_parent_indices(column).to_numpy(), np.stack([f.to_numpy() for f in values.flatten()], axis=1).astype(np.int64)
    return pc.list_parent_indices(column).to_numpy(), values.to_numpy().astype(np.int64)


def _window_columns(texts: DataFrame, schema: str, units) -> DataFrame:
    """Rows of ``units(lot, *places of the columns after the text)`` for every (id, text_hash, text, ..)."""
    names = [part.split()[0] for part in schema.split(", ")]

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        more = [_flat(batch.column(i)) for i in range(3, batch.num_columns)]
        texts = byte_texts(batch.column(2))
        for first, last in _lots(texts):
            lot, places = _words(texts[first:last]), []
            for its, values in more:
                own = slice(*np.searchsorted(its, [first, last]))
                ahead = lot.bytes_at[its[own] - first]
                places.append(values[own] + ahead.reshape(-1, *[1] * (values.ndim - 1)))
            at, *found = units(lot, *places)
            rows = pa.array(at + first)
            yield dict(zip(names, (batch.column(0).take(rows), batch.column(1).take(rows), *found), strict=True))

    return map_batches(texts, run, schema)


def _window_rows(rows: DataFrame, gone: DataFrame) -> DataFrame:
    """Windows chosen by content; ``gone``: (id, text_hash, gone) removed paragraphs."""
    texts = _at_texts(rows.select("id", "text_hash", "text"), gone, "left")
    return _window_columns(texts, _WINDOW, window_units)


def _near_rows(rows: DataFrame, places: DataFrame, gone: DataFrame) -> DataFrame:
    """Windows near the given ones, with ``unit`` true for the given ones."""
    begins = places.groupBy("id", "text_hash").agg(F.collect_set("start").alias("begins"))
    spans = gone.toDF("g_id", "g_hash", "gone")
    begins = materialize(begins.join(shuffled(spans), F.expr("id <=> g_id AND text_hash = g_hash"), "left").drop("g_id", "g_hash"), "window-places")
    texts = _at_texts(rows.select("id", "text_hash", "text"), begins, "inner")
    return _window_columns(texts, f"{_WINDOW}, unit boolean", near_windows)


def _unit_texts(rows: DataFrame, sets: DataFrame, sids: DataFrame) -> DataFrame:
    """(sid, text) of the given distinct lines."""
    chosen = materialize(sets.join(shuffled(sids), "sid", "left_semi").selectExpr("sid", "rep.*"), "unit-places")
    chosen = chosen.toDF("sid", "rep_id", "rep_hash", "start", "stop")
    side = F.broadcast(chosen) if chosen.count() <= BROADCAST_IDS // 2 else shuffled(chosen)
    cut = rows.join(side, F.expr("id <=> rep_id AND text_hash = rep_hash")).selectExpr(
        "sid", "CAST(substring(CAST(text AS BINARY), start + 1, stop - start) AS STRING) AS text"
    )
    return materialize(cut.dropDuplicates(["sid"]), "unit-texts")


def repeated_units(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Units that repeat: id, text_hash, start, stop (bytes), component, unit,
    class_id, removed; ``component`` names its kept unit as (id, text_hash, start).
    Rows with ``unit`` false are windows that only extend a repeat to its ends."""
    rows = _rows(docs, id_col, text_col)
    lines = materialize(_line_rows(rows), "lines")
    sets = lines.groupBy("d1", "d2").agg(
        F.first("n").alias("n"), F.first("odd").alias("odd"), F.first("bands").alias("bands"), F.expr("min(struct(id, text_hash, start, stop)) AS rep"),
        F.count("*").alias("copies"),
    )
    sets = materialize(sets.withColumn("sid", F.monotonically_increasing_id()), "distinct-lines")
    entries = sets.selectExpr("sid", "n", "0 AS pos", "explode(array_distinct(bands)) AS token")
    odd = sets.selectExpr("sid", *(f"odd[{k}] AS odd{k}" for k in range(4)))
    labels = linked_sets(entries, lambda sids: _unit_texts(rows, sets, sids), WORDS, PERCENT, positions=False, odd=odd)
    named = sets.join(shuffled(labels), F.col("sid") == F.col("node"), "left").selectExpr(
        "d1", "d2", "coalesce(label, sid) AS label", "copies", "struct(rep.id, rep.text_hash, rep.start) AS first_place"
    )
    named = materialize(named, "named-lines")
    discard(sets)
    classes = named.groupBy("label").agg(F.sum("copies").alias("size"), F.min("first_place").alias("component"))
    classes = classes.filter("size > 1").withColumnRenamed("label", "of")
    answer = materialize(by_label(named, "label", "d1", classes).select("d1", "d2", "component"), "line-classes")
    discard(named)
    lines_out = lines.drop("n", "odd", "bands").join(shuffled(answer), ["d1", "d2"]).selectExpr(
        "id", "text_hash", "start", "stop", "component", "true AS unit", "'p' AS kind"
    )
    removed = "NOT (id <=> component.id AND text_hash = component.text_hash AND start = component.start)"
    gone = lines_out.filter(removed).groupBy("id", "text_hash").agg(F.expr(f"{_SPANS} AS gone"))
    gone = materialize(gone, "removed-paragraphs")

    place = "struct(id, text_hash, start)"
    windows = materialize(_window_rows(rows, gone), "windows")
    often = windows.groupBy("d1", "d2").agg(F.count("*").alias("copies"), F.expr("bool_or(NOT touched) AS whole"))
    often = materialize(often.filter("copies > 1 AND whole").select("d1", "d2"), "repeated-windows")
    again = materialize(windows.join(shuffled(often), ["d1", "d2"], "left_semi").select("id", "text_hash", "start").distinct(), "window-copies")
    discard(windows, often)
    near = materialize(_near_rows(rows, again, gone), "near-windows")
    kept = near.groupBy("d1", "d2").agg(F.count("*").alias("copies"), F.expr(f"min(IF(touched, NULL, {place})) AS component"))
    kept = materialize(kept.filter("copies > 1 AND component IS NOT NULL").drop("copies"), "kept-windows")
    windows_out = near.join(shuffled(kept), ["d1", "d2"]).selectExpr("id", "text_hash", "start", "stop", "component", "unit", "'w' AS kind")

    class_id = "concat(kind, coalesce(component.id, 'null'), ':', hex(component.text_hash), ':', component.start)"
    return lines_out.unionByName(windows_out).withColumns({"class_id": F.expr(class_id), "removed": F.expr(removed)}).drop("kind")


def removed_spans(repeated: DataFrame) -> DataFrame:
    """(id, text_hash, n_units, class_ids, spans) per document with repeated
    units; spans are (start, stop) of bytes to remove, merged and in order."""
    merge = """aggregate(array_sort(collect_set(IF(removed, struct(start, stop), NULL))), CAST(array() AS ARRAY<STRUCT<start: INT, stop: INT>>),
      (done, s) -> IF(size(done) > 0 AND element_at(done, -1).stop >= s.start,
        concat(slice(done, 1, size(done) - 1), array(named_struct('start', element_at(done, -1).start, 'stop', greatest(element_at(done, -1).stop, s.stop)))),
        concat(done, array(s))))"""
    return repeated.groupBy("id", "text_hash").agg(
        F.expr("CAST(size(collect_set(IF(unit, struct(start, stop), NULL))) AS BIGINT) AS n_units"),
        F.expr("array_sort(collect_set(IF(unit, class_id, NULL))) AS class_ids"),
        F.expr(f"{merge} AS spans"),
    )


def document_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_units, class_ids, spans) of every row, with empty arrays where nothing repeats."""
    spans = materialize(removed_spans(repeated_units(docs, id_col, text_col)), "spans").toDF("s_id", "s_hash", "n_units", "class_ids", "spans")
    joined = _rows(docs, id_col, text_col).drop("text").join(shuffled(spans), F.expr("id <=> s_id AND text_hash = s_hash"), "left")
    none = "CAST(array() AS ARRAY<STRUCT<start: INT, stop: INT>>)"
    return joined.selectExpr(
        "id", "coalesce(n_units, 0L) AS n_units", "coalesce(class_ids, CAST(array() AS ARRAY<STRING>)) AS class_ids",
        f"coalesce(spans, {none}) AS spans",
    )


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text) of every row, without the spans to remove."""
    spans = materialize(removed_spans(repeated_units(docs, id_col, text_col)), "spans").toDF("s_id", "s_hash", "n_units", "class_ids", "spans")
    joined = _rows(docs, id_col, text_col).join(shuffled(spans), F.expr("id <=> s_id AND text_hash = s_hash"), "left")

    def run(batch: pa.RecordBatch) -> dict:
        texts = []
        for text, gone in zip(byte_texts(batch.column(1)), batch.column(2).to_pylist(), strict=True):
            parts, at = [], 0
            for span in gone or []:
                parts.append(text[at : span["start"]])
                at = span["stop"]
            texts.append(b"".join([*parts, text[at:]]).decode())
        return {"id": batch.column(0), "text": texts}

    return map_batches(joined.select("id", "text", "spans"), run, "id long, text string")

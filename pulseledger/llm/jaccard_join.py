"""Exact n-gram Jaccard join with set-relation skipping.

Sets of word shingles link if intersection / union reaches a threshold t. Equal
sets are merged first. Shingles are ordered from rare to frequent by a count
sketch of fixed size (any order is correct; this one keeps index lists short), and
two sets can only link if they share one of their first n - ceil(t n) + 1
shingles. Two relations between sets then save work.

Index level: list entries carry set size and position. Entries are blocked by
size, so a set skips whole blocks that are too small or large, and an entry whose
position leaves too few shingles for the overlap that the sizes need is
skipped.

Answer level: every set is first compared with one head of its lists, and sets
that link are gathered in components. Lists within one component need no more
work. For the others the answers of a set Y are derived from those of a similar
set X whose overlaps are known: |Z & X| - |X - Y| <= |Z & Y| <= |Z & X| + |Y - X|.
Only pairs that these bounds leave open are compared. No link is lost, and no
group of near copies is compared pair by pair.

Defined cases: shingles are hashed to 64 bits. With fewer words than a shingle
the whole sequence is one; a null, empty or blank text has the empty set and links
with nothing. Rows with the same id are separate members.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_texts, map_batches, materialize, mix64, shingle_hashes, shuffled, word_hashes
from .components import by_label, components

SHINGLE_WORDS = 3
PERCENT = 90
# Size of the frequency sketch, whatever the corpus: 2**SKETCH_BITS counters.
SKETCH_BITS = 18
_CHUNK = 1 << 12
# Entries of a list among which one head is chosen.
HEAD_ENTRIES = 5_000
# Open pairs, in all and for each pair compared, from which on a round of the nearest
# pairs pays: its some 30 jobs take longer than to compare fewer pairs.
OPEN_PAIRS, OPEN_PER_COMPARED = 2_000_000, 10
# Ids up to this number are broadcast (about 110 bytes each) to pick texts without a shuffle.
BROADCAST_IDS = 1_000_000


def text_shingles(text: bytes, words: int = SHINGLE_WORDS) -> np.ndarray:
    return shingle_hashes(word_hashes(text.lower()), words)


def _cell(shingles: np.ndarray) -> np.ndarray:
    return (mix64(shingles ^ np.uint64(0x5851F42D4C957F2D)) >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)


def frequency_classes(rows: DataFrame, words: int) -> np.ndarray:
    """Frequency class of every sketch cell, from all texts.

    A task sums its texts in one array; chunks of these arrays are summed again
    as they stream by. The result has 2**SKETCH_BITS bytes at every corpus size.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << SKETCH_BITS, np.uint32)
        for batch in batches:
            cells = [_cell(text_shingles(t, words)) for t in byte_texts(batch.column(0))]
            if cells:
                total += np.bincount(np.concatenate(cells), minlength=len(total)).astype(np.uint32)
        chunks = total.reshape(-1, _CHUNK)
        yield pa.RecordBatch.from_pydict(
            {"chunk": pa.array(range(len(chunks)), pa.int32()), "counts": pa.array([c.tobytes() for c in chunks], pa.binary())}
        )

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if chunk not in sums:
                    sums[chunk] = np.zeros(_CHUNK, np.uint64)
                sums[chunk] += np.frombuffer(counts, np.uint32)
        # About ten classes for each doubling.
        classes = [np.minimum(np.log2(s + 1.0) * 6, 255).astype(np.uint8).tobytes() for s in sums.values()]
        yield pa.RecordBatch.from_pydict({"chunk": pa.array(list(sums), pa.int32()), "classes": pa.array(classes, pa.binary())})

    counted = rows.select("text").mapInArrow(count, "chunk int, counts binary")
    n_chunks = (1 << SKETCH_BITS) // _CHUNK
    summed = counted.repartition(n_chunks, "chunk").mapInArrow(add, "chunk int, classes binary")
    out = np.zeros((n_chunks, _CHUNK), np.uint8)
    for chunk, classes in summed.collect():  # one byte per cell
        out[chunk] = np.frombuffer(classes, np.uint8)
    return out.reshape(-1)


def _prefix(shingles: np.ndarray, classes: np.ndarray, percent: int) -> np.ndarray:
    """The rarest shingles, in order; as many as a link must share one of."""
    n = len(shingles)
    length = n - -(-percent * n // 100) + 1
    order = np.lexsort((shingles, classes[_cell(shingles)]))[:length]
    return shingles[order]


@dataclass(frozen=True)
class Sets:
    """``members``: (id, text_hash, digest, n) of every row; ``sets``: (digest,
    sid, n, prefix, rep_id, rep_hash) of every distinct set that can link."""

    members: DataFrame
    sets: DataFrame


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    rows = docs.selectExpr(f"CAST(`{id_col}` AS BIGINT) AS id", f"coalesce(`{text_col}`, '') AS text")
    return rows.withColumn("text_hash", F.expr("xxhash64(text)"))


def distinct_sets(rows: DataFrame, words: int, percent: int) -> Sets:
    classes = rows.sparkSession.sparkContext.broadcast(frequency_classes(rows, words))

    def run(batch: pa.RecordBatch) -> dict:
        digests, sizes, prefixes = [], [], []
        for text in byte_texts(batch.column(2)):
            shingles = text_shingles(text, words)
            digests.append(hashlib.blake2b(shingles.tobytes(), digest_size=16).digest())
            sizes.append(len(shingles))
            # Below this size not even a set with one shingle more is near enough.
            links = 100 * len(shingles) >= percent * (len(shingles) + 1)
            prefixes.append(_prefix(shingles, classes.value, percent).view(np.int64) if links else None)
        return {"id": batch.column(0), "text_hash": batch.column(1), "digest": digests, "n": sizes, "prefix": prefixes}

    found = map_batches(rows.select("id", "text_hash", "text"), run, "id long, text_hash long, digest binary, n int, prefix array<long>")
    found = materialize(found, "shingle-sets")
    merged = found.filter("n > 0").groupBy("digest").agg(
        F.first("n").alias("n"), F.first("prefix").alias("prefix"), F.min(F.struct("id", "text_hash")).alias("rep")
    )
    sets = merged.selectExpr(
        "digest", "monotonically_increasing_id() AS sid", "n", "prefix", "rep.id AS rep_id", "rep.text_hash AS rep_hash"
    )
    return Sets(found.drop("prefix"), materialize(sets, "distinct-sets"))


def candidate_texts(rows: DataFrame, sets: DataFrame, sids: DataFrame) -> DataFrame:
    """(sid, text) of the given sets, one text each."""
    chosen = materialize(
        sets.join(shuffled(sids), "sid", "left_semi").select("sid", "rep_id", "rep_hash"), "candidates"
    )
    side = F.broadcast(chosen) if chosen.count() <= BROADCAST_IDS else shuffled(chosen)
    found = rows.join(side, F.expr("id <=> rep_id AND text_hash = rep_hash")).select("sid", "text")
    return materialize(found.dropDuplicates(["sid"]), "candidate-texts")


def overlaps(pairs: DataFrame, texts: DataFrame, words: int) -> DataFrame:
    """(a, b, n_a, n_b, both) of (a, b) pairs, counted on the whole texts."""
    sides = pairs.select("a", "b").join(shuffled(texts.toDF("a", "text_a")), "a").join(shuffled(texts.toDF("b", "text_b")), "b")

    def run(batch: pa.RecordBatch) -> dict:
        known: dict[bytes, np.ndarray] = {}

        def shingles(text: bytes) -> np.ndarray:
            if text not in known:
                known[text] = text_shingles(text, words)
            return known[text]

        sets = [[shingles(t) for t in byte_texts(batch.column(i))] for i in (2, 3)]
        both = [len(np.intersect1d(x, y, assume_unique=True)) for x, y in zip(*sets, strict=True)]
        return {
            "a": batch.column(0), "b": batch.column(1), "n_a": [len(x) for x in sets[0]],
            "n_b": [len(y) for y in sets[1]], "both": both,
        }

    counted = map_batches(sides.select("a", "b", "text_a", "text_b"), run, "a long, b long, n_a int, n_b int, both int")
    return materialize(counted, "overlaps")


def _reaches(both: str, n_a: str, n_b: str, percent: int) -> str:
    return f"100 * ({both}) >= {percent} * ({n_a} + {n_b} - ({both}))"


def _odd_columns(entries: DataFrame) -> list[str]:
    return [c for c in entries.columns if c.startswith("odd")]


def _bits(odd: list[str]) -> str:
    """SQL for the number of bits that two sets differ in."""
    return " + ".join(f"bit_count({c}_a ^ {c}_b)" for c in odd) or "0"


def _may_link(odd: list[str], percent: int) -> str:
    """SQL that is false only for sets whose odd counts differ in more bits than sets that
    link have different shingles."""
    return f"{100 + percent} * ({_bits(odd)}) <= {100 - percent} * (n_a + n_b)"


def _shared(entries: DataFrame) -> DataFrame:
    """Entries of lists with two sets or more, with the list's length."""
    lengths = materialize(entries.groupBy("token").agg(F.count("*").alias("length")).filter("length > 1"), "lists")
    return materialize(entries.join(shuffled(lengths), "token"), "entries")


def _head_pairs(entries: DataFrame, percent: int) -> DataFrame:
    """Each set with that head which it shares most lists with."""
    part = f"CAST(pmod(xxhash64(token, sid), ceil(length / {HEAD_ENTRIES})) AS INT)"
    parts = entries.withColumn("part", F.expr(part))
    odd = _odd_columns(entries)
    heads = parts.groupBy("token", "part").agg(F.expr(f"min(struct({', '.join(['pos', 'n', 'sid', *odd])})) AS head"))
    pairs = parts.join(shuffled(heads), ["token", "part"]).selectExpr(
        "sid AS a", "n AS n_a", "head.sid AS b", "head.n AS n_b", *(f"{c} AS {c}_a" for c in odd), *(f"head.{c} AS {c}_b" for c in odd)
    )
    pairs = pairs.filter(f"a <> b AND 100 * least(n_a, n_b) >= {percent} * greatest(n_a, n_b) AND {_may_link(odd, percent)}")
    best = pairs.groupBy("a", "b").count().groupBy("a").agg(F.expr("max_by(b, struct(count, -b)) AS b"))
    return best.selectExpr("least(a, b) AS a", "greatest(a, b) AS b").distinct()


def _open_pairs(entries: DataFrame, labels: DataFrame, percent: int, positions: bool, within: bool) -> DataFrame:
    """Pairs that index-level skipping leaves; those in one component only if ``within``.

    (a, n_a, label_a, b, n_b, label_b, bits) with a not larger than b; ``bits``: how
    many of their odd counts differ.
    """
    odd = _odd_columns(entries)
    labelled = entries.join(shuffled(labels), F.col("sid") == F.col("node"), "left").selectExpr(
        "token", "sid", "n", "pos", *odd, "coalesce(label, sid) AS label"
    )
    if not within:
        labelled = materialize(labelled, "labelled")
        mixed = labelled.groupBy("token").agg(F.min("label").alias("low"), F.max("label").alias("high"))
        mixed = materialize(mixed.filter("low <> high").select("token"), "mixed-lists")
        labelled = labelled.join(shuffled(mixed), "token")
    # Sizes of a block differ by less than the threshold, so a set meets its own
    # block and the next one only.
    block = f"CAST(floor(ln(n) / ln({100 / percent!r})) AS INT)"
    left = labelled.withColumn("block", F.expr(block))
    left = materialize(left, "open-entries")
    names = ["n", "pos", "label", *odd]
    small = left.selectExpr("token AS t", "explode(array(block, block + 1)) AS block", "sid AS a", *(f"{c} AS {c}_a" for c in names))
    large = left.selectExpr("token", "block AS at", "sid AS b", *(f"{c} AS {c}_b" for c in names))
    needed = f"ceil({percent} * (n_a + n_b) / {100 + percent})"
    rest = f"least(n_a - pos_a, n_b - pos_b) >= {needed}" if positions else "true"
    apart = "true" if within else "label_a <> label_b"
    pairs = small.join(shuffled(large), F.expr("token = t AND block = at")).filter(
        f"{apart} AND (n_a < n_b OR n_a = n_b AND a < b) AND 100 * n_a >= {percent} * n_b AND {rest} AND {_may_link(odd, percent)}"
    ).withColumn("bits", F.expr(_bits(odd)))
    return pairs.groupBy("a", "b").agg(*[F.first(c).alias(c) for c in ("n_a", "n_b", "label_a", "label_b", "bits")])


def _joined_by_the_nearest(
    open_: DataFrame, n_compared: int, texts: DataFrame, words: int, percent: int
) -> tuple[list[DataFrame], DataFrame]:
    """Links that join components, and what of ``open_`` then still lies between two.

    In a round the open pair with the fewest different bits is compared for every
    component, and what links is joined, so the members of a group of near copies
    are not all compared with each other. Once few of these pairs link, or the open ones
    are few beside those compared last (``n_compared`` at first), they are left to be
    compared as a whole.
    """
    links, n_linked = [], n_compared
    while open_.count() > max(OPEN_PAIRS, OPEN_PER_COMPARED * n_compared) and 10 * n_linked >= n_compared:
        offered = open_.selectExpr("explode(array(label_a, label_b)) AS label", "struct(bits, a, b, label_a, label_b) AS pair")
        nearest = materialize(offered.groupBy("label").agg(F.min("pair").alias("pair")).select("pair.*").distinct(), "nearest-pairs")
        found = overlaps(nearest, texts, words)
        linked = materialize(found.filter(_reaches("both", "n_a", "n_b", percent)).select("a", "b"), "nearest-links")
        n_linked, n_compared = linked.count(), nearest.count()
        joined_ = nearest.join(shuffled(linked), ["a", "b"]).selectExpr("label_a AS a", "label_b AS b")
        merged = components(joined_).toDF("was", "now")
        left = open_.join(shuffled(found.selectExpr("a AS x", "b AS y")), F.expr("a = x AND b = y"), "left_anti")
        for label, part in (("label_a", "b"), ("label_b", "a")):
            left = by_label(left, label, part, merged, "left").withColumn(label, F.expr(f"coalesce(now, {label})")).drop("now")
        open_ = materialize(left.filter("label_a <> label_b"), "open-pairs")
        links.append(linked)
    return links, open_


def linked_sets(entries: DataFrame, texts_of, words: int, percent: int, positions: bool = True, odd: DataFrame | None = None) -> DataFrame:
    """(node, label) of the sets that link with another one."""
    return _linked(entries, texts_of, words, percent, positions, False, odd)[0]


def _linked(
    entries: DataFrame, texts_of, words: int, percent: int, positions: bool, within: bool, odd: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """(node, label) of the sets that link with another one, and (a, b) links:
    all of them if ``within``, else enough to connect the components.

    ``entries``: (token, sid, n, pos), two sets that link share a token;
    ``texts_of``: from a frame of sid to (sid, text); ``odd``: sid and bits odd0..
    of every set, two sets differ by as many shingles at least as by bits.
    """
    entries = _shared(entries)
    if odd is not None:
        entries = materialize(entries.join(shuffled(odd), "sid"), "entries-with-bits")
    heads = materialize(_head_pairs(entries, percent), "head-pairs")
    texts = texts_of(entries.select("sid").distinct())
    first = overlaps(heads, texts, words)
    near = first.filter(_reaches("both", "n_a", "n_b", percent))
    labels = components(near)

    open_ = _open_pairs(entries, labels, percent, positions, within)
    known = first.selectExpr("least(a, b) AS x", "greatest(a, b) AS y")
    open_ = open_.join(shuffled(known), F.expr("least(a, b) = x AND greatest(a, b) = y"), "left_anti")
    open_ = materialize(open_, "open-pairs")
    if odd is not None and not within:
        joins, open_ = _joined_by_the_nearest(open_, first.count(), texts, words, percent)
        for linked in joins:
            near = near.select("a", "b").union(linked)
        labels = components(near) if joins else labels
    if open_.isEmpty():
        return labels, near.select("a", "b")

    # A label is the smallest set of its component and serves as X for all of
    # its sets: overlaps of Z with X, and of Y with X.
    either = open_.selectExpr("a AS z", "label_b AS x", "b AS y").union(open_.selectExpr("b", "label_a", "a"))
    either = either.filter("x <> y")
    asked = either.select("z", "x").union(either.select("y", "x")).distinct()
    asked = asked.selectExpr("least(z, x) AS a", "greatest(z, x) AS b").filter("a <> b").distinct()
    pivot = overlaps(asked, texts, words)
    sides = pivot.selectExpr("a AS s", "b AS x", "n_b AS n_x", "both").union(pivot.selectExpr("b", "a", "n_a", "both"))
    zx, yx = (sides.toDF(f"s_{k}", f"x_{k}", f"n_x_{k}", f"both_{k}") for k in ("z", "y"))
    bounds = either.join(shuffled(zx), F.expr("z = s_z AND x = x_z")).join(shuffled(yx), F.expr("y = s_y AND x = x_y")).selectExpr(
        "least(z, y) AS p", "greatest(z, y) AS q", "both_z + both_y - n_x_z AS low", "both_z - both_y AS more", "y"
    )
    bounds = bounds.groupBy("p", "q").agg(
        F.max("low").alias("low"), F.expr("min(IF(y = p, more, NULL)) AS more_p"), F.expr("min(IF(y = q, more, NULL)) AS more_q")
    )
    judged = open_.join(shuffled(bounds), F.expr("least(a, b) = p AND greatest(a, b) = q"), "left")
    n_p, n_q = "IF(a = p, n_a, n_b)", "IF(a = p, n_b, n_a)"
    high = f"least(n_a, n_b, coalesce(more_p + {n_p}, n_a), coalesce(more_q + {n_q}, n_a))"
    judged = judged.selectExpr("a", "b", "n_a", "n_b", f"{high} AS high", "coalesce(low, 0) AS low")
    judged = materialize(judged.filter(_reaches("high", "n_a", "n_b", percent)), "judged")
    certain = _reaches("low", "n_a", "n_b", percent)
    second = overlaps(judged.filter(f"NOT ({certain})"), texts, words)
    links = near.select("a", "b").union(judged.filter(certain).select("a", "b")).union(
        second.filter(_reaches("both", "n_a", "n_b", percent)).select("a", "b")
    ).selectExpr("least(a, b) AS a", "greatest(a, b) AS b")
    return components(links), links


def _joined(docs: DataFrame, id_col: str, text_col: str, words: int, percent: int, within: bool) -> tuple[DataFrame, DataFrame]:
    rows = _rows(docs, id_col, text_col)
    found = distinct_sets(rows, words, percent)
    entries = found.sets.filter("prefix IS NOT NULL").selectExpr("sid", "n", "posexplode(prefix) AS (pos, token)")
    labels, links = _linked(entries, lambda sids: candidate_texts(rows, found.sets, sids), words, percent, True, within)
    named = found.sets.join(shuffled(labels), F.col("sid") == F.col("node"), "left").selectExpr(
        "digest", "sid", "coalesce(label, sid) AS label", "rep_id"
    )
    named = materialize(named, "named")
    lowest = named.groupBy("label").agg(F.min("rep_id").alias("component_id"))
    answer = materialize(
        by_label(named, "label", "sid", lowest.withColumnRenamed("label", "of")).selectExpr("digest AS set_digest", "sid", "component_id"),
        "answers",
    )
    members = found.members.join(shuffled(answer), F.col("digest") == F.col("set_digest"), "left").selectExpr(
        "id", "CAST(n AS BIGINT) AS n_shingles", "IF(n = 0, id, component_id) AS component_id", "sid AS set_id", "text_hash"
    )
    return members, links


def joined(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE_WORDS, percent: int = PERCENT
) -> DataFrame:
    """One row per input row: id, n_shingles, component_id (the smallest id
    reachable by links, its own included), set_id of its distinct set."""
    return _joined(docs, id_col, text_col, words, percent, False)[0]


def links(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE_WORDS, percent: int = PERCENT
) -> tuple[DataFrame, DataFrame]:
    """The rows of ``joined`` with n_links, and (a, b) set ids, a < b, of every
    pair of distinct sets that reaches the threshold. ``n_links`` is the number of
    other rows that a row links with, those of its own set included."""
    members, pairs = _joined(docs, id_col, text_col, words, percent, True)
    members, pairs = materialize(members, "members"), materialize(pairs, "links")
    sizes = materialize(members.filter("set_id IS NOT NULL").groupBy("set_id").count().toDF("s", "copies"), "set-sizes")
    both = pairs.union(pairs.select("b", "a")).toDF("s", "other")
    near = both.join(shuffled(sizes.toDF("other", "copies")), "other").select("s", "copies")
    counts = near.union(sizes).groupBy("s").agg((F.sum("copies") - 1).alias("n"))
    out = members.join(shuffled(counts), F.col("set_id") == F.col("s"), "left")
    return out.select(*members.columns, F.expr("coalesce(n, 0L) AS n_links")), pairs


def one_per_component(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows with the smallest id of their component, with all columns."""
    kept = joined(docs, id_col, text_col, **options).filter("id <=> component_id").selectExpr("id", "text_hash").distinct()
    kept = materialize(kept, "kept-ids").toDF("kept_id", "kept_hash")
    names = docs.columns
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    id_, text = (f"c{names.index(c)}" for c in (id_col, text_col))
    mine = F.expr(f"CAST({id_} AS BIGINT) <=> kept_id AND xxhash64(coalesce({text}, '')) = kept_hash")
    return plain.join(shuffled(kept), mine, "left_semi").toDF(*names)

"""Hard-negative mining by the threshold algorithm.

Rows are dealt into shards and anchors into blocks; every pair of a shard and a
block is one group. Within it, each dimension has a list of the shard's rows
sorted by that component. An anchor reads the lists in rounds, each from its high
end where the anchor's component is positive, from its low end where it is
negative. Rows that turn up are scored in full. No row that has not turned up
can score more than the threshold, the anchor's product with what the lists
hold at the depth reached, so an anchor stops once the threshold falls strictly
below its k-th best score (rows of equal score must be seen, as ties go by id).

The first pass finds an anchor's positives (lists of its own label), the second
its negatives: each positive's score gives a window of scores, and the search
stops once the threshold is below the k-th best score of every window, or below
the window. The best of all shards are merged by rank. A shard contributes at
most k rows to each list, so merging is bounded, and no row or pair is left out.

Scores are exact integers: products of scaled components, in float64 where it
holds them exactly, else as Python integers (scores past a long are cut to it).

Defined cases: rows with a null label, a null vector, or a null or non-finite
component take no part; missing components of shorter vectors count as 0. A
repeated id is a row of its own, also among its twin's candidates. A null id is
never an anchor and comes last among equal scores. Empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize

SHARD_ROWS = 32_768
SMALLEST_SHARD = 4_096
BLOCK_ANCHORS = 8_192
FIRST_DEPTH = 16
_EXACT = 2.0**53
_ROW = "id long, row long, label long, v array<long>"
_FOUND = "anchor_row long, anchor_id long, positive_row long, positive_id long, positive_score long, other_row long, other_id long, score long"


def usable_rows(vectors: DataFrame, id_col: str, vector_col: str, label: str, scale: int) -> DataFrame:
    """(row, id, label, v): scaled whole components of the rows that take part.

    ``label`` is SQL over the row.
    """
    v = f"`{vector_col}`"
    rows = vectors.filter(f"({label}) IS NOT NULL AND {v} IS NOT NULL").filter(
        f"forall({v}, x -> x IS NOT NULL AND NOT isnan(x) AND abs(CAST(x AS DOUBLE)) < double('infinity'))"
    )
    return rows.selectExpr(
        "monotonically_increasing_id() AS row",
        f"CAST(`{id_col}` AS BIGINT) AS id",
        f"CAST({label} AS BIGINT) AS label",
        f"transform({v}, x -> floor(CAST(x AS DOUBLE) * {scale}D)) AS v",
    )


def _matrix(lists: list) -> np.ndarray:
    """Rows of components; float64 if all products of them are exact in it."""
    width = max(map(len, lists), default=0)
    out = np.zeros((len(lists), width), dtype=object)
    if all(len(x) == width for x in lists):
        out = np.array(lists, dtype=np.int64).reshape(len(lists), width)
    else:
        for i, x in enumerate(lists):
            out[i, : len(x)] = x
    largest = float(np.abs(out.astype(np.float64)).max(initial=0))
    return out.astype(np.float64 if width * largest * largest < _EXACT else object)


class SortedLists:
    """For each dimension, the rows of a matrix by ascending component."""

    def __init__(self, matrix: np.ndarray):
        self.matrix = matrix
        self.order = np.argsort(matrix, axis=0, kind="stable").T.astype(np.int32)
        self.values = np.take_along_axis(matrix, self.order.T.astype(np.int64), axis=0).T

    def rounds(self, anchor: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
        """(rows first seen, their scores, bound of all rows not yet seen).

        The depth doubles from round to round; the last round sees every row.
        """
        n = len(self.matrix)
        up, down = np.flatnonzero(anchor > 0), np.flatnonzero(anchor < 0)
        if not len(up) and not len(down):
            yield np.arange(n), self.matrix @ anchor, -np.inf
            return
        seen = np.zeros(n, bool)
        depth = 0
        while depth < n:
            reach = min(n, max(FIRST_DEPTH, 2 * depth))
            met = np.zeros(n, bool)
            met[self.order[up, n - reach : n - depth].ravel()] = True
            met[self.order[down, depth:reach].ravel()] = True
            new = np.flatnonzero(met & ~seen)
            seen[new] = True
            bound = -np.inf
            if reach < n:
                bound = self.values[up, n - reach] @ anchor[up] + self.values[down, reach - 1] @ anchor[down]
            yield new, self.matrix[new] @ anchor, bound
            depth = reach


def _kth(scores: np.ndarray, k: int):
    """The k-th largest score, or less than any if there are fewer."""
    if len(scores) < k:
        return -np.inf
    return np.partition(scores, len(scores) - k)[len(scores) - k] if scores.dtype != object else sorted(scores)[-k]


def threshold_search(lists: SortedLists, anchor: np.ndarray, eligible: np.ndarray, windows: list[tuple], k: int) -> list[tuple]:
    """For each window (lowest, highest score): rows that include its k best, and their scores.

    Rows of equal score are all there down to the k-th best.
    """
    kept = [(np.zeros(0, np.int64), np.zeros(0, lists.matrix.dtype)) for _ in windows]
    open_ = {i for i, (low, high) in enumerate(windows) if low <= high}
    for new, scores, bound in lists.rounds(anchor) if open_ else ():
        fits = eligible[new]
        new, scores = new[fits], scores[fits]
        for i in list(open_):
            low, high = windows[i]
            inside = (scores >= low) & (scores <= high)
            rows, found = np.concatenate([kept[i][0], new[inside]]), np.concatenate([kept[i][1], scores[inside]])
            kth = _kth(found, k)
            best = found >= kth
            kept[i] = rows[best], found[best]
            if bound < kth or bound < low:
                open_.discard(i)
        if not open_:
            break
    return kept


def _best(rows: np.ndarray, scores: np.ndarray, ids: list, k: int) -> list[tuple[int, int]]:
    """(row, score) of the k best: higher scores, then smaller ids, null last."""
    ranked = sorted(zip(rows.tolist(), scores.tolist()), key=lambda x: (-x[1], ids[x[0]] is None, ids[x[0]] or 0, x[0]))
    return ranked[:k]


def _long(score) -> int:
    return int(max(-(2**63), min(2**63 - 1, int(score))))


def _dealt(rows: DataFrame, anchors: DataFrame, n_shards: int, n_blocks: int) -> DataFrame:
    """Rows and anchors of every pair of a shard and a block."""
    shard, block = f"pmod(hash(row), {n_shards})", f"pmod(hash(row, 1), {n_blocks})"
    left = rows.selectExpr("*", "false AS is_anchor", "CAST(NULL AS ARRAY<STRUCT<row: BIGINT, id: BIGINT, score: BIGINT>>) AS positives",
                           f"{shard} AS shard", f"explode(sequence(0, {n_blocks - 1})) AS block")
    right = anchors.selectExpr("*", "true AS is_anchor", f"explode(sequence(0, {n_shards - 1})) AS shard", f"{block} AS block")
    return left.unionByName(right)


def _table(found: list[tuple]) -> pa.Table:
    names = [c.split()[0] for c in _FOUND.split(", ")]
    columns = zip(*found) if found else [[] for _ in names]
    return pa.table({n: pa.array(list(c), pa.int64()) for n, c in zip(names, columns)})


def _split(table: pa.Table) -> tuple[list, list, list, np.ndarray, list[dict]]:
    """Candidates as (rows, ids, labels, matrix), and the anchors with their vectors."""
    table = table.select(["row", "id", "label", "v", "is_anchor", "positives"])
    every = table.to_pydict()
    matrix = _matrix(every["v"])
    at = [i for i, a in enumerate(every["is_anchor"]) if not a]
    anchors = [
        {"row": every["row"][i], "id": every["id"][i], "label": every["label"][i], "v": matrix[i], "positives": every["positives"][i] or []}
        for i, a in enumerate(every["is_anchor"])
        if a
    ]
    return [every["row"][i] for i in at], [every["id"][i] for i in at], [every["label"][i] for i in at], matrix[at], anchors


def _positives_of(k: int):
    def run(table: pa.Table) -> pa.Table:
        rows, ids, labels, matrix, anchors = _split(table)
        places = {}
        for i, label in enumerate(labels):
            places.setdefault(label, []).append(i)
        found = []
        for label, own in places.items():
            wanted = [a for a in anchors if a["label"] == label]
            if not wanted:
                continue
            lists = SortedLists(matrix[own])
            own_rows, own_ids = np.array([rows[i] for i in own]), [ids[i] for i in own]
            for a in wanted:
                [(at, scores)] = threshold_search(lists, a["v"], own_rows != a["row"], [(-np.inf, np.inf)], k)
                for i, score in _best(at, scores, own_ids, k):
                    found.append((a["row"], a["id"], None, None, None, int(own_rows[i]), own_ids[i], _long(score)))
        return _table(found)

    return run


def _negatives_of(k: int, low: int, high: int):
    def run(table: pa.Table) -> pa.Table:
        rows, ids, labels, matrix, anchors = _split(table)
        lists, labels = SortedLists(matrix), np.array(labels)
        found = []
        for a in anchors:
            windows = [(-(-low * p["score"] // 100), high * p["score"] // 100) for p in a["positives"]]
            kept = threshold_search(lists, a["v"], labels != a["label"], windows, k)
            for p, (at, scores) in zip(a["positives"], kept):
                for i, score in _best(at, scores, ids, k):
                    found.append((a["row"], a["id"], p["row"], p["id"], p["score"], rows[i], ids[i], _long(score)))
        return _table(found)

    return run


def _ranked(found: DataFrame, keys: str, k: int) -> DataFrame:
    order = f"PARTITION BY {keys} ORDER BY score DESC, other_id ASC NULLS LAST, other_row"
    return found.selectExpr("*", f"row_number() OVER ({order}) AS rank").filter(f"rank <= {k}")


def _grid(n_rows: int, n_anchors: int, n_tasks: int) -> tuple[int, int]:
    """Numbers of shards and blocks; more, smaller shards where few rows would leave tasks idle."""
    shards = max(-(-n_rows // SHARD_ROWS), min(n_tasks, -(-n_rows // SMALLEST_SHARD)), 1)
    return shards, max(-(-n_anchors // BLOCK_ANCHORS), 1)


def hard_negatives(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label: str = "label",
    anchors_where: str = "id % 100 = 0",
    n_positives: int = 5,
    n_negatives: int = 10,
    low_percent: int = 30,
    high_percent: int = 90,
    scale: int = 256,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``label`` is SQL over the table's row; ``anchors_where`` over its id. A
    negative has another label than the anchor and a score of ``low_percent`` to
    ``high_percent`` of the positive's.
    """
    spark = vectors.sparkSession
    rows = materialize(usable_rows(vectors, id_col, vector_col, label, scale), "vectors")
    anchors = rows.filter(anchors_where)
    n_shards, n_blocks = _grid(rows.count(), anchors.count(), int(spark.conf.get("spark.sql.shuffle.partitions")))

    none = anchors.withColumn("positives", F.expr("CAST(NULL AS ARRAY<STRUCT<row: BIGINT, id: BIGINT, score: BIGINT>>)"))
    dealt = _dealt(rows, none, n_shards, n_blocks)
    near = dealt.groupBy("shard", "block").applyInArrow(_positives_of(n_positives), _FOUND)
    best = _ranked(near, "anchor_row", n_positives)
    positives = best.groupBy("anchor_row").agg(F.expr("collect_list(struct(other_row AS row, other_id AS id, score)) AS positives"))
    asking = materialize(anchors.join(positives, F.expr("row = anchor_row")).drop("anchor_row"), "positives")

    far = _dealt(rows, asking, n_shards, n_blocks).groupBy("shard", "block")
    found = far.applyInArrow(_negatives_of(n_negatives, low_percent, high_percent), _FOUND)
    ranked = _ranked(found, "anchor_row, positive_row", n_negatives)
    return ranked.selectExpr("anchor_id", "positive_id", "rank", "other_id AS negative_id", "positive_score", "score AS negative_score")

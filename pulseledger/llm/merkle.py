"""Merkle manifest of a data set, by nested-interval labels.

Leaves are digests of rows, numbered per group; a node is labelled with the
interval of leaf numbers it covers. ``FANOUT`` neighbours make a node while a
group has more than one. The groups' top nodes are the leaves of a last tree.

Ancestors are attached from the top down, one level at a time: a node joins the
node of the next level in its bucket (its first leaf number divided by that
level's width) whose interval contains its own. What the parent's interval has
left of and right of the node's interval are its siblings; they and what the
parent brought along are the node's way to the root. A leaf's proof and the
root folded from a changed leaf follow from its way alone.

Leaf numbers come from a range-partitioned sort: the place in a task's rows
plus the group's rows of earlier tasks. So a group with a third of all rows is
spread over many tasks, and every other group here has ``FANOUT`` rows at most.

Defined cases: a null group is a group of its own and comes first; rows of
equal id, and rows without an id (first in their group), follow in the order of
their digests. Repeated rows are leaves of their own. A group of one row has the
leaf itself as its top. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize

FANOUT = 16


def field_text(column: str) -> str:
    """SQL of a value as length and text; null is a dash."""
    text = f"CAST({column} AS STRING)"
    return f"IF({column} IS NULL, '-', concat(CAST(octet_length({text}) AS STRING), ':', {text}))"


def leaf_digest(columns: Sequence[str]) -> str:
    """SQL of the digest of a row."""
    return f"sha2(concat({', '.join(map(field_text, columns))}), 256)"


def numbered(rows: DataFrame, group: str, order: Sequence[str], name: str) -> DataFrame:
    """``rows`` with ``rank`` (from 0 within the group) and ``total`` (rows of it)."""
    keys = [group, *order]
    # In each task's sorted rows the generated id is the task's number (upper
    # bits) and the place in it; written once, so the order is fixed.
    spread = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = materialize(spread.withColumn("place", F.monotonically_increasing_id()), name)
    task = F.expr("shiftright(place, 33) AS task")
    spans = placed.groupBy(F.col(group).alias("span_group"), task).agg(F.count("*").alias("n"), F.min("place").alias("first_place"))
    spans = spans.selectExpr(
        "*",
        "coalesce(sum(n) OVER (PARTITION BY span_group ORDER BY task ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0L) AS earlier",
        "sum(n) OVER (PARTITION BY span_group) AS total",
    )
    return placed.join(spans, F.expr(f"{group} <=> span_group AND shiftright(place, 33) = task")).selectExpr(
        *rows.columns, "earlier + place - first_place AS rank", "total"
    )


def _parents(nodes: DataFrame, level: int) -> DataFrame:
    """Nodes of ``level`` from those of the level below, with their children."""
    width = FANOUT**level
    several = nodes.filter(f"total > {width // FANOUT}")
    runs = several.groupBy("node_group", F.expr(f"lo div {width}L AS bucket"), "total").agg(
        F.expr("array_sort(collect_list(struct(lo, hi, digest))) AS children")
    )
    return runs.selectExpr(
        "node_group", "total", "children[0].lo AS lo", "children[size(children) - 1].hi AS hi",
        "sha2(array_join(transform(children, c -> c.digest), ''), 256) AS digest", "children",
    )


def _with_ancestors(nodes: DataFrame, above: DataFrame, level: int) -> DataFrame:
    """Join nodes to the nodes ``above`` them, which lie on ``level``.

    ``way`` lists, from the node to the root, what lies left and right of it.
    """
    width = FANOUT**level
    parent = above.select(*[F.col(c).alias(f"parent_{c}") for c in ("node_group", "lo", "hi", "children", "way", "top")])
    inside = f"""node_group <=> parent_node_group AND lo div {width}L = parent_lo div {width}L
        AND lo >= parent_lo AND hi <= parent_hi"""

    def outside(test: str) -> str:
        return f"array_join(transform(filter(parent_children, c -> {test}), c -> c.digest), '')"

    return nodes.join(parent, F.expr(inside)).selectExpr(
        *nodes.columns,
        f"concat(array(struct({outside('c.hi < lo')} AS `left`, {outside('c.lo > hi')} AS `right`)), parent_way) AS way",
        "parent_top AS top",
    )


def _levels(leaves: DataFrame, largest: int, name: str) -> list[DataFrame]:
    """Nodes by level, the leaves (node_group, total, lo, hi, digest) first."""
    levels = [leaves]
    while FANOUT ** (len(levels) - 1) < largest:
        levels.append(materialize(_parents(levels[-1], len(levels)), f"{name}-{len(levels)}"))
    return levels


def _tops(levels: Sequence[DataFrame]) -> DataFrame:
    """The node of each group that covers it whole: (node_group, digest, level, total)."""
    found = [
        nodes.filter(f"total <= {FANOUT**k}" + (f" AND total > {FANOUT ** (k - 1)}" if k else "")).selectExpr("node_group", "digest", "total")
        for k, nodes in enumerate(levels)
    ]
    return reduce(DataFrame.unionByName, found)


def _attached(levels: Sequence[DataFrame], tops: DataFrame) -> DataFrame:
    """The leaves with their ways; ``tops`` has (top_group, way, top) of each group."""
    above = None
    for k in range(len(levels) - 1, -1, -1):
        nodes = levels[k]
        highest = nodes.filter(f"total <= {FANOUT**k}" + (f" AND total > {FANOUT ** (k - 1)}" if k else ""))
        found = highest.join(tops, F.expr("node_group <=> top_group")).select(*nodes.columns, "way", "top")
        if above is not None:
            found = found.unionByName(_with_ancestors(nodes.filter(f"total > {FANOUT**k}"), above, k + 1))
        above = found
    return above


def _as_leaves(ranked: DataFrame, group: str, digest: str, *more: str) -> DataFrame:
    return ranked.selectExpr(f"{group} AS node_group", "total", "rank AS lo", "rank AS hi", f"{digest} AS digest", *more)


def _largest(leaves: DataFrame) -> int:
    return leaves.agg(F.max("total")).first()[0] or 0


def manifest(leaves: DataFrame) -> DataFrame:
    """Tree over (group_key, id, leaf, and any further columns).

    Adds subroot, root, and ``way``: structs (left, right) from the leaf up.
    """
    more = [c for c in leaves.columns if c not in ("group_key", "leaf")]
    ranked = numbered(leaves, "group_key", ["id", "leaf"], "leaves")
    bottom = _as_leaves(ranked, "group_key", "leaf", *more)
    levels = _levels(bottom, _largest(ranked), "nodes")

    subroots = _tops(levels).selectExpr("node_group AS source_group", "digest", "0 AS whole")
    order = numbered(subroots, "whole", ["source_group"], "subroot-order")
    upper = _levels(_as_leaves(order, "whole", "digest", "source_group"), _largest(order), "upper")
    one = _tops(upper).selectExpr(
        "node_group AS top_group", "CAST(array() AS ARRAY<STRUCT<`left`: STRING, `right`: STRING>>) AS way", "digest AS top"
    )
    placed = _attached(upper, one)
    tops = materialize(placed.selectExpr("source_group AS top_group", "way", "named_struct('subroot', digest, 'root', top) AS top"), "tops")
    return _attached(levels, tops).selectExpr("node_group AS group_key", "digest AS leaf", *more, "top.subroot", "top.root", "way")


def proof_digest(way: str = "way") -> str:
    """SQL of the digest of all siblings, level by level, left to right."""
    return f"sha2(array_join(transform({way}, s -> concat(s.`left`, s.`right`)), ''), 256)"


def folded_root(leaf: str, way: str = "way") -> str:
    """SQL of the root that a leaf and the siblings on its way give."""
    return f"aggregate({way}, {leaf}, (node, s) -> sha2(concat(s.`left`, node, s.`right`), 256))"


def verified_manifest(
    docs: DataFrame, group_col: str, id_col: str, columns: Sequence[str], changed: dict[str, str], changed_where: str
) -> DataFrame:
    """Manifest of ``docs`` checked against rows of which some were changed.

    ``columns`` are the fields of a leaf. Where ``changed_where`` holds (an
    expression over the row), the fields in ``changed`` have another value.
    Returns id, leaf, subroot, root, proof_sha256, folded_root, verified.
    """
    names = {c: f"`{c}`" for c in columns}
    rows = docs.selectExpr(
        f"`{group_col}` AS group_key",
        f"`{id_col}` AS id",
        f"{leaf_digest(list(names.values()))} AS leaf",
        f"IF({changed_where}, {leaf_digest([changed.get(c, n) for c, n in names.items()])}, NULL) AS changed_leaf",
    )
    folded = manifest(rows).selectExpr(
        "id", "leaf", "subroot", "root", f"{proof_digest()} AS proof_sha256", f"{folded_root('coalesce(changed_leaf, leaf)')} AS folded_root"
    )
    return folded.selectExpr("*", "folded_root = root AS verified")

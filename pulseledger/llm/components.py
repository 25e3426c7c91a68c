"""Connected components of a link table, by label contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, shuffled

# A component may hold a third of all nodes, so what is looked up by label is dealt by label and part.
PARTS = 32


def by_label(rows: DataFrame, label: str, part: str, values: DataFrame, how: str = "inner") -> DataFrame:
    """``rows`` joined by their column ``label`` with ``values``, whose first column
    is the label, one row each; ``part`` is a column that spreads a label's rows."""
    key = values.columns[0]
    parts = values.withColumn("to_part", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))))
    spread = rows.withColumn("its_part", F.expr(f"pmod(xxhash64({part}), {PARTS})"))
    found = spread.join(shuffled(parts), (F.col(label) == F.col(key)) & F.expr("its_part = to_part"), how)
    return found.drop("its_part", "to_part", key)


def components(links: DataFrame) -> DataFrame:
    """(node, label) of every node of the (a, b) links; the label is the
    smallest node of its component.

    Each round points every node at the smallest label next to it, then
    shortens the paths. A node's links meet as minima, combined on the map
    side, so a hub with many links is no hot spot, and the number of rounds grows
    with the logarithm of the longest chain. Every round is written.
    """
    both = links.select("a", "b").union(links.select(F.col("b"), F.col("a"))).toDF("node", "other")
    edges = materialize(both.filter("node <> other").distinct(), "edges")
    labels = materialize(
        edges.groupBy("node").agg(F.min("other").alias("low")).selectExpr("node", "least(node, low) AS label"), "labels"
    )
    while True:
        # Smallest label around each label's nodes: roots hook onto smaller roots.
        of = labels.toDF("at", "its_label")
        seen = edges.join(shuffled(of), F.col("other") == F.col("at")).groupBy("node").agg(F.min("its_label").alias("near"))
        offered = labels.join(shuffled(seen), "node").groupBy("label").agg(F.min("near").alias("near"))
        hooks = materialize(offered.filter("near < label").selectExpr("label AS root", "near AS target"), "hooks")
        moved = by_label(labels, "label", "node", hooks, "left").selectExpr("node", "label AS old", "coalesce(target, label) AS label")
        moved = materialize(moved, "hooked")
        # Follow the label's own label, where it has another one: paths halve.
        of = moved.filter("node <> label").selectExpr("node AS at", "label AS its_label")
        of = materialize(of.join(shuffled(moved.select("label").distinct()), F.expr("at = label"), "left_semi"), "labels-of-labels")
        jumped = by_label(moved, "label", "node", of, "left").selectExpr(
            "node", "old", "least(label, coalesce(its_label, label)) AS label"
        )
        jumped = materialize(jumped, "labels")
        if jumped.filter("label <> old").isEmpty():
            return jumped.select("node", "label")
        labels = jumped.select("node", "label")

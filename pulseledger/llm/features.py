"""Labelled samples and sparse features for the two text classifiers."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_texts, map_batches, materialize


def in_fold(id_col: str, folds: int) -> str:
    """SQL for the fold of an id: crc32 of its decimal text."""
    return f"pmod(crc32(CAST(`{id_col}` AS STRING)), {folds})"


def labelled_sample(
    docs: DataFrame,
    labels: DataFrame,
    label: str,
    keep: str,
    at_most: int,
    featurize: Callable[[bytes], bytes],
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(id, label, features) of labelled documents to learn from.

    At most ``at_most`` labels are used, those with the smallest hash of the
    id; this bounds what is broadcast and what one task learns from. ``keep``
    is an SQL condition on the label's id. Null ids or labels are left out.
    """
    usable = labels.selectExpr(f"`{id_col}` AS label_id", f"CAST(`{label}` AS INT) AS label").filter(
        f"label_id IS NOT NULL AND label IS NOT NULL AND ({keep.format(id='label_id')})"
    )
    first = usable.groupBy("label_id").agg(F.max("label").alias("label"))
    chosen = first.orderBy(F.expr("xxhash64(label_id)"), "label_id").limit(at_most)
    chosen = materialize(chosen, "labels")
    texts = docs.selectExpr(f"`{id_col}` AS id", f"`{text_col}` AS text").join(
        F.broadcast(chosen), F.expr("id = label_id")
    )

    def run(batch: pa.RecordBatch) -> dict:
        return {
            "id": batch.column(0),
            "label": batch.column(2),
            "features": [featurize(t) for t in byte_texts(batch.column(1))],
        }

    return map_batches(texts.selectExpr("CAST(id AS BIGINT) AS id", "text", "label"), run, "id long, label int, features binary")


def learn(sample: DataFrame, fit: Callable[[list[int], list[bytes]], bytes]) -> bytes:
    """Fit on the bounded sample in one task, in a fixed order of rows."""

    def run(batches):
        rows = sorted(
            {
                row
                for b in batches
                for row in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True)
            }
        )
        model = fit([r[1] for r in rows], [r[2] for r in rows])
        yield pa.RecordBatch.from_pydict({"model": pa.array([model], pa.binary())})

    return sample.repartition(1).mapInArrow(run, "model binary").head()[0]


def score_documents(
    docs: DataFrame, score: Callable[[bytes], float], id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, score) of every row."""

    def run(batch: pa.RecordBatch) -> dict:
        return {"id": batch.column(0), "score": [score(t) for t in byte_texts(batch.column(1))]}

    return map_batches(docs.selectExpr(f"CAST(`{id_col}` AS BIGINT) AS id", f"`{text_col}` AS text"), run, "id long, score double")


def sigmoid(x: float) -> float:
    return float(1.0 / (1.0 + np.exp(-np.clip(x, -35.0, 35.0))))


def below(docs: DataFrame, score: Callable[[bytes], float], threshold: float, text_col: str = "text") -> DataFrame:
    """The rows whose text scores below ``threshold``, with all their columns."""
    at = docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            keep = [score(t) < threshold for t in byte_texts(batch.column(at))]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)

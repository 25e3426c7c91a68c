"""One query for each operator over the test tables, with SQL twins where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (
    byte_bpe,
    exact_dedup,
    features,
    fingerprints,
    hard_negatives,
    jaccard_join,
    line_dedup,
    merkle,
    mixing,
    quality,
    sentencepiece_bpe,
    substring_dedup,
    suffix_dedup,
    toxicity,
)
from .common import LOWER, UPPER, documents, prepare

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def _query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def piece_model() -> str:
    """Path of the public BPE model that the queries use."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@_query
def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded text of every document, as digests."""
    return sentencepiece_bpe.round_trips(documents(spark, sf_dir), piece_model()).withColumnRenamed("id", "doc_id")


@_query
def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group and survivor of every document."""
    return exact_dedup.duplicate_groups(documents(spark, sf_dir)).withColumnRenamed("id", "doc_id")


_SAME = f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')"
ORACLE_SQL["op6_exact_dedup"] = f"""SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  row_number() OVER (PARTITION BY {_SAME} ORDER BY doc_id DESC) = 1 AS kept, sha256({_SAME}) AS text_sha256
  FROM documents WINDOW same AS (PARTITION BY {_SAME})"""


@_query
def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of every document."""
    report = mixing.mix_report(mixing.plan_mix(documents(spark, sf_dir)))
    return report.selectExpr("id AS doc_id", "size", "source_size", "target", "taken", "shards")


def _scored(spark: SparkSession, sf_dir: str, classifier, folds: int, held: int) -> DataFrame:
    """Scores of all documents by a model learnt outside fold ``held``."""
    docs = documents(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = classifier.train(docs, labels, f"{features.in_fold('{id}', folds).replace('`', '')} <> {held}")
    return classifier.score(docs, model).selectExpr(
        "id AS doc_id",
        f"{features.in_fold('id', folds)} = {held} AS held_out",
        "score",
        f"CAST(score >= {classifier.THRESHOLD} AS INT) AS predicted",
    )


@_query
def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document; fold 0 of 5 is held out."""
    return _scored(spark, sf_dir, quality, 5, 0)


@_query
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document; fold 1 of 3 is held out."""
    return _scored(spark, sf_dir, toxicity, 3, 1)


@_query
def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its half-replaced text."""
    return fingerprints.edits(documents(spark, sf_dir)).withColumnRenamed("id", "doc_id")


@_query
def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines found in ten documents or more."""
    docs = documents(spark, sf_dir)
    kept = line_dedup.LineIndex.build(docs).kept_lines(docs)
    return kept.selectExpr("id AS doc_id", "n_lines", "n_dropped", "sha2(text, 256) AS kept_sha256")


ORACLE_SQL["op4_line_dedup"] = f"""WITH lines AS (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
           generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS n FROM documents),
  keyed AS (SELECT *, translate(trim(line, chr(32) || chr(9) || chr(11) || chr(12) || chr(13)), '{UPPER}', '{LOWER}') AS key FROM lines),
  common AS (SELECT key FROM keyed WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
  SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE key IN (FROM common)) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (WHERE key NOT IN (FROM common)), '')) AS kept_sha256
  FROM keyed GROUP BY doc_id"""


@_query
def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component and number of links of every document under Jaccard links of 0.9."""
    answer, _ = jaccard_join.links(documents(spark, sf_dir))
    return answer.selectExpr("id AS doc_id", "n_shingles", "component_id", "n_links")


@_query
def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of repeated paragraphs and passages of every document, and what goes from it."""
    spans = substring_dedup.document_classes(documents(spark, sf_dir))
    removed = "aggregate(spans, 0L, (n, s) -> n + s.stop - s.start)"
    return spans.selectExpr(
        "id AS doc_id", "n_units AS n_repeated", "CAST(size(spans) AS BIGINT) AS n_spans", f"{removed} AS n_bytes_removed", "spans", "class_ids"
    )


@_query
def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the 200-byte strings that occur more than once."""
    kept = suffix_dedup.without_repeats(documents(spark, sf_dir))
    return kept.selectExpr("id AS doc_id", "n_bytes", "n_removed", "n_spans", "sha2(kept, 256) AS kept_sha256")


@_query
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector; some labels are moved on by one first."""
    vectors = prepare(spark).read.parquet(f"{sf_dir}/embeddings.parquet")
    return hard_negatives.hard_negatives(vectors, label="IF(vec_id % 7 = 0, (label + 1) % 10, label)")


ORACLE_SQL["op11_hard_negatives"] = """WITH v AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
      list_transform(embedding, lambda x: floor(CAST(x AS DOUBLE) * 256)) AS v
    FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
  s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
    FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
  p AS (SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5),
  n AS (SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) AS INTEGER) AS rank,
      other_id AS negative_id, positive_score, score AS negative_score
    FROM p JOIN s USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score)
  SELECT * FROM n WHERE rank <= 10"""


@_query
def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level ids and decoded bytes of every document, as digests."""
    import public_tokenizers

    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return byte_bpe.round_trips(documents(spark, sf_dir), ranks, public_tokenizers.PATTERN).withColumnRenamed("id", "doc_id")


@_query
def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, proof and check of every document; in a fifth of them A-Z was lower-cased."""
    checked = merkle.verified_manifest(
        documents(spark, sf_dir),
        group_col="source",
        id_col="doc_id",
        columns=["doc_id", "source", "lang", "n_chars", "text"],
        changed={"text": f"translate(text, '{UPPER}', '{LOWER}')"},
        changed_where="crc32(CAST(doc_id AS STRING)) % 5 = 0",
    )
    return checked.withColumnRenamed("id", "doc_id")


def _merkle_sql(source_levels: int = 6, root_levels: int = 4) -> str:
    """The tree level by level, each document's place, folded node and siblings with it."""

    def field(c: str, value: str = "") -> str:
        value = value or f"CAST({c} AS VARCHAR)"
        return f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen({value}) || ':' || {value} END"

    def leaf(text: str = "") -> str:
        return "sha256(" + " || ".join([*map(field, ("doc_id", "source", "lang", "n_chars")), field("text", text)]) + ")"

    # The register of CRC-32: a byte is xor-ed in, then eight shifts (-1) follow.
    steps = """flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: [ord(c), -1, -1, -1, -1, -1, -1, -1, -1]))"""
    crc = f"""xor(list_reduce(list_prepend(4294967295::BIGINT, {steps}),
      lambda r, s: CASE WHEN s >= 0 THEN xor(r, s) WHEN r & 1 = 1 THEN xor(r >> 1, 3988292384::BIGINT) ELSE r >> 1 END), 4294967295::BIGINT)"""
    parts = [
        f"""d0 AS (SELECT doc_id, dense_rank() OVER (ORDER BY source NULLS FIRST) AS g, {leaf()} AS leaf,
          CASE WHEN ({crc}) % 5 = 0 THEN {leaf(f"translate(text, '{UPPER}', '{LOWER}')")} ELSE {leaf()} END AS cur, '' AS sibs FROM documents)""",
        "p0 AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM d0)",
        "n0 AS (SELECT g, pos, leaf AS digest, count(*) OVER (PARTITION BY g) AS n FROM p0)",
    ]

    def climb(first: int, last: int) -> None:
        for k in range(first, last):
            others = f"string_agg(n{k}.digest, '' ORDER BY n{k}.pos) FILTER (n{k}.pos <> p{k}.pos)"
            folded = f"string_agg(CASE WHEN n{k}.pos = p{k}.pos THEN p{k}.cur ELSE n{k}.digest END, '' ORDER BY n{k}.pos)"
            step = f"any_value(n{k}.n) = 1"
            more = "" if first == 0 else ", any_value(subroot) AS subroot"
            parts.append(
                f"""p{k + 1} AS (SELECT p{k}.row, any_value(doc_id) AS doc_id, any_value(leaf) AS leaf, p{k}.g, p{k}.pos // 16 AS pos{more},
                  CASE WHEN {step} THEN any_value(p{k}.cur) ELSE sha256({folded}) END AS cur,
                  any_value(sibs) || CASE WHEN {step} THEN '' ELSE coalesce({others}, '') END AS sibs
                  FROM p{k} JOIN n{k} ON p{k}.g = n{k}.g AND p{k}.pos // 16 = n{k}.pos // 16 GROUP BY p{k}.row, p{k}.g, p{k}.pos)"""
            )
            parts.append(
                f"""n{k + 1} AS (SELECT g, pos // 16 AS pos, count(*) OVER (PARTITION BY g) AS n,
                  CASE WHEN any_value(n) = 1 THEN any_value(digest) ELSE sha256(string_agg(digest, '' ORDER BY pos)) END AS digest
                  FROM n{k} GROUP BY g, pos // 16)"""
            )

    parts[1] = parts[1].replace("SELECT *,", "SELECT *, row_number() OVER () AS row,")
    climb(0, source_levels)
    top, end = source_levels, source_levels + 1 + root_levels
    parts.append(f"p{top + 1} AS (SELECT row, doc_id, leaf, 0 AS g, g - 1 AS pos, s.digest AS subroot, cur, sibs FROM p{top} JOIN n{top} s USING (g))")
    parts.append(f"n{top + 1} AS (SELECT 0 AS g, g - 1 AS pos, digest, count(*) OVER () AS n FROM n{top})")
    climb(top + 1, end)
    return f"""WITH {", ".join(parts)}
      SELECT doc_id, leaf, subroot, digest AS root, sha256(sibs) AS proof_sha256, cur AS folded_root, cur = digest AS verified
      FROM p{end} JOIN n{end} USING (g)"""


ORACLE_SQL["op13_merkle"] = _merkle_sql()

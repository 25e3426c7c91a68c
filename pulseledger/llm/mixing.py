"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Every source is cut into blocks of documents by a pseudo-random permutation
(the high bits of a keyed hash). The mix takes whole blocks in permuted order,
several times round if its target exceeds the source, and from the block that
the target cuts on, each document that still fits, in permuted order. For that,
rounds leave out what exceeds the words left, take what comes before the next
cut as a range of inner blocks, and try one by one only the documents of the inner
block that is cut; they end when no document fits. The exact block quotas
of the sources are partitioned among the output shards by a binary tree: each
node gives its left half a multivariate-hypergeometric draw of its quota and
the rest to the right. Shards draw disjoint ranges of the permuted blocks, and
documents are shuffled locally within their shard.

Defined cases: the size of a text is its number of words (null: 0). Sources are
ordered by code point, null last. A source without words gets target 0. Rows
repeated with the same id, source and text stand or fall together.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MAX_COPIES = 2
# Documents a block should hold, and blocks a source may have at each of the
# two levels; a cut block holds about n / MAX_BLOCKS**2 documents if that is more.
BLOCK_DOCS = 64
MAX_BLOCKS = 1024
WORD = "[^\\\\x20\\\\x09-\\\\x0D]+"


@dataclass(frozen=True)
class Mix:
    """``picks``: (source, block, shards) of whole blocks, one shard for each
    time the block is drawn; ``ranges``: (source, first, end, most) of inner blocks
    whose documents of at most ``most`` words go in once more; ``cut``: keys of
    the documents that fit from inner blocks that are cut; ``sources``: one row each."""

    sized: DataFrame
    sources: DataFrame
    picks: DataFrame
    ranges: DataFrame
    cut: DataFrame
    n_shards: int


def targets(sizes: Sequence[float], weights: Sequence[float], share: float, most: float) -> list[float]:
    """Words wanted from each source: ``share`` of all words by weight, each at
    most ``most`` times its source; the excess is shared again by weight."""
    out = [0.0] * len(sizes)
    open_ = [i for i, size in enumerate(sizes) if size > 0]
    rest = share * sum(sizes)
    while open_:
        total = sum(weights[i] for i in open_)
        full = [i for i in open_ if rest * weights[i] / total > most * sizes[i]]
        if not full:
            for i in open_:
                out[i] = rest * weights[i] / total
            break
        for i in full:
            out[i] = most * float(sizes[i])
        rest -= sum(out[i] for i in full)
        open_ = [i for i in open_ if i not in set(full)]
    return out


def split_quotas(quotas: Sequence[int], n_shards: int, seed: int) -> np.ndarray:
    """Blocks of each source for each shard, as (shards, sources).

    Column sums equal ``quotas`` exactly and shard totals differ by at most
    one; the same seed gives the same tree.
    """
    out = np.zeros((n_shards, len(quotas)), np.int64)
    stack = [(0, n_shards, np.asarray(quotas, np.int64))]
    while stack:
        first, n, quota = stack.pop()
        if n == 1 or not len(quota):
            out[first] = quota
            continue
        left = n // 2
        draw = int(quota.sum()) * left // n
        rng = np.random.Generator(np.random.PCG64([seed, first, n]))
        taken = rng.multivariate_hypergeometric(quota, draw, method="marginals")
        stack += [(first, left, taken), (first + left, n - left, quota - taken)]
    return out


def _sized(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: int) -> DataFrame:
    """(id, source, size, key, place): ``key`` identifies the row, ``place`` is
    its permuted position in the source, from 0 to 2**40."""
    return docs.selectExpr(
        f"`{id_col}` AS id",
        f"`{source_col}` AS source",
        f"{_size(text_col)} AS size",
        f"{_key(id_col, text_col, source_col, seed)} AS key",
    ).withColumn("place", F.expr("pmod(key, 1099511627776L)"))


def _size(text_col: str) -> str:
    return f"CAST(regexp_count(coalesce(`{text_col}`, ''), '{WORD}') AS BIGINT)"


def _key(id_col: str, text_col: str, source_col: str, seed: int) -> str:
    return f"xxhash64({seed}, `{id_col}`, `{source_col}`, coalesce(`{text_col}`, ''))"


def _first_fit(rows):
    """Documents of a cut inner block, in permuted order, that still fit."""
    rows = rows.groupby(["key", "place"], as_index=False).agg(size=("size", "sum"), budget=("budget", "first"))
    left, taken, sizes = float(rows["budget"].iloc[0]) if len(rows) else 0.0, [], []
    for key, size in rows.sort_values(["place", "key"])[["key", "size"]].itertuples(index=False):
        if 0 < size <= left + 0.5:
            taken.append(key)
            sizes.append(size)
            left -= size
    return pd.DataFrame({"cut_key": pd.Series(taken, dtype="int64"), "cut_size": pd.Series(sizes, dtype="int64")})


def _block(place: str, n: str) -> str:
    """Block number of a place among ``n`` equal parts of the permutation."""
    return f"CAST({place} * {n} DIV 1099511627776L AS BIGINT)"


_OUTER = _block("place", "n_blocks")
# Number of an inner block in its source.
_INNER = f"({_OUTER} * n_inner + {_block('(place * n_blocks % 1099511627776L)', 'n_inner')})"
# A block that the budget covers, and the one that it cuts.
_WHOLE = "before + words <= budget + 0.5"
_CUT = "before < budget AND before + words > budget + 0.5"


def _blocks(rows: DataFrame, block: str) -> DataFrame:
    """Blocks of each source with their words and the words of earlier blocks."""
    at = rows.groupBy("source", "budget", F.expr(f"{block} AS block")).agg(F.expr("sum(size) AS words"))
    earlier = "PARTITION BY source ORDER BY block ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    return at.withColumn("before", F.expr(f"coalesce(sum(words) OVER ({earlier}), 0)"))


def _cut_at(words: dict[int, int], left: float) -> tuple[int | None, float]:
    """The first block that the words left do not cover, and what is left before it."""
    for block in sorted(words):
        if words[block] > left + 0.5:
            return block, left
        left -= words[block]
    return None, left


def _fill(placed: DataFrame, state: dict[str | None, tuple[float, int]], facts: dict[str | None, tuple[int, int]]) -> tuple[DataFrame, DataFrame]:
    """Each document that fits from an inner block on, as ``ranges`` and ``cut``.

    ``state``: words left and the first inner block to look at, by source;
    ``facts``: numbers of blocks and of inner blocks in each. Every round reads
    only documents that may still fit, and passes one cut in every source.
    """
    spark = placed.sparkSession
    ranges: list[tuple[str | None, int, int, float]] = []
    cuts = []
    rest = placed.withColumn("inner", F.expr(_INNER))

    def sums(rows: DataFrame, block: str) -> dict[str | None, dict[int, int]]:
        out: dict[str | None, dict[int, int]] = {}
        for r in rows.groupBy("source", F.expr(f"{block} AS block")).agg(F.expr("sum(size) AS words")).collect():
            out.setdefault(r[0], {})[r[1]] = r[2]
        return out

    def only(rows: DataFrame, kind: str, found: list[tuple]) -> DataFrame:
        known = spark.createDataFrame(found, f"its_source string, {kind}")
        return rows.join(F.broadcast(known), F.expr(f"source <=> its_source AND {_MATCHES[kind]}")).drop("its_source")

    while state := {k: v for k, v in state.items() if v[0] >= 0.5}:
        rest = only(rest, "most double, first long", [(k, *v) for k, v in state.items()])
        rest = materialize(rest.drop("most", "first"), "may-fit")
        outer = {k: _cut_at(words, state[k][0]) for k, words in sums(rest, _OUTER).items()}
        ends = {k: facts[k][0] * facts[k][1] for k in outer}
        found = [(k, block) for k, (block, _) in outer.items() if block is not None]
        after = {}
        if found:
            inside = sums(only(rest, "at long", found), "inner")
            after = {k: _cut_at(words, outer[k][1]) for k, words in inside.items()}
            ends |= {k: block for k, (block, _) in after.items()}
        ranges += [(k, state[k][1], end, state[k][0]) for k, end in ends.items()]
        if not after:
            break
        pool = only(rest, "cut long, budget double", [(k, *v) for k, v in after.items()])
        fitted = pool.select("source", "key", "place", "size", "budget").groupBy("source").applyInPandas(_first_fit, "cut_key long, cut_size long")
        cuts.append(materialize(fitted, "cut"))
        # The words of what fitted, by source.
        keys = F.broadcast(cuts[-1].select("cut_key"))
        taken = dict(pool.join(keys, F.expr("key = cut_key")).groupBy("source").agg(F.expr("sum(size)")).collect())
        state = {k: (left - taken.get(k, 0), block + 1) for k, (block, left) in after.items()}
    keys = spark.createDataFrame([], "cut_key long")
    for cut in cuts:
        keys = keys.union(cut.select("cut_key"))
    return spark.createDataFrame(ranges, "range_source string, first_inner long, end_inner long, most double"), keys


_MATCHES = {
    "most double, first long": "inner >= first AND size > 0 AND size <= most + 0.5",
    "at long": f"{_OUTER} = at",
    "cut long, budget double": "inner = cut",
}


def plan_mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    max_copies: int = MAX_COPIES,
    n_shards: int = 64,
    seed: int = 17,
) -> Mix:
    """Decide what the mix takes. The driver sees one row per source and one
    per block, at most ``MAX_BLOCKS`` a source."""
    spark = docs.sparkSession
    sized = materialize(_sized(docs, id_col, text_col, source_col, seed), "sized")
    per_source = sized.groupBy("source").agg(F.expr("sum(size) AS words"), F.expr("count(*) AS n_docs"))
    found = sorted(((r[0] is None, r[0] or "", r[1], r[2]) for r in per_source.collect()), key=lambda r: r[:2])
    sizes = [r[2] for r in found]
    wanted = targets(sizes, [weights[i % len(weights)] for i in range(len(found))], share, max_copies)
    rows = []
    for (missing, name, words, n_docs), target in zip(found, wanted, strict=True):
        rounds = int(target // words) if words else 0
        n_blocks = int(min(MAX_BLOCKS, max(1, n_docs // BLOCK_DOCS)))
        n_inner = int(min(MAX_BLOCKS, max(1, n_docs // n_blocks // BLOCK_DOCS)))
        rows.append((None if missing else name, words, target, rounds, target - rounds * words, n_blocks, n_inner))
    kind = "source string, source_size long, target double, rounds int, budget double, n_blocks long, n_inner long"
    sources = spark.createDataFrame(rows, kind)

    known = sources.select("source", "budget", "n_blocks", "n_inner").withColumnRenamed("source", "its_source")
    placed = sized.join(F.broadcast(known), F.expr("source <=> its_source")).drop("its_source")
    blocks = materialize(_blocks(placed, _OUTER), "blocks")
    facts = {r[0]: (r[5], r[6]) for r in rows}
    at_cut = blocks.filter(_CUT).selectExpr("source", "block", "budget - before AS left_over").collect()
    ranges, cut_keys = _fill(placed.drop("budget"), {r[0]: (r[2], r[1] * facts[r[0]][1]) for r in at_cut}, facts)

    # The tree: block draws of every source, dealt to the shards.
    by_source: dict[str | None, list[tuple[int, bool]]] = {r[0]: [] for r in rows}
    for r in blocks.selectExpr("source", "block", f"{_WHOLE} AS whole").collect():
        by_source[r[0]].append((r[1], r[2]))
    draws = []
    for name, _, target, rounds, *_ in rows:
        own = sorted(by_source[name])
        draws.append([b for b, _ in own] * rounds + [b for b, whole in own if whole and target > 0])
    tree = split_quotas([len(d) for d in draws], n_shards, seed)
    picked: dict[tuple[str | None, int], list[int]] = {}
    for i, (name, *_) in enumerate(rows):
        # Permuted draws: shard k gets the next tree[k, i] of them.
        order = np.random.Generator(np.random.PCG64([seed, i])).permutation(len(draws[i]))
        for at, shard in zip(order, np.repeat(np.arange(n_shards), tree[:, i]), strict=True):
            picked.setdefault((name, draws[i][at]), []).append(int(shard))
    picks = spark.createDataFrame(
        [(name, block, sorted(shards)) for (name, block), shards in picked.items()],
        "pick_source string, pick_block long, pick_shards array<int>",
    )
    return Mix(sized, sources, picks, ranges, cut_keys, n_shards)


def _attach(rows: DataFrame, mix: Mix) -> DataFrame:
    """Add source facts and ``shards`` (one entry per copy) to rows with
    source, key, size and place. What is broadcast is bounded for each source: its
    facts, at most MAX_BLOCKS blocks, and for each round of cuts a range and the
    documents of one inner block (about BLOCK_DOCS, or n / MAX_BLOCKS**2)."""
    facts = mix.sources.withColumnRenamed("source", "its_source").select(
        "its_source", "source_size", "target", "n_blocks", "n_inner"
    )
    out = rows.join(F.broadcast(facts), F.expr("source <=> its_source"), "left")
    out = out.withColumns({"block": F.expr(_OUTER), "inner": F.expr(_INNER)})
    out = out.join(F.broadcast(mix.picks), F.expr("source <=> pick_source AND block = pick_block"), "left")
    inside = F.expr("source <=> range_source AND inner >= first_inner AND inner < end_inner AND size <= most + 0.5")
    out = out.join(F.broadcast(mix.ranges), inside, "left").join(F.broadcast(mix.cut), F.expr("key = cut_key"), "left")
    extra = f"IF(cut_key IS NULL AND first_inner IS NULL, CAST(array() AS ARRAY<INT>), array(CAST(pmod(xxhash64(key, 5), {mix.n_shards}) AS INT)))"
    return out.withColumn("shards", F.expr(f"concat(coalesce(pick_shards, CAST(array() AS ARRAY<INT>)), {extra})"))


def mix_report(mix: Mix) -> DataFrame:
    """What the mix takes of every document: id, size, source_size, target,
    taken, shards."""
    return _attach(mix.sized, mix).selectExpr("id", "size", "source_size", "target", "size * size(shards) AS taken", "shards")


def mixed_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 17, **options
) -> DataFrame:
    """The documents of the mix, a row for each copy, grouped by output shard
    and shuffled within it."""
    mix = plan_mix(docs, id_col, text_col, source_col, seed=seed, **options)
    names = docs.columns
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    id_, text, source = (f"c{names.index(c)}" for c in (id_col, text_col, source_col))
    facts = {"source": F.col(source), "size": F.expr(_size(text)), "key": F.expr(_key(id_, text, source, seed))}
    rows = plain.withColumns(facts)
    rows = _attach(rows.withColumn("place", F.expr("pmod(key, 1099511627776L)")), mix)
    copies = rows.selectExpr(*plain.columns, "key", "posexplode(shards) AS (copy, shard)")
    dealt = copies.repartition(mix.n_shards, "shard").sortWithinPartitions("shard", F.expr(f"xxhash64({seed}, key, copy)"))
    return dealt.select(*plain.columns).toDF(*names)

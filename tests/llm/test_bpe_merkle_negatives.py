"""Byte-level BPE, Merkle manifest and hard-negative mining against brute force, on awkward rows."""

import base64
import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from oracle_check import compare, duckdb_tables

from pulseledger.llm import byte_bpe, catalog, common, hard_negatives, merkle

SF = "/root/testdata/sf0.001"
RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
# Extra columns whose names the operators use inside.
CLASHES = "id long, key string, piece int, rank string, row int, way string, digest int"
CLASHING = (1, "k", 2, "r", 3, "w", 4)


@pytest.fixture(scope="module")
def library():
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def sha(data) -> str:
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


# --- byte-level BPE ----------------------------------------------------------

ALPHABET = ["a", "the ", "'", "'re", "'ll ", " ", "  ", "\n", "\t\n ", "1", "23", "é", "中文", "😀", " ", "\x00", "\x1c", ".", "!!", "ſ", "́"]


def awkward_texts():
    rng = random.Random(5)
    texts = [None, "", " ", "\n" * 90, " " * 130 + "x", "a" * 500, "don't " * 40, "x" * 40 + "'re" + "y" * 40, "'" * 300, "12 " * 99, "<|endoftext|>" * 9]
    texts += ["".join(rng.choice(ALPHABET) for _ in range(rng.choice([3, 30, 200, 400]))) for _ in range(150)]
    # Long stretches without a boundary, between stretches with many.
    texts += ["ab cd " * 20 + "z" * rng.randrange(10, 300) + " of the" * 20 + "\n" * rng.randrange(200) for _ in range(30)]
    return texts


def test_merging_equals_the_library(library):
    model = byte_bpe.load(RANKS, PATTERN)
    for text in awkward_texts():
        assert model.encode(text) == library.encode_ordinary(text or "")
        assert model.decode(model.encode(text)) == (text or "").encode()


def test_merging_one_long_pretoken(library):
    model = byte_bpe.load(RANKS, PATTERN)
    text = "".join(random.Random(1).choices("abcdefgh", k=60_000))
    assert model.encode(text) == library.encode_ordinary(text)


@pytest.fixture(scope="module")
def texts(spark):
    common.prepare(spark)
    rows = [(i, t, *CLASHING) for i, t in enumerate(awkward_texts())] + [(None, "null id", *CLASHING), (None, None, *CLASHING), (3, "twice " * 50, *CLASHING)] * 2
    return rows, spark.createDataFrame(rows, f"doc_id long, text string, {CLASHES}").repartition(3).cache()


@pytest.mark.parametrize("chunk,overlap", [(byte_bpe.CHUNK, byte_bpe.OVERLAP), (64, 16), (50, 40), (16, 8)])
def test_chunked_encoding_equals_the_library(texts, library, chunk, overlap):
    rows, docs = texts
    ids = byte_bpe.with_ids(docs, RANKS, PATTERN, chunk=chunk, overlap=overlap)
    expected = [(r[0], tuple(library.encode_ordinary(r[1] or ""))) for r in rows]
    found = ids.collect()
    assert Counter((r.id, tuple(r.ids)) for r in found) == Counter(expected)
    digests = byte_bpe.round_trips(docs, RANKS, PATTERN, chunk=chunk, overlap=overlap)
    assert Counter(map(tuple, digests.collect())) == Counter(
        (i, len(t), sha(" ".join(map(str, t))), sha(library.decode_bytes(list(t)))) for i, t in expected
    )


def test_chunks_are_stitched(texts, spark):
    """Nearly all slices of ordinary text are stitched to their neighbours, not joined to one piece."""
    prose = "It's 25 of the words we're counting here, isn't it?  And so on.\n" * 60
    df = spark.createDataFrame([(1, prose)], "id long, text string")
    found = byte_bpe.pieces(df, RANKS, PATTERN, chunk=64, overlap=20).orderBy("piece").collect()
    assert "".join(r.text for r in found) == prose and len(found) >= 0.95 * len(prose) / 64
    # A pre-token longer than the overlap has no boundary in it.
    df = spark.createDataFrame([(1, "z" * 1000)], "id long, text string")
    assert [r.text for r in byte_bpe.pieces(df, RANKS, PATTERN, chunk=64, overlap=20).collect()] == ["z" * 1000]
    with pytest.raises(ValueError):
        byte_bpe.pieces(df, RANKS, PATTERN, chunk=20, overlap=20)


def test_decoding(spark):
    ids = spark.createDataFrame([("a", [1, 2]), ("b", []), (None, None)], "id string, ids array<int>")
    model = byte_bpe.load(RANKS, PATTERN)
    assert {(r.id, bytes(r.data)) for r in byte_bpe.decoded(ids, RANKS, PATTERN).collect()} == {("a", model.decode([1, 2])), ("b", b""), (None, b"")}


def test_byte_bpe_edges(spark):
    empty = spark.createDataFrame([], "doc_id string, text string")
    assert byte_bpe.with_ids(empty, RANKS, PATTERN).collect() == byte_bpe.round_trips(empty, RANKS, PATTERN).collect() == []
    text_id = spark.createDataFrame([("x", "a b")], "doc_id string, text string")
    assert byte_bpe.round_trips(text_id, RANKS, PATTERN).first().id == "x"


def test_op12_query(spark, library):
    texts = {r.doc_id: r.text or "" for r in common.documents(spark, SF).collect()}
    for r in catalog.op12_byte_bpe(spark, SF).collect():
        ids = library.encode_ordinary(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids), sha(" ".join(map(str, ids))))
        assert r.decoded_sha256 == sha(texts.pop(r.doc_id))
    assert not texts


# --- Merkle manifest ---------------------------------------------------------


def field(value) -> str:
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf_of(row, text) -> str:
    return sha("".join(map(field, (row[0], row[1], row[2], row[3], text))))


def climb(nodes):
    """The top of a list of digests, and for each the (left, right) of every level."""
    ways, covered = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        above, cover = [], []
        for at in range(0, len(nodes), 16):
            run = nodes[at : at + 16]
            for j in range(len(run)):
                for leaf in covered[at + j]:
                    ways[leaf].append((run[:j], run[j + 1 :]))
            above.append(sha("".join(run)))
            cover.append([leaf for c in covered[at : at + 16] for leaf in c])
        nodes, covered = above, cover
    return nodes[0], ways


def manifest_by_hand(rows):
    """Counter of (doc_id, leaf, subroot, root, proof, folded root, verified)."""
    groups = defaultdict(list)
    for row in rows:
        groups[row[1]].append((row[0] is not None, row[0] or 0, leaf_of(row, row[4]), row))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    tops = {}
    for s in names:
        groups[s].sort(key=lambda x: x[:3])
        tops[s] = climb([x[2] for x in groups[s]])
    root, upper = climb([tops[s][0] for s in names])
    out = Counter()
    for s, above in zip(names, upper):
        for (_, _, leaf, row), way in zip(groups[s], tops[s][1]):
            node = leaf
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0 and row[4] is not None:
                node = leaf_of(row, "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in row[4]))
            for left, right in way + above:
                node = sha("".join([*left, node, *right]))
            siblings = [h for left, right in way + above for h in left + right]
            out[row[0], leaf, tops[s][0], root, sha("".join(siblings)), node, node == root] += 1
    return out


def manifest_of(spark, rows):
    docs = spark.createDataFrame([(*r, *CLASHING) for r in rows], f"doc_id long, source string, lang string, n_chars long, text string, {CLASHES}")
    found = merkle.verified_manifest(
        docs.repartition(5), "source", "doc_id", ["doc_id", "source", "lang", "n_chars", "text"],
        {"text": f"translate(text, '{common.UPPER}', '{common.LOWER}')"}, "crc32(CAST(doc_id AS STRING)) % 5 = 0",
    )
    return Counter(tuple(r) for r in found.select("id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect())


def test_manifest_equals_brute_force(spark):
    common.prepare(spark)
    rng = random.Random(2)
    sizes = {"hot": 700, "b": 16, "B": 17, "é": 33, "": 1, None: 40, "lone": 1, "z": 256}
    rows, n = [], 0
    for source, size in sizes.items():
        for _ in range(size):
            n += 1
            rows.append((rng.choice([n, n, n, -n]), source, rng.choice(["en", None, ""]), rng.choice([n, None]), rng.choice([f"Text {n} É", f"low {n}", "", None])))
    rows += [(None, "b", None, None, None), (None, "b", "de", 1, "X"), (5, "b", "de", 1, "X"), (5, "b", "de", 1, "X"), (5, "b", "de", 1, "Y")]
    expected = manifest_by_hand(rows)
    assert manifest_of(spark, rows) == expected
    verdicts = Counter()
    for row, count in expected.items():
        verdicts[row[-1]] += count
    assert verdicts[True] and verdicts[False]


@pytest.mark.parametrize("sources", [1, 16, 17, 300])
def test_number_of_sources(spark, sources):
    rows = [(i, f"s{i}", "en", 1, "T") for i in range(sources)]
    assert manifest_of(spark, rows) == manifest_by_hand(rows)


def test_empty_manifest(spark):
    assert not manifest_of(spark, [(1, "a", None, None, None)]) - manifest_by_hand([(1, "a", None, None, None)])
    docs = spark.createDataFrame([], "doc_id long, source string, text string")
    assert merkle.verified_manifest(docs, "source", "doc_id", ["text"], {}, "false").collect() == []


def test_numbering_spreads_a_hot_group(spark):
    rows = spark.range(5000).selectExpr("IF(id % 3 = 0, 'hot', concat('s', id % 7)) AS g", "4999 - id AS id")
    ranked = merkle.numbered(rows, "g", ["id"], "ranks").collect()
    by_group = defaultdict(list)
    for r in ranked:
        by_group[r.g].append((r.rank, r.id, r.total))
    for found in by_group.values():
        found.sort()
        assert [x[0] for x in found] == list(range(len(found))) and {x[2] for x in found} == {len(found)}
        assert [x[1] for x in found] == sorted(x[1] for x in found)


def test_op13_query(spark):
    assert compare(catalog.op13_merkle(spark, SF), duckdb_tables(SF), catalog.ORACLE_SQL["op13_merkle"]) is None


# --- hard negatives ----------------------------------------------------------


def mined_by_hand(rows, positives=5, negatives=10):
    usable = []
    for at, (i, label, v) in enumerate(rows):
        if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            usable.append((at, i, label, [math.floor(256 * float(np.float32(x))) for x in v]))

    def order(x):
        return -x[0], x[1] is None, x[1] or 0

    out = Counter()
    for at, i, label, v in usable:
        if i is None or i % 100:
            continue
        scored = [(sum(a * b for a, b in zip(v, w)), j, m) for bt, j, m, w in usable if bt != at]
        near = sorted((x for x in scored if x[2] == label), key=order)[:positives]
        for p, j, _ in near:
            far = [x for x in scored if x[2] != label and 30 * p <= 100 * x[0] <= 90 * p]
            for rank, (score, k, _) in enumerate(sorted(far, key=order)[:negatives], 1):
                out[i, j, rank, k, p, score] += 1
    return out


def mined(spark, rows, **more):
    df = spark.createDataFrame([(*r, *CLASHING) for r in rows], f"vec_id long, label int, embedding array<float>, {CLASHES.replace('row int', 'score int')}")
    found = hard_negatives.hard_negatives(df.repartition(3), **more)
    return Counter(map(tuple, found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()))


def vectors(rng, n, dims=6):
    rows = []
    for i in range(n):
        label = rng.randrange(4)
        rows.append((i, label, [rng.gauss(0.3 * (d == label), 0.2) for d in range(dims)]))
    return rows


@pytest.mark.parametrize("small", [False, True])
def test_hard_negatives_equal_brute_force(spark, monkeypatch, small):
    if small:
        monkeypatch.setattr(hard_negatives, "SHARD_ROWS", 150)
        monkeypatch.setattr(hard_negatives, "BLOCK_ANCHORS", 2)
    rng = random.Random(8)
    rows = vectors(rng, 900)
    hot = rows[50][2]
    rows += [(i, rng.randrange(4), hot) for i in range(900, 1200)]  # ties by id
    rows += [(1200, 9, [1.0] * 6), (1201, 9, [0.9] * 6), (1300, 5, [0.0] * 6), (1400, None, hot), (1500, 1, None), (1600, 1, [1.0, None] * 3)]
    rows += [(1700, 1, [math.nan] * 6), (1800, 1, [math.inf] * 6), (1900, 0, [0.5, 0.5]), (2000, 0, []), (None, 1, hot), (None, 2, rows[7][2])]
    rows += [(100, 1, hot), (100, 1, hot), (-100, 2, hot)]
    expected = mined_by_hand(rows)
    assert mined(spark, rows) == expected and len(expected) > 300


def test_hard_negatives_edges(spark):
    assert not mined(spark, [])
    assert not mined(spark, [(100, 1, [1.0])])
    few = [(100, 1, [1.0]), (1, 1, [1.0]), (2, 2, [0.5]), (3, 2, [0.95])]
    assert mined(spark, few) == mined_by_hand(few) == Counter({(100, 1, 1, 2, 65536, 32768): 1})


def test_large_components_are_exact(spark):
    rng = random.Random(3)
    rows = [(i, i % 2, [rng.uniform(-1e6, 1e6) for _ in range(4)]) for i in range(300)]
    assert mined(spark, rows) == mined_by_hand(rows)


def test_search_stops_early():
    """With few large components the threshold falls before most rows are seen."""
    rng = np.random.default_rng(1)
    matrix = np.floor(256 * rng.pareto(1.0, (20_000, 3)))
    lists = hard_negatives.SortedLists(matrix)
    anchor = np.array([3.0, 2.0, 5.0])
    read = []
    rounds = lists.rounds
    lists.rounds = lambda a: (read.append(len(r[0])) or r for r in rounds(a))
    [(rows, scores)] = hard_negatives.threshold_search(lists, anchor, np.ones(20_000, bool), [(-np.inf, np.inf)], 10)
    every = matrix @ anchor
    assert sorted(scores)[-10:] == sorted(every)[-10:] and sum(read) < 2_000


def test_op11_query(spark):
    assert compare(catalog.op11_hard_negatives(spark, SF), duckdb_tables(SF), catalog.ORACLE_SQL["op11_hard_negatives"]) is None

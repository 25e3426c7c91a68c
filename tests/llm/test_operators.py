"""The training-data operators against brute force, on awkward rows."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
import sentencepiece
from oracle_check import compare, duckdb_tables

from pulseledger.llm import (
    catalog,
    common,
    exact_dedup,
    fingerprints,
    jaccard_join,
    line_dedup,
    mixing,
    quality,
    sentencepiece_bpe,
    substring_dedup,
    suffix_dedup,
    toxicity,
)
from pulseledger.llm.components import components
from pulseledger.llm.induced_sort import ExternalSorter

SF = "/root/testdata/sf0.001"
# Extra columns whose names the operators use inside.
COLUMNS = "doc_id long, text string, source string, id long, digest string, key string, text_hash long, label int"
WORDS = [a + b for a in "ka lo mi ne su ti ra".split() for b in "bon dar fel gim hos".split()]


def words(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    """(doc_id, text, source) with nulls, ties, repeats, near copies and one long text."""
    rng = random.Random(4)
    base, passage, line = words(rng, 220), words(rng, 60), words(rng, 6)
    rows = [(1, None, "b"), (2, "", None), (3, " \t\n ", "a"), (4, "One", "a"), (5, "oNE", "b"), (None, "none id", "a"), (None, None, None)]
    rows += [(6, base, "a"), (6, base, "a"), (7, base.upper(), "b"), (8, base + " " + words(rng, 3), "b")]
    for i in range(9, 40):
        parts = base.split()
        parts[rng.randrange(len(parts))] = "x" * (i % 5 + 1)
        rows.append((i, f"{line}\n {line.upper()}\t\n" + " ".join(parts), rng.choice(["a", "b", None])))
    rows += [(i, f"{words(rng, 30)}\n{words(rng, 20)} {passage} {words(rng, 9)}\n\n", "c") for i in range(40, 52)]
    rows += [(60, words(rng, 30_000), "c"), (61, "of " * 700, "c"), (62, "ab\x00cé\U0001f600 " * 30, "a"), (-3, "short   one", "a")]
    return rows


@pytest.fixture(scope="module")
def docs(spark, texts):
    common.prepare(spark)
    rows = [(i, t, s, 0, "d", "k", 1, 1) for i, t, s in texts]
    return spark.createDataFrame(rows, COLUMNS).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], COLUMNS)


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def rows_of(df, *columns):
    return Counter(tuple(r) for r in df.select(*columns).collect())


# --- SentencePiece -----------------------------------------------------------


@pytest.fixture(scope="module")
def models():
    path = catalog.piece_model()
    return path, sentencepiece_bpe.load(path), sentencepiece.SentencePieceProcessor(model_file=path)


def test_encoding_equals_the_library(models):
    _, own, library = models
    rng = random.Random(1)
    alphabet = "aàbßethnio  ▁\n\t\x00中文😀of'.,0123"
    samples = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 50))) for _ in range(1500)]
    samples += [" " * k + "the" for k in range(40)] + ["a" * k for k in range(60)] + ["the" + " " * 3000 + "end", "", "<s></s>"]
    for text in samples:
        ids = library.encode(text, add_eos=True)
        assert own.encode(text) == ids
        n, joined, back = own.round_trip(text)
        assert (n, joined, back) == (len(ids), " ".join(map(str, ids)), library.decode(ids))


def test_packed_ids_are_few_and_equal_the_encoding(models, monkeypatch):
    _, own, _ = models
    monkeypatch.setattr(sentencepiece_bpe, "CACHED_IDS", 50)
    rng = random.Random(3)
    for _ in range(300):
        text = " ".join(rng.choice(["the", "word", "ü中", "\n", "a" * 70, str(rng.random())]) for _ in range(rng.randint(0, 30)))
        assert np.frombuffer(own.packed(text), np.int32).tolist() == own.encode(text)
        assert len(own._packed) <= 50 + 31 * 3 and "a" * 70 not in own._packed
    own._packed.clear()


def test_decoding_equals_the_library(models):
    _, own, library = models
    rng = random.Random(2)
    for _ in range(1500):
        ids = [rng.choice([rng.randrange(32000), rng.randrange(3, 259), 0, 1, 2]) for _ in range(rng.randint(0, 7))]
        assert own.decode(ids) == library.decode(ids), ids


def test_sentencepiece_rows(docs, empty, texts, models):
    path, _, library = models
    got = rows_of(sentencepiece_bpe.round_trips(docs, path), "id", "n_tokens", "decoded_sha256")
    want = Counter()
    for i, text, _ in texts:
        ids = library.encode(text or "", add_eos=True)
        want[i, len(ids), hashlib.sha256(library.decode(ids).encode()).hexdigest()] += 1
    assert got == want
    back = sentencepiece_bpe.decoded(sentencepiece_bpe.with_ids(docs, path), path)
    assert rows_of(back, "id", "text") == Counter((i, library.decode(library.encode(t or ""))) for i, t, _ in texts)
    assert sentencepiece_bpe.round_trips(empty, path).count() == 0


# --- classifiers -------------------------------------------------------------


def auc(labels, scores):
    positive, negative = ([s for s, l in zip(scores, labels, strict=True) if l == k] for k in (1, 0))
    return np.mean([(p > n) + 0.5 * (p == n) for p in positive for n in negative])


@pytest.mark.parametrize("name, column, fold", [("op2_quality", "quality", (5, 0)), ("op9_toxicity", "toxic", (3, 1))])
def test_held_out_ranking(spark, name, column, fold):
    sf = "/root/testdata/sf0.01"
    labels = dict(duckdb.sql(f"SELECT doc_id, {column} FROM '{sf}/labels.parquet'").fetchall())
    rows = catalog.QUERIES[name](spark, sf).collect()
    assert len(rows) == len({r.doc_id for r in rows}) == 1000
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % fold[0] == fold[1]) for r in rows)
    assert all(0 <= r.score <= 1 for r in rows)
    held = [(labels[r.doc_id], r.score) for r in rows if r.held_out and r.doc_id in labels]
    assert auc(*zip(*held, strict=True)) > 0.85


@pytest.mark.parametrize("classifier, column", [(quality, "quality"), (toxicity, "toxic")])
def test_classifier_edges(spark, docs, empty, texts, classifier, column):
    none = spark.createDataFrame([(None, 1), (5, None), (999, 1)], f"doc_id long, {column} int")
    scores = classifier.score(docs, classifier.train(docs, none)).collect()
    assert len(scores) == len(texts) and {r.score for r in scores} == {0.5}
    some = spark.createDataFrame([(i, i % 2) for i in range(1, 50)] + [(6, 1)], f"doc_id long, {column} int")
    model = classifier.train(docs, some, "{id} <> 8")
    first, again = (rows_of(classifier.score(docs, m), "id", "score") for m in (model, classifier.train(docs, some, "{id} <> 8")))
    assert first == again and all(0 <= s <= 1 for _, s in first)
    assert classifier.score(empty, model).count() == 0


def plain_ftrl(labels, rows):
    """FTRL-proximal one coordinate at a time, over all features."""
    z, n = defaultdict(float), defaultdict(float)

    def weight(i):
        if abs(z[i]) <= toxicity.L1:
            return 0.0
        return -math.copysign(abs(z[i]) - toxicity.L1, z[i]) / ((toxicity.BETA + math.sqrt(n[i])) / toxicity.ALPHA + toxicity.L2)

    rng = np.random.Generator(np.random.PCG64(5))
    for _ in range(toxicity.EPOCHS):
        for k in rng.permutation(len(rows)):
            w = {int(i): weight(int(i)) for i in rows[k]}
            g = 1 / (1 + math.exp(-sum(w.values()))) - labels[k]
            for i, own in w.items():
                sigma = (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / toxicity.ALPHA
                z[i] += g - sigma * own
                n[i] += g * g
    return {i: weight(i) for i in list(z) if weight(i)}


def test_toxicity_learns_like_plain_ftrl():
    rng = random.Random(12)
    labels = [rng.randrange(2) for _ in range(60)]
    texts = [f"{words(rng, 12)} {'vile stuff' if label else 'kind words'} {words(rng, 5)}".encode() for label in labels]
    rows = [toxicity.features(t) for t in texts]
    packed = toxicity.fit(labels, [r.tobytes() for r in rows])
    count = len(packed) // 8
    got = dict(zip(np.frombuffer(packed[: 4 * count], np.int32).tolist(), np.frombuffer(packed[4 * count :], np.float32).tolist(), strict=True))
    expected = plain_ftrl(labels, rows)
    # Features of one document are left out at once: their weights are zero.
    assert got.keys() == expected.keys() and len(got) > 3
    assert all(got[i] == pytest.approx(expected[i], rel=1e-5, abs=1e-6) for i in got)
    model = toxicity.Model(packed)
    for text, row in zip(texts, rows, strict=True):
        assert model.score(text) == pytest.approx(1 / (1 + math.exp(-sum(expected.get(int(i), 0) for i in row))), abs=1e-5)


def test_factorisation_machine_pairs():
    """The linear-time pair sum equals the sum over pairs."""
    rng = np.random.default_rng(3)
    size = quality._WORDS + quality.N_STATISTICS * quality.BINS
    model = quality.Model(np.zeros((quality.N_STATISTICS, quality.BINS - 1)), 0.3, rng.normal(size=size), rng.normal(size=(size, 3)))
    at, x = np.array([3, 8, 100, 4000]), rng.normal(size=4)
    pairs = sum(model.factors[at[i]] @ model.factors[at[j]] * x[i] * x[j] for i in range(4) for j in range(i))
    assert model.raw(at, x)[0] == pytest.approx(0.3 + model.linear[at] @ x + pairs)


# --- fingerprints ------------------------------------------------------------


def test_fingerprint_is_a_homomorphic_multiset_hash():
    a, b, c = b"first paragraph here", b"second", b"third one, rather longer than the others"
    whole = fingerprints.vector(b"\n".join([a, b, c]))
    assert np.array_equal(whole, fingerprints.vector(b"\n".join([c, a, b])))
    assert not np.array_equal(whole, fingerprints.vector(b"\n".join([a, b, c, c])))
    assert np.array_equal(fingerprints.insert(fingerprints.vector(a + b"\n" + c), b), whole)
    assert np.array_equal(fingerprints.delete(whole, b), fingerprints.vector(a + b"\n" + c))
    assert np.array_equal(fingerprints.from_text(fingerprints.to_text(whole)), whole)
    assert fingerprints.likeness(whole, whole) == 1 and fingerprints.likeness(fingerprints.vector(b""), whole) < 0.2


def exact_likeness(a, b):
    """1 - |x - y|**2 / (|x|**2 + |y|**2) over counts of 16-byte windows of paragraphs."""
    x, y = (Counter(p[k : k + 16] for p in t.split(b"\n") for k in range(max(1, len(p) - 15))) for t in (a, b))
    both = sum(n * n for n in [*x.values(), *y.values()])
    return 1 - sum((x[w] - y[w]) ** 2 for w in x | y) / both


def test_likeness_is_near_the_exact_one():
    rng = random.Random(6)
    runs = [(b"a" * 40_000, b"a" * 20_000), (b"a" * 100_000, b"a" * 99_000), (b"log line again\n" * 40_000, b"log line again\n" * 30_000)]
    for a, b in runs:
        assert abs(fingerprints.likeness(fingerprints.vector(a), fingerprints.vector(b)) - exact_likeness(a, b)) < 0.01
    for _ in range(30):
        text = words(rng, rng.randrange(50, 400)).encode()
        edited = text[: rng.randrange(len(text))] + words(rng, rng.randrange(1, 200)).encode()
        near = fingerprints.likeness(fingerprints.vector(text), fingerprints.vector(edited))
        assert abs(near - max(0, exact_likeness(text, edited))) < 0.25


def test_a_result_is_read_twice(spark):
    """Shuffle files go when a query ends; a second action on the same frame makes them again."""
    common.prepare(spark)
    counts = spark.range(10_000).repartition(7).selectExpr("id % 97 AS k").groupBy("k").count()
    assert sorted(counts.collect()) == sorted(counts.collect()) and counts.count() == 97
    joined = counts.join(counts.withColumnRenamed("count", "c"), "k")
    assert joined.count() == len(joined.collect()) == len(joined.collect()) == 97


def test_edits_equal_brute_force(docs, empty, texts):
    order = sorted(texts, key=lambda r: (r[0] is not None, r[0] or 0), reverse=True)
    got = fingerprints.edits(docs).collect()
    assert len(got) == len(texts)
    unique = Counter(i for i, _, _ in texts)
    donors = {order[k][0]: order[(k + 1) % len(order)] for k in range(len(order))}
    checked = 0
    for r in got:
        if r.id is None or unique[r.id] > 1 or unique[donors[r.id][0]] > 1:
            continue
        text, donor = (next(t or "" for i, t, _ in texts if i == k) for k in (r.id, donors[r.id][0]))
        half = len(text) // 2
        edited = text[: len(text) - half] + donor[:half]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert r.fingerprint == fingerprints.to_text(fingerprints.vector(text.encode()))
        assert r.edited_fingerprint == fingerprints.to_text(fingerprints.vector(edited.encode()))
        checked += 1
    assert checked > 40
    assert fingerprints.edits(empty).count() == 0
    assert fingerprints.fingerprints(docs).count() == len(texts)


# --- lines -------------------------------------------------------------------


def brute_lines(rows, least):
    strip = " \t\n\x0b\x0c\r"
    held = [[(line, lower(line.strip(strip))) for line in (t or "").split("\n")] for _, t, _ in rows]
    seen = Counter(k for lines in held for k in {k for _, k in lines} if k)
    out = Counter()
    for (i, _, _), lines in zip(rows, held, strict=True):
        kept = [line for line, k in lines if not k or seen[k] < least]
        out[i, len(lines), len(lines) - len(kept), "\n".join(kept)] += 1
    return out


def test_lines_equal_brute_force(docs, empty, texts):
    index = line_dedup.LineIndex.build(docs)
    columns = ("id", "n_lines", "n_dropped", "text")
    assert rows_of(index.kept_lines(docs), *columns) == brute_lines(texts, 10)
    assert index.kept_lines(empty).count() == 0
    assert line_dedup.LineIndex.build(empty).kept_lines(docs).count() == len(texts)


def test_line_index_is_reversible(spark, docs, texts):
    more = [(100 + k, f"added line\n{texts[-1][1]}", "z") for k in range(11)]
    batch = spark.createDataFrame(more, "doc_id long, text string, source string")
    before = line_dedup.LineIndex.build(docs)
    grown = before.add(batch)
    assert rows_of(grown.kept_lines(docs), "id", "n_lines", "n_dropped", "text") == brute_lines_of(texts, more)
    back = grown.remove(batch)
    assert rows_of(back.counts, "key", "n_docs") == rows_of(before.counts, "key", "n_docs")
    assert rows_of(back.shards, "shard", "keys") == rows_of(before.shards, "shard", "keys")


def brute_lines_of(texts, more):
    every, ids = brute_lines(texts + more, 10), {i for i, _, _ in texts}
    return Counter({k: v for k, v in every.items() if k[0] in ids})


def test_cuckoo_filter():
    keys = np.random.default_rng(1).integers(0, 2**63, 5000).astype(np.uint64)
    held = line_dedup.CuckooFilter.sized(5000)
    assert held.insert(keys[:4000]) and held.contains(keys[:4000]).all()
    assert held.contains(keys[4000:]).mean() < 0.02
    held = line_dedup.CuckooFilter.from_bytes(held.to_bytes())
    held.delete(keys[:2000])
    assert held.contains(keys[2000:4000]).all() and held.contains(keys[:2000]).mean() < 0.02


# --- suffixes ----------------------------------------------------------------


def test_suffix_order_and_prefixes_equal_brute_force():
    rng = random.Random(1)
    for _ in range(150):
        parts = [bytes(rng.choice(b"abcd"[: rng.randint(1, 4)]) for _ in range(rng.randint(1, 25))) for _ in range(rng.randint(1, 5))]
        parts += [parts[0], parts[0][1:] or b"a"]
        text = [x + 1 for p in parts for x in [*p, -1]]
        cap = rng.choice([3, 8, 20])
        # A memory of 64 bytes makes the queues write their runs out.
        order, prefixes = ExternalSorter(np.array(text, np.uint8), cap, rng.choice([1 << 20, 64])).sort()

        def suffix(i, text=text):
            return tuple(text[i : text.index(0, i)])

        pairs = [(int(i), int(p)) for i, p in zip(order, prefixes, strict=True) if text[int(i)]]
        assert [suffix(i) for i, _ in pairs] == sorted(suffix(i) for i in range(len(text)) if text[i])
        for (i, _), (j, p) in zip(pairs, pairs[1:], strict=False):
            same = next((k for k, (x, y) in enumerate(zip(suffix(i), suffix(j), strict=False)) if x != y), min(len(suffix(i)), len(suffix(j))))
            assert p == min(same, cap)


def test_repeated_bytes_equal_brute_force(docs, empty, texts):
    data = [(i, (t or "").encode()) for i, t, _ in texts]
    seen = Counter(b[s : s + 200] for _, b in data for s in range(len(b) - 199))
    want = Counter()
    for i, b in data:
        gone = bytearray(len(b))
        for s in range(len(b) - 199):
            if seen[b[s : s + 200]] > 1:
                gone[s : s + 200] = b"\1" * 200
        spans = len(re.findall(b"\1+", bytes(gone)))
        want[i, len(b), sum(gone), spans, bytes(x for x, g in zip(b, gone, strict=True) if not g)] += 1
    got = Counter((r.id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in suffix_dedup.without_repeats(docs).collect())
    assert got == want and any(k[2] for k in want)
    assert suffix_dedup.without_repeats(empty).count() == 0


def test_frequent_keys_are_refined(docs, texts, monkeypatch):
    plain = rows_of(suffix_dedup.without_repeats(docs), "id", "n_removed", "n_spans")
    monkeypatch.setattr(suffix_dedup, "MAX_PIECES", 2)
    monkeypatch.setattr(suffix_dedup, "MAX_ROUNDS", 4)
    monkeypatch.setattr(suffix_dedup, "SHARD_BYTES", 500)
    assert rows_of(suffix_dedup.without_repeats(docs), "id", "n_removed", "n_spans") == plain


def test_long_text_is_read_in_stretches(monkeypatch):
    text = words(random.Random(9), 3000).encode()
    whole = suffix_dedup.pieces(text)
    monkeypatch.setattr(suffix_dedup, "MAX_TEXT", 1000)
    parts = suffix_dedup.pieces(text)
    for found in (whole, parts):
        covered = np.concatenate([np.arange(s, s + n) for s, n in zip(found[0], found[1], strict=True)])
        assert np.array_equal(covered, np.arange(len(text) - 199))


# --- exact copies ------------------------------------------------------------


def test_groups_equal_brute_force(docs, empty, texts):
    groups = defaultdict(list)
    for i, t, _ in texts:
        groups[lower(t)].append(i)
    got = exact_dedup.duplicate_groups(docs).collect()
    assert len(got) == len(texts)
    for r in got:
        key = next(k for k in groups if hashlib.sha256(k.encode()).hexdigest() == r.text_sha256)
        known = [i for i in groups[key] if i is not None]
        assert (r.group_size, r.keep_id) == (len(groups[key]), max(known, default=None))
    assert sum(r.kept for r in got) == len(groups)
    kept = exact_dedup.drop_duplicates(docs)
    assert kept.columns == docs.columns and kept.count() == len(groups)
    assert {lower(r.text) for r in kept.collect()} == set(groups)
    assert exact_dedup.duplicate_groups(empty).count() == exact_dedup.drop_duplicates(empty).count() == 0


def test_exact_dedup_without_broadcast(docs, monkeypatch):
    plain = rows_of(exact_dedup.duplicate_groups(docs), "id", "keep_id", "group_size", "kept")
    monkeypatch.setattr(exact_dedup, "BROADCAST_BYTES", 0)
    assert rows_of(exact_dedup.duplicate_groups(docs), "id", "keep_id", "group_size", "kept") == plain


def test_exact_dedup_runs_no_python(docs):
    plan = exact_dedup.duplicate_groups(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# --- Jaccard join ------------------------------------------------------------


def shingle_set(text):
    found = [w for w in re.split(r"[\x20\x09-\x0D]+", lower(text)) if w]
    k = min(3, len(found))
    return frozenset(tuple(found[j : j + k]) for j in range(len(found) - k + 1)) if found else frozenset()


def test_components_equal_brute_force(docs, empty, texts):
    rows = [(i, shingle_set(t)) for i, t, _ in texts if i is not None]
    parent = {i: i for i, _ in rows}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, x in rows:
        for j, y in rows:
            both = len(x & y)
            if x and 100 * both >= 90 * (len(x) + len(y) - both):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    got = {r.id: (r.n_shingles, r.component_id) for r in jaccard_join.joined(docs).collect() if r.id is not None}
    assert got == {i: (len(s), find(i)) for i, s in rows}
    assert len(set(v[1] for v in got.values())) < len(got) - 20
    kept = jaccard_join.one_per_component(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} - {None} == {find(i) for i, _ in rows}
    assert jaccard_join.joined(empty).count() == 0


def test_answers_derived_from_similar_sets(spark):
    """Many near copies around several bases: nothing is lost without heads."""
    rng = random.Random(8)
    rows = []
    for b in range(4):
        base = words(rng, 120).split()
        for k in range(40):
            copy = list(base)
            for _ in range(rng.randint(0, 4)):
                copy[rng.randrange(len(copy))] = f"edit{rng.randrange(3)}"
            rows.append((100 * b + k, " ".join(copy), "s"))
    test_components_equal_brute_force(
        spark.createDataFrame(rows, "doc_id long, text string, source string"),
        spark.createDataFrame([], "doc_id long, text string"), rows,
    )


def test_drifting_texts_equal_brute_force(spark):
    """Texts that drift apart step by step share lists without all linking."""
    rng = random.Random(31)
    rows = []
    for family in range(3):
        text = words(rng, 120).split()
        for step in range(30):
            text = list(text)
            for _ in range(rng.randrange(1, 9)):
                text[rng.randrange(len(text))] = f"e{rng.randrange(10**9)}"
            rows.append((family * 100 + step, " ".join(text)))
    small = spark.createDataFrame(rows, "doc_id long, text string")
    sets = {i: {tuple(t.split()[k : k + 5]) for k in range(len(t.split()) - 4)} for i, t in rows}
    root = {i: i for i in sets}

    def find(i):
        return i if root[i] == i else find(root[i])

    for i, j in itertools.combinations(sets, 2):
        both = len(sets[i] & sets[j])
        if 100 * both >= 70 * (len(sets[i]) + len(sets[j]) - both):
            low, high = sorted((find(i), find(j)))
            root[high] = low
    got = {r.id: r.component_id for r in jaccard_join.joined(small, words=5, percent=70).collect()}
    assert got == {i: find(i) for i in sets} and 3 < len(set(got.values())) < len(got)


def test_links_equal_brute_force(spark):
    """All pairs of distinct sets, inside components too; copies count as members."""
    rng = random.Random(8)
    rows = [(900, "", "s"), (901, None, "s"), (902, "two words", "s"), (903, "TWO words", "s")]
    for b in range(3):
        base = words(rng, 120).split()
        for k in range(25):
            copy = list(base)
            for _ in range(rng.randint(0, 4)):
                copy[rng.randrange(len(copy))] = f"edit{rng.randrange(3)}"
            rows.append((100 * b + k, " ".join(copy), "s"))
    sets = {i: shingle_set(t) for i, t, _ in rows}

    def near(x, y):
        both = len(x & y)
        return bool(x) and 100 * both >= 90 * (len(x) + len(y) - both)

    members, pairs = jaccard_join.links(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    members = members.collect()
    assert {r.id: r.n_links for r in members} == {i: sum(near(x, y) for j, y in sets.items() if i != j) for i, x in sets.items()}
    of = {r.set_id: sets[r.id] for r in members if r.set_id is not None}
    want = {(a, b) for a in of for b in of if a < b and near(of[a], of[b])}
    got = [tuple(r) for r in pairs.collect()]
    assert len(got) == len(set(got)) and set(got) == want
    # More links than connect the components.
    assert len(want) > len(of) - len({r.component_id for r in members if r.set_id is not None})


def plans_of(monkeypatch, *modules):
    """Fills with the plan of every table that the modules write."""
    plans = []

    def written(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return common.materialize(df, name)

    for module in modules:
        monkeypatch.setattr(f"pulseledger.llm.{module}.materialize", written)
    return plans


def test_links_broadcast_no_table_that_grows(spark, monkeypatch):
    """Spark takes a label table of some MB, read 32 times by an explode, for small enough."""
    rng = random.Random(5)
    base = words(rng, 120).split()
    rows = [(i, " ".join(base[:k] + [f"e{i}"] + base[k + 1 :])) for i, k in enumerate(rng.sample(range(120), 40))]
    monkeypatch.setattr(jaccard_join, "BROADCAST_IDS", 0)
    plans = plans_of(monkeypatch, "jaccard_join", "components")
    members, pairs = jaccard_join.links(common.prepare(spark).createDataFrame(rows, "doc_id long, text string"))
    plans.append(members._jdf.queryExecution().executedPlan().toString())
    assert members.filter("n_links > 0").count() == 40 and pairs.count() > 39
    joins = sum(p.count("SortMergeJoin") for p in plans)
    assert joins > 20 and not [p for p in plans if "Broadcast" in p]


def test_label_contraction(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 90), (90, 95), (7, 7)]
    got = {r.node: r.label for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {90: 90, 95: 90, 100: 90}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- paragraphs --------------------------------------------------------------


def test_paragraphs(spark, docs, empty):
    rng = random.Random(12)
    near, passage = words(rng, 100).split(), words(rng, 55)
    rows = [(1, " ".join(near) + "\nshort line"), (2, "short line\n" + " ".join([*near[:50], "edit", *near[51:]]))]
    rows += [(3, words(rng, 40) + " " + passage + " " + words(rng, 30)), (4, passage.upper() + " " + words(rng, 50))]
    rows += [(5, words(rng, 80) + "\nshort line"), (6, None), (7, " ".join(near)), (7, " ".join(near))]
    small = spark.createDataFrame(rows, "doc_id long, text string")
    repeated = substring_dedup.repeated_units(small)
    assert {r.id for r in repeated.collect()} == {1, 2, 3, 4, 7}
    kept = sorted(((r.id, r.text) for r in substring_dedup.without_repeats(small).collect()), key=repr)
    assert (1, rows[0][1]) in kept and (2, "short line\n") in kept and (3, rows[2][1]) in kept and (5, rows[4][1]) in kept
    assert len(next(t for i, t in kept if i == 4)) < len(rows[3][1]) - 100
    assert len(kept) == len(rows)
    assert substring_dedup.repeated_units(empty).count() == 0
    assert substring_dedup.without_repeats(docs).count() == docs.count()


def test_passages_cross_lines_and_go_whole(spark):
    rng = random.Random(21)

    def fresh(tag, n):
        return [f"{tag}{k}x{rng.randrange(10**6)}" for k in range(n)]

    def broken(found, size):
        return "\n".join(" ".join(found[k : k + size]) for k in range(0, len(found), size))

    short, inside, near = fresh("s", 60), fresh("i", 55), fresh("n", 120)
    edited = [*near[:60], "edit", *near[61:]]
    rows = [(1, broken([*fresh("a", 30), *short, *fresh("b", 30)], 8)), (2, broken([*fresh("c", 33), *short, *fresh("d", 30)], 7))]
    rows += [(3, " ".join([*fresh("e", 40), *inside, *fresh("f", 40)])), (4, " ".join([*fresh("g", 40), *inside, *fresh("h", 40)]))]
    # A third document has only a part of the passage, and comes first.
    rows += [(0, " ".join([*fresh("j", 40), *inside[3:53], *fresh("k", 40)])), (5, "nothing again"), (6, None)]
    rows += [(7, broken(near, 6)), (8, broken(edited, 6))]
    small = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {r.id: r.text.split() for r in substring_dedup.without_repeats(small).collect()}
    texts = {i: (t or "").split() for i, t in rows}
    assert all(kept[i] == texts[i] for i in (0, 1, 5, 6, 7))
    assert kept[2] == [w for w in texts[2] if w not in short] and kept[4] == [w for w in texts[4] if w not in inside]
    assert kept[3] == [w for w in texts[3] if w not in inside[3:53]]
    assert len(kept[8]) <= 1
    found = {r.id: r for r in substring_dedup.document_classes(small).collect()}
    assert set(found) == set(texts) and not found[5].class_ids and not found[6].spans
    assert all(set(found[i].class_ids) & set(found[j].class_ids) for i, j in ((1, 2), (3, 4), (0, 3), (7, 8)))
    assert not set(found[1].class_ids) & set(found[3].class_ids)


def test_a_passage_of_a_removed_paragraph_stays_elsewhere(spark):
    """The first copy of a passage lies in a near copy that goes: the other copy stays."""
    rng = random.Random(22)

    def fresh(tag, n):
        return [f"{tag}{k}x{rng.randrange(10**6)}" for k in range(n)]

    base, passage = fresh("b", 500), fresh("p", 55)
    rows = [(1, " ".join(base)), (2, " ".join([*base[:200], *passage, *base[200:]])), (3, " ".join([*fresh("c", 90), *passage, *fresh("d", 90)]))]
    small = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {r.id: r.text.split() for r in substring_dedup.without_repeats(small).collect()}
    assert kept[1] == base and kept[2] == [] and kept[3] == rows[2][1].split()


@pytest.mark.parametrize("seed", [1, 2])
def test_no_repeated_passage_vanishes(spark, seed):
    """Passages, exact paragraphs and near copies at random: each repeated word is left somewhere."""
    rng = random.Random(seed)

    def fresh(tag, n):
        return [f"{tag}w{rng.randrange(10**9)}" for _ in range(n)]

    passages = [fresh(f"p{k}", rng.randrange(50, 90)) for k in range(6)]
    paragraphs = [fresh(f"q{k}", rng.randrange(60, 300)) for k in range(6)]
    rows = []
    for i in range(40):
        lines = []
        for _ in range(rng.randrange(1, 4)):
            line = list(rng.choice(paragraphs)) if rng.random() < 0.6 else fresh("f", rng.randrange(30, 120))
            if rng.random() < 0.5:
                at, cut = rng.randrange(len(line)), rng.randrange(0, 20)
                line[at:at] = rng.choice(passages)[cut:]
            lines.append(" ".join(line))
        rows.append((i, "\n".join(lines)))
    small = spark.createDataFrame(rows, "doc_id long, text string")
    kept = Counter(w for r in substring_dedup.without_repeats(small).collect() for w in r.text.split())
    seen = Counter(w for _, t in rows for w in t.split())
    # Each paragraph is taken several times, so its first copy is exact or holds a passage.
    repeated = {w for w, n in seen.items() if n > 1 and w[0] in "pq"}
    assert repeated and not {w for w in repeated if not kept[w]}
    assert sum(kept.values()) < 0.8 * sum(seen.values())


def test_paragraph_query_has_every_document(spark):
    rows = catalog.op8_substring_dedup(spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in common.documents(spark, SF).collect())
    assert any(r.class_ids for r in rows) and not all(r.class_ids for r in rows)


def test_bands_find_similar_lines():
    """At similarity 0.8 nearly all pairs of sets collide in a band."""
    rng = np.random.default_rng(5)
    hits = 0
    for _ in range(300):
        shared = rng.integers(0, 2**63, 80).astype(np.uint64)
        a, b = (np.concatenate([shared, rng.integers(0, 2**63, 10).astype(np.uint64)]) for _ in range(2))
        hits += bool(set(substring_dedup._bands(a)[0]) & set(substring_dedup._bands(b)[0]))
    assert hits >= 295


def test_sets_that_collide_but_are_far_apart_are_not_compared(spark, monkeypatch):
    """Half-equal paragraphs collide in a band with most others; linking ones are still found."""
    rng = random.Random(17)
    shared = words(rng, 40)
    rows = [(i, f"{shared} " + " ".join(f"own{i}x{k}" for k in range(20))) for i in range(60)]
    rows += [(100 + i, text.replace(f"own{i}x19", "edit")) for i, text in rows[:10]]
    compared, write = [], common.materialize

    def written(df, name):
        out = write(df, name)
        if name == "overlaps":
            compared.append(out.count())
        return out

    monkeypatch.setattr(jaccard_join, "materialize", written)
    repeated = substring_dedup.repeated_units(common.prepare(spark).createDataFrame(rows, "doc_id long, text string"))
    got = {(r.id, r.component.id) for r in repeated.filter("class_id LIKE 'p%'").collect()}
    assert got == {(j, i) for i in range(10) for j in (i, 100 + i)}
    assert 10 <= sum(compared) < 60


def test_a_group_of_near_copies_is_not_compared_pair_by_pair(spark, monkeypatch):
    """Paragraphs around a base that none equals, of which many link and many do not."""
    rng = random.Random(23)
    base = words(rng, 90).split()
    rows = []
    for i in range(90):
        copy = list(base)
        for at in rng.sample(range(90), rng.choice([1, 1, 2, 3])):
            copy[at] = f"e{rng.randrange(10**6)}"
        rows.append((i, " ".join(copy)))
    sets = {i: {tuple(t.split()[k : k + 5]) for k in range(86)} for i, t in rows}
    links = {(i, j) for i, j in itertools.combinations(sets, 2) if 10 * len(sets[i] & sets[j]) >= 8 * len(sets[i] | sets[j])}
    root = {i: i for i in sets}
    for _ in sets:
        for i, j in links:
            root[i] = root[j] = min(root[i], root[j])
    compared, write = [], common.materialize

    def written(df, name):
        out = write(df, name)
        if name == "overlaps":
            compared.append(out.count())
        return out

    monkeypatch.setattr(jaccard_join, "materialize", written)
    monkeypatch.setattr(jaccard_join, "OPEN_PAIRS", 0)
    monkeypatch.setattr(jaccard_join, "OPEN_PER_COMPARED", 0)
    repeated = substring_dedup.repeated_units(common.prepare(spark).createDataFrame(rows, "doc_id long, text string"))
    got = {r.id: r.component.id for r in repeated.filter("class_id LIKE 'p%'").collect()}
    alone = {i for i in sets if list(root.values()).count(root[i]) == 1}
    assert got == {i: root[i] for i in sets if i not in alone}
    assert len(got) > 40 and len(links) > 200 and sum(compared) < 400


def test_odd_counts_differ_in_no_more_bits_than_sets_in_members():
    rng = np.random.default_rng(6)
    for n in (1, 20, 90, 700):
        shared = rng.integers(0, 2**64, n, np.uint64)
        own = [rng.integers(0, 2**64, k, np.uint64) for k in (0, 3, 1 + n // 5)]
        sets = [np.concatenate([shared, o]) for o in own]
        odd = substring_dedup._odd_counts(np.concatenate(sets), np.cumsum([0, *map(len, sets[:-1])]))
        for i, j in itertools.combinations(range(3), 2):
            bits = sum(int(x ^ y).bit_count() for x, y in zip(odd.view(np.uint64)[i].tolist(), odd.view(np.uint64)[j].tolist(), strict=True))
            assert bits <= len(own[i]) + len(own[j]) and bits % 2 == (len(own[i]) + len(own[j])) % 2


def test_paragraphs_of_texts_worked_on_together(monkeypatch):
    """Texts side by side give what each gives by itself."""
    rng = random.Random(2)
    texts = [b"", b" \n", b"one", b"x " * 24, b"x " * 25, b"\n" + b"y " * 200 + b"\n\nz z", "\u00e9 \x01 w ".encode() * 30]
    texts += ["\n".join(words(rng, rng.randrange(40)) for _ in range(rng.randrange(12))).encode() for _ in range(80)]
    rng.shuffle(texts)
    alone = [(i, *(c.tolist() for c in row)) for i, t in enumerate(texts) for row in zip(*substring_dedup.line_units([t])[1:], strict=True)]
    for size in (1, 900, 1 << 18):
        monkeypatch.setattr(substring_dedup, "_LOT_BYTES", size)
        both = []
        for first, last in substring_dedup._lots(texts):
            at, *columns = substring_dedup.line_units(texts[first:last])
            both += [(i, *(c.tolist() for c in row)) for i, row in zip((at + first).tolist(), zip(*columns, strict=True), strict=True)]
        assert both == alone and len({r[0] for r in both}) > 60
    for i, start, stop, n, *_ in alone:
        found = texts[i][start:stop].lower().split()
        assert len(found) >= 25 and n == len({tuple(found[k : k + 5]) for k in range(len(found) - 4)})


# --- mixing ------------------------------------------------------------------


def test_targets():
    assert mixing.targets([100, 100, 100], [5, 2, 1], 1.5, 2) == [200, pytest.approx(500 / 3), pytest.approx(250 / 3)]
    assert mixing.targets([0, 10], [5, 2], 1.5, 2) == [0, 15]
    assert mixing.targets([], [], 1.5, 2) == []


def test_splitting_tree_is_exact():
    quotas = [1000, 37, 0, 5]
    tree = mixing.split_quotas(quotas, 7, 3)
    assert tree.sum(axis=0).tolist() == quotas and np.ptp(tree.sum(axis=1)) <= 1
    assert np.array_equal(tree, mixing.split_quotas(quotas, 7, 3))


def test_mix(docs, empty, texts):
    sizes = [len([w for w in re.split(r"[\x20\x09-\x0D]+", t or "") if w]) for _, t, _ in texts]
    by_source = Counter()
    for (_, _, s), n in zip(texts, sizes, strict=True):
        by_source[s] += n
    names = sorted(s for s in by_source if s is not None) + [None]
    want = dict(zip(names, mixing.targets([by_source[s] for s in names], [5, 2, 1, 5], 1.5, 2), strict=True))
    report = mixing.mix_report(mixing.plan_mix(docs)).collect()
    assert sorted(r.size for r in report) == sorted(sizes)
    assert all(r.taken in (0, r.size, 2 * r.size) for r in report)
    assert {round(r.target, 6) for r in report} == {round(t, 6) for t in want.values()}
    again = mixing.mix_report(mixing.plan_mix(docs)).collect()
    assert Counter((r.id, r.taken) for r in report) == Counter((r.id, r.taken) for r in again)
    mix = mixing.mixed_documents(docs)
    assert mix.columns == docs.columns
    taken = Counter()
    for r in report:
        taken[r.id] += len(r.shards)
    assert Counter(r.doc_id for r in mix.collect()) == Counter({k: v for k, v in taken.items() if v})
    assert mixing.mix_report(mixing.plan_mix(empty)).count() == mixing.mixed_documents(empty).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_mix_goes_on_after_a_document_that_does_not_fit(spark, seed):
    """The mix equals first fit over all documents of a source in permuted order."""
    sizes = [1000] * 199 + [200_000]
    rows = [(i, "w " * n, "s") for i, n in enumerate(sizes)] + [(1000 + i, "w " * (1 + i * 7 % 50), None) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    mix = mixing.plan_mix(docs, weights=(1.0, 1.0), seed=seed)
    report = mixing.mix_report(mix).join(mix.sized.select("id", "source", "place"), "id").collect()
    for source in ("s", None):
        own = sorted((r for r in report if r.source == source), key=lambda r: r.place)
        left = own[0].target - own[0].source_size * (own[0].target // own[0].source_size)
        for r in own:
            fits = r.size <= left + 0.5
            left -= r.size * fits
            assert r.taken == r.size * (r.target // r.source_size + fits)
    assert sum(r.taken for r in report if r.source == "s") > 0.99 * next(r.target for r in report if r.source == "s")
    assert mixing.mixed_documents(docs, weights=(1.0, 1.0), seed=seed).count() == sum(len(r.shards) for r in report)


def test_mix_comes_near_its_targets(spark):
    rows = catalog.op10_mixing(spark, "/root/testdata/sf0.1")
    rows = rows.join(common.documents(spark, "/root/testdata/sf0.1").select("doc_id", "source"), "doc_id")
    for r in rows.groupBy("source").agg({"target": "max", "taken": "sum"}).collect():
        assert r["sum(taken)"] == pytest.approx(r["max(target)"], rel=0.01)


# --- queries -----------------------------------------------------------------


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_query_equals_its_sql(spark, name):
    assert compare(catalog.QUERIES[name](spark, SF), duckdb_tables(SF), catalog.ORACLE_SQL[name]) is None


def test_every_operator_has_a_query():
    assert {int(re.match(r"op(\d+)_", n)[1]) for n in catalog.QUERIES} == set(range(1, 11))


def test_line_keys_lower_ascii_letters_only_and_strip_a_line_once(spark):
    lines = ["  Ab\t", "ab", "\x0bÄB  ", "ÄB ", "äb ", "İI", "", " \r\x0c", "a "]
    docs = spark.createDataFrame([(i, line) for i, line in enumerate(lines)], "doc_id long, text string")
    keys = line_dedup._keys(line_dedup._rows(docs, "doc_id", "text"))
    found = {r.id: bytes(r.key) for r in keys.collect()}
    lowered = [line.strip("\x20\t\n\x0b\x0c\r").translate({c: c + 32 for c in range(65, 91)}) for line in lines]
    assert found == {i: hashlib.md5(key.encode()).digest() for i, key in enumerate(lowered) if key}
    # A lambda computes an expression as often as it is written.
    assert keys._jdf.queryExecution().optimizedPlan().toString().count("trim(") == 1

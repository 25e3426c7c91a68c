"""The corpus pipeline, each stage on what the stage before has kept."""

import random
import re
from collections import Counter

import corpus_pipeline
import sentencepiece

from pulseledger.llm import catalog, common, jaccard_join, mixing, toxicity

SF = "/root/testdata/sf0.001"


def rows_of(df):
    return Counter(tuple(r) for r in df.collect())


def heads_by_hand(texts):
    """Smallest id of each component of texts that share 0.8 of their sets of five words."""

    def shingles(text):
        found = re.findall(r"[^\x20\x09-\x0D]+", text.translate({c: c + 32 for c in range(65, 91)}))
        return {tuple(found[k : k + 5]) for k in range(max(1, len(found) - 4))} if found else set()

    sets = {i: shingles(t or "") for i, t in texts.items()}
    links = [(i, j) for i in sets for j in sets if i < j and sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    heads = {i: i for i in sets}
    for _ in sets:
        before = dict(heads)
        for i, j in links:
            heads[i] = heads[j] = min(heads[i], heads[j])
        if heads == before:
            break
    return set(heads.values())


def test_stages(spark):
    docs = common.documents(spark, SF)
    kept = [docs]
    for name, stage in corpus_pipeline.STAGES:
        kept.append(common.materialize(stage(spark, kept[-1], SF), re.sub(r"\W", "-", name)))
    assert all(k.columns == docs.columns for k in kept[:-1])
    start, clean, unique, far, mixed, ids = kept

    model = toxicity.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    assert rows_of(clean) == rows_of(start.filter("true")) - Counter(
        {tuple(r): 1 for r in start.collect() if model.score(r.text.encode()) >= toxicity.THRESHOLD}
    )

    best = {}
    for r in clean.collect():
        key = r.text.translate({c: c + 32 for c in range(65, 91)})
        best[key] = max(best.get(key, r), r, key=lambda r: r.doc_id)
    assert rows_of(unique) == Counter(map(tuple, best.values()))

    heads = heads_by_hand({r.doc_id: r.text for r in unique.collect()})
    assert Counter(r.doc_id for r in far.collect()) == Counter(heads)

    copies = {r.id: len(r.shards) for r in mixing.mix_report(mixing.plan_mix(far)).collect()}
    assert Counter(r.doc_id for r in mixed.collect()) == Counter({k: v for k, v in copies.items() if v})

    library = sentencepiece.SentencePieceProcessor(model_file=catalog.piece_model())
    texts = {r.doc_id: r.text for r in far.collect()}
    got = Counter((r.doc_id, tuple(r.ids)) for r in ids.collect())
    assert got == Counter((i, tuple(library.encode(texts[i], add_eos=True))) for i in (r.doc_id for r in mixed.collect()))


def test_near_copies_equal_brute_force(spark):
    """Five words and 0.8: near copies that three words at 0.9 do not link go as well."""
    rng = random.Random(3)
    base = [f"w{rng.randrange(400)}" for _ in range(200)]
    rows = [(0, " ".join(base))]
    for i in range(1, 25):
        copy = list(base)
        for at in rng.sample(range(len(copy)), i % 8):
            copy[at] = f"edit{i}x{at}"
        rows.append((i, " ".join(copy)))
    rows += [(i, " ".join(f"w{rng.randrange(400)}" for _ in range(50))) for i in range(25, 30)]

    docs = common.prepare(spark).createDataFrame(rows, "doc_id long, text string")
    stage = dict(corpus_pipeline.STAGES)["jaccard join"]
    kept = {r.doc_id for r in stage(spark, docs, SF).collect()}
    assert kept == heads_by_hand(dict(rows))
    assert kept < {r.doc_id for r in jaccard_join.one_per_component(docs).collect()}


def test_near_copies_broadcast_no_table_that_grows(spark, monkeypatch):
    """The label tables of the stage and the ids it keeps are dealt by key, whatever size Spark expects."""
    rng = random.Random(9)
    base = [f"w{rng.randrange(400)}" for _ in range(200)]
    rows = [(i, " ".join(base[:i] + [f"e{i}"] + base[i + 1 :])) for i in range(20)]
    plans = []

    def written(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return common.materialize(df, name)

    for module in ("jaccard_join", "components"):
        monkeypatch.setattr(f"pulseledger.llm.{module}.materialize", written)
    monkeypatch.setattr(jaccard_join, "BROADCAST_IDS", 0)
    stage = dict(corpus_pipeline.STAGES)["jaccard join"]
    kept = stage(spark, common.prepare(spark).createDataFrame(rows, "doc_id long, text string"), SF)
    plans.append(kept._jdf.queryExecution().executedPlan().toString())
    assert [r.doc_id for r in kept.collect()] == [0]
    assert len(plans) > 10 and not [p for p in plans if "Broadcast" in p]

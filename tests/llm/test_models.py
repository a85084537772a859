"""Toxicity, top-k search, the pipeline and the registered queries."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest

import __spark_entry__
import corpus_pipeline
from liftlab.llm import queries, topk, toxicity
from tests.llm import data


def toxic_rows(share=0.2):
    rng = random.Random(3)
    docs, labels = [], []
    for i in range(900):
        bad = rng.random() < share
        text = data.words(rng, rng.randrange(5, 60))
        if bad:
            for _ in range(rng.randrange(1, 4)):
                text.insert(rng.randrange(len(text)), rng.choice(["Vile,", "rotten", "grubx" + str(rng.randrange(99))]))
        docs.append((i, " ".join(text), "en", "s", None) + (None,) * data.EXTRA)
        labels.append((i, 1, int(bad)))
    return docs, labels


def test_toxicity(spark):
    docs, labels = toxic_rows()
    extra = [(1000, None, None, None, None) + (None,) * data.EXTRA, (1001, "", None, None, None) + (None,) * data.EXTRA,
             (1002, "vile rotten " * 5000, None, None, None) + (None,) * data.EXTRA, docs[0], docs[0]]
    table = data.frame(spark, docs + extra)
    marks = spark.createDataFrame(labels + [(5, 1, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    got = toxicity.score(table, marks).collect()
    assert len(got) == len(docs) + len(extra)
    truth = {i: y for i, _, y in labels}
    held = [(r.predicted, truth[r.doc_id]) for r in got if r.held_out and r.doc_id in truth]
    assert len(held) > 100 and np.mean([p == y for p, y in held]) > 0.98
    by_id = {r.doc_id: r for r in got}
    assert by_id[1000].predicted == by_id[1001].predicted == 0 and by_id[1002].predicted == 1
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    kept = toxicity.clean(table, marks)
    assert kept.columns == table.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(r.doc_id for r in got if not r.predicted)


@pytest.mark.parametrize("share", [0.25, 0.5, 0.9])
def test_toxicity_at_any_share(spark, share):
    docs, labels = toxic_rows(share)
    got = toxicity.score(data.frame(spark, docs), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    truth = {i: y for i, _, y in labels}
    held = [(r.predicted, truth[r.doc_id]) for r in got.collect() if r.held_out]
    assert len(held) > 100 and np.mean([p == y for p, y in held]) > 0.98


def test_toxicity_without_telling_stems(spark):
    docs = data.plain(spark, [(i, "same words") for i in range(60)])
    marks = spark.createDataFrame([(i, 1, int(i % 10 > 0)) for i in range(60)], "doc_id long, quality int, toxic int")
    assert all(0.8 < r.score < 1 and r.predicted == 1 for r in toxicity.score(docs, marks).collect())


def test_lexicon_of_all_labelled_texts(spark):
    docs, labels = toxic_rows(0.1)
    rare, bad = {}, [i for i, _, y in labels if y and zlib.crc32(str(i).encode()) % 5]
    for i in bad[:9]:
        rare[i] = " qqrare"
    found = [(i, r[1] + rare.get(i, "")) for i, r in enumerate(docs)]
    copied = [(2000 + i, "copied onlyhere vile") for i in range(300)]
    marks = labels + [(i, 1, 1) for i, _ in copied]
    marks = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    lexicon = toxicity.fit(data.plain(spark, found + copied), marks, rows=60).lexicon
    # nine of all labelled texts hold the first, whatever the sample; copies of one text are one text
    assert {"qqrare$", "vile$", "rotten$"} <= set(lexicon) and not {"copied$", "onlyhere$"} & set(lexicon)


def test_lexicon_without_a_cap(spark):
    rng = random.Random(8)
    vile = [rng.choice("pqxz") + "".join(rng.choice("jkwvy") for _ in range(6)) for _ in range(220)]
    found, labels = [], []
    for i in range(1000):
        text = data.words(rng, 40) + (rng.sample(vile, 25) if i % 2 else [])
        found.append((i, " ".join(text)))
        labels.append((i, 1, i % 2))
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = toxicity.fit(data.plain(spark, found), marks)
    assert {v + "$" for v in vile} <= set(model.lexicon) and len(model.weights) == toxicity.FEATURES + 2
    got = toxicity.score(data.plain(spark, found), marks).collect()
    assert all(r.predicted == r.doc_id % 2 for r in got if r.held_out)


def test_held_out_labels_change_nothing(spark):
    docs, labels = toxic_rows()
    flipped = [(i, q, 1 - y if zlib.crc32(str(i).encode()) % 5 == 0 else y) for i, q, y in labels]
    one, two = (toxicity.fit(data.frame(spark, docs), spark.createDataFrame(m, "doc_id long, quality int, toxic int"))
                for m in (labels, flipped))
    assert one.lexicon == two.lexicon and np.allclose(one.weights, two.weights)


def test_toxicity_without_labels(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = toxicity.score(data.frame(spark), none).collect()
    assert len(got) == len(data.rows()) and all(r.predicted == 0 for r in got)
    assert toxicity.score(data.frame(spark, []), none).collect() == []


def test_label_model_weighs_correlated_voters_less():
    rng = np.random.default_rng(1)
    free, known = Counter(), Counter()
    for k in range(4000):
        y = rng.random() < 0.3
        one = rng.random() < (0.8 if y else 0.1)
        votes = [toxicity.TOXIC if one else 0] * 4                      # four copies of one voter
        votes += [toxicity.TOXIC if rng.random() < (0.8 if y else 0.1) else 0 for _ in range(toxicity.N_VOTERS - 4)]
        if k % 4:
            free[toxicity.encode(tuple(votes))] += 1.0
        else:
            known[toxicity.encode(tuple(votes)), int(y)] += 1.0
    model = toxicity.LabelModel().fit(free, known)
    assert model.weights[:4].max() < 0.35 < model.weights[4:].min()
    assert abs(model.prior[1] - 0.3) < 0.05
    assert abs(model.chances[1, 6, toxicity.TOXIC] - 0.8) < 0.07


def brute_top(rows, k=5, every=50):
    good = [(i, [int(np.floor(256 * float(x))) for x in v]) for i, v in rows
            if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    asked = {}
    for i, v in good:
        if i % every == 0:
            asked[i] = min(asked.get(i, v), v)
    out = Counter()
    for q, v in asked.items():
        found = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in good if i != q and len(w) == len(v))[:k]
        for rank, (score, i) in enumerate(found, 1):
            out[(q, rank, i, -score)] += 1
    return out


@pytest.mark.parametrize("tiles", [(2_048, 8_192), (2, 7)])
def test_top_k(spark, tiles, monkeypatch):
    monkeypatch.setattr(topk, "TILE_QUERIES", tiles[0])
    monkeypatch.setattr(topk, "TILE_VECTORS", tiles[1])
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.integers(-3, 4, 6) / 4]) for i in range(260)]
    rows += [(300, None), (301, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (302, [float("nan")] * 6), (303, [float("inf")] * 6),
             (304, [1.0, 2.0]), (350, [1.0, 1.0]), (None, [1.0] * 6), rows[50], rows[50], rows[7], rows[7],
             (400, [3e5] * 6), (401, [-3e5] * 6), (450, [])]
    table = spark.createDataFrame([(i, v, 1, "clash") for i, v in rows], "vec_id long, embedding array<double>, label int, score string")
    usable = topk.usable(table)
    got = topk.top_k(usable, usable.filter("vec_id % 50 = 0"))
    assert Counter(map(tuple, got.collect())) == brute_top(rows)
    empty = topk.usable(table.limit(0))
    assert topk.top_k(empty, empty).collect() == []


def test_top_k_beyond_a_long(spark):
    table = spark.createDataFrame([(0, [1e30, 1.0]), (1, [1e30, 0.0]), (2, [-1e30, 0.0])], "vec_id long, embedding array<double>")
    usable = topk.usable(table)
    got = [tuple(r) for r in topk.top_k(usable, usable.filter("vec_id = 0")).orderBy("rank").collect()]
    assert got == [(0, 1, 1, 2**63 - 1), (0, 2, 2, -2**63 + 1)]


def test_pipeline_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    numbers = [2, 7, 5, 1, 4]
    assert len(corpus_pipeline.STAGES) == len(numbers)
    before = docs
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        after = corpus_pipeline.written(stage(spark, before, sf), "test-stage")
        if k < 4:
            assert after.columns == docs.columns and after.count()
        else:
            assert {r.doc_id for r in after.select("doc_id").distinct().collect()} == {
                r.doc_id for r in before.select("doc_id").collect()}
        before = after


def test_registered(spark, sf):
    found = __spark_entry__.queries()
    assert {f"op{n}" for n in range(1, 11)} <= {name.split("_")[0] for name in found} and "pipeline" in found
    assert set(queries.ORACLES) <= set(found)

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidelog.llm import labelled, quality, registry, textbatch, toxicity

import pyarrow as pa


def _pairs(module, texts):
    out = []
    for at, to, body, offsets in textbatch.slices(pa.array(texts, pa.string())):
        found, owner = module.features(body, offsets) if module is quality else module.distinct(*module.terms(body, offsets))
        out += [np.sort(found[owner == k]).tolist() for k in range(to - at)]
    return out


@pytest.mark.parametrize("module", [quality, toxicity])
def test_features_do_not_depend_on_neighbours(module):
    texts = ["one two, THREE one two, THREE", "", None, "a", "Été élan ÉTÉ déjà-vu", "x " * 500, "long" * 900]
    together = _pairs(module, texts)
    assert together == [_pairs(module, [t])[0] for t in texts]
    assert together[1] == together[2] == []
    assert all(len(set(f)) == len(f) for f in together)


def test_terms_fold_case_and_share_prefixes():
    a, b, c = _pairs(toxicity, ["ÉTÉSTUPIDE", "étéstupide", "étéstupides"])
    assert a == b and set(a) & set(c) and a != c


def test_machine_learns_a_pair():
    r = random.Random(1)
    rows = []
    for _ in range(1500):
        x, y = r.random() < 0.5, r.random() < 0.5
        found = [1000 + r.randrange(30) for _ in range(3)] + [1] * x + [2] * y
        rows.append((int(x and y), np.unique(found)))
    m = toxicity.fit(rows)
    p = [float(m.probability(m.margins(np.array(f), np.zeros(len(f), int), 1))[0]) for f in ([1, 2], [1], [2])]
    assert p[0] > 0.8 and max(p[1:]) < 0.3


def test_margins_equal_the_definition():
    r = np.random.default_rng(0)
    m = toxicity.Machine(-1.0, np.array([3, 9, 12]), np.array([0.5, -2.0, 1.0]), r.normal(size=(3, 4)))
    found, owner = np.array([9, 3, 3, 77, 12, 9]), np.array([0, 0, 0, 0, 0, 1])
    v = m.factors
    want = -1 + 0.5 - 2 + 1 + v[0] @ v[1] + v[0] @ v[2] + v[1] @ v[2]
    assert np.allclose(m.margins(found, owner, 3), [want, -3.0, -1.0])


@pytest.mark.parametrize("module", [quality, toxicity])
def test_labels_of_one_class_or_none(module):
    if module is quality:
        assert module.fit([])[2:] == (1.0, 0.0)
        assert module.fit([(1, np.array([5]))] * 8)[3] > 2
    else:
        assert module.fit([]).offset == 0.0
        assert module.fit([(0, np.array([5]))] * 8).offset < -2


def auc(scores, truth):
    """The share of pairs of a row of each class that the scores put in order; ties count half."""
    values, ranks = np.unique(scores, return_inverse=True)
    below = np.concatenate([[0], np.cumsum(np.bincount(ranks, 1 - truth))])
    mid = (below[ranks] + below[ranks + 1]) / 2
    return float((mid * truth).sum() / (truth.sum() * (1 - truth).sum()))


@pytest.mark.parametrize("name,column,least,area,recall", [("op8_nbsvm_quality", "quality", 0.97, 0.99, 0.97), ("op9_fm_toxicity", "toxic", 0.95, 0.97, 0.85)])
def test_held_out_accuracy(spark, name, column, least, area, recall):
    sf = "/root/testdata/sf0.1"
    got = {r.doc_id: r for r in registry.queries()[name](spark, sf).collect()}
    labels = spark.read.parquet(f"{sf}/labels.parquet").collect()
    assert len(got) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r.score <= 1 for i, r in got.items())
    held = [(got[r.doc_id].predicted, r[column]) for r in labels if r.doc_id in got and got[r.doc_id].held_out]
    assert sum(a == b for a, b in held) / len(held) > least
    truth = np.array([b for _, b in held])
    scores = np.array([got[r.doc_id].score for r in labels if r.doc_id in got and got[r.doc_id].held_out])
    assert auc(scores, truth) > area and np.array([a for a, _ in held])[truth == 1].mean() > recall


def test_nulls_ties_and_clashes(spark):
    docs = spark.createDataFrame([(None, "bad words", "s"), (1, None, "s"), (2, "", "s"), (2, "", "s"), (3, "fine", None)], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(None, 1, 1), (1, None, None), (3, 1, 0), (3, 1, 0), (2, 0, 1)], "doc_id long, quality int, toxic int")
    for module in (quality, toxicity):
        got = module.scored(docs, module.fitted(docs, labels)).withColumn("held_out", labelled.held_out()).collect()
        assert len(got) == 5 and all(0 <= r.score <= 1 for r in got)
        empty = [r.score for r in got if r.doc_id in (1, 2)]
        assert len(set(empty)) == 1
        assert [r.held_out for r in got if r.doc_id is None] == [False]
        assert module.scored(docs.limit(0), module.fitted(docs, labels.limit(0))).collect() == []


def test_machine_learns_a_pair_whose_terms_tell_nothing_alone():
    r = random.Random(4)
    rows = []
    for _ in range(1500):
        x, y = r.random() < 0.5, r.random() < 0.5
        rows.append((int(x != y), np.unique([1000 + r.randrange(30) for _ in range(3)] + [1] * x + [2] * y)))
    m = toxicity.fit(rows)
    p = [float(m.probability(m.margins(np.array(f), np.zeros(len(f), int), 1))[0]) for f in ([1, 2], [1], [2])]
    assert p[0] < 0.2 and min(p[1:]) > 0.7


def test_the_sample_is_bounded_whatever_repeats_and_ids_may_be_text(spark):
    docs = spark.range(3000).select(F.concat(F.lit("d"), (F.col("id") % 40).cast("string")).alias("doc_id"), F.concat(F.lit("good or bad "), (F.col("id") % 7).cast("string")).alias("text"))
    labels = docs.select("doc_id", (F.length("doc_id") % 2).cast("int").alias("quality")).withColumn("toxic", F.col("quality"))
    got = labelled.training_texts(docs, labels, "toxic", 25).collect()
    assert len(got) == len({r.doc_id for r in got}) == 25
    for module in (quality, toxicity):
        assert module.scored(docs, module.fitted(docs, labels)).where("score between 0 and 1").count() == 3000


@pytest.mark.parametrize("module", [quality, toxicity])
def test_very_long_texts_score_as_any(spark, module):
    r = random.Random(3)
    long = " ".join(r.choice(("fine", "bad", "word", "other")) for _ in range(300_000))
    docs = spark.createDataFrame([(i, long if i == 7 else "fine words" if i % 2 else "bad words") for i in range(60)], "doc_id long, text string")
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality")).withColumn("toxic", F.lit(1) - F.col("quality"))
    got = {x.doc_id: x.score for x in module.scored(docs, module.fitted(docs, labels)).collect()}
    assert len(got) == 60 and all(0 <= s <= 1 for s in got.values())

"""Quality classifier: a Naive Bayes support vector machine over n-gram indicators.

A text becomes the set of its n-grams: four-grams of symbol classes of its bytes (32
classes with letter case folded, and the case, length and repetition shapes of its words as
further n-grams). An indicator is scaled by its class log-count ratio, then a linear
hinge-loss model is fitted by dual coordinate descent and its margin calibrated to a
probability. Labels come from a bounded sample of labelled rows outside the held-out fold;
id, language, source and labels are never inputs.

Defined results: null and empty texts have no n-grams and score by the offset alone; a null
doc_id isn't held out; repeated rows score alike, ties and texts of any length as all others; without labels of both classes the score
is their share, or one half; columns of the input named like a result are replaced, all
others kept; an empty table stays empty.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidelog.llm import labelled, textbatch
from tidelog.llm.boosting import platt
from tidelog.llm.perplexity import codes

#: Symbol four-grams take the first part of the feature space, shapes of words the rest.
GRAMS = 1 << 20
SHAPES = 1 << 12
FEATURES = GRAMS + SHAPES
THRESHOLD = 0.3
#: Of the hinge loss, and of the ratio's counts.
COST, SMOOTHING = 0.1, 1.0
EPOCHS = 12


def _word_shapes(body: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(code, text): three-grams of word shapes, and binned shares of repeated words."""
    starts, ends, owner = textbatch.words(body, offsets)
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    hashes = textbatch.word_hashes(body, starts, ends)
    upper = np.concatenate([[0], np.cumsum((body >= 65) & (body <= 90))])
    capital = upper[ends] - upper[starts]
    shape = np.where(capital == 0, 0, np.where(capital == 1, 1, 2))
    last = body[ends - 1]
    letter = (last >= 128) | ((last | 32) >= 97) & ((last | 32) <= 122)
    shape = shape * 2 + ~letter
    same = np.zeros(len(starts), bool)
    same[1:] = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
    shape = shape * 2 + same  # below 12
    n = len(offsets) - 1
    gram = shape.copy()
    gram[1:] = np.where(owner[1:] == owner[:-1], gram[1:] * 13 + shape[:-1] + 1, gram[1:] * 13)
    gram[0] *= 13
    # The share of words and of word pairs that a text has seen before, in 16 bins each.
    bins = []
    for k, size in enumerate((1, 2, 5)):
        found, who = textbatch.shingle_hashes(hashes, owner, n, size)
        order = np.lexsort((found, who))
        again = np.zeros(len(found), bool)
        again[1:] = (found[order][1:] == found[order][:-1]) & (who[order][1:] == who[order][:-1])
        total = np.bincount(who, minlength=n)
        seen = np.bincount(who[order], again, minlength=n)
        scale = np.log2(1 + total) if size == 1 else np.ones(n)
        share = seen / np.maximum(total, 1) / np.maximum(scale, 1) * (6 if size == 1 else 1)
        bins.append(1024 + 64 * k + np.minimum((share * 24).astype(np.int64), 23))
    some = np.flatnonzero(np.bincount(owner, minlength=n))
    code = np.concatenate([gram, *(b[some] for b in bins)])
    return code + GRAMS, np.concatenate([owner, *([some] * len(bins))])


def features(body: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(feature, text), each pair once, grouped by text for the symbol n-grams."""
    n = len(offsets) - 1
    gram = codes(body, offsets).astype(np.int64)
    owner = np.repeat(np.arange(n), np.diff(offsets))
    shape, who = _word_shapes(body, offsets)
    key = np.concatenate([gram, shape]) + np.concatenate([owner, who]) * FEATURES
    key.sort()
    first = np.ones(len(key), bool)
    first[1:] = key[1:] != key[:-1]
    key = key[first]
    return key % FEATURES, key // FEATURES


def _feature_rows(batches):
    for batch in batches:
        for at, to, body, offsets in textbatch.slices(batch.column(1)):
            found, owner = features(body, offsets)
            cut = np.searchsorted(owner, np.arange(to - at + 1))
            rows = [found[a:b].astype("<i4").tobytes() for a, b in zip(cut, cut[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, to - at), pa.array(rows, pa.binary())], ["label", "found"])


def fit(rows: list[tuple[int, np.ndarray]], seed: int = 5) -> tuple[np.ndarray, float, float, float]:
    """(weights by feature, offset, slope and offset of the probability)."""
    y = np.array([label for label, _ in rows])
    if not len(y) or y.min() == y.max():
        share = (y.sum() + 1) / (len(y) + 2)
        return np.zeros(FEATURES, np.float32), 0.0, 1.0, float(np.log(share / (1 - share)))
    sign = np.where(y > 0, 1.0, -1.0)
    fold = np.arange(len(rows)) % 5 == 0  # for calibration, of which nothing else is learned
    counts = np.full((2, FEATURES), SMOOTHING)
    for (label, found), held in zip(rows, fold):
        if not held:
            counts[label, found] += 1
    ratio = np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())
    weights, offset = _descent([(sign[i], rows[i][1]) for i in np.flatnonzero(~fold)], ratio, seed)
    margins = np.array([_margin(weights, offset, rows[i][1]) for i in np.flatnonzero(fold)])
    slope, intercept = platt(margins, y[fold].astype(float))
    return weights.astype(np.float32), offset, slope, intercept


def _margin(weights, offset, found) -> float:
    return float(weights[found].sum()) / np.sqrt(max(len(found), 1)) + offset


def _descent(rows, ratio, seed):
    """Dual coordinate descent for the hinge loss on ratio-scaled indicators of norm-like length."""
    w, b = np.zeros(len(ratio)), 0.0
    xs = [ratio[found] / np.sqrt(max(len(found), 1)) for _, found in rows]
    norms = np.array([float(x @ x) + 1.0 for x in xs])
    alpha = np.zeros(len(rows))
    positive = sum(s > 0 for s, _ in rows)
    cost = {1.0: COST * len(rows) / (2 * max(positive, 1)), -1.0: COST * len(rows) / (2 * max(len(rows) - positive, 1))}
    rng = np.random.default_rng(seed)
    for _ in range(EPOCHS):
        for i in rng.permutation(len(rows)):
            s, found = rows[i]
            gradient = s * (float(w[found] @ xs[i]) + b) - 1
            new = min(max(alpha[i] - gradient / norms[i], 0.0), cost[s])
            step = (new - alpha[i]) * s
            if step:
                alpha[i] = new
                w[found] += step * xs[i]
                b += step
    return w * ratio, b


def _scorer(model):
    weights, offset, slope, intercept = model

    @F.arrow_udf("double")
    def score(text: pa.Array) -> pa.Array:
        out = np.zeros(len(text))
        for at, to, body, offsets in textbatch.slices(text):
            found, owner = features(body, offsets)
            n = to - at
            total = np.bincount(owner, weights[found], minlength=n)
            margin = total / np.sqrt(np.maximum(np.bincount(owner, minlength=n), 1)) + offset
            out[at:to] = 1 / (1 + np.exp(-np.clip(slope * margin + intercept, -35, 35)))
        return pa.array(out)

    return score


def fitted(docs: DataFrame, labels: DataFrame, bound: int = labelled.TRAINING_ROWS):
    """The model from at most bound labelled texts, whose feature numbers are collected."""
    sample = labelled.training_texts(docs, labels, "quality", bound).select("label", "text", "doc_id")
    found = sample.mapInArrow(_feature_rows_with_id, "label int, found binary, doc_id string").collect()
    rows = sorted((r.doc_id, r.label, bytes(r.found)) for r in found)
    return fit([(label, np.frombuffer(f, "<i4")) for _, label, f in rows])


def _feature_rows_with_id(batches):
    for batch in batches:
        done = 0
        for out in _feature_rows([batch]):
            yield pa.RecordBatch.from_arrays([*out.columns, batch.column(2).slice(done, out.num_rows)], ["label", "found", "doc_id"])
            done += out.num_rows


def scored(docs: DataFrame, model) -> DataFrame:
    """docs with score (0 to 1, of quality) and predicted."""
    out = docs.withColumn("score", _scorer(model)(F.col("text")))
    return out.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))

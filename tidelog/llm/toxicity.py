"""Toxicity: a factorization machine over hashed terms.

A term is a word in lower case or one of its beginnings of PREFIXES bytes (inflected forms
share these), hashed to one of BUCKETS numbers. The machine adds to the linear weights of a
text's terms the inner products of the factors of every two of them, so that two terms may
weigh more, or less, together than apart. Factors and weights (a fixed number of them) are
fitted by AdaGrad on log loss over a bounded sample of labelled rows outside the held-out
fold; id, language, source and labels are never inputs.

Defined results: null and empty texts have no terms and score by the offset alone; a null
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

BITS = 20
BUCKETS = 1 << BITS
PREFIXES = (5, 6, 7)
FACTORS = 8
THRESHOLD = 0.5
#: Rows of the sample that must hold a term, and the G statistic between term and label from which its steps are full.
LEAST_ROWS, FULL_G = 4, 8.0
EPOCHS, RATE, PENALTY, BATCH = 30, 0.15, 2e-3, 64
#: Steps of a term of less G are full only in rows of that many terms, and fall with the root of more.
STEP_TERMS = 0.5


def terms(body: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, text) of every term, repeats included."""
    body = textbatch.lowered(body)
    starts, ends, owner = textbatch.words(body, offsets, letters_only=True)
    found = [textbatch.word_hashes(body, starts, ends) >> np.uint64(64 - BITS)]
    who = [owner]
    for k, size in enumerate(PREFIXES, 1):
        longer = ends - starts > size
        own = textbatch.word_hashes(body, starts[longer], starts[longer] + size)
        found.append(textbatch.mix(own + np.uint64(k)) >> np.uint64(64 - BITS))
        who.append(owner[longer])
    return np.concatenate(found).astype(np.int64), np.concatenate(who)


def distinct(found: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    key = np.unique(owner * BUCKETS + found)
    return key % BUCKETS, key // BUCKETS


class Machine:
    """Offset, weights and factors of the buckets in use; all others are zero."""

    def __init__(self, offset: float, used: np.ndarray, weights: np.ndarray, factors: np.ndarray, scale=(1.0, 0.0)):
        self.offset, self.used, self.weights, self.factors, self.scale = offset, used, weights, factors, scale
        self.place = None

    def __getstate__(self):
        return {**self.__dict__, "place": None}

    def margins(self, found: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
        """Of n texts, from their terms (repeats allowed)."""
        if self.place is None:
            self.place = np.full(BUCKETS, -1, np.int32)
            self.place[self.used] = np.arange(len(self.used))
        at = self.place[found]
        some = at >= 0
        key = np.unique(owner[some] * BUCKETS + at[some])
        at, who = key % BUCKETS, key // BUCKETS
        out = np.full(n, self.offset) + np.bincount(who, self.weights[at], minlength=n)
        for f in range(self.factors.shape[1]):
            v = self.factors[at, f]
            out += 0.5 * (np.bincount(who, v, minlength=n) ** 2 - np.bincount(who, v * v, minlength=n))
        return out

    def probability(self, margin: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale[0] * margin + self.scale[1], -35, 35)))


def fit(rows: list[tuple[int, np.ndarray]], seed: int = 11) -> Machine:
    """The machine for rows of (label, distinct buckets)."""
    y = np.array([label for label, _ in rows], float)
    if not len(y) or y.min() == y.max():
        share = (y.sum() + 1) / (len(y) + 2)
        none = np.zeros(0, np.int64)
        return Machine(float(np.log(share / (1 - share))), none, np.zeros(0), np.zeros((0, FACTORS)))
    fold = np.arange(len(rows)) % 5 == 0  # for calibration
    used, g = _frequent([r for r, f in zip(rows, fold) if not f])
    place = np.full(BUCKETS, -1, np.int64)
    place[used] = np.arange(len(used))
    xs = []
    for _, found in rows:
        at = place[found]
        xs.append(at[at >= 0])
    rng = np.random.default_rng(seed)
    # A term that alone tells little has small steps, so that sums over many such terms stay small.
    small = min(1.0, np.sqrt(STEP_TERMS / max(1, np.mean([len(x) for x in xs]))))
    step = np.where(g >= FULL_G, 1.0, small)
    rate = RATE * step
    w, v = np.zeros(len(used)), rng.normal(0, 0.03, (len(used), FACTORS)) * step[:, None]
    b = float(np.log(y.mean() / (1 - y.mean())))
    gw, gv, gb = np.full(len(used), 1e-2), np.full(v.shape, 1e-2), 1e-2
    order = rng.permutation(np.flatnonzero(~fold))
    batches = [_batch(xs, order[i : i + BATCH]) for i in range(0, len(order), BATCH)]
    for _ in range(EPOCHS):
        for k in rng.permutation(len(batches)):
            picked, at, who, here, by_term, first = batches[k]
            n, own = len(picked), v[at]
            sums = np.stack([np.bincount(who, own[:, f], minlength=n) for f in range(FACTORS)], 1)
            squares = np.bincount(who, np.einsum("ij,ij->i", own, own), minlength=n)
            margin = b + np.bincount(who, w[at], minlength=n) + 0.5 * ((sums**2).sum(1) - squares)
            slope = (1 / (1 + np.exp(-np.clip(margin, -35, 35))) - y[picked]) / n
            if not len(here):
                continue
            each = slope[who[by_term]]
            totals = np.add.reduceat(each, first)
            dw = totals + PENALTY / 10 * w[here]
            dv = np.add.reduceat((slope[:, None] * sums)[who[by_term]], first, axis=0) + (PENALTY - totals[:, None]) * v[here]
            gw[here] += dw**2
            gv[here] += dv**2
            gb += slope.sum() ** 2
            w[here] -= rate[here] * dw / np.sqrt(gw[here])
            v[here] -= rate[here, None] * dv / np.sqrt(gv[here])
            b -= RATE * slope.sum() / np.sqrt(gb)
    machine = Machine(b, used, w, v)
    held = np.flatnonzero(fold)
    found = np.concatenate([rows[j][1] for j in held])
    margin = machine.margins(found, np.repeat(np.arange(len(held)), [len(rows[j][1]) for j in held]), len(held))
    machine.scale = platt(margin, y[held])
    return machine


def _batch(xs: list[np.ndarray], picked: np.ndarray) -> tuple:
    """Rows, their terms and whose they are; the terms in order, the places that sort them and where each one's start."""
    at = np.concatenate([xs[j] for j in picked])
    who = np.repeat(np.arange(len(picked), dtype=np.int32), [len(xs[j]) for j in picked])
    by_term = np.argsort(at, kind="stable").astype(np.int32)
    here, first = np.unique(at[by_term], return_index=True)
    return picked, at.astype(np.int32), who, here, by_term, first


def _frequent(rows) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of rows enough, whatever the labels, as a term may count only beside another; and their G statistics."""
    n = np.zeros((2, BUCKETS))
    of = np.zeros(2)
    for label, found in rows:
        n[label, found] += 1
        of[label] += 1
    all_with, total = n.sum(0), of.sum()
    g = np.zeros(BUCKETS)
    for label in (0, 1):
        for seen, whole in ((n[label], all_with), (of[label] - n[label], total - all_with)):
            expected = np.maximum(whole * of[label] / total, 1e-12)
            g += np.where(seen > 0, 2 * seen * np.log(np.maximum(seen, 1e-12) / expected), 0)
    used = np.flatnonzero(all_with >= LEAST_ROWS)
    return used, g[used]


def _feature_rows(batches):
    for batch in batches:
        for at, to, body, offsets in textbatch.slices(batch.column("text")):
            found, owner = distinct(*terms(body, offsets))
            cut = np.searchsorted(owner, np.arange(to - at + 1))
            rows = [found[a:b].astype("<i4").tobytes() for a, b in zip(cut, cut[1:])]
            own = [batch.column(c).slice(at, to - at) for c in ("doc_id", "label")]
            yield pa.RecordBatch.from_arrays([*own, pa.array(rows, pa.binary())], ["doc_id", "label", "found"])


def fitted(docs: DataFrame, labels: DataFrame, bound: int = labelled.TRAINING_ROWS) -> Machine:
    """The machine from at most bound labelled texts, whose buckets are collected."""
    sample = labelled.training_texts(docs, labels, "toxic", bound)
    found = sample.mapInArrow(_feature_rows, "doc_id string, label int, found binary").collect()
    rows = sorted((r.doc_id, r.label, bytes(r.found)) for r in found)
    return fit([(label, np.frombuffer(f, "<i4")) for _, label, f in rows])


def _scorer(machine: Machine):
    @F.arrow_udf("double")
    def score(text: pa.Array) -> pa.Array:
        out = np.zeros(len(text))
        for at, to, body, offsets in textbatch.slices(text):
            out[at:to] = machine.probability(machine.margins(*terms(body, offsets), to - at))
        return pa.array(out)

    return score


def scored(docs: DataFrame, machine: Machine) -> DataFrame:
    """docs with score (0 to 1, of toxicity) and predicted."""
    out = docs.withColumn("score", _scorer(machine)(F.col("text")))
    return out.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))

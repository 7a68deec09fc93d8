"""Quality rules: word and line counts, then bands of n-gram perplexity by language.

Two models are made of all texts. A text's language is that of the likeliest model of order 4
over 32 classes of bytes (letters without case, white space, digit, punctuation, symbol, lead
and further bytes): it has at most 32**4 n-grams a language, is collected and goes to the
workers, so a wrong or missing lang column rejects no text. Its perplexity comes from its
language's model over whole bytes (tidelog.llm.bytemodel), whose n-grams grow with the corpus
and stay in shared files, and is the exponential of the mean negative log-likelihood per byte
in nats; texts are scored by models that weren't fitted on them. Its marks are the nats of all
bytes but letters and digits, by word: junk between words, which costs little by the byte, is
dear there. The exact histograms of nats and of marks over all documents with words enough
give each language a band, median -/+ WIDTH scaled median deviations, and a bound of marks,
median + WIDTH such deviations; documents outside are rejected.

Defined results: a null text has no words and counts as empty; an empty text has perplexity
null and fails the base rules; languages not in LANGUAGES, null among them, share one model
and band; equal texts of a language have equal results, so ties and repeated rows cannot
matter; texts of any length are scored whole, in slices of one text at least; columns of the
input named like a result (in any case) are replaced, all others kept; an empty table stays
empty.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidelog.llm import shared, textbatch, worker
from tidelog.llm.bytemodel import ByteModels, folds

ORDER, BITS = 4, 5
CODES = 1 << (ORDER * BITS)
#: Languages with a model and band of their own (fixed values); the rest share one more.
LANGUAGES = ("de", "en", "es", "fr", "it", "nl", "pt")
#: Log-probabilities are kept as integers of this unit, so that sums are exact in any order.
UNIT = 1 << 16
#: Bins of the histogram in a nat.
BINS = 1000
#: Half the band in median deviations (scaled to standard deviations), and at least, in nats.
WIDTH, LEAST_WIDTH = 8.0, 0.05
#: Bytes that are no marks: ASCII letters and digits, and all of other characters.
_LETTER = np.zeros(256, bool)
_LETTER[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50

_SPACE = 26
_CLASS = np.full(256, 29, np.uint8)  # symbols, control characters
_CLASS[[*range(97, 123)]] = np.arange(26)
_CLASS[[*range(65, 91)]] = np.arange(26)
_CLASS[[0x20, *range(0x09, 0x0E)]] = _SPACE
_CLASS[[*range(48, 58)]] = 27
_CLASS[[*b".,;:'\"-?()"]] = 28
_CLASS[0xC0:] = 30
_CLASS[0x80:0xC0] = 31


def codes(body: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The n-gram code that ends at each byte; before its text stand white-space symbols."""
    c = _CLASS[body].astype(np.int32)
    out = c.copy()
    for k in range(1, ORDER):
        earlier = np.full(len(c), _SPACE, np.int32)
        earlier[k:] = c[:-k] if k < len(c) else 0
        for j in range(k):  # the first k symbols of a text look back beyond its start
            at = offsets[:-1] + j
            earlier[at[at < offsets[1:]]] = _SPACE
        out |= earlier << (BITS * k)
    return out


def language_index(lang: pa.Array) -> np.ndarray:
    known = {name: i for i, name in enumerate(LANGUAGES)}
    return np.array([known.get(x, len(LANGUAGES)) for x in lang.to_pylist()], np.int64)


def _count(batches):
    worker.enter("perplexity")
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        lang = language_index(batch.column(0))
        for at, to, body, offsets in textbatch.slices(batch.column(1)):
            found = codes(body, offsets)
            of_byte = np.repeat(lang[at:to], np.diff(offsets))
            for k in np.unique(lang[at:to]):
                sums.setdefault(int(k), np.zeros(CODES, np.int64))
                sums[int(k)] += np.bincount(found[of_byte == k], minlength=CODES)
    while sums:
        k, n = sums.popitem()
        seen = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(seen), k, np.int32)), pa.array(seen.astype(np.int32)), pa.array(n[seen])], ["model", "code", "n"]
        )
    worker.trim()


def counted(docs: DataFrame) -> DataFrame:
    """model, code, n: the counts of all n-grams of all texts."""
    texts = docs.select(F.col("lang").cast("string"), F.col("text"))
    return texts.mapInArrow(_count, "model int, code int, n long").groupBy("model", "code").agg(F.sum("n").alias("n"))


def _keys(order: int, found: np.ndarray) -> np.ndarray:
    return textbatch.mix(found.astype(np.uint64) | np.uint64(order << 32))


@dataclass
class KneserNey:
    """One language's model: for each order arrays sorted by hash, of n-grams and of contexts."""

    grams: list = field(default_factory=list)
    contexts: list = field(default_factory=list)

    @classmethod
    def of(cls, found: np.ndarray, n: np.ndarray) -> "KneserNey":
        """found, n: the codes and counts of the highest order."""
        by_order = [(found.astype(np.int64), n.astype(np.int64))]
        for order in range(ORDER - 1, 0, -1):  # continuation counts: the distinct symbols before
            lower, count = np.unique(by_order[0][0] & ((1 << (order * BITS)) - 1), return_counts=True)
            by_order.insert(0, (lower, count))
        out = cls()
        for order, (gram, count) in enumerate(by_order, 1):
            of = [int((count == k).sum()) for k in range(1, 5)]
            y = of[0] / (of[0] + 2 * of[1]) if of[0] and of[1] else 0.5
            cut = [min(k, max(0.05, k - (k + 1) * y * of[k] / of[k - 1])) if of[k - 1] else 0.5 * k for k in (1, 2, 3)]
            discount = np.array([0.0, *cut])[np.minimum(count, 3)]
            context, which = np.unique(gram >> BITS, return_inverse=True)
            total = np.bincount(which, count)
            out.grams.append(_sorted(_keys(order, gram), (count - discount) / total[which]))
            out.contexts.append(_sorted(_keys(order, context), np.bincount(which, discount) / total))
        return out

    def scores(self) -> np.ndarray:
        """Log-probabilities of all codes of the highest order, in UNITs."""
        p = np.full(1, 1 / (1 << BITS))
        for order in range(1, ORDER + 1):
            every = np.arange(1 << (order * BITS), dtype=np.int64)
            below = p[every & ((1 << ((order - 1) * BITS)) - 1)]
            p = _looked_up(self.grams[order - 1], _keys(order, every), 0.0) + below * _looked_up(self.contexts[order - 1], _keys(order, every >> BITS), 1.0)
        return np.rint(np.log(p) * UNIT).astype(np.int32)


def _sorted(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys)
    return keys[order], values[order]


def _looked_up(table: tuple[np.ndarray, np.ndarray], keys: np.ndarray, default: float) -> np.ndarray:
    at = np.minimum(np.searchsorted(table[0], keys), len(table[0]) - 1)
    return np.where(table[0][at] == keys, table[1][at], default)


class Models:
    """The models of all languages; their score tables are made once in a process."""

    _made: dict = {}

    def __init__(self, models: dict[int, KneserNey], name: str):
        self.models, self.name = models, name

    @classmethod
    def fitted(cls, docs: DataFrame) -> "Models":
        """Counted by Spark over all of docs; at most (languages + 1) * 32**4 rows are collected."""
        table = counted(docs).toArrow()
        model, code, n = (table.column(k).to_numpy() for k in range(3))
        own = {}
        for k in np.unique(model):
            rows = np.flatnonzero(model == k)
            rows = rows[np.argsort(code[rows])]
            own[int(k)] = KneserNey.of(code[rows], n[rows])
        return cls(own, uuid.uuid4().hex)

    @classmethod
    def forget(cls) -> None:
        cls._made = {}
        ByteModels.forget()

    def scores(self, k: int) -> np.ndarray:
        if Models._made.get("name") != self.name:
            Models._made = {"name": self.name}
        if k not in Models._made:
            Models._made[k] = self.models[k].scores()
        return Models._made[k]

    def likeliest(self, body: np.ndarray, offsets: np.ndarray, allowed: np.ndarray) -> np.ndarray:
        """The model that each text (none empty) is likeliest by, of those allowed for it (texts x models)."""
        found = codes(body, offsets)
        sums = np.stack([np.add.reduceat(self.scores(k)[found], offsets[:-1], dtype=np.int64) for k in self.models], 1)
        return np.array([*self.models], np.int32)[np.where(allowed, sums, np.iinfo(np.int64).min).argmax(1)]


worker.keeps("perplexity", Models.forget)


class Measures:
    """The models of classes, for a text's language, and of bytes, for its perplexity."""

    def __init__(self, classes: Models, whole: ByteModels):
        self.classes, self.whole = classes, whole

    @classmethod
    def fitted(cls, docs: DataFrame) -> "Measures":
        return cls(Models.fitted(docs), ByteModels.fitted(docs, len(LANGUAGES) + 1, language_index))

    def nats(self, text: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """By the model of a text's language the mean negative log-likelihood per byte and that of marks per word, and which model that is; NaN for an empty text."""
        out, which = np.full((2, len(text)), np.nan), np.full(len(text), -1, np.int32)
        languages = self.whole.languages
        for at, to, body, offsets in textbatch.slices(text, 3 << 18):
            full = np.flatnonzero(np.diff(offsets))
            if not len(full):
                continue
            offsets = np.append(offsets[full], len(body))
            other = (1 - folds(body, offsets)) * languages
            known = np.array([[o + k in self.whole.low for k in self.classes.models] for o in range(0, 2 * languages, languages)])[other // languages]
            none = ~known.any(1)
            best = self.classes.likeliest(body, offsets, known | none[:, None])
            scores = self.whole.scores(body, offsets, np.where(none, -1, other + best))
            out[0, at + full] = -np.add.reduceat(scores, offsets[:-1]) / np.diff(offsets) / UNIT
            letter = _LETTER[body]
            start = letter.copy()
            start[1:] &= ~letter[:-1]
            start[offsets[:-1]] = letter[offsets[:-1]]
            words = np.maximum(np.add.reduceat(start, offsets[:-1], dtype=np.int64), 1)
            out[1, at + full] = -np.add.reduceat(np.where(letter, 0, scores), offsets[:-1]) / words / UNIT
            which[at + full] = best
        return out[0], out[1], which


def counts(body: bytes) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a text in UTF-8."""
    found = body.split()
    bare = body.translate(None, b" \t\n\r\x0b\x0c")
    chars = len(bare) if bare.isascii() else len(bare.decode("utf-8", "replace"))
    symbols = len(bare) - len(bare.translate(None, b"#*$%&|<>"))
    duplicate = 0
    if b"\n" in body:
        lines = [x for x in body.split(b"\n") if x.strip()]
        duplicate = len(lines) - len(set(lines))
    repeated = 0
    windows = list(zip(found, found[1:], found[2:]))
    if len(set(windows)) < len(windows):
        seen: dict = {}
        for i, w in enumerate(windows):
            seen.setdefault(w, []).append(i)
        covered = np.zeros(len(found), bool)
        for at in seen.values():
            if len(at) > 1:
                for i in at:
                    covered[i : i + 3] = True
        repeated = int(covered.sum())
    return len(found), chars, symbols, duplicate, repeated


def base_failed(n_words: int, n_repeat_words: int) -> bool:
    return n_words < MIN_WORDS or 100 * n_repeat_words > MAX_REPEAT_PERCENT * n_words


RESULTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _measured(models: Measures):
    fields = [*((n, pa.int64()) for n in RESULTS), ("nats", pa.float64()), ("marks", pa.float64()), ("model", pa.int32())]

    @F.arrow_udf("struct<" + ", ".join(f"{n}: long" for n in RESULTS) + ", nats: double, marks: double, model: int>")
    def measure(text: pa.Array) -> pa.Array:
        worker.enter("perplexity")
        rows = np.zeros((len(text), len(RESULTS)), np.int64)
        for i, t in enumerate(text.cast(pa.binary())):
            if t.is_valid:
                rows[i] = counts(t.as_py())
        nats, marks, which = models.nats(text)
        worker.trim()
        columns = [pa.array(rows[:, k]) for k in range(len(RESULTS))] + [pa.array(x, mask=np.isnan(x)) for x in (nats, marks)] + [pa.array(which)]
        return pa.StructArray.from_arrays(columns, fields=[pa.field(n, t) for n, t in fields])

    return measure


def histogram(found: DataFrame) -> DataFrame:
    """model, marks, bin, n over measured rows with words enough for the base rules; of nats, or of marks."""
    both = F.explode(F.array(*(F.struct(F.lit(m).alias("marks"), F.rint(F.col(n) * BINS).cast("int").alias("bin")) for m, n in ((False, "nats"), (True, "marks")))))
    long = found.where((F.col("n_words") >= MIN_WORDS) & F.col("nats").isNotNull())
    return long.select("model", both.alias("b")).groupBy("model", "b.marks", "b.bin").agg(F.count("*").alias("n"))


def bands(rows) -> dict[int, tuple[float, float]]:
    """For each language the least and largest nats that are kept, from (model, bin, n) rows."""
    out = {}
    by: dict[int, list] = {}
    for model, at, n in rows:
        by.setdefault(model, []).append((at, n))
    for model, own in by.items():
        middle = _median(own)
        deviation = _median([(abs(at - middle), n) for at, n in own])
        half = max(WIDTH * 1.4826 * deviation / BINS, LEAST_WIDTH)
        out[model] = (middle / BINS - half, middle / BINS + half)
    return out


def _median(weighted: list) -> float:
    total, run = sum(n for _, n in weighted), 0
    for at, n in sorted(weighted):
        run += n
        if 2 * run >= total:
            return at
    return 0


def judged(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """docs (or their columns in keep) with the counts, base_failed, kept and perplexity.

    The measured rows are written, so that texts are scored once.
    """
    own = shared.free(docs, "_measures")
    results = {n.lower() for n in (*RESULTS, "base_failed", "kept", "perplexity")}
    names = [c for c in (docs.columns if keep is None else keep) if c.lower() not in results]
    scored = docs.select(*(F.col(f"`{c}`") for c in names), _measured(Measures.fitted(docs))(F.col("text")).alias(own))
    out = shared.written(scored, "measured")
    rows = [tuple(r) for r in histogram(out.select(f"{own}.*")).collect()]
    found, most = (bands((k, at, n) for k, marks, at, n in rows if marks == of) for of in (False, True))
    m = F.col(own)
    inside = F.lit(False)
    for k, (low, high) in found.items():
        inside = inside | ((m["model"] == k) & m["nats"].between(low, high) & (m["marks"] <= most[k][1]))
    failed = (m["n_words"] < MIN_WORDS) | (100 * m["n_repeat_words"] > MAX_REPEAT_PERCENT * m["n_words"])
    return out.select(
        *(F.col(f"`{c}`") for c in names),
        *(m[n].alias(n) for n in RESULTS),
        failed.alias("base_failed"),
        (~failed & F.coalesce(inside, F.lit(False))).alias("kept"),
        F.exp(m["nats"]).alias("perplexity"),
    )


def kept(docs: DataFrame) -> DataFrame:
    """The rows of docs that pass, with their own columns."""
    return judged(docs.withColumn("_row", F.struct(*docs.columns)), ["_row"]).where("kept").select("_row.*")

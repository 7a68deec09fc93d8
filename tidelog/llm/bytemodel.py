"""Modified Kneser-Ney over whole bytes at order 6, counted by Spark and kept in shared files.

An n-gram of 6 bytes is a 48-bit number, so the counts are exact and their number grows with
the corpus. They are dealt by the two bytes before the last one: all orders from 3 on of a
gram, its contexts and its endings then meet in one task, which writes them as arrays sorted
by hash into the shared folder. The driver gets counts of counts and the bounded orders 1
and 2. Workers map the files; they hold a language's grams once for all processes.

Texts are dealt into two folds by their hash, and a text is scored by the models of the
other fold: its own rare n-grams would otherwise make junk likely. Equal texts share a fold.
"""

from __future__ import annotations

import uuid
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, functions as F

from tidelog.llm import shared, textbatch, worker

ORDER = 6
FOLDS = 2
UNIT = 1 << 16
LEAST_PARTS = 32
#: N-grams that a task counts before it hands them on, and scores that a worker remembers (2**x).
HELD, REMEMBERED = 600_000, 22
_ALL = np.uint64((1 << 64) - 1)
_SPACE = np.uint64(0x20)
#: A gram's number has its model's in the bits above.
_MODEL = np.uint64(8 * ORDER)
_GRAM = _ALL >> np.uint64(64 - 8 * ORDER)


def grams(body: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The ORDER bytes that end at each byte, the last one lowest; before its text stand spaces."""
    wide = body.astype(np.uint64)
    out = wide.copy()
    for k in range(1, min(ORDER, len(wide))):
        out[k:] |= wide[:-k] << np.uint64(8 * k)
    spaces = _SPACE * np.uint64(0x010101010101)
    for j in range(ORDER - 1):  # the first bytes of a text look back beyond its start
        at = offsets[:-1] + j
        at = at[at < offsets[1:]]
        own = np.uint64((1 << 8 * (j + 1)) - 1)
        out[at] = (out[at] & own) | (spaces & ~own)
    return out


def folds(body: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return (textbatch.word_hashes(body, offsets[:-1], offsets[1:]) >> np.uint64(40)).astype(np.int64) % FOLDS


def _ending(gram: np.ndarray, order: int) -> np.ndarray:
    return gram & (_ALL >> np.uint64(64 - 8 * order))


def _prefix(gram: np.ndarray) -> np.ndarray:
    """16 bits that all orders from 3 on of a gram and its contexts have in common."""
    return textbatch.mix((gram >> np.uint64(8)) & np.uint64(0xFFFF)) >> np.uint64(48)


def _part(prefix: np.ndarray, parts: int) -> np.ndarray:
    return (prefix * np.uint64(parts) >> np.uint64(16)).astype(np.int32)


def _key(prefix: np.ndarray, gram: np.ndarray, model, order: int, context: bool = False) -> np.ndarray:
    of = (np.asarray(model).astype(np.uint64) * np.uint64(16) + np.uint64(order)) * np.uint64(2) + np.uint64(context)
    return (prefix << np.uint64(48)) | (textbatch.mix(textbatch.mix(gram) + of) >> np.uint64(16))


def _merged(named: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of grams and models in order, each once, and the sums of n."""
    order = np.argsort(named)
    named = named[order]
    first = _runs(named)
    return named[first], np.add.reduceat(n[order], first)


def _packed(x: np.ndarray) -> bytes:
    """64-bit numbers, their first bytes first, compressed."""
    return pa.compress(np.ascontiguousarray(x.view(np.uint8).reshape(-1, 8).T).tobytes(), "zstd", asbytes=True)


def _unpacked(x: bytes, size: int) -> np.ndarray:
    whole = np.frombuffer(pa.decompress(x, size * 8, "zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(whole.reshape(8, -1).T).view(np.uint64).ravel()


def _count(parts: int, languages: int, index):
    def count(batches):
        worker.enter("perplexity")
        held, size = [], 0

        def handed(named, n):
            part = _part(_prefix(named), parts)
            order = np.argsort(part, kind="stable")
            named, n, part = named[order], n[order], part[order]
            first = np.append(_runs(part), len(part))
            rows = [(_packed(np.diff(named[a:b], prepend=np.uint64(0))), _packed(n[a:b])) for a, b in zip(first, first[1:])]
            columns = [pa.array(part[first[:-1]]), pa.array(np.diff(first)), *(pa.array(x, pa.binary()) for x in zip(*rows))]
            return pa.RecordBatch.from_arrays(columns, ["part", "size", "grams", "n"])

        for batch in batches:
            lang = index(batch.column(0))
            for at, to, body, offsets in textbatch.slices(batch.column(1)):
                if not len(body):
                    continue
                model = (folds(body, offsets) * languages + lang[at:to]).astype(np.uint64) << _MODEL
                held.append(np.unique(grams(body, offsets) | np.repeat(model, np.diff(offsets)), return_counts=True))
                size += len(held[-1][0])
                if size > 2 * HELD:
                    held = [_merged(*(np.concatenate(x) for x in zip(*held)))]
                    size = len(held[0][0])
                    if size > HELD:
                        yield handed(*held[0])
                        held, size = [], 0
        if held:
            last = handed(*_merged(*(np.concatenate(x) for x in zip(*held))))
            del held
            yield last
        worker.trim()

    return count


def _store(uri: str) -> tuple[fs.FileSystem, str]:
    scheme = urlparse(uri).scheme
    return (fs.LocalFileSystem(), urlparse(uri).path) if scheme in ("", "file") else fs.FileSystem.from_uri(uri)


def _runs(*by: np.ndarray) -> np.ndarray:
    """Where runs of equal values start."""
    new = np.zeros(len(by[0]), bool)
    new[:1] = True
    for x in by:
        new[1:] |= x[1:] != x[:-1]
    return np.flatnonzero(new)


def _tables(named: np.ndarray, n: np.ndarray):
    """Sorted keys and values of grams and contexts, and rows (model, order, code, n) for the driver."""
    named, n = _merged(named, n)
    kept, contexts, rows = [], [], []
    for order in range(ORDER, 2, -1):
        gram, model, prefix = named & _GRAM, named >> _MODEL, _prefix(named)
        kept.append((_key(prefix, gram, model, order), n.astype(np.float32)))
        first = _runs(named >> np.uint64(8))
        values = np.stack([np.add.reduceat(x, first, dtype=np.int64) for x in (n, n == 1, n == 2, n >= 3)], 1).astype(np.float32)
        contexts.append((_key(prefix[first], gram[first] >> np.uint64(8), model[first], order, True), values))
        for k in range(1, 5):
            seen = np.bincount(model[n == k].astype(np.int64))
            rows += [(m, order, k, seen[m]) for m in np.flatnonzero(seen)]
        named, n = _merged(_ending(gram, order - 1) | (model << _MODEL), np.ones(len(gram), np.int64))
    model, gram = (named >> _MODEL).astype(np.int64), named & _GRAM
    rows += zip(model, np.full(len(model), 2), gram.astype(np.int64), n)
    out = []
    for table in (kept, contexts):
        keys, values = (np.concatenate(x) for x in zip(*table))
        at = np.argsort(keys)
        out.append((keys[at], values[at]))
    return out, rows


def _build(folder: str):
    def build(batches):
        worker.enter("perplexity")
        held: dict[int, list] = {}
        for batch in batches:
            for part, size, named, n in zip(*(x.to_pylist() for x in batch.columns)):
                held.setdefault(part, []).append((size, named, n))
        store, path = _store(folder)
        for p in sorted(held):
            own = held.pop(p)
            named = np.concatenate([np.cumsum(_unpacked(x, size), dtype=np.uint64) for size, x, _ in own])
            (grams_, contexts), rows = _tables(named, np.concatenate([_unpacked(x, size) for size, _, x in own]).astype(np.int64))
            draft = f"{path}/.{p}-{uuid.uuid4().hex}"
            with store.open_output_stream(draft) as out:
                out.write(np.array([len(grams_[0]), len(contexts[0])], np.int64).tobytes())
                for x in (grams_[0], contexts[0], grams_[1], contexts[1]):
                    out.write(x.tobytes())
            store.move(draft, f"{path}/{p}")
            columns = [np.array(x, np.int64) for x in zip(*rows)]
            del grams_, contexts, rows, named, own
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["model", "order", "code", "n"])
        worker.trim()

    return build


def _discounts(of: list[int]) -> np.ndarray:
    y = of[0] / (of[0] + 2 * of[1]) if of[0] and of[1] else 0.5
    return np.array([min(k, max(0.05, k - (k + 1) * y * of[k] / of[k - 1])) if of[k - 1] else 0.5 * k for k in (1, 2, 3)])


def _low(n: np.ndarray) -> np.ndarray:
    """Probabilities of all pairs of bytes from their continuation counts."""
    p = np.full(1, 1 / 256)
    for order in (1, 2):
        own = n if order == 2 else (n.reshape(256, 256) > 0).sum(0)
        cut = np.array([0.0, *_discounts([int((own == k).sum()) for k in range(1, 5)])])[np.minimum(own, 3)]
        own, cut = own.reshape(-1, 256), cut.reshape(-1, 256)
        total = own.sum(1, keepdims=True)
        safe = np.maximum(total, 1)
        p = np.where(total > 0, (own - cut) / safe + cut.sum(1, keepdims=True) / safe * p, p)
    return p.ravel().astype(np.float32)


class ByteModels:
    """The models of all folds and languages; the orders from 3 on are in shared files."""

    _mapped: dict = {}
    _known: dict = {}

    def __init__(self, folder: str, parts: int, languages: int, low: dict, discounts: dict):
        self.folder, self.parts, self.languages, self.low, self.discounts = folder, parts, languages, low, discounts

    @classmethod
    def fitted(cls, docs: DataFrame, languages: int, index) -> "ByteModels":
        """From lang and text of all docs; index gives the numbers of languages of a column."""
        spark = docs.sparkSession
        folder = f"{shared.shared_dir(spark)}/byte-model-{uuid.uuid4().hex}"
        store, path = _store(folder)
        store.create_dir(path, recursive=True)
        texts = docs.select(F.col("lang").cast("string"), F.col("text"))
        parts = max(LEAST_PARTS, texts.rdd.getNumPartitions())
        dealt = texts.mapInArrow(_count(parts, languages, index), "part int, size long, grams binary, n binary").repartition(parts, "part")
        rows = dealt.mapInArrow(_build(folder), "model long, order long, code long, n long").groupBy("model", "order", "code").agg(F.sum("n").alias("n"))
        model, order, code, n = (x.to_numpy() for x in rows.toArrow().columns)
        low, discounts = {}, {}
        for m in np.unique(model).tolist():
            pairs = (model == m) & (order == 2)
            low[m] = _low(np.bincount(code[pairs], n[pairs], 1 << 16).astype(np.int64))
            for k in range(3, ORDER + 1):
                own = (model == m) & (order == k)
                discounts[m, k] = _discounts(np.bincount(code[own], n[own], 5).astype(np.int64)[1:].tolist())
        return cls(folder, parts, languages, low, discounts)

    @classmethod
    def forget(cls) -> None:
        cls._mapped, cls._known = {}, {}

    def _tables(self, part: int):
        if ByteModels._mapped.get("folder") != self.folder:
            ByteModels._mapped = {"folder": self.folder}
        if part not in ByteModels._mapped:
            store, path = _store(self.folder)
            path = f"{path}/{part}"
            if store.get_file_info(path).type == fs.FileType.NotFound:
                ByteModels._mapped[part] = None
            else:
                local = isinstance(store, fs.LocalFileSystem)
                with pa.memory_map(path) if local else store.open_input_file(path) as file:
                    whole = file.read_buffer()
                g, c = np.frombuffer(whole, np.int64, 2)
                at = 16 + 8 * (g + c)
                ByteModels._mapped[part] = (
                    (np.frombuffer(whole, np.uint64, g, 16), np.frombuffer(whole, np.float32, g, at)),
                    (np.frombuffer(whole, np.uint64, c, 16 + 8 * g), np.frombuffer(whole, np.float32, 4 * c, at + 4 * g).reshape(-1, 4)),
                )
        return ByteModels._mapped[part]

    def probabilities(self, m: np.ndarray, gram: np.ndarray) -> np.ndarray:
        """Of the last byte of each gram after the others, by model m of each."""
        models = np.array(sorted(self.low))
        at = np.searchsorted(models, m)
        p, pair = np.empty(len(gram)), _ending(gram, 2).astype(np.int64)
        for i in np.unique(at).tolist():
            own = np.flatnonzero(at == i)
            p[own] = self.low[int(models[i])][pair[own]]
        # Discounts of counts 0 to 3 by model and order.
        cuts = {k: np.stack([np.concatenate([[0.0], self.discounts[int(x), k]]) for x in models]) for k in range(3, ORDER + 1)}
        prefix = _prefix(gram)
        part = _part(prefix, self.parts)
        order = np.argsort(part, kind="stable")
        edges = np.flatnonzero(np.diff(part[order], prepend=-1, append=self.parts))
        for a, b in zip(edges, edges[1:]):
            own = order[a:b]
            tables = self._tables(int(part[own[0]]))
            if tables is None:
                continue
            (keys, count), (context_keys, sums) = tables
            for k in range(3, ORDER + 1):
                g, model = _ending(gram[own], k), m[own]
                key = _key(prefix[own], g >> np.uint64(8), model, k, True)
                place = np.minimum(np.searchsorted(context_keys, key), len(context_keys) - 1)
                some = np.flatnonzero(context_keys[place] == key)
                if not len(some):
                    break  # no longer context is known either
                own, g, model = own[some], g[some], model[some]
                of = sums[place[some]].astype(np.float64)
                cut = cuts[k][at[own]]
                key = _key(prefix[own], g, model, k)
                place = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
                n = np.where(keys[place] == key, count[place], 0).astype(np.float64)
                less = cut[np.arange(len(n)), np.minimum(n, 3).astype(np.int64)]
                p[own] = (n - less + (of[:, 1:] * cut[:, 1:]).sum(1) * p[own]) / of[:, 0]
        return p

    def scores(self, body: np.ndarray, offsets: np.ndarray, model: np.ndarray) -> np.ndarray:
        """Log-probability of each byte, in UNITs, by its text's model; by chance alone where that is -1."""
        named = grams(body, offsets)
        named |= np.repeat(np.maximum(model, 0).astype(np.uint64) << _MODEL, np.diff(offsets))
        if ByteModels._known.get("folder") != self.folder:
            slots = 1 << REMEMBERED
            ByteModels._known = {"folder": self.folder, "named": np.full(slots, _ALL), "scores": np.zeros(slots, np.int32)}
        names, known = ByteModels._known["named"], ByteModels._known["scores"]
        slot = textbatch.mix(named)
        slot >>= np.uint64(64 - REMEMBERED)
        slot = slot.view(np.int64)
        got, miss = known[slot], names[slot] != named
        none = model < 0  # texts that no model may score: by chance alone
        if none.any():
            miss &= np.repeat(~none, np.diff(offsets))
        new = np.flatnonzero(miss)
        if len(new):
            fresh, which = np.unique(named[new], return_inverse=True)
            score = self.probabilities((fresh >> _MODEL).astype(np.int64), fresh & _GRAM)
            score = np.rint(np.log(score) * UNIT).astype(np.int32)
            got[new] = score[which]
            # Of grams that share a slot one stays, with its own score.
            slot, at = np.unique(slot[new], return_index=True)
            names[slot], known[slot] = named[new[at]], got[new[at]]
        if none.any():
            got[np.repeat(none, np.diff(offsets))] = round(np.log(1 / 256) * UNIT)
        return got

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from hypothesis import given, settings, strategies as st

from tidelog.llm import perplexity as px


def plain_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in range(i, i + 3)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text if c not in " \t\n\r\x0b\x0c"), len(lines) - len(set(lines)), len(covered))


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="ab #|é\n\t \x0b\x85", max_size=60))
def test_counts(text):
    assert px.counts(text.encode()) == plain_counts(text)


def brute_probability(counts, gram):
    """Interpolated modified Kneser-Ney by its definition, from a Counter of 4-tuples."""
    levels = [counts]
    for order in (3, 2, 1):
        levels.insert(0, Counter(g[1:] for g in levels[0]))
    p = 1 / 32
    for order in range(1, 5):
        own = levels[order - 1]
        of = [sum(1 for n in own.values() if n == k) for k in range(1, 5)]
        y = of[0] / (of[0] + 2 * of[1]) if of[0] and of[1] else 0.5
        cut = [min(k, max(0.05, k - (k + 1) * y * of[k] / of[k - 1])) if of[k - 1] else 0.5 * k for k in (1, 2, 3)]
        g = gram[4 - order :]
        after = {h: n for h, n in own.items() if h[:-1] == g[:-1]}
        if not after:
            continue
        total = sum(after.values())
        back = sum(cut[min(n, 3) - 1] for n in after.values()) / total
        mine = own.get(g, 0)
        p = (mine - (cut[min(mine, 3) - 1] if mine else 0)) / total + back * p
    return p


def test_model_equals_the_definition():
    text = b"the cat sat on the mat; the rat ate the cat 12 times. \xc3\xa9"
    found = px.codes(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
    code, n = np.unique(found, return_counts=True)
    model = px.KneserNey.of(code, n)
    tables = Counter({tuple((c >> (5 * k)) & 31 for k in (3, 2, 1, 0)): int(m) for c, m in zip(code.tolist(), n)})
    scores = model.scores()
    for c in [*code[:40].tolist(), 0, 12345, 999_999]:
        gram = tuple((c >> (5 * k)) & 31 for k in (3, 2, 1, 0))
        assert abs(np.exp(scores[c] / px.UNIT) - brute_probability(tables, gram)) < 1e-4
    whole = np.exp(scores.reshape(-1, 32) / px.UNIT).sum(1)
    assert np.allclose(whole, 1, atol=2e-3)
    for keys, _ in (*model.grams, *model.contexts):
        assert (np.diff(keys.astype(object)) > 0).all()


def test_codes_start_afresh_at_every_text():
    a, b = b"abcde", b"xy"
    both = px.codes(np.frombuffer(a + b, np.uint8), np.array([0, 5, 5, 7]))
    alone = [px.codes(np.frombuffer(t, np.uint8), np.array([0, len(t)])) for t in (a, b)]
    assert both.tolist() == np.concatenate(alone).tolist()


def _docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, kept string")


def test_bands_reject_junk_and_keep_clean(spark):
    import random

    r = random.Random(3)
    vocabulary = ["".join(r.choice("aeioutnsr") for _ in range(r.randint(2, 7))) for _ in range(300)]
    clean = [" ".join(r.choice(vocabulary) for _ in range(120)) for _ in range(150)]
    junk = [" ".join("".join(r.choice("qxzjvkw#|") for _ in range(5)) for _ in range(100)) for _ in range(3)]
    rows = [(i, t, "en", "x") for i, t in enumerate(clean + junk)]
    rows += [(None, None, None, None), (900, "", "en", "x"), (901, "few words", "zz", "x"), (902, "same words " * 60, "en", "x"), (903, clean[0], None, "x")]
    got = {r.doc_id: r for r in px.judged(_docs(spark, rows)).collect()}
    assert all(got[i].kept for i in range(150)) and not any(got[i].kept for i in range(150, 153))
    assert got[None].base_failed and got[None].n_words == 0 and got[None].perplexity is None
    assert got[902].base_failed and got[902].n_repeat_words == 120 and not got[902].kept
    assert got[903].kept
    again = {r.doc_id: r.perplexity for r in px.judged(_docs(spark, rows).repartition(7)).collect()}
    assert again == {k: v.perplexity for k, v in got.items()}
    assert px.kept(_docs(spark, rows)).columns == ["doc_id", "text", "lang", "kept"]
    assert px.kept(_docs(spark, rows)).count() == 151
    assert px.judged(_docs(spark, [])).collect() == []


def _perplexities(spark, texts):
    rows = [(i, t, "zz", "x") for i, t in enumerate(texts)]
    return {r.doc_id: r.perplexity for r in px.judged(_docs(spark, rows)).collect()}


def test_letters_that_are_not_ascii_count(spark):
    import random

    r = random.Random(8)
    letters = [chr(c) for c in range(0x430, 0x450)]
    vocabulary = ["".join(r.choice(letters) for _ in range(r.randint(2, 8))) for _ in range(200)]
    clean = [" ".join(r.choice(vocabulary) for _ in range(100)) for _ in range(80)]
    shuffled = ["".join(c if c == " " else r.choice(letters) for c in t) for t in clean[:4]]
    got = _perplexities(spark, clean + shuffled)
    assert min(got[80 + i] for i in range(4)) > 1.5 * max(got[i] for i in range(80))


def test_byte_model_equals_the_definition(spark):
    from tidelog.llm import bytemodel as bm

    texts = ["the cat sat on the mat; the rat", "ate the cat 12 times. é", "on the mat sat the rat and the cat"]
    model = bm.ByteModels.fitted(_docs(spark, [(i, t, "en", "x") for i, t in enumerate(texts)]), 8, px.language_index)
    for m in model.low:
        own = [t.encode() for t in texts if int(bm.folds(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t.encode())]))[0]) * 8 + 1 == m]
        padded = [b" " * (bm.ORDER - 1) + t for t in own]
        levels = [Counter(p[i : i + bm.ORDER] for p in padded for i in range(len(p) - bm.ORDER + 1))]
        while len(levels) < bm.ORDER:
            levels.insert(0, Counter(g[1:] for g in levels[0]))

        def chance(gram):
            p = 1 / 256
            for k, level in enumerate(levels, 1):
                of = [sum(1 for n in level.values() if n == j) for j in range(1, 5)]
                cut = bm._discounts(of)
                after = {h: n for h, n in level.items() if h[:-1] == gram[-k:][:-1]}
                if after:
                    n = level.get(gram[-k:], 0)
                    p = (n - (cut[min(n, 3) - 1] if n else 0) + sum(cut[min(x, 3) - 1] for x in after.values()) * p) / sum(after.values())
            return p

        probes = [*levels[-1], b"zzzzzz", b"he cax", b" the q"]
        packed = np.array([int.from_bytes(g, "big") for g in probes], np.uint64)
        assert np.allclose(model.probabilities(np.full(len(packed), m), packed), [chance(g) for g in probes], rtol=1e-5)


def test_junk_between_clean_words_is_rejected(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text", "lang")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").select("doc_id", "quality")
    rows = px.judged(docs).join(labels, "doc_id").where("not base_failed").collect()
    junk, clean = ([r.kept for r in rows if r.quality == k] for k in (0, 1))
    assert sum(junk) < 0.01 * len(junk) and sum(clean) > 0.99 * len(clean)


def test_columns_that_clash_and_a_very_long_text(spark):
    text = "some words of a kind that repeat little " * 3
    long = " ".join(f"word{i}" for i in range(200_000))
    df = spark.createDataFrame([(1, text, "en", 5, 6.0, "m", 9), (2, long, "en", 5, 6.0, "m", 9), (2, long, None, 5, 6.0, "m", 9)], "doc_id long, text string, lang string, model int, nats double, _m string, KEPT int")
    got = px.judged(df).orderBy("n_words").collect()
    assert got[0].__fields__[:6] == ["doc_id", "text", "lang", "model", "nats", "_m"] and "KEPT" not in got[0].__fields__
    assert [(r.model, r.nats, r._m) for r in got] == [(5, 6.0, "m")] * 3 and [r.n_words for r in got] == [24, 200_000, 200_000]
    assert px.kept(df).columns == df.columns

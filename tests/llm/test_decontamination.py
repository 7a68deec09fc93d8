import itertools
import random
import re

import numpy as np

from tidelog.llm import decontamination as dc

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(docs, items):
    """(row, item) pairs by laying every item at every place of every text."""
    out, number = set(), {}
    numbers = lambda text: [number.setdefault(x, len(number) + 1) for x in WORD.findall((text or "").lower())]
    bench = [(i, numbers(item)) for i, item in items]
    for d, text in docs:
        w = numbers(text)
        for i, g in bench:
            n = len(g)
            if n < dc.LEAST_WORDS:
                continue
            size = min(dc.WINDOW, n)
            need = n if n < dc.SPAN else -(-size * 4 // 5)
            laid = np.lib.stride_tricks.sliding_window_view(np.array([0] * n + w + [0] * n), n) == np.array(g)
            total = np.concatenate([np.zeros((len(laid), 1), int), laid.cumsum(1)], 1)
            if (total[:, size:] - total[:, :-size]).max() >= need:
                out.add((d, i))
    return out


def make(seed, substituted):
    r = random.Random(seed)
    word = lambda: r.choice(["the", "of", "and"]) if r.random() < 0.3 else "".join(r.choice("abcdefghij") for _ in range(4))
    items = [(i, " ".join(word() for _ in range(r.choice((5, 7, 8, 15, 20, 38))))) for i in range(14)]
    items += [(50, None), (51, ""), (52, "the of"), (53, items[3][1]), (None, "a null item of some eight or more words")]
    docs = []
    for d in range(60):
        w = [word() for _ in range(r.choice((0, 3, 40, 90)))]
        if r.random() < 0.6:
            g = WORD.findall(r.choice(items[:14])[1])
            for _ in range(int(substituted * len(g))):
                g[r.randrange(len(g))] = word()
            at = r.randint(0, len(w))
            w[at:at] = [x.upper() if r.random() < 0.2 else x for x in g]
        docs.append((d, r.choice((" ", "\n", " \t ")).join(w)))
    return docs + [(60, None), (None, items[2][1]), (61, "x " + items[4][1])], items


def frames(spark, docs, items):
    return (
        spark.createDataFrame([(d, t, "x") for d, t in docs], "doc_id long, text string, item_id string"),
        spark.createDataFrame([(i, t, "y") for i, t in items], "item_id long, text string, doc_id string"),
    )


def test_exact_passages_equal_brute_force(spark):
    docs, items = make(1, 0)
    got = {(r.doc_id, r.item_id) for r in dc.passages(*frames(spark, docs, items)).collect()}
    assert got == brute(docs, items) and len(got) > 20


def test_substituted_passages_and_blocks(spark):
    docs, items = make(2, 0.12)
    df, bench = frames(spark, docs, items)
    got = {(r.doc_id, r.item_id) for r in dc.passages(df, bench).collect()}
    want = brute(docs, items)
    assert got == want and len(want) > 10
    assert {(r.doc_id, r.item_id) for r in dc.passages(df, bench, block=100).collect()} == got
    kept = dc.clean(df, bench).collect()
    assert sorted(str(r.doc_id) for r in kept) == sorted(str(d) for d, _ in docs if d not in {x for x, _ in got})
    assert kept[0].__fields__ == ["doc_id", "text", "item_id"]


def test_masks_meet_every_passage_in_tolerance():
    for n in range(dc.SPAN, dc.WINDOW + 1):
        for lost in itertools.combinations(range(n), n - -(-n * 4 // 5)):
            assert any(not {i + x for x in m} & set(lost) for m in dc.MASKS for i in range(n - max(m)))


def test_a_very_long_text_and_text_ids(spark):
    r = random.Random(8)
    item = [f"q{r.randrange(10**6)}" for _ in range(40)]
    long = [f"w{r.randrange(10**6)}" for _ in range(60_000)]
    long[59_000:59_000] = item[10:30]
    docs = spark.createDataFrame([("a", " ".join(long)), ("b", "short")], "doc_id string, text string")
    got = dc.passages(docs, spark.createDataFrame([("i", " ".join(item))], "item_id string, text string")).collect()
    assert [(x.doc_id, x.item_id, x.matched) for x in got] == [("a", "i", 15)]


def test_empty_tables(spark):
    docs, items = frames(spark, [(1, "some words here that are none of them")], [(1, "some words here that are none of them")])
    assert dc.passages(docs, items).count() == 1
    assert dc.passages(docs.limit(0), items).collect() == []
    assert dc.passages(docs, items.limit(0)).collect() == []
    assert dc.clean(docs, items.limit(0)).count() == 1

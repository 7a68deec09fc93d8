import random
from collections import Counter, defaultdict

import numpy as np

from tidelog.llm import bagminhash, neardup
from tidelog.llm.components import components


def shingles(text):
    w = text.encode().split()
    if not w:
        return Counter()
    return Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else Counter([tuple(w)])


def jaccard(a, b):
    total = sum((a | b).values())
    return sum((a & b).values()) / total if total else 0.0


def brute_classes(rows):
    """Least doc_id of each row's class, by comparing everything."""
    bags = [shingles(t) if t is not None else None for _, t in rows]
    parent = list(range(len(rows)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if bags[i] is not None and bags[j] is not None and (rows[i][1] == rows[j][1] or jaccard(bags[i], bags[j]) >= 0.8):
                parent[top(i)] = top(j)
    groups = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        groups[top(i)].append(d)
    return [min((d for d in groups[top(i)] if d is not None), default=None) for i in range(len(rows))]


def test_signatures_are_unbiased():
    r = np.random.default_rng(1)
    errors = []
    for _ in range(20):
        e = r.integers(1, 1 << 49, 60).astype(np.uint64)
        a = r.integers(0, 9, 60)
        b = np.maximum(a + r.integers(-3, 4, 60), 0)
        s = [bagminhash.signatures(e[c > 0], np.zeros((c > 0).sum(), int), c[c > 0], 1, 2000) for c in (a, b)]
        errors.append((s[0] == s[1]).mean() - np.minimum(a, b).sum() / np.maximum(a, b).sum())
    assert abs(np.mean(errors)) < 0.01 and np.abs(errors).max() < 0.05


def test_signatures_do_not_depend_on_neighbours():
    r = np.random.default_rng(2)
    e, c, o = r.integers(1, 1 << 49, 500).astype(np.uint64), r.integers(1, 5, 500), np.sort(r.integers(0, 9, 500))
    whole = bagminhash.signatures(e, o, c, 10, 64)
    for t in range(9):
        own = o == t
        assert (bagminhash.signatures(e[own], np.zeros(own.sum(), int), c[own], 1, 64)[0] == whole[t]).all()
    assert (whole[9] == np.iinfo(np.int64).max).all()


def test_components(spark):
    r = random.Random(4)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(1000, 1060)] + [(5000, x) for x in range(5001, 5200)] + [(7, 7)]
    parent = {}

    def top(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = top(a), top(b)
        parent[max(x, y)] = min(x, y)
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: top(x) for a, b in edges for x in (a, b) if a != b}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def families():
    """Texts with exact copies, chains of edits, and look-alikes below the threshold."""
    r = random.Random(9)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(5))
    rows, n = [], 0
    for _ in range(12):
        base = [word() for _ in range(r.choice((6, 40, 150)))]
        for _ in range(r.choice((1, 3, 9))):
            if r.random() < 0.7:
                base = base.copy()
                for _ in range(r.choice((0, 1, 1, 3))):
                    base[r.randrange(len(base))] = word()
            rows.append((n, " ".join(base)))
            n += 1
    common = " ".join(word() for _ in range(30))
    for _ in range(40):
        rows.append((n, common + " " + " ".join(word() for _ in range(25))))
        n += 1
    rows += [(n, "again and again " * 30), (n + 1, "again and again " * 31), (n + 2, "one two"), (n + 3, "one two"), (n + 4, "one  two"), (n + 5, "three")]
    rows += [(n + 6, ""), (n + 7, ""), (n + 8, None), (n + 9, None), (None, common), (None, common), (n + 10, "solo"), (n + 10, "solo")]
    r.shuffle(rows)
    return rows


def test_classes_equal_brute_force(spark):
    rows = families()
    df = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, class_id string")
    got = neardup.classes(df).collect()
    want = Counter(zip((d for d, _ in rows), brute_classes(rows)))
    assert Counter((r.doc_id, r.class_id) for r in got) == want
    sizes = Counter(r.class_id for r in got if r.class_id is not None)
    assert all(r.class_size == sizes[r.class_id] for r in got if r.class_id is not None)
    kept = neardup.deduplicated(df).collect()
    by_class = Counter(r.class_id for r in got)
    assert len(kept) == len({c for c in by_class if c is not None}) + (1 if by_class[None] else 0)
    assert kept[0].__fields__ == ["doc_id", "text", "class_id"]
    assert len({r.doc_id for r in kept}) == len(kept)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert neardup.classes(none).collect() == [] and neardup.deduplicated(none).collect() == []
    blank = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert neardup.deduplicated(blank).count() == 2


def look_alikes(n):
    """Texts made from one by up to 30 changed words, so that similarities run from 0.2 to 1."""
    r = random.Random(5)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(6))
    base = [word() for _ in range(150)]
    out = []
    for _ in range(n):
        own = base.copy()
        for _ in range(r.randint(0, 30)):
            own[r.randrange(len(own))] = word()
        out.append(" ".join(own))
    return out


def test_look_alikes_are_settled_with_few_comparisons(spark, monkeypatch):
    texts = look_alikes(1200)
    index: dict = {}
    bags = [[index.setdefault(s, len(index)) for s in shingles(t)] for t in texts]
    held = np.zeros((len(texts), len(index)), np.float32)
    for i, b in enumerate(bags):
        held[i, b] = 1
    both = held @ held.T
    size = held.sum(1)
    near = both / (size[:, None] + size[None] - both) >= 0.8
    root = np.arange(len(texts))
    while True:
        least = np.where(near, root[None], len(texts)).min(1)
        if (least == root).all():
            break
        root = least
    compared = []
    measured = neardup.shared.measured

    def noted(df, name, **totals):
        out = measured(df, name, **totals)
        if name == "pairs":
            compared.append(out[1]["rows"])
        return out

    monkeypatch.setattr(neardup.shared, "measured", noted)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.class_id for r in neardup.classes(df).collect()}
    assert [got[i] for i in range(len(texts))] == root.tolist()
    assert len(set(root.tolist())) > 300 and sum(compared) < len(texts) * (len(texts) - 1) / 2 / 10


def test_very_long_texts_and_any_id(spark):
    r = random.Random(6)
    long = [f"w{r.randrange(10**9)}" for _ in range(150_000)]
    other = long.copy()
    other[77_777] = "changed"
    rows = [("b", " ".join(long)), ("a", " ".join(other)), ("c", "x " * 400_000), (None, "x y z")]
    df = spark.createDataFrame(rows, "doc_id string, text string")
    got = {r.doc_id: (r.class_id, r.class_size) for r in neardup.classes(df).collect()}
    assert got == {"a": ("a", 2), "b": ("a", 2), "c": ("c", 1), None: (None, 1)}

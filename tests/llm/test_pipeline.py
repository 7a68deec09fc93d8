from collections import defaultdict

import corpus_pipeline
from tidelog.llm import bpe, pii

from test_bpe import library  # noqa: F401
from test_decontamination import brute
from test_neardup import jaccard, shingles

SF = "/root/testdata/sf0.001"


def test_run_equals_brute_force_from_the_judged_rows(spark, library):  # noqa: F811
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    passed = corpus_pipeline.quality_rules(spark, docs, SF).collect()
    rows = {r.doc_id: r for r in docs.collect()}
    assert 0 < len(passed) < len(rows) and all(rows[r.doc_id] == r for r in passed)
    bags = {r.doc_id: shingles(r.text) for r in passed}
    group = {d: d for d in bags}
    ids = sorted(bags)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if jaccard(bags[a], bags[b]) >= 0.8:
                old, new = group[a], group[b]
                group = {d: new if g == old else g for d, g in group.items()}
    classes = defaultdict(list)
    for d, g in group.items():
        classes[g].append(d)
    stay = [rows[min(c)] for c in classes.values()]
    bad = {d for d, _ in brute([(r.doc_id, r.text) for r in stay], items)}
    trees = pii.model()
    want = {}
    for r in stay:
        if r.doc_id not in bad:
            want[r.doc_id] = library.encode_ordinary(pii.redact(r.text, pii.find(r.text, *trees)[1]))
    got = {r.doc_id: bpe.unpacked(bytes(r.ids)).tolist() for r in corpus_pipeline.run(spark, SF).collect()}
    assert got == want


def test_stages_keep_the_columns_of_documents(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.schema.names == docs.schema.names and out.collect() == []


def test_stages_with_clashing_columns_nulls_and_repeated_rows(spark):
    import random

    r = random.Random(2)
    prose = lambda: " ".join(r.choice(("the", "river", "runs", "past", "old", "mills", "and", "fields", "of", "grain")) + str(r.randrange(40)) for _ in range(120))
    texts = [prose() for _ in range(30)]
    rows = [(i if i % 9 else None, t, "en", None, len(t or ""), i, "a", float(i), True, None) for i, t in enumerate([*texts, texts[3], texts[3], "", None, "short"])]
    names = "doc_id long, text string, lang string, source string, n_chars long, tid int, _row string, marks double, _Kept_ boolean, Model string"
    docs = spark.createDataFrame(rows, names)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        assert out.columns[: len(docs.columns)] == docs.columns, name
        assert out.count() <= len(rows), name
    assert corpus_pipeline.STAGES[1][1](spark, docs, SF).where("text is not null").count() == 32

from collections import Counter

from tidelog.llm import licenses as lc


def test_held_out_paragraphs():
    w, b, t = lc.model()
    rows = lc._paragraphs(1200, 99)
    right = [int(lc._margin(w, b, f).argmax()) == k for k, f in rows]
    assert sum(right) / len(right) > 0.97


def test_every_template_is_found_and_prose_is_not():
    fitted = lc.model()
    for family, texts in lc.TEMPLATES.items():
        for t in texts:
            got = lc.classify(t, fitted)
            assert got and got[0] == family, (family, t, got)
    assert all(lc.classify(t, fitted) is None for t in lc._OTHER)


def test_the_hint_holds_for_all_templates():
    assert all(lc.hinted(t) for texts in lc.TEMPLATES.values() for t in texts)


def test_frames(spark):
    text = "prose line\nReleased under the MIT License.\n\nLicensed under CC BY-NC 4.0.\nReleased under the MIT License."
    df = spark.createDataFrame([(1, text, "a"), (None, "Licensed under the Apache License, Version 2.0.", "b"), (2, None, "c"), (3, "", "d")], "doc_id long, text string, family string")
    got = Counter((r.doc_id, r.paragraph, r.family) for r in lc.scanned(df).collect())
    assert got == Counter([(1, 1, "MIT"), (1, 3, "CC-BY-NC"), (1, 4, "MIT"), (None, 0, "Apache-2.0")])
    assert lc.scanned(df.limit(0)).collect() == []


def test_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    known = {"Apache License": "Apache-2.0", "MIT License": "MIT", "GNU General": "GPL", "CC BY-NC": "CC-BY-NC", "rights reserved": "Proprietary"}
    want = Counter()
    for r in docs.collect():
        for n, line in enumerate(r.text.split("\n")):
            for name, family in known.items():
                if name in line:
                    want[(r.doc_id, n, family)] += 1
    assert Counter((r.doc_id, r.paragraph, r.family) for r in lc.scanned(docs).collect()) == want


def test_wrapped_notices_are_found():
    import textwrap

    fitted = lc.model()
    for family in ("GPL", "BSD", "ISC", "Apache-2.0", "MIT"):
        for t in lc.TEMPLATES[family]:
            wrapped = "\n".join("# " + x for x in textwrap.wrap(t, 50))
            got = list(lc.paragraphs(f"prose line\n\n{wrapped}\n\nmore prose", fitted))
            assert [g[:2] for g in got] == [(2, family)], (t, got)


def test_ids_of_any_kind_go_through_unchanged(spark):
    line = "Released under the MIT License."
    big = 1152921504606846977
    got = lc.scanned(spark.createDataFrame([(big, line), (None, line), (big, line)], "doc_id long, text string")).collect()
    assert Counter(r.doc_id for r in got) == Counter({big: 2, None: 1})
    got = lc.scanned(spark.createDataFrame([("a", line), (None, "x")], "doc_id string, text string")).collect()
    assert [r.doc_id for r in got] == ["a"]


def test_a_notice_in_a_very_long_text(spark):
    text = "some prose of no account\n" * 40_000 + "Released under the MIT License.\n" + "more\n\n" * 20_000
    got = lc.scanned(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    assert [(r.paragraph, r.family) for r in got] == [(40_000, "MIT")]


def test_families_hold_on_templates_left_out(monkeypatch):
    """Fitted without one template of a family that has several, the rest still names it, or leaves it unknown: never another."""
    texts = [(family, t) for family, own in lc.TEMPLATES.items() if len(own) > 2 for t in own[-1:]]
    monkeypatch.setattr(lc, "TEMPLATES", {f: [t for t in own if (f, t) not in texts] for f, own in lc.TEMPLATES.items()})
    fitted = lc.model.__wrapped__()
    named = [(family, lc.classify(t, fitted)) for family, t in texts]
    assert texts and all(got is None or got[0] == family for family, got in named)

import re

from hypothesis import given, settings, strategies as st
import pytest

from tidelog.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain(text):
    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        d = re.sub("[^0-9]", "", m[0])
        if 16 <= len(d) <= 19 and pii.luhn(d):
            out.append(("card", *m.span()))
    return out + [("phone", *m.span()) for m in PHONE.finditer(text) if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15]


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="a.@1 +-(9)é4é25", max_size=60))
def test_base_spans_equal_the_plain_patterns(text):
    assert pii.base_spans(text) == plain(text)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from(["4111 1111 1111 1111", "10.1.2.3", "256.1.1.1.9", "a@b.co", "@x.y", "+1 (377) 555-0271", " ", "x", "é", "@", ".", "4111111111111111"]), max_size=12))
def test_base_spans_of_joined_parts(parts):
    assert pii.base_spans("".join(parts)) == plain("".join(parts))


@pytest.fixture(scope="module")
def trees():
    return pii.model()


def test_trees_add_written_out_data_and_keep_the_rest(trees):
    base, spans = pii.find("write to bob (at) example (dot) com or call 555-123-4567 today", *trees)
    assert base == [] and [s[0] for s in spans] == ["email", "phone"]
    assert pii.find("version 2024-10-11, at the dot of chapter 11-12-1999", *trees) == ([], [])


@pytest.mark.parametrize(
    ("text", "kind", "found"),
    [
        ("ask jane (at) example.com now", "email", "jane (at) example.com"),
        ("host 2001:db8::1 is up", "ip", "2001:db8::1"),
        ("ping fe80::1ff:fe23:4567:890a", "ip", "fe80::1ff:fe23:4567:890a"),
        ("mobile 5551234567 today", "phone", "5551234567"),
        ('TOKEN = "9233A8ECF7C5B09FE5949719B6B82BC439E9329B" end', "secret", "9233A8ECF7C5B09FE5949719B6B82BC439E9329B"),
    ],
)
def test_further_forms(trees, text, kind, found):
    at = text.index(found)
    assert pii.find(text, *trees)[1] == [(kind, at, at + len(found))]


@pytest.mark.parametrize("text", ["at 12:30:45 they are at and. It is", "the id 123e4567-e89b-12d3-a456-426614174000", "commit 9233a8ecf7c5b09fe5949719b6b82bc439e9329b", "order 5551234567"])
def test_look_alikes_are_left_alone(trees, text):
    assert pii.find(text, *trees) == ([], [])


def test_held_out_examples_by_kind(trees):
    x, y = pii._examples(3000, 77)
    p = trees[0].probability(x)
    for k, kind in enumerate(pii.ALL_KINDS):
        own = x[:, 0] == k
        passed = p[own] >= trees[1][kind]
        assert passed[y[own] > 0].mean() > 0.85 and y[own][passed].mean() > 0.94, kind


def test_columns_that_clash_and_repeated_rows(spark):
    df = spark.createDataFrame([("x", 1, 2)] * 2 + [("a@b.co", 1, None)], "text string, _pii long, N_EMAIL long")
    got = pii.redacted(df).collect()
    assert got[0].__fields__ == ["text", "_pii", "N_EMAIL"] and [r.text for r in got] == ["x", "x", "[EMAIL]"]
    assert [r.n_email for r in pii.detected(df.drop("N_EMAIL")).collect()] == [0, 0, 1]


def test_long_runs_take_linear_time(trees):
    for text in ("1" * 300_000, "a" * 300_000 + "@", "1." * 150_000, "+1" * 100_000):
        pii.find(text, *trees)


def test_frames(spark):
    rows = [(1, None, 5, "a"), (None, "", 0, "b"), (2, "a@b.co é +1 (377) 555-0271", 26, None), (2, "clean", 5, "c")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_chars long, spans string")
    got = pii.detected(df).collect()
    assert [(r.n_email, r.n_phone, r.base_spans) for r in got] == [(0, 0, ""), (0, 0, ""), (1, 1, "email:0:6,phone:9:26"), (0, 0, "")]
    out = pii.redacted(df).collect()
    assert [r.text for r in out] == [None, "", "[EMAIL] é [PHONE]", "clean"]
    assert [r.n_chars for r in out] == [5, 0, 17, 5] and [r.spans for r in out] == ["a", "b", None, "c"]
    assert pii.detected(df.limit(0)).collect() == []

import base64
import hashlib

import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings, strategies as st

from tidelog.llm import bpe, registry


@pytest.fixture(scope="module")
def library():
    with open(P.path(bpe.RANKS), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


PATTERN = bpe.vocabulary(P.path(bpe.RANKS)).pattern


def by_chunks(text, size, overlap):
    step = size - overlap
    chunks = []
    for s in range(0, max(len(text) - overlap - 1, 0) + 1, step):
        chunk = text[s : s + size]
        chunks.append(bpe.pretokenised(PATTERN, chunk, s, s + len(chunk) >= len(text)))
    return bpe.stitched(PATTERN, len(text), chunks, lambda a, b: text[a:b])


@settings(max_examples=1500, deadline=None)
@given(st.text(alphabet="ab 1'rels\n\té!²ß", max_size=80), st.integers(4, 24), st.integers(1, 8))
def test_stitching_equals_one_pass(text, size, overlap):
    overlap = min(overlap, size - 1)
    whole = [0] + [m.end() for m in PATTERN.finditer(text)]
    assert by_chunks(text, size, overlap) == whole


def test_frames(spark, library, monkeypatch):
    monkeypatch.setattr(bpe, "CHUNK", 300)
    monkeypatch.setattr(bpe, "OVERLAP", 40)
    long = "it's we'll  12345\n\n" * 60 + "é" * 500 + " tail   "
    texts = [None, "", "plain text, it's 2024!", "<|endoftext|>", long, long, "x" * 2000, "日本語 テキスト 🎉 " * 50, " " * 900]
    rows = [(i if i % 2 else None, t, "clash") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = bpe.decoded(bpe.encoded(df)).collect()
    assert len(got) == len(texts)
    want = sorted((t or "", library.encode_ordinary(t or "")) for t in texts)
    have = sorted((r.text or "", bpe.unpacked(bytes(r.ids)).tolist()) for r in got)
    assert have == want
    assert all(bytes(r.decoded) == (r.text or "").encode() and r.n_tokens * 4 == len(r.ids) for r in got)
    assert bpe.encoded(df.limit(0)).collect() == []


def test_query(spark, library):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = registry.queries()["op4_byte_bpe"](spark, sf).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = library.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in ids)).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()

from collections import Counter
import zlib

import pytest

from tidelog.llm import registry, sharding


def _rows(spark, rows, schema="doc_id long, text string, size string"):
    return spark.createDataFrame(rows, schema)


def _check(rows, texts, n):
    total = len(texts)
    assert len(rows) == total
    assert Counter((r.doc_id, r.text_crc32, r["size"]) for r in rows) == Counter(
        (d, zlib.crc32((t or "").encode()), len((t or "").encode()) + 16) for d, t in texts
    )
    counts = Counter(r.shard for r in rows)
    if total >= n:
        assert max(counts.values()) - min(counts.get(s, 0) for s in range(n)) <= 1
    for s in counts:
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(counts[s]))
    assert sorted(r.row_number for r in rows) == list(range(total))


@pytest.mark.parametrize("total", [1, 2, 5, 17, 1000])
def test_places_are_a_permutation(spark, total):
    texts = [(i, f"text {i} é") for i in range(total)]
    df = _rows(spark, [(d, t, "x") for d, t in texts])
    rows = sharding.shards(df, 4, buckets=8).collect()
    _check(rows, texts, 4)
    again = sharding.shards(df.repartition(3), 4, buckets=8).collect()
    assert {(r.doc_id, r.shard, r.slot) for r in rows} == {(r.doc_id, r.shard, r.slot) for r in again}
    if total == 1000:
        by_number = [r.shard for r in sorted(rows, key=lambda r: r.row_number)]
        assert sum(a == b for a, b in zip(by_number, by_number[1:])) < 350


def test_nulls_ties_and_copies(spark):
    texts = [(None, None), (None, "a"), (1, ""), (1, ""), (1, "b"), (2, None)] + [(7, "same")] * 50
    rows = sharding.shards(_rows(spark, [(d, t, None) for d, t in texts]), 4, buckets=4).collect()
    _check(rows, texts, 4)


def test_copies_beyond_one_block(spark, monkeypatch):
    monkeypatch.setattr(sharding, "BLOCK", 8)
    texts = [(7, "same")] * 50 + [(8, "x")]
    _check(sharding.shards(_rows(spark, [(d, t, None) for d, t in texts]), 4, buckets=4).collect(), texts, 4)


def test_the_query_over_documents(spark):
    sf = "/root/testdata/sf0.001"
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    rows = registry.op2_feistel_shards(spark, sf).collect()
    _check(rows, texts, 40)
    assert {r.law for r in rows} == {"rows"} and {r.grown_shard for r in rows} == {None}


def test_more_buckets_for_more_rows(spark, monkeypatch):
    monkeypatch.setattr(sharding, "BUCKET_ROWS", 10)
    texts = [(f"id{i}", "x" * i) for i in range(300)] + [("long", "é" * 3_000_000)]
    df = _rows(spark, [(d, t, None) for d, t in texts], "doc_id string, text string, size string")
    _check(sharding.shards(df, 4, buckets=2).collect(), texts, 4)


def test_empty_table(spark):
    assert sharding.shards(_rows(spark, [])).collect() == []

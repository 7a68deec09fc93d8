"""Byte-level BPE: overlapping chunks are pre-tokenised apart, stitched, encoded; and decoding.

A text of more than CHUNK characters is split into chunks that overlap. Tasks pre-tokenise
chunks without knowing where the tokens before them end, so a chunk may start inside a
token; but where a match starts decides all matches after it, so from the first boundary
that a chunk has in common with what is known before it, its boundaries are right. Where an
overlap holds no common boundary (one very long word), matching goes on from the last known
boundary until one is met. A match counts only if the characters that decide it lie in its
chunk. The pieces are then encoded each by its own; decoding concatenates the bytes of ids.

Equal long texts are encoded once and joined back by their SHA-256. Texts up to CHUNK are
one chunk and take no shuffle.

Defined results: null text is as the empty text, which has no ids and decodes to no bytes;
rows of equal texts (ties) get equal ids; texts of any length are encoded whole; columns of
the input named like a result are replaced, all others kept; an empty table stays empty.
"""

from __future__ import annotations

import base64
from array import array
from bisect import bisect_left
from functools import lru_cache

import pandas as pd
import public_tokenizers
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, functions as F

from tidelog.llm import worker

CHUNK, OVERLAP = 1 << 16, 1 << 10
#: Pieces whose ids a worker keeps; beyond that it starts afresh.
CACHE = 100_000
RANKS = "byte_bpe_50k.tiktoken"


class Vocabulary(dict):
    """Ids of pieces, computed when first asked for, and the bytes of ids."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.core = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})._core_bpe
        self.pattern = regex.compile(public_tokenizers.PATTERN)

    def __missing__(self, piece: str) -> list[int]:
        if len(self) >= CACHE:
            self.clear()
        ids = self[piece] = self.core.encode_single_piece(piece.encode())
        return ids

    def encode_pieces(self, pieces) -> bytes:
        ids: list[int] = []
        for piece in pieces:
            ids += self[piece]
        return packed(ids)

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, unpacked(ids)))


def packed(ids: list[int]) -> bytes:
    out = array("I", ids)
    if out.itemsize != 4 or memoryview(out).format != "I":
        raise RuntimeError("unsigned 32-bit integers expected")
    if _BIG_ENDIAN:
        out.byteswap()
    return out.tobytes()


def unpacked(ids: bytes) -> array:
    out = array("I")
    out.frombytes(ids)
    if _BIG_ENDIAN:
        out.byteswap()
    return out


_BIG_ENDIAN = array("H", [1]).tobytes() == b"\x00\x01"


@lru_cache(maxsize=2)
def _vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


worker.keeps("bpe", _vocabulary.cache_clear)


def vocabulary(path: str) -> Vocabulary:
    worker.enter("bpe")
    return _vocabulary(path)


def pretokenised(pattern, text: str, start: int, last: bool) -> list[int]:
    """start and the ends of the matches in a chunk that starts at start; unless last, only what later text can't change."""
    out, n = [start], len(text)
    for m in pattern.finditer(text):
        begin, end = m.span()
        if not last and (end + 1 > n or begin + 3 > n):
            break
        out.append(start + end)
    return out


def stitched(pattern, n: int, chunks: list[list[int]], read) -> list[int]:
    """The boundaries of a text of n characters from those of its chunks; read(a, b) gives text[a:b]."""
    known = list(chunks[0])
    for own in chunks[1:]:
        while True:
            at = _common(known, own)
            if at is not None:
                break
            if known[-1] == n:
                return known
            size, more = OVERLAP, []
            while len(more) < 2:
                size *= 2
                more = pretokenised(pattern, read(known[-1], known[-1] + size), known[-1], known[-1] + size >= n)
            known += more[1:]
        i, j = at
        del known[i + 1 :]  # in place: a text has many chunks
        known += own[j + 1 :]
    if known[-1] < n:
        raise RuntimeError("the last chunk must reach the end of the text")
    return known


def _common(known: list[int], own: list[int]) -> tuple[int, int] | None:
    """Places of the first boundary in both sorted lists."""
    i = bisect_left(known, own[0])
    j = 0
    while i < len(known) and j < len(own):
        if known[i] == own[j]:
            return i, j
        if known[i] < own[j]:
            i += 1
        else:
            j += 1
    return None


def _encoder(path: str):
    @F.arrow_udf("binary")
    def encode(texts: pa.Array) -> pa.Array:
        v = vocabulary(path)
        find = v.pattern.findall
        return pa.array([v.encode_pieces(find(t.as_py())) if t.is_valid else b"" for t in texts], pa.binary())

    return encode


def _decoder(path: str):
    @F.arrow_udf("binary")
    def decode(ids: pa.Array) -> pa.Array:
        v = vocabulary(path)
        return pa.array([v.decode(x.as_py()) if x.is_valid else b"" for x in ids], pa.binary())

    return decode


def _encoded_long(texts: DataFrame, path: str) -> DataFrame:
    """sha, ids for texts (sha, text): chunks pre-tokenised in parallel, stitched by text."""
    step = CHUNK - OVERLAP
    starts = F.sequence(F.lit(0), F.greatest(F.char_length("text") - OVERLAP - 1, F.lit(0)), F.lit(step))
    chunks = (
        texts.select("sha", "text", F.char_length("text").alias("n"), F.explode(starts).alias("start"))
        .select("sha", "n", "start", F.expr(f"substring(text, start + 1, {CHUNK})").alias("chunk"))
        .repartition("sha", "start")
    )

    def cut(batches):
        pattern = vocabulary(path).pattern
        for batch in batches:
            ends = [
                array("q", pretokenised(pattern, chunk, start, start + len(chunk) >= n)).tobytes()
                for n, start, chunk in zip(batch["n"], batch["start"], batch["chunk"])
            ]
            yield batch.assign(ends=ends)

    def join(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("start")
        v, n = vocabulary(path), int(group["n"].iloc[0])
        text = "".join(chunk[:step] for chunk in group["chunk"][:-1]) + group["chunk"].iloc[-1]
        bounds = stitched(v.pattern, n, [array("q", e).tolist() for e in group["ends"]], lambda a, b: text[a:b])
        ids = v.encode_pieces(text[a:b] for a, b in zip(bounds, bounds[1:]))
        return pd.DataFrame({"sha": [group["sha"].iloc[0]], "ids": [ids]})

    found = chunks.mapInPandas(cut, "sha string, n int, start int, chunk string, ends binary")
    return found.groupBy("sha").applyInPandas(join, "sha string, ids binary")


def encoded(docs: DataFrame, path: str | None = None) -> DataFrame:
    """docs with ids (binary: little-endian unsigned 32-bit integers) and n_tokens of each whole text."""
    path = path or public_tokenizers.path(RANKS)
    row = docs.select(F.struct(*docs.columns).alias("_row"), F.col("text").alias("_text"))
    long = F.coalesce(F.char_length("_text") > CHUNK, F.lit(False))
    short = row.where(~long).select("_row", _encoder(path)(F.col("_text")).alias("ids"))
    chunked = row.where(long).withColumn("_sha", F.sha2("_text", 256))
    texts = chunked.groupBy(F.col("_sha").alias("sha")).agg(F.first("_text").alias("text"))
    joined = chunked.join(_encoded_long(texts, path), F.col("_sha") == F.col("sha")).select("_row", "ids")
    out = short.unionByName(joined)
    keep = [F.col("_row").getField(c).alias(c) for c in docs.columns if c not in ("ids", "n_tokens")]
    return out.select(*keep, "ids", (F.length("ids") / 4).cast("long").alias("n_tokens"))


def decoded(encoded_docs: DataFrame, path: str | None = None) -> DataFrame:
    """encoded_docs with decoded, the bytes of its ids."""
    return encoded_docs.withColumn("decoded", _decoder(path or public_tokenizers.path(RANKS))(F.col("ids")))

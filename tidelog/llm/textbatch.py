"""Whole texts of an Arrow batch as one byte array, with vectorised words and hashes.

Every function takes whole texts: a text is never cut, so a slice holds at least one text
however long it is. Null texts count as empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from tidelog.llm import worker

#: Bytes of text that are worked on at a time (one text, if it is longer).
SLICE = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True

_MULT = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_BYTES = np.random.default_rng(20240501).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers: dict[str, np.ndarray] = {}
worker.keeps("powers", _powers.clear)


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def slices(column: pa.Array, limit: int = SLICE, rows: int = 1 << 13) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, offsets) for runs of at most so many rows of a string column."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type):
        kind = np.int64
    else:
        kind = np.int32
    n = len(column)
    if n == 0:
        return
    if column.null_count:
        column = column.fill_null("")
    _, offs, data = column.buffers()
    offsets = np.frombuffer(offs, kind)[column.offset : column.offset + n + 1].astype(np.int64)
    body = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        to = int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1
        to = min(n, max(to, at + 1), at + rows)
        yield at, to, body[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
        at = to


def lowered(body: np.ndarray) -> np.ndarray:
    """Bytes with ASCII and Latin-1 capitals in lower case."""
    out = _LOWER[body]
    lead = np.flatnonzero(body[:-1] == 0xC3) + 1
    lead = lead[(body[lead] >= 0x80) & (body[lead] <= 0x9E) & (body[lead] != 0x97)]
    out[lead] += 0x20
    return out


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_PUNCT = _SPACE.copy()
_PUNCT[: 0x80] = True
for _c in b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ":
    _PUNCT[_c] = False


def words(body: np.ndarray, offsets: np.ndarray, letters_only: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, text index) of the words: runs outside ASCII white space, or of letters."""
    inside = ~(_PUNCT if letters_only else _SPACE)[body]
    if not len(body):
        none = np.zeros(0, np.int64)
        return none, none, none
    edge = np.zeros(len(body) + 1, bool)
    edge[offsets] = True
    start = inside.copy()
    start[1:] &= ~inside[:-1] | edge[1:-1]
    end = inside.copy()
    end[:-1] &= ~inside[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(start), np.flatnonzero(end) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers.get("up", ())) < n:
        for name, by in (("up", _MULT), ("down", _INVERSE)):
            out = np.full(n, by, np.uint64)
            out[0] = 1
            _powers[name] = np.multiply.accumulate(out)
    return _powers["up"], _powers["down"]


def word_hashes(body: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the words, from one running polynomial over the bytes."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    up, down = _power(max(SLICE, len(body)) + 1)
    total = np.zeros(len(body) + 1, np.uint64)
    np.cumsum(_BYTES[body] * up[: len(body)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts])


def shingle_hashes(hashes: np.ndarray, owner: np.ndarray, n_texts: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, text index) of all runs of size words; a shorter text with words gives one run of them all."""
    count = np.bincount(owner, minlength=n_texts)
    first = np.concatenate([[0], np.cumsum(count)])[:-1]
    out = np.zeros(0, np.uint64)
    who = np.zeros(0, np.int64)
    n = len(hashes) - size + 1
    if n > 0:
        whole = owner[:n] == owner[size - 1 :]
        total = np.zeros(n, np.uint64)
        for k in range(size):
            total = total * np.uint64(0xD6E8FEB86659FD93) + hashes[k : n + k]
        out, who = mix(total[whole]), owner[:n][whole]
    short = np.flatnonzero((count > 0) & (count < size))
    if len(short):
        extra = []
        for t in short:
            total = np.uint64(count[t])
            with np.errstate(over="ignore"):
                for h in hashes[first[t] : first[t] + count[t]]:
                    total = total * np.uint64(0xA0761D6478BD642F) + h
            extra.append(total)
        out = np.concatenate([out, mix(np.array(extra, np.uint64))])
        who = np.concatenate([who, short])
    return out, who

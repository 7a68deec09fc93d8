"""Weighted minhash signatures of multisets by hierarchical Poisson processes, in numpy.

The weight axis is cut at 1, 2, 4, 8, ... An element (a shingle) has in each cell of it a
Poisson process of points in time, of the cell's width as rate, made from the element's and
the cell's hash alone; every point has a component of the signature and a place in the cell.
An element of weight c owns the points below c: all points of the cells that end at or
below c, and of the cell around c those placed below it. A component's value is the time of
its first owned point, so two texts agree in it with probability sum(min) / sum(max) of
their weights. Times are made in order and a text is done when all components have a point
earlier than any still to come, so few points of heavy texts are ever made.
"""

from __future__ import annotations

import numpy as np

from tidelog.llm.textbatch import mix

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_UNIT = 2.0**-53
#: Times are whole numbers of this.
TICK = 2.0**-40


def multiset(hashes: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(element, text, count), sorted by text, of at most 2**13 texts; elements keep 50 bits."""
    key = (owner.astype(np.uint64) << np.uint64(50)) | (hashes >> np.uint64(14))
    key.sort()
    first = np.ones(len(key), bool)
    first[1:] = key[1:] != key[:-1]
    at = np.flatnonzero(first)
    count = np.diff(np.append(at, len(key)))
    key = key[at]
    return key & np.uint64((1 << 50) - 1), (key >> np.uint64(50)).astype(np.int64), count


def _cells(element, owner, count):
    """(key, text, rate, share of the cell that is owned) of every cell that holds owned weight."""
    keys, owners, rates, shares = [mix(element)], [owner], [np.ones(len(owner))], [np.ones(len(owner))]
    low, level = 1, 1
    at = np.flatnonzero(count > low)
    while len(at):
        keys.append(mix(element[at] ^ (np.uint64(level) << np.uint64(56))))
        owners.append(owner[at])
        rates.append(np.full(len(at), float(low)))
        shares.append(np.minimum((count[at] - low) / low, 1.0))
        low, level = low * 2, level + 1
        at = at[count[at] > low]
    return [np.concatenate(x) for x in (keys, owners, rates, shares)]


def signatures(element: np.ndarray, owner: np.ndarray, count: np.ndarray, n: int, m: int) -> np.ndarray:
    """n by m times, as integers of TICK; a text without elements has the greatest ones."""
    best = np.full((n, m), np.iinfo(np.int64).max)
    total = np.bincount(owner, count, minlength=n)
    reach = np.log(m) + 2.5  # all components have a point by then in 92 of 100 texts
    key, who, rate, share = _cells(element, owner, count)
    while len(key):
        limit = np.where(total > 0, m * reach / np.maximum(total, 1), 0.0)
        _points(best, key, who, rate, share, np.rint(limit / TICK).astype(np.int64))
        left = (best > limit[:, None] / TICK).any(1) & (total > 0)
        stay = left[who]
        key, who, rate, share = (x[stay] for x in (key, who, rate, share))
        reach *= 2
    return best


def _points(best, key, who, rate, share, limit) -> None:
    """Lower best to the owned points of the cells up to their texts' limits."""
    flat, m = best.reshape(-1), best.shape[1]
    start, step = np.zeros(len(key), np.int64), np.zeros(len(key), np.uint64)
    while len(key):
        often = ((limit[who] - start) * TICK * rate * 1.1).astype(np.int64) + 2
        cell = np.repeat(np.arange(len(key)), often)
        first = np.cumsum(often) - often
        mark = mix(key[cell] + (step[cell] + (np.arange(len(cell)) - first[cell] + 1).astype(np.uint64)) * _GOLDEN)
        u = ((mark >> np.uint64(11)).astype(float) + 1.0) * _UNIT
        gap = np.rint(np.log(u) / (rate[cell] * -TICK)).astype(np.int64)
        run = np.cumsum(gap)  # integers, so a cell's times don't depend on its neighbours
        time = run + (start - run[first] + gap[first])[cell]
        due = np.flatnonzero(time <= limit[who[cell]])
        mine = cell[due]
        place = mix(mark[due] ^ _GOLDEN)
        component = ((place >> np.uint64(32)) * np.uint64(m)) >> np.uint64(32)
        at = who[mine] * m + component.astype(np.int64)
        part = share[mine] < 1
        if part.any():
            own = ~part | ((mix(place) >> np.uint64(11)).astype(float) * _UNIT < share[mine])
            at, due = at[own], due[own]
        np.minimum.at(flat, at, time[due])
        last = time[first + often - 1]
        more = last <= limit[who]
        key, who, rate, share, start, step = key[more], who[more], rate[more], share[more], last[more], (step + often.astype(np.uint64))[more]


def bands(times: np.ndarray, rows: int) -> np.ndarray:
    """Hashes of runs of rows components, one column a band."""
    n, m = times.shape
    bits = times.view(np.uint64).reshape(n, m // rows, rows)
    out = np.broadcast_to(mix(np.arange(1, m // rows + 1, dtype=np.uint64)), (n, m // rows)).copy()
    for k in range(rows):
        out = mix(out * np.uint64(0xD6E8FEB86659FD93) + bits[:, :, k])
    return out

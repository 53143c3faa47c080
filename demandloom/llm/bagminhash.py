"""Bags of word shingles and their BagMinHash signatures, vectorised over a batch of texts.

A shingle of weight w takes part with a Poisson process of points over (0, w] x time. The
weight axis is discretised at whole numbers and cut at powers of two, (0,1], (1,2], (2,4],
(4,8], ...; each stretch is one stream of points, in order of time, whose hash says in which unit of
the stretch a point lies (the low bits, as its length is a power of two), so that a lighter bag sees
exactly the points below its own weight. Every point belongs to one signature component; a component keeps
its earliest point. Two bags agree in a component with probability equal to their weighted
Jaccard similarity. Streams stop at the time by which all components are filled.
"""

from __future__ import annotations

import numpy as np
import xxhash

from demandloom.llm.common import Recent, text_parts, worker_kept

SHINGLE = 5
ROWS, BANDS = 5, 26
COMPONENTS = ROWS * BANDS

_U = np.uint64
_GOLD, _M1, _M2, _POLY = _U(0x9E3779B97F4A7C15), _U(0xBF58476D1CE4E5B9), _U(0x94D049BB133111EB), _U(0x100000001B3 * 0x9E3779B1 & (1 << 64) - 1 | 1)


_MASK = (1 << 64) - 1


def _times_gold(k: int) -> np.uint64:
    return _U(int(_GOLD) * k & _MASK)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that scatters neighbours (splitmix64's finaliser)."""
    x = (x ^ (x >> _U(30))) * _M1
    x = (x ^ (x >> _U(27))) * _M2
    return x ^ (x >> _U(31))


def shingle_hashes(text: str | None) -> np.ndarray:
    """Sorted 64-bit hashes of all five-word shingles, with repeats.

    Words are runs of anything but white space, in lower case. A text of one to four words has
    one shingle, all of it; one without words has none.
    """
    words = worker_kept("words", lambda: Recent(xxhash.xxh64_intdigest))
    parts = []
    for part in text_parts(text or ""):
        found = part.lower().split()
        parts.append(np.fromiter(map(words.__getitem__, found), np.uint64, len(found)))
    one = np.concatenate(parts)
    if not len(one):
        return one
    if len(one) < SHINGLE:
        return np.array([xxhash.xxh64_intdigest(" ".join(text.lower().split()))], np.uint64)
    out = one[: len(one) - SHINGLE + 1].copy()
    for k in range(1, SHINGLE):
        out *= _POLY
        out += one[k : len(one) - SHINGLE + 1 + k]
    out = mix(out)
    out.sort()
    return out


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Weighted Jaccard of two sorted bags; 0 if either is empty."""
    if not len(a) or not len(b):
        return 0.0
    both = np.concatenate([a, b])
    both.sort(kind="stable")
    starts = np.concatenate([[0], np.nonzero(both[1:] != both[:-1])[0] + 1])
    kinds = both[starts]
    in_a = np.searchsorted(a, kinds, "right") - np.searchsorted(a, kinds, "left")
    in_b = np.searchsorted(b, kinds, "right") - np.searchsorted(b, kinds, "left")
    return float(np.minimum(in_a, in_b).sum() / np.maximum(in_a, in_b).sum())


def overlaps(bags: list[np.ndarray], width: int = 8192) -> np.ndarray:
    """Sizes of the multiset intersections of all pairs of bags.

    The k-th repeat of a shingle is an element of its own. Elements of two bags or more are the
    columns of a 0/1 matrix, taken ``width`` at a time, whose product with its transpose counts what rows share.
    """
    sizes = np.array([len(b) for b in bags])
    every, owner = np.concatenate(bags), np.repeat(np.arange(len(bags)), sizes)
    first = np.ones(len(every), bool)
    first[1:] = (every[1:] != every[:-1]) | (owner[1:] != owner[:-1])
    repeat = np.arange(len(every)) - np.maximum.accumulate(np.where(first, np.arange(len(every)), 0))
    _, column, count = np.unique(mix(every + _GOLD * repeat.astype(np.uint64)), return_inverse=True, return_counts=True)
    keep = count[column] > 1
    column, owner = np.unique(column[keep], return_inverse=True)[1], owner[keep]
    out = np.zeros((len(bags), len(bags)))
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        a, b = np.searchsorted(column, [low, low + width])
        part = np.zeros((len(bags), width), np.float32)
        part[owner[a:b], column[a:b] - low] = 1
        out += part @ part.T
    return out


def _streams(bags: list[np.ndarray]) -> tuple[np.ndarray, ...]:
    """(bag, seed, low, length, reach) of every stretch that a bag's weights enter."""
    sizes = np.array([len(x) for x in bags])
    every = np.concatenate(bags) if bags else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(len(bags)), sizes)
    first = np.ones(len(every), bool)
    first[1:] = (every[1:] != every[:-1]) | (owner[1:] != owner[:-1])
    at = np.nonzero(first)[0]
    weight = np.diff(np.append(at, len(every)))
    element, owner = every[at], owner[at]
    parts, low, length = [], 0, 1
    keep = np.arange(len(at))
    while len(keep):
        reach = np.minimum(weight[keep], low + length) - low
        parts.append((owner[keep], mix(element[keep] + _times_gold(low + 1)), np.full(len(keep), length), reach))
        low, length = low + length, max(1, low + length)
        keep = keep[weight[keep] > low]
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True)) if parts else (np.zeros(0, np.int64),) * 4


def signatures(bags: list[np.ndarray], components: int = COMPONENTS) -> np.ndarray:
    """One row of ``components`` 32-bit point names a bag; empty bags have zeros."""
    total = np.array([len(x) for x in bags], np.float64)
    best = np.full(len(bags) * components, np.iinfo(np.uint64).max, np.uint64)
    owner, seed, length, reach = _streams(bags)
    limit = (np.log(components) + 3) / np.maximum(total, 1)
    time, step = np.zeros(len(owner)), 0
    pending = total > 0
    while pending.any():
        live = np.nonzero(pending[owner])[0]
        # streams are taken up again from their start with the longer limit; what was found stays valid
        o, s, ln, rc, t, step = owner[live], seed[live], length[live], reach[live], time[live], 0
        bound = limit[o]
        rate = components * ln.astype(np.float64)
        while len(o):
            point = mix(s + _times_gold(2 * step + 1))
            # 53 random bits, never 0
            t = t - np.log((point >> _U(11)).astype(np.float64) * 2.0**-53 + 2.0**-54) / rate
            go = np.nonzero(t <= bound)[0]
            if not len(go):
                break
            o, s, ln, rc, t, bound, rate = o[go], s[go], ln[go], rc[go], t[go], bound[go], rate[go]
            name = mix(s + _times_gold(2 * step + 2))
            inside = (rc == ln) | (((name >> _U(16)) % ln.astype(np.uint64)) < rc.astype(np.uint64))
            where = o * components + ((name >> _U(40)) % _U(components)).astype(np.int64)
            value = (t.astype(np.float32).view(np.uint32).astype(np.uint64) << _U(32)) | (mix(name) & _U(0xFFFFFFFF))
            if inside.all():
                np.minimum.at(best, where, value)
            else:
                np.minimum.at(best, where[inside], value[inside])
            step += 1
        unfilled = (best.reshape(len(bags), components) == np.iinfo(np.uint64).max).any(axis=1)
        pending = unfilled & (total > 0)
        limit[pending] *= 2
    out = (best & _U(0xFFFFFFFF)).astype(np.uint32).reshape(len(bags), components)
    out[total == 0] = 0
    return out


def bands(signature: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """64-bit keys of the bands, as signed integers, one row a signature."""
    parts = signature.reshape(len(signature), bands, rows).astype(np.uint64)
    out = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64) * _GOLD, parts.shape[:2]).copy()
    for k in range(rows):
        out = mix(out * _POLY + parts[:, :, k])
    return out.view(np.int64)

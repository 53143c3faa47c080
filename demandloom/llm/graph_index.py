"""A robust-pruned directed graph over vectors, built and searched for many points at a time.

Greedy searches from the medoid propose neighbours; a candidate is kept only if no neighbour
kept before is closer to it, by the factor alpha, than the point itself; the reverse edges are
added, and pruned alike where a point gets more than the degree. Largest inner product is turned into least distance by one more
coordinate that gives all vectors the same length.
"""

from __future__ import annotations

import struct

import numpy as np

DEGREE, BUILD_BEAM, SEARCH_BEAM, ALPHA, WIDTH = 32, 48, 128, 1.2, 4
_CELLS = 32 << 20
#: Points pruned in one step, so that the matrices of their candidates stay in a processor's cache.
_PRUNED = 64
_HEAD = struct.Struct("<4sIIII")


def _greedy(points: np.ndarray, graph: np.ndarray, starts: np.ndarray, queries: np.ndarray, beam: int, norms: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Beam searches in step: ids and distances [queries, beam] of the nearest met, nearest first (-1: none).

    Distances are squared lengths less the query's own where ``norms`` is given, else negative inner products.
    """
    n, many = len(points), len(queries)

    def away(rows: np.ndarray) -> np.ndarray:
        dots = np.matmul(points[rows], queries[:, :, None])[:, :, 0]
        return norms[rows] - 2 * dots if norms is not None else -dots

    seen = np.zeros(many * n, bool)
    line = np.arange(many)[:, None]
    ids = np.full((many, beam), -1, np.int64)
    dist = np.full((many, beam), np.inf, np.float32)
    done = np.ones((many, beam), bool)
    first = np.broadcast_to(starts[:beam], (many, min(beam, len(starts))))
    k = first.shape[1]
    ids[:, :k], dist[:, :k], done[:, :k] = first, away(first), False
    seen[(line * n + first).ravel()] = True
    order = np.argsort(dist, axis=1, kind="stable")
    ids, dist, done = ids[line, order], dist[line, order], done[line, order]
    while True:
        pick = np.argsort(done, axis=1, kind="stable")[:, :WIDTH]  # the nearest that aren't expanded
        fresh = ~done[line, pick]
        if not fresh.any():
            return ids, dist
        done[line, pick] = True
        near = np.where(fresh[:, :, None], graph[np.maximum(ids[line, pick], 0)], -1).reshape(many, -1)
        near.sort(axis=1)
        ok = near >= 0
        ok[:, 1:] &= near[:, 1:] != near[:, :-1]
        at = line * n + np.maximum(near, 0)
        ok &= ~seen[at]
        seen[at[ok]] = True
        width = int(ok.sum(axis=1).max(initial=0))
        if not width:
            continue
        best = np.argsort(~ok, axis=1, kind="stable")[:, :width]
        near, ok = near[line, best], ok[line, best]
        far = np.where(ok, away(np.maximum(near, 0)), np.inf).astype(np.float32)
        all_ids, all_dist = np.concatenate([ids, np.where(ok, near, -1)], 1), np.concatenate([dist, far], 1)
        all_done = np.concatenate([done, ~ok], 1)
        top = np.argsort(all_dist, axis=1, kind="stable")[:, :beam]
        ids, dist, done = all_ids[line, top], all_dist[line, top], all_done[line, top]


def _prune(points: np.ndarray, who: np.ndarray, candidates: np.ndarray, alpha: float, degree: int) -> np.ndarray:
    """[len(who), degree] neighbours chosen from candidates [len(who), k] (-1: none)."""
    if len(who) > _PRUNED:
        return np.concatenate([_prune(points, who[k : k + _PRUNED], candidates[k : k + _PRUNED], alpha, degree) for k in range(0, len(who), _PRUNED)])
    candidates = np.sort(candidates, axis=1)
    alive = (candidates >= 0) & (candidates != who[:, None])
    alive[:, 1:] &= candidates[:, 1:] != candidates[:, :-1]
    near = points[np.maximum(candidates, 0)]
    squares = np.einsum("bkd,bkd->bk", near, near)
    own = np.maximum(squares + np.einsum("bd,bd->b", points[who], points[who])[:, None] - 2 * np.matmul(near, points[who][:, :, None])[:, :, 0], 0)
    line = np.arange(len(who))
    # nearest first, so that the first one alive is the next to keep
    order = np.argsort(np.where(alive, own, np.inf), axis=1, kind="stable")
    column = line[:, None]
    candidates, alive, near, squares, own = candidates[column, order], alive[column, order], near[column, order], squares[column, order], own[column, order]
    # alpha**2 * |x - y|**2 > own(y), solved for the inner product
    beyond = 2 * np.matmul(near, near.transpose(0, 2, 1)) - squares[:, :, None] < (squares - own / (alpha * alpha))[:, None, :]
    out = np.full((len(who), degree), -1, np.int32)
    for k in range(degree):
        pick = alive.argmax(axis=1)
        ok = alive[line, pick]
        if not ok.any():
            break
        out[ok, k] = candidates[line, pick][ok]
        alive &= beyond[line, pick]
        alive[line, pick] = False
    return out


def build_graph(points: np.ndarray, degree: int = DEGREE, beam: int = BUILD_BEAM, alpha: float = ALPHA, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(graph [n, degree] of ids or -1, entry ids). Two passes, the second one with ``alpha``."""
    n = len(points)
    rng = np.random.default_rng(seed)
    graph = np.full((n, degree), -1, np.int32)
    if n > 1:
        some = min(degree // 2, n - 1)
        graph[:, :some] = (np.arange(n)[:, None] + rng.integers(1, n, (n, some))) % n
    norms = np.einsum("nd,nd->n", points, points)
    entry = np.array([np.argmin(norms - 2 * points @ points.mean(axis=0))]) if n else np.zeros(0, np.int64)
    step = max(1, min(512, _CELLS // max(n, 1)))
    for factor in (1.0, alpha):
        turn = rng.permutation(n)
        for at in range(0, n, step):
            who = turn[at : at + step]
            met, _ = _greedy(points, graph, entry, points[who], beam, norms)
            graph[who] = _prune(points, who, np.concatenate([met, graph[who]], 1), factor, degree)
            source = np.repeat(who, degree)
            target = graph[who].ravel()
            source, target = source[target >= 0], target[target >= 0]
            order = np.argsort(target, kind="stable")
            source, target = source[order], target[order]
            nodes, first, many = np.unique(target, return_index=True, return_counts=True)
            # nodes by how many edges come in, so that few wide rows don't pad the rest
            for lo, hi in ((1, 8), (9, 64), (65, step)):
                rows = np.nonzero((many >= lo) & (many <= hi))[0]
                for part in (rows[k : k + 256] for k in range(0, len(rows), 256)):
                    wide = np.full((len(part), int(many[part].max())), -1, np.int64)
                    spots = np.arange(wide.shape[1])[None, :] < many[part][:, None]
                    wide[spots] = source[(first[part][:, None] + np.arange(wide.shape[1]))[spots]]
                    wide = np.sort(np.concatenate([graph[nodes[part]], wide], 1), axis=1)[:, ::-1]
                    wide[:, 1:][wide[:, 1:] == wide[:, :-1]] = -1
                    wide = -np.sort(-wide, axis=1)
                    over = (wide >= 0).sum(axis=1) > degree  # the others have room for all
                    graph[nodes[part[~over]]] = wide[~over, :degree]
                    graph[nodes[part[over]]] = _prune(points, nodes[part[over]], wide[over], factor, degree)
    return graph, entry


def same_length(vectors: np.ndarray, longest: float) -> np.ndarray:
    """Vectors with one more coordinate that brings each to the length sqrt(longest)."""
    wide = vectors.astype(np.float32)
    rest = np.sqrt(np.maximum(longest - np.einsum("nd,nd->n", wide, wide, dtype=np.float64), 0))
    return np.concatenate([wide, rest[:, None].astype(np.float32)], axis=1)


def pack_index(vectors: np.ndarray, members: list[list[int]], longest: float) -> bytes:
    """Vectors (as given, in double precision), member ids of each, graph and entry points in one value."""
    graph, entry = build_graph(same_length(vectors, longest))
    ends = np.cumsum([len(x) for x in members])
    parts = [vectors.astype("<f8"), ends.astype("<i8"), np.array([i for x in members for i in x], "<i8"), graph.astype("<i4"), entry.astype("<i8")]
    return _HEAD.pack(b"RPG1", len(vectors), vectors.shape[1], graph.shape[1], len(entry)) + b"".join(x.tobytes() for x in parts)


def unpack_index(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    magic, n, dim, degree, entries = _HEAD.unpack_from(data)
    if magic != b"RPG1":
        raise ValueError("not an index of this format")
    at = _HEAD.size

    def take(kind: str, count: int) -> np.ndarray:
        nonlocal at
        out = np.frombuffer(data, kind, count, at)
        at += out.nbytes
        return out

    vectors, ends = take("<f8", n * dim).reshape(n, dim), take("<i8", n)
    members = take("<i8", int(ends[-1]) if n else 0)
    return vectors, ends, members, take("<i4", n * degree).reshape(n, degree), take("<i8", entries)


def search_index(index: tuple, query_ids: np.ndarray, queries: np.ndarray, top: int, beam: int = SEARCH_BEAM) -> list[tuple[list[int], list[float]]]:
    """For each query, ids and exact scores of its best ``top`` members other than itself, best first, ties to smaller ids."""
    vectors, ends, members, graph, entry = index
    narrow, starts = vectors.astype(np.float32), np.concatenate([[0], ends[:-1]])
    step = max(1, min(512, _CELLS // max(len(vectors), 1)))
    out = []
    for at in range(0, len(queries), step):
        asked = queries[at : at + step]
        met, _ = _greedy(narrow, graph, entry, asked.astype(np.float32), max(beam, 2 * top), None)
        exact = np.einsum("bkd,bd->bk", vectors[np.maximum(met, 0)], asked)
        for row, scores, own in zip(met, exact, query_ids[at : at + step].tolist(), strict=True):
            found = [(-s, m) for r, s in zip(row.tolist(), scores.tolist(), strict=True) if r >= 0 for m in members[starts[r] : ends[r]].tolist() if m != own]
            found.sort()
            out.append(([m for _, m in found[:top]], [-s for s, _ in found[:top]]))
    return out

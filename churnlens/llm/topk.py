"""Exact top-k search by multi-resolution segment statistics.

Vectors are cut into segments; a segment's mean and standard deviation bound its part of a distance
from below: |a-b|^2 >= n ((mean_a - mean_b)^2 + (dev_a - dev_b)^2). Summed over the segments this
bounds the whole distance, more tightly the finer the segments. The bounds are computed coarse to fine,
each level for the pairs that the coarser ones left, and a vector is dropped for a query as soon as its
bound passes the distance of the query's k-th best so far; what survives all levels is computed exactly.
A level that is measured to drop less than it costs is left out until a later trial shows a gain (for
directions without any structure the coarse levels can drop nothing); which levels run changes no result.

Scores are inner products of the integer components floor(scale * x): a score s is the squared
distance |q|^2 + |c|^2 - 2 s, so the largest scores of a query are searched with the limit
|q|^2 + |c|^2 - 2 s_k. Bounds are compared with a margin for rounding and ties survive, so results
are exact. Integers are multiplied as doubles where every sum stays below 2^53, else as Python
integers; a score that doesn't fit a long is cut to the nearest long.

Vectors that are null, empty or hold null or non-finite components, and rows without a vec_id, take
no part. Rows that share a query's vec_id are its own and no candidates; of such query rows the
smallest vector asks. Other repeated rows are candidates each. Vectors of another dimension are not
compared. An empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlens.llm.vectors import Found, best, query_vectors, search_blocks, whole_vectors

LONG = 1 << 63


def segment_features(x: np.ndarray, segments: int) -> np.ndarray:
    """Per segment sqrt(n) mean and sqrt(n) deviation: squared distances of these rows are the lower
    bounds, and their squared length is that of the vector."""
    edges = np.unique(np.linspace(0, x.shape[1], segments + 1).astype(int))
    n = np.diff(edges)
    mean = np.add.reduceat(x, edges[:-1], axis=1) / n
    square = np.add.reduceat(x * x, edges[:-1], axis=1) / n
    dev = np.sqrt(np.maximum(square - mean * mean, 0.0))
    return np.concatenate([mean * np.sqrt(n), dev * np.sqrt(n)], axis=1)


def levels_of(dim: int, finest: int = 2) -> list[int]:
    """Numbers of segments, coarse to fine: 1, 4, 16, ... and segments of ``finest`` components."""
    out, n = [], 1
    while n * finest < dim:
        out.append(n)
        n *= 4
    return [*out, max(1, -(-dim // finest))]


def dots(qs: np.ndarray, vs: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Exact inner products of the pairs (qs[i], vs[j]) as longs."""
    top = lambda x: float(np.abs(x).max()) if x.size else 0.0
    if qs.shape[1] * top(qs) * top(vs) < 2 ** 53:
        out = np.empty(len(i), dtype=np.int64)
        for at in range(0, len(i), 1 << 15):
            part = slice(at, at + (1 << 15))
            out[part] = np.einsum("nd,nd->n", qs[i[part]], vs[j[part]]).astype(np.int64)
        return out
    whole = [sum(int(a) * int(b) for a, b in zip(qs[x], vs[y], strict=True)) for x, y in zip(i, j, strict=True)]
    return np.array([min(max(s, -LONG), LONG - 1) for s in whole], dtype=np.int64)


class Gains:
    """What each level has dropped so far. A level is left out while it drops less than its cost, which
    next to an exact product is about ``weight`` times its features per component; every ``again``-th
    time it is tried all the same, so that it comes back where the vectors allow it."""

    def __init__(self, levels: list[int], dim: int, weight: float = 0.05, first: int = 100_000, again: int = 32):
        self.cost = [weight * 2 * n / dim for n in levels]
        self.seen, self.dropped, self.passed = ([0] * len(levels) for _ in range(3))
        self.first, self.again = first, again
        self.exact = self.pairs = 0

    def worth(self, level: int) -> bool:
        if self.seen[level] < self.first or self.dropped[level] >= self.cost[level] * self.seen[level]:
            return True
        self.passed[level] += 1
        return self.passed[level] % self.again == 0

    def note(self, level: int, before: int, after: int) -> None:
        self.seen[level] += before
        self.dropped[level] += before - after


def pair_bounds(q: np.ndarray, v: np.ndarray, norms: np.ndarray, alive: np.ndarray) -> np.ndarray:
    """Lower bounds from features q and v where ``alive``; other places hold anything. Few pairs are
    computed one by one, many by columns that have some."""
    out = np.full(alive.shape, np.inf)
    if alive.mean() < 0.05:
        i, j = np.nonzero(alive)
        out[i, j] = norms[i, j] - 2.0 * np.einsum("nd,nd->n", q[i], v[j])
    else:
        columns = np.flatnonzero(alive.any(axis=0))
        out[:, columns] = norms[:, columns] - 2.0 * (q @ v[columns].T)
    return out


def search(k: int, chunk: int = 256, slab: int = 512, watch=None):
    """The search of one block for ``search_blocks``. Vectors come in slabs: those of the first are
    computed exactly where earlier blocks gave no k-th best, later ones pass the levels from coarse to
    fine, each level for the pairs that are still alive, and only survivors of all are computed.
    ``watch`` gets the gains of each block (pairs, exact products, seen and dropped per level)."""
    def run(qids: np.ndarray, qs: np.ndarray, ids: np.ndarray, vs: np.ndarray, held: Found | None) -> Found:
        qs, vs = qs.astype(np.float64), vs.astype(np.float64)
        levels = levels_of(qs.shape[1])
        gains = Gains(levels, qs.shape[1])
        features: dict[int, tuple[np.ndarray, np.ndarray]] = {}  # of the levels that are used
        q_norm, v_norm = (qs * qs).sum(axis=1), (vs * vs).sum(axis=1)
        found = []
        for at in range(0, len(qs), chunk):
            rows = np.arange(at, min(at + chunk, len(qs)))
            top = None
            if held is not None:
                mine = (held[0] >= rows[0]) & (held[0] <= rows[-1])
                top = tuple(x[mine] for x in held)
            for first in range(0, len(vs), slab):
                columns = np.arange(first, min(first + slab, len(vs)))
                alive = ids[columns][None, :] != qids[rows][:, None]
                gains.pairs += int(alive.sum())
                if top is not None and len(top[0]):
                    full = np.bincount(top[0] - at, minlength=len(rows)) >= k
                    kth = np.full(len(rows), np.inf)
                    np.minimum.at(kth, top[0] - at, top[2].astype(np.float64))
                    norms = q_norm[rows][:, None] + v_norm[columns][None, :]
                    limit = norms - 2.0 * np.where(full, kth, -np.inf)[:, None] + 1e-9 * (norms + 1.0)
                    for level, n in enumerate(levels):
                        if not full.any() or not gains.worth(level):
                            continue
                        if level not in features:
                            features[level] = segment_features(qs, n), segment_features(vs, n)
                        q, v = features[level]
                        before = int(alive[full].sum())
                        alive &= pair_bounds(q[rows], v[columns], norms, alive) <= limit
                        gains.note(level, before, int(alive[full].sum()))
                i, j = np.nonzero(alive)
                gains.exact += len(i)
                i, j = rows[i], columns[j]
                new = (i, ids[j], dots(qs, vs, i, j))
                top = best([new] if top is None else [top, new], k)
            found.append(top)
        if watch is not None:
            watch(gains)
        return best(found, k)
    return run


def scaled(v, scale: int):
    """floor(scale * x) of each component, as double."""
    return F.transform(v, lambda x: F.floor(x * float(scale)).cast("double"))


def exact_top_k(embeddings: DataFrame, every: int = 100, k: int = 10, scale: int = 1024,
                block_rows: int = 2048, query_rows: int = 16_384) -> DataFrame:
    """query_id, rank, vec_id, score of the k highest integer inner products of each query."""
    vectors = whole_vectors(embeddings, lambda v: scaled(v, scale))
    return search_blocks(query_vectors(vectors, every), vectors, k, "<f8", "long", search(k), block_rows, query_rows)

"""Approximate nearest neighbours by forests of random-projection trees.

Every block of ``block_rows`` vectors is indexed whole by ``trees`` trees: a node projects its
vectors on the difference of two of them, drawn by a fixed seed, and splits at the median, down to
leaves of ``leaf`` vectors. A query's path to a leaf has the smallest margin by which it lies on the
side it takes; a queue shared by the trees of a block yields leaves by falling margin until the
leaves yielded hold ``inspect`` times the block's vectors (the trees overlap, so that is a share of
the distinct vectors). Margins only shrink along a path, so that order is the leaves' margins sorted,
and it is computed for all queries of a block at once. The vectors of the yielded leaves are ranked
by their exact inner products.

All blocks are searched for every query, so what is missed is only what a block's queue didn't reach;
measured recall is in the README. More ``inspect`` or ``trees`` raise it, at the limit to 1.

Vectors that are null, empty, zero or hold null or non-finite components, and rows without a vec_id,
take no part. Rows that share a query's vec_id are its own and no candidates; of such query rows the
smallest vector asks. Other repeated rows are candidates each. Vectors of another dimension are not
compared. An empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from churnlens.llm.vectors import Found, best, query_vectors, search_blocks, whole_vectors


class Tree:
    """Normals and boundaries of the inner nodes, children (leaf k as -k - 1), rows of the leaves."""

    def __init__(self, vs: np.ndarray, leaf: int, rng: np.random.Generator):
        self.normals: list[np.ndarray] = []
        self.bounds: list[float] = []
        self.children: list[list[int]] = []
        self.leaves: list[np.ndarray] = []
        self.root = self._grow(vs, np.arange(len(vs)), leaf, rng)

    def _grow(self, vs: np.ndarray, rows: np.ndarray, leaf: int, rng: np.random.Generator) -> int:
        if len(rows) <= leaf:
            self.leaves.append(rows)
            return -len(self.leaves)
        a, b = rng.choice(rows, 2, replace=False)
        normal = vs[a] - vs[b]
        length = np.linalg.norm(normal)
        if not np.isfinite(length) or length == 0:  # equal vectors: any direction
            normal, length = rng.standard_normal(vs.shape[1]), 1.0
        normal = normal / length
        side = vs[rows] @ normal
        order = np.argsort(side, kind="stable")
        half = len(rows) // 2  # ties are parted too: no leaf grows beyond its size
        at = len(self.normals)
        self.normals.append(normal)
        self.bounds.append(float((side[order[half - 1]] + side[order[half]]) / 2))
        self.children.append([0, 0])
        self.children[at] = [self._grow(vs, rows[order[:half]], leaf, rng), self._grow(vs, rows[order[half:]], leaf, rng)]
        return at

    def margins(self, qs: np.ndarray) -> np.ndarray:
        """queries x leaves: the smallest margin on the way to the leaf."""
        out = np.full((len(qs), len(self.leaves)), np.inf)
        if not self.normals:
            return out
        sides = qs @ np.array(self.normals).T - np.array(self.bounds)
        todo = [(self.root, np.full(len(qs), np.inf))]
        while todo:
            at, margin = todo.pop()
            if at < 0:
                out[:, -at - 1] = margin
                continue
            low, high = self.children[at]
            todo += [(low, np.minimum(margin, -sides[:, at])), (high, np.minimum(margin, sides[:, at]))]
        return out


def yielded(margins: np.ndarray, sizes: np.ndarray, budget: float) -> np.ndarray:
    """queries x leaves: which leaves the queue yields before their sizes pass the budget."""
    order = np.argsort(-margins, axis=1, kind="stable")
    before = np.cumsum(sizes[order], axis=1) - sizes[order]
    out = np.zeros(margins.shape, dtype=bool)
    np.put_along_axis(out, order, before < budget, axis=1)
    return out


def inner(qs: np.ndarray, vs: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Inner products of pairs in double precision; a pair's value depends on nothing else."""
    out = np.empty(len(i))
    for at in range(0, len(i), 1 << 15):
        part = slice(at, at + (1 << 15))
        out[part] = (qs[i[part]] * vs[j[part]]).sum(axis=1)
    return out


def search(k: int, trees: int, leaf: int, inspect: float, seed: int, chunk: int = 1024):
    """The search of one block for ``search_blocks``."""
    def run(qids: np.ndarray, qs: np.ndarray, ids: np.ndarray, vs: np.ndarray, held: Found | None) -> Found:
        qs, vs = qs.astype(np.float64), vs.astype(np.float64)
        rng = np.random.default_rng(seed)
        forest = [Tree(vs, leaf, rng) for _ in range(trees)]
        leaves = [rows for t in forest for rows in t.leaves]
        sizes = np.array([len(rows) for rows in leaves])
        found = [held] if held is not None else []
        for at in range(0, len(qs), chunk):
            q = qs[at:at + chunk]
            chosen = yielded(np.concatenate([t.margins(q) for t in forest], axis=1), sizes, inspect * len(vs))
            scores = np.full((len(q), len(vs)), -np.inf)
            for rows, asks in zip(leaves, chosen.T, strict=True):
                who = np.flatnonzero(asks)
                if len(who):
                    scores[np.ix_(who, rows)] = q[who] @ vs[rows].T
            scores[ids[None, :] == qids[at:at + chunk][:, None]] = -np.inf
            few = min(k, scores.shape[1])
            kth = np.partition(scores, -few, axis=1)[:, -few][:, None]
            # ties and what rounding may have put below the k-th stay for the exact ranking
            near = (scores > -np.inf) & (scores >= kth - 1e-12 * (1.0 + np.abs(kth)))
            i, j = np.nonzero(near)
            found.append(best([(i + at, ids[j], inner(qs, vs, i + at, j))], k))
        return best(found, k)
    return run


def nearest(embeddings: DataFrame, every: int = 20, k: int = 20, trees: int = 8, leaf: int = 32, inspect: float = 1.5,
            seed: int = 8, block_rows: int = 4096, query_rows: int = 16_384) -> DataFrame:
    """query_id, rank, vec_id, score of each query's k nearest found by inner product."""
    vectors = whole_vectors(embeddings, nonzero=True)
    return search_blocks(query_vectors(vectors, every), vectors, k, "<f8", "double",
                         search(k, trees, leaf, inspect, seed), block_rows, query_rows)

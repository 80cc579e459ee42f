"""Exact and approximate vector search against brute force."""

from __future__ import annotations

import math

import numpy as np
import pytest

from churnlens.llm import ann, topk
from tests.conftest import SF_SMALL
from tests.llm.helpers import embeddings, tuples

AWKWARD = [
    (0, [1.0, 2.0, -1.5, 0.25], 0), (100, [0.5, 0.5, 0.5, 0.5], 0), (200, [0.0, 0.0, 0.0, 0.0], 0),
    (300, None, 0), (400, [1.0, None, 0.0, 0.0], 0), (500, [float("nan"), 0.0, 0.0, 0.0], 0),
    (600, [float("inf"), 0.0, 0.0, 0.0], 0), (None, [1.0, 1.0, 1.0, 1.0], 0), (700, [], 0),
    (800, [3.0, 1.0], 0), (7, [2.0, -1.0], 0), (5, [1.0, 2.0, -1.5, 0.25], 0), (6, [1.0, 2.0, -1.5, 0.25], 0),
    (9, [-1.0, 4.0, 0.0, 1.0], 0), (9, [-1.0, 4.0, 0.0, 1.0], 0), (100, [0.25, 0.5, 0.5, 0.5], 0),
]


def whole(rows, zero=True):
    good = [(i, v) for i, v, _ in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    return good if zero else [(i, v) for i, v in good if any(v)]


def brute(rows, every, k, measure):
    out = []
    asks = {}
    for i, v in rows:
        if i % every == 0:
            asks[i] = min(asks.get(i, v), v)
    for q, v in asks.items():
        scored = sorted(((-measure(v, w), i) for i, w in rows if i != q and len(w) == len(v)))
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:k])]
    return sorted(out, key=repr)


def integer(a, b):
    return sum(math.floor(1024 * x) * math.floor(1024 * y) for x, y in zip(a, b, strict=True))


def test_exact_top_k_on_awkward_rows(spark):
    got = topk.exact_top_k(embeddings(spark, AWKWARD), k=4)
    assert tuples(got, "query_id", "rank", "vec_id", "score") == brute(whole(AWKWARD), 100, 4, integer)


@pytest.mark.parametrize("block_rows", [7, 2048])
def test_exact_top_k_equals_brute_force(spark, block_rows):
    rng = np.random.default_rng(4)
    base = rng.standard_normal((300, 9)).astype(np.float32)
    base[100:180] = base[100]  # many ties
    rows = [(k, [float(x) for x in v], 0) for k, v in enumerate(base)]
    got = topk.exact_top_k(embeddings(spark, rows), every=25, block_rows=block_rows, query_rows=5)
    assert tuples(got, "query_id", "rank", "vec_id", "score") == brute(whole(rows), 25, 10, integer)


def test_bounds_never_pass_the_distance():
    rng = np.random.default_rng(5)
    a, b = rng.standard_normal((50, 13)) * 1000, rng.standard_normal((60, 13)) * 1000
    real = ((a[:, None] - b[None]) ** 2).sum(axis=2)
    last = None
    for n in topk.levels_of(13):
        fa, fb = topk.segment_features(a, n), topk.segment_features(b, n)
        bound = ((fa[:, None] - fb[None]) ** 2).sum(axis=2)
        assert (bound <= real + 1e-6).all()
        assert last is None or (bound >= last - 1e-6).mean() > 0.5  # finer segments bound more tightly
        last = bound


def test_levels_decide_before_exact_products():
    """On vectors with structure the coarse levels leave few pairs for the finer ones and for exact
    products; on directions without any they are left out, and results are the same either way."""
    rng = np.random.default_rng(9)
    smooth = np.repeat(rng.standard_normal((3000, 4)) * 900, 16, axis=1) + rng.standard_normal((3000, 64)) * 20
    loose = rng.standard_normal((3000, 64)) * 100
    for vectors, structured in ((np.floor(smooth), True), (np.floor(loose), False)):
        ids = np.arange(3000)
        gains = []
        qs, qids = vectors[:60], ids[:60]
        got = topk.search(10, watch=gains.append)(qids, qs, ids, vectors, None)
        scores = qs @ vectors.T
        scores[np.arange(60), np.arange(60)] = -np.inf
        want = {(q, n) for q in range(60) for n in sorted(range(3000), key=lambda n: (-scores[q, n], n))[:10]}  # noqa: B023
        assert set(zip(got[0].tolist(), got[1].tolist(), strict=True)) == want
        g = gains[0]
        if structured:
            later = g.pairs - 60 * 512  # the first slab gives the first k-th best
            assert g.exact < 60 * 512 + 0.1 * later
            assert g.dropped[1] > 0.5 * g.seen[1] and g.seen[-1] < 0.2 * g.pairs
        else:
            assert g.dropped[0] == g.dropped[1] == 0 and g.seen[0] <= 200_000


def test_large_components_are_exact(spark):
    rows = [(0, [3.0e7, -1.0], 0), (1, [2.0e5, 1.0], 0), (2, [-1.0, 5.0e5], 0)]
    got = topk.exact_top_k(embeddings(spark, rows))
    assert tuples(got, "query_id", "rank", "vec_id", "score") == brute(whole(rows), 100, 10, integer)


def test_nearest_takes_every_leaf_when_asked(spark):
    rng = np.random.default_rng(6)
    base = rng.standard_normal((200, 6)).astype(np.float32)
    base[50:90] = base[50]
    rows = [(k, [float(x) for x in v], 0) for k, v in enumerate(base)] + AWKWARD
    got = ann.nearest(embeddings(spark, rows), inspect=1e9, block_rows=64, leaf=8)
    want = brute(whole(rows, zero=False), 20, 20, lambda a, b: sum(x * y for x, y in zip(a, b, strict=True)))
    assert tuples(got, "query_id", "rank", "vec_id") == sorted(((q, n, i) for q, n, i, _ in want), key=repr)


def test_nearest_recall_and_scores(spark):
    table = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    vectors = {r.vec_id: np.array(r.embedding, dtype=np.float64) for r in table.collect()}
    found = {}
    for r in ann.nearest(table).collect():
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert set(found) == {i for i in vectors if i % 20 == 0}
    hit = total = 0
    for q, rows in found.items():
        rows.sort()
        assert [n for n, _, _ in rows] == list(range(1, 21)) and q not in {i for _, i, _ in rows}
        assert all(abs(s - float(vectors[q] @ vectors[i])) < 1e-12 for _, i, s in rows)
        assert rows == sorted(rows, key=lambda r: (-r[2], r[1]))
        best = sorted((i for i in vectors if i != q), key=lambda i: (-float(vectors[q] @ vectors[i]), i))[:20]
        hit, total = hit + len(set(best) & {i for _, i, _ in rows}), total + 20
    assert hit / total >= 0.9


def test_empty_tables(spark):
    for search in (topk.exact_top_k, ann.nearest):
        got = search(embeddings(spark, []))
        assert got.columns == ["query_id", "rank", "vec_id", "score"] and got.count() == 0

"""Fingerprints, vantage-point search and components against brute force."""

from __future__ import annotations

import random
import re

import numpy as np
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from churnlens.llm import simhash
from tests.conftest import SF_SMALL
from tests.llm.helpers import documents, tuples


def plain_fingerprint(text, shingle=4):
    """The definition, word by word and bit by bit."""
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    parts = [words[i:i + shingle] for i in range(len(words) - shingle + 1)] or ([words] if words else [])
    hashes = [xxhash.xxh64_intdigest(" ".join(p).encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="abAB É\x1c\t\n\x0b\xa0ß.", max_size=60))
def test_fingerprint_follows_the_definition(text):
    assert simhash.fingerprint(text) == plain_fingerprint(text)


def test_spark_has_the_same_hash(spark):
    text = "Ünï code words here"
    signed = spark.range(1).select(F.xxhash64(F.lit(text))).first()[0]
    assert signed % (1 << 64) == xxhash.xxh64_intdigest(text.encode(), 42)


def near_prints(seed, n=1500, groups=60):
    rnd = random.Random(seed)
    fps = [rnd.getrandbits(64) for _ in range(n)]
    for _ in range(groups):
        base = rnd.choice(fps)
        for _ in range(rnd.randrange(1, 9)):
            base ^= sum(1 << b for b in rnd.sample(range(64), rnd.randrange(1, 6)))
            fps.append(base)
    return fps


def all_links(fps, bits=4):
    a = np.array(sorted(set(fps)), dtype=np.uint64)
    i, j = np.nonzero(np.bitwise_count(a[:, None] ^ a[None, :]) <= bits)
    return {(int(a[x]), int(a[y])) for x, y in zip(i, j, strict=True) if x < y}


def test_every_tree_search_finds_every_pair():
    for seed in range(4):
        fps = np.array(sorted(set(near_prints(seed))), dtype=np.uint64)
        found = set()
        for mask in simhash.fields(3):
            for p, q in simhash.pairs_within(fps, fps, mask, 1, 4, leaf=8, block=1000):
                found |= set(zip(p.tolist(), q.tolist(), strict=True))
        assert found == all_links(fps.tolist())


def test_shards_overlap_where_balls_do():
    fps = np.array(sorted(set(near_prints(9))), dtype=np.uint64)
    tree = simhash.TopTree(fps[::5], simhash.fields(3)[0], 3)
    home = {}
    for shard, own in tree.deal(fps, 0):
        for k in own:
            assert int(k) not in home  # a point lies in one shard
            home[int(k)] = shard
    visits = {}
    for shard, own in tree.deal(fps, 1):
        for k in own:
            visits.setdefault(int(k), set()).add(shard)
    assert len(home) == len(fps) and len(set(home.values())) > 4
    near = np.bitwise_count((fps[:, None] ^ fps[None, :]) & np.uint64(simhash.fields(3)[0])) <= 1
    for i, j in zip(*np.nonzero(near), strict=True):
        assert home[int(j)] in visits[int(i)]


def component_of(fps):
    forest = simhash.Forest()
    for a, b in all_links(fps):
        forest.join(a, b)
    return forest.top


def test_links_keep_every_component(spark):
    fps = near_prints(21, n=4000)
    signed = [(f - (1 << 64) if f >> 63 else f,) for f in set(fps)]
    classes = spark.createDataFrame(signed, "fp long")
    links = simhash.fingerprint_links(classes, len(signed), shard_rows=200, sample_rows=500)
    roots = {r.node: r.root for r in simhash.components(links).collect()}
    top = component_of(fps)
    by_ours, by_brute = {}, {}
    for (f,) in signed:
        by_ours.setdefault(roots.get(f, f), set()).add(f)
        by_brute.setdefault(top(f % (1 << 64)), set()).add(f)
    assert sorted(map(sorted, by_ours.values())) == sorted(map(sorted, by_brute.values()))


def test_components_of_chains_stars_and_rings(spark):
    chain = [(k, k + 1) for k in range(100, 160)]
    star = [(5, k) for k in range(6, 60)]
    ring = [(k, k + 1) for k in range(-30, -10)] + [(-10, -30)]
    loops = [(7, 7)]
    got = simhash.components(spark.createDataFrame(chain + star + ring + loops + star[::-1], "a long, b long"))
    assert {(r.node, r.root) for r in got.collect()} == (
        {(k, 100) for k in range(101, 161)} | {(k, 5) for k in range(6, 60)} | {(k, -30) for k in range(-29, -9)})
    assert simhash.components(spark.createDataFrame([], "a long, b long")).count() == 0


ROWS = [(4, ""), (9, None), (2, " \t "), (7, "one two three four five six"), (8, "ONE two three four five six"),
        (8, "ONE two three four five six"), (None, "one two three four five six"), (None, "lonely text of its own here"),
        (1, "three words only"), (3, "b " * 50_000), (6, "b " * 50_000)]


def test_awkward_rows(spark):
    got = simhash.near_duplicates(documents(spark, ROWS))
    zero, hex_of = "0" * 16, lambda t: format(plain_fingerprint(t), "016x")
    want = [(4, zero, 2), (9, zero, 2), (2, zero, 2)]
    want += [(d, hex_of(ROWS[3][1]), 7) for d in (7, 8, 8, None)]
    want += [(None, hex_of(ROWS[7][1]), None), (1, hex_of(ROWS[8][1]), 1), (3, hex_of("b " * 50), 3), (6, hex_of("b " * 50), 3)]
    assert tuples(got, "doc_id", "fingerprint", "component_id") == sorted(want, key=repr)
    kept = simhash.keep_one(documents(spark, ROWS))
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted([2, 7, 1, 3, None, None], key=repr)
    assert kept.columns == documents(spark, ROWS).columns
    for op in (simhash.near_duplicates, simhash.keep_one):
        assert op(documents(spark, [])).count() == 0


def test_one_row_of_each_group_whatever_the_doc_ids(spark):
    words = lambda g: " ".join(f"w{g}x{k}" for k in range(30))
    rows = [(0, words(g)) for g in range(40)]  # one doc_id, unrelated texts
    rows += [(0, words(3)), (0, words(3)), (5, words(100)), (9, words(100)), (5, words(101)), (8, words(101)), (9, words(102))]
    docs = documents(spark, rows)
    want = sorted([(0, words(g)) for g in range(40)] + [(5, words(100)), (5, words(101)), (9, words(102))], key=repr)
    assert tuples(simhash.keep_one(docs), "doc_id", "text") == want
    assert tuples(simhash.keep_one(docs.repartition(5)), "doc_id", "text") == want


def test_documents_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = {r.doc_id: r.component_id for r in simhash.near_duplicates(docs).collect()}
    assert got == simhash.brute_force(rows)
    kept = {r.doc_id for r in simhash.keep_one(docs).collect()}
    assert kept == {d for d, c in got.items() if d == c}


def test_fingerprints_alike_in_a_field_are_split_by_the_other_bits():
    """Thousands of fingerprints that share a field: all pairs within four bits are found with far fewer
    comparisons than all pairs."""
    import itertools
    rng = np.random.default_rng(6)
    mask = simhash.fields(3)[0]
    heads = rng.integers(0, 1 << 43, 40, dtype=np.uint64) << np.uint64(21)
    fps = {int(h) for h in heads}
    for h in heads.tolist():
        for _ in range(60):
            bits = rng.choice(np.arange(21, 64), rng.integers(1, 6), replace=False)
            fps.add(int(h) ^ sum(1 << int(b) for b in bits))
    fps = np.sort(np.array(sorted(fps), dtype=np.uint64))
    want = {(a, b) for a, b in itertools.combinations(fps.tolist(), 2) if (a ^ b).bit_count() <= 4}
    got, compared = set(), []
    real = np.bitwise_count
    for a, b in simhash.pairs_within(fps, fps, mask, 1, 4):
        got |= set(zip(a.tolist(), b.tolist(), strict=True))
    assert got == want

    def counting(x, *args, **kwargs):
        if getattr(x, "ndim", 0) == 2:
            compared.append(x.size)
        return real(x, *args, **kwargs)
    simhash.np.bitwise_count, kept = counting, simhash.np.bitwise_count
    try:
        list(simhash.pairs_within(fps, fps, mask, 1, 4))
    finally:
        simhash.np.bitwise_count = kept
    assert sum(compared) < 0.5 * len(fps) ** 2


def test_a_hubs_links_are_split_over_tasks(spark):
    """Both inputs of a star join are plain scans of written tables: Spark's skew join applies."""
    import contextlib
    import io

    from churnlens.llm.common import written
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32k"}
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        links = written(spark.range(1, 60_000).selectExpr("0L AS a", "id AS b"), "hub-links")
        least = written(links.groupBy("a").agg(F.min("b").alias("m")), "hub-least")
        joined = simhash.star(links, least, F.col("b").alias("a"), F.col("m").alias("b"))
        joined.collect()
        out = io.StringIO()
        with contextlib.redirect_stdout(out):
            joined.explain()
        assert "skew=true" in out.getvalue()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)

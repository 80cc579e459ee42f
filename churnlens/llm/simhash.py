"""SimHash near-duplicates by a forest of vantage-point trees over Hamming distance.

Fingerprint: A-Z lower-cased, words ``[^\\x20\\x09-\\x0D]+``, shingles of ``shingle`` words (repeats
included, fewer words: all of them as one), XXH64 with seed 42; a bit is 1 if it is set in over half
the hashes; no words give zero.

Link search: two fingerprints that differ in at most ``max_bits`` bits differ in at most
``max_bits // thirds`` bits of one of ``thirds`` bit fields (pigeonhole), so there is one tree per
field, searched with that small radius. A tree node holds a vantage point and the median distance m
of its fingerprints: those at distance <= m lie inside, the others outside. By the triangle bound a
query at distance d need only look inside if d - r <= m and outside if d + r > m, so a query near the
boundary goes to both sides. The upper levels are built on a bounded sample of fingerprints and deal
fingerprints (once) and queries (to every shard that their ball overlaps) out to shards; within a
shard the tree goes on in memory. Every candidate pair is then checked on all 64 bits, so the links
are exactly the pairs within ``max_bits``. Which fingerprints are sampled changes only how even the
shards are.

Equal fingerprints are one class, represented by its smallest doc_id, before the search; each shard
reports the links that join its classes (a spanning forest of the links it found, so no component is
lost and a group of g near copies gives g - 1 rows), and components follow from alternating large-
and small-star rounds in Spark. Nothing of the documents is gathered on the driver but the sample.

Null and empty texts have fingerprint zero and link like any other. A row without a doc_id has the
component_id of its group, null if no member of it has a doc_id.
Repeated rows are returned each. An empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlens.llm.common import free_names, map_rows, replaced, written

DEALT = pa.schema([("tree", pa.int32()), ("shard", pa.int64()), ("is_query", pa.bool_()), ("fp", pa.int64())])
LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def fingerprint(text: str | None, shingle: int = 4, seed: int = 42) -> int:
    """The unsigned 64-bit fingerprint of a text."""
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: only A-Z and \x20 \x09-\x0D
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= shingle:
        starts, ends = [0], [len(line)]
    else:
        cuts = np.cumsum([len(w) + 1 for w in words])
        ends = (cuts[shingle - 1:] - 1).tolist()
        starts = [0, *cuts[:len(words) - shingle].tolist()]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(line[i:j], seed) for i, j in zip(starts, ends, strict=True)], dtype="<u8")
    total = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 15):  # long texts in pieces
        bits = np.unpackbits(hashes[at:at + (1 << 15)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        total += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * total > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 4, seed: int = 42, **longs: Column) -> DataFrame:
    """doc_id, the columns ``longs``, fp (the fingerprint as a signed long)."""
    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        for *kept, text in rows:
            fp = fingerprint(text, shingle, seed)
            yield *kept, fp - (1 << 64) if fp >> 63 else fp
    named = {"doc_id": F.col("doc_id"), **longs}
    slim = docs.select(*(c.cast("long").alias(k) for k, c in named.items()), F.col("text").cast("string").alias("text"))
    return map_rows(slim, run, pa.schema([(k, pa.int64()) for k in (*named, "fp")]), ", ".join(f"{k} long" for k in (*named, "fp")))


def fields(thirds: int) -> list[int]:
    """Bit masks that part the 64 bits as evenly as can be."""
    edges = [round(64 * k / thirds) for k in range(thirds + 1)]
    return [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:], strict=False)]


def distance(fps: np.ndarray, point: int, mask: int) -> np.ndarray:
    return np.bitwise_count((fps ^ np.uint64(point)) & np.uint64(mask)).astype(np.int16)


def vantage(fps: np.ndarray) -> int:
    """A vantage point: the fingerprint in the middle of the sorted ones."""
    return int(np.partition(fps, len(fps) // 2)[len(fps) // 2])


def split_at(d: np.ndarray) -> int | None:
    """The boundary m that parts distances most evenly into <= m and > m; None if all are equal."""
    counts = np.bincount(d)
    inside = np.cumsum(counts)[:-1]
    if not len(inside) or not inside[-1]:
        return None
    return int(np.argmin(np.abs(2 * inside - len(d))))


class TopTree:
    """The upper levels of a field's tree: nodes (vantage point, m) in heap order, shards below."""

    def __init__(self, sample: np.ndarray, mask: int, levels: int):
        self.mask, self.levels = mask, levels
        self.nodes: dict[int, tuple[int, int]] = {}
        todo = [(1, sample)]
        while todo:
            at, fps = todo.pop()
            if at >> levels or len(fps) < 2:
                continue
            point = vantage(fps)
            d = distance(fps, point, mask)
            m = split_at(d)
            if m is None:
                continue
            self.nodes[at] = (point, m)
            todo += [(2 * at, fps[d <= m]), (2 * at + 1, fps[d > m])]

    def deal(self, fps: np.ndarray, radius: int) -> Iterator[tuple[int, np.ndarray]]:
        """(shard, indexes of the fingerprints whose ball of ``radius`` overlaps it)."""
        todo = [(1, np.arange(len(fps)))]
        while todo:
            at, own = todo.pop()
            if not len(own):
                continue
            if at not in self.nodes:
                yield at, own
                continue
            point, m = self.nodes[at]
            d = distance(fps[own], point, self.mask)
            todo += [(2 * at, own[d - radius <= m]), (2 * at + 1, own[d + radius > m])]


def pairs_within(points: np.ndarray, queries: np.ndarray, mask: int, radius: int, max_bits: int,
                 leaf: int = 48, block: int = 1 << 20) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (point, query) of fingerprints at most ``max_bits`` apart, by the tree of one field. Points
    that are all alike in the field go on in a tree over all bits, with ``max_bits`` as radius, so they
    are not compared with each other pair by pair."""
    todo = [(points, queries, mask, radius)]
    while todo:
        p, q, field, reach = todo.pop()
        if not len(p) or not len(q):
            continue
        m = None
        if len(p) > leaf:
            point = vantage(p)
            dp = distance(p, point, field)
            m = split_at(dp)
            if m is None and field != ALL_BITS:
                todo.append((p, q, ALL_BITS, max_bits))
                continue
        if m is None:  # a leaf
            step = max(1, block // len(p))
            for at in range(0, len(q), step):
                part = q[at:at + step]
                near = np.bitwise_count(part[:, None] ^ p[None, :]) <= max_bits
                near &= part[:, None] > p[None, :]  # each pair once; both ends are points and queries
                i, j = np.nonzero(near)
                if len(i):
                    yield p[j], part[i]
            continue
        dq = distance(q, point, field)
        todo += [(p[dp <= m], q[dq - reach <= m], field, reach), (p[dp > m], q[dq + reach > m], field, reach)]


ALL_BITS = (1 << 64) - 1


class Forest:
    """Union-find over fingerprints; ``join`` says whether the link was new."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def top(self, x: int) -> int:
        path = []
        while (y := self.up.setdefault(x, x)) != x:
            path.append(x)
            x = y
        for y in path:
            self.up[y] = x
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.top(a), self.top(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)
        return a != b


def fingerprint_links(classes: DataFrame, n_classes: int, max_bits: int = 4, thirds: int = 3, sample_rows: int = 20_000,
                      shard_rows: int = 1 << 14) -> DataFrame:
    """a, b: links between fingerprints (column ``fp``, each once) that connect the same ones as all
    pairs within ``max_bits`` do. ``sample_rows`` bounds the fingerprints the upper levels are built
    on; the levels are as many as bring shards down to about ``shard_rows``."""
    radius = max_bits // thirds
    masks = fields(thirds)
    levels = max(0, int(np.ceil(np.log2(max(1, n_classes / shard_rows)))))
    share = min(1.0, sample_rows / max(1, n_classes))
    drawn = classes.select("fp").filter(F.pmod(F.xxhash64("fp"), F.lit(1 << 20)) < share * (1 << 20))
    sample = np.array([r[0] for r in drawn.limit(2 * sample_rows).collect()], dtype=np.int64).view(np.uint64)
    trees = [TopTree(np.sort(sample), mask, levels) for mask in masks]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for k, tree in enumerate(trees):
                for as_query, r in ((False, -1), (True, radius)):
                    # a point is dealt with a ball of nothing: to the one side it lies on
                    for shard, own in tree.deal(fps.view(np.uint64), max(r, 0)):
                        n = len(own)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(n, k), pa.int32()), pa.array(np.full(n, shard), pa.int64()),
                             pa.array([as_query] * n, pa.bool_()), pa.array(fps[own], pa.int64())], schema=DEALT)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches), schema=DEALT)
        if not table.num_rows:
            return
        k, shard, as_query, fp = (c.to_numpy() for c in table.columns)
        fp = fp.astype(np.int64).view(np.uint64)
        order = np.lexsort((shard, k))
        edges = np.flatnonzero(np.diff(k[order]) | np.diff(shard[order])) + 1
        forest = Forest()
        for own in np.split(order, edges):
            points, queries = fp[own[~as_query[own]]], fp[own[as_query[own]]]
            for a, b in pairs_within(points, queries, masks[k[own[0]]], radius, max_bits):
                new = [(x, y) for x, y in zip(a.view(np.int64).tolist(), b.view(np.int64).tolist(), strict=True)
                       if forest.join(x, y)]
                if new:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*new, strict=True)], schema=LINKS)

    dealt = classes.select("fp").mapInArrow(deal, "tree int, shard long, is_query boolean, fp long")
    parts = max(1, thirds << levels)
    return dealt.repartition(parts, "tree", "shard").mapInArrow(search, "a long, b long")


def star(links: DataFrame, least: DataFrame, *columns: Column) -> DataFrame:
    """``columns`` of each link and the least neighbour (m) of its node a."""
    return links.join(least, "a").select(*columns)


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """node, root: the smallest node of each component with a link, by large- and small-star rounds
    until a round changes nothing. Links to a hub are summed before they are shuffled."""
    folders: dict[str, str] = {}

    def now(df: DataFrame, name: str) -> DataFrame:
        """``df`` written; the table of that name of the round before is removed."""
        table, folders[name] = replaced(df, name, folders.get(name))
        return table
    links = now(links.filter("a <> b"), "links")
    before = None
    for _ in range(max_rounds):
        # large star: every larger neighbour of a node moves to the node's smallest neighbour. Both
        # sides of the joins are plain written tables: Spark splits a hub's links over tasks
        both = now(links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))), "both-ways")
        least = now(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "least")
        large = star(both.filter("b > a"), least, F.col("b").alias("a"), F.col("m").alias("b"))
        # small star: a node's smaller neighbours move to the smallest of them
        large = now(large.filter("a <> b").distinct(), "large-star")
        least = now(large.groupBy("a").agg(F.min("b").alias("m")), "least-of-large")
        small = star(large, least, F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
        links = now(small.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), "links")
        # when no node changes its neighbours, every link leads from a node to its root
        state = links.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0))).first()
        if tuple(state) == before:
            return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = tuple(state)
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def component_members(prints: DataFrame, first: Column, max_bits: int = 4, **options) -> DataFrame:
    """fp, first (that aggregate of its rows) and root (smallest fingerprint of its component) of
    every fingerprint, written."""
    classes = written(prints.groupBy("fp").agg(first.alias("first")), "fingerprint-classes")
    links = fingerprint_links(classes, classes.count(), max_bits, **options)
    roots = components(links)
    return written(classes.join(roots, classes["fp"] == roots["node"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")), "component-members")


def near_duplicates(docs: DataFrame, shingle: int = 4, max_bits: int = 4, seed: int = 42, **options) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (smallest doc_id reachable by links)."""
    prints = written(fingerprints(docs, shingle, seed), "fingerprints")
    members = component_members(prints, F.min("doc_id"), max_bits, **options)
    ids = written(members.groupBy("root").agg(F.min("first").alias("component_id")), "component-ids")
    # written tables on both sides again: a component of very many fingerprints is split
    named = written(members.join(ids, "root").select("fp", "component_id"), "fingerprint-components")
    # both sides are plain written tables: a fingerprint that many documents share is split
    return prints.join(named, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle: int = 4, max_bits: int = 4, seed: int = 42, null_ids_stay: bool = True,
             **options) -> DataFrame:
    """``docs`` with one row of each component: that of the smallest doc_id, of rows that share it the
    first by a hash of the text. Rows that share a doc_id but not a component are nothing to each
    other. Rows without a doc_id all stay, or if not ``null_ids_stay`` are copies like all others: the
    first by a hash of the text stays of a component that has no doc_id at all."""
    (number,) = free_names(docs, "__row")
    rows = written(docs.withColumn(number, F.monotonically_increasing_id()), "numbered-documents")
    prints = written(fingerprints(rows, shingle, seed, content=F.xxhash64("text"), row=F.col(number)), "fingerprints")
    # one row a fingerprint, then one a component, both summed up before their shuffle
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "content", "row"))
    members = component_members(prints, first, max_bits, **options)
    kept = members.groupBy("root").agg(F.min("first").alias("first")).select(F.col("first.row").alias(number))
    # kept rows are a share of all rows, so the join is by sorting at every size
    one = rows.join(written(kept, "kept-rows").hint("merge"), number, "left_semi")
    if null_ids_stay:
        one = one.filter(F.col("doc_id").isNotNull()).unionByName(rows.filter(F.col("doc_id").isNull()))
    return one.select(*docs.columns)


def brute_force(rows: list[tuple[int, str]], shingle: int = 4, max_bits: int = 4) -> dict[int, int]:
    """doc_id to component_id by comparing all pairs; for tests."""
    fps = {d: fingerprint(t, shingle) for d, t in rows}
    forest = Forest()
    for a, b in combinations(sorted(fps), 2):
        if (fps[a] ^ fps[b]).bit_count() <= max_bits:
            forest.join(a, b)
    return {d: forest.top(d) for d in fps}

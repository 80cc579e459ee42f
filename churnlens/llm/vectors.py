"""Query vectors against all vectors in blocks, for the two vector searches.

Candidates are packed into blocks of ``block_rows`` vectors where they are read, queries into blocks
of ``query_rows``; every pair of blocks meets in one row of an equi-join on (dimension, query block,
slot), the query blocks being copied to the slots over which candidate blocks are dealt: as many as
there are cores, a few times over. Candidate blocks are copied once per query block. A task
keeps the best k of each query over all the blocks it sees, so each gives k rows a query at most, and
a ranking per query follows. Only vectors of the same dimension are compared.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK_DDL = "dim int, block long, ids binary, data binary"
BLOCK = pa.schema([("dim", pa.int32()), ("block", pa.int64()), ("ids", pa.binary()), ("data", pa.binary())])

Found = tuple[np.ndarray, np.ndarray, np.ndarray]  # query position, vec_id, score


def whole_vectors(table: DataFrame, vector: Callable[[Column], Column] = lambda v: v, nonzero: bool = False) -> DataFrame:
    """vec_id, v (array of double): rows with a vec_id and a vector without null or non-finite
    components (``nonzero``: nor all zero). ``vector`` maps the checked array."""
    v = F.col("embedding")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    kept = table.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").filter(
        F.col("vec_id").isNotNull() & v.isNotNull() & (F.size(v) > 0) & finite)
    if nonzero:
        kept = kept.filter(F.exists(v, lambda x: x != 0))
    return kept.select("vec_id", vector(F.transform(v, lambda x: x.cast("double"))).alias("v"))


def query_vectors(vectors: DataFrame, every: int) -> DataFrame:
    """Rows whose vec_id is divisible by ``every``; of rows that share a vec_id the smallest vector."""
    chosen = vectors.filter(F.col("vec_id") % every == 0)
    return chosen.groupBy("vec_id").agg(F.min("v").alias("v"))


def packed(vectors: DataFrame, dtype: str, rows: int, key: str | None = None) -> DataFrame:
    """Blocks of at most ``rows`` vectors of one dimension (and one value of ``key``, which then is
    the block's number)."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        made = TaskContext.get().partitionId() << 32
        held: dict[tuple, list] = {}
        sizes: dict[tuple, int] = {}

        def block(at: tuple) -> pa.RecordBatch:
            nonlocal made
            parts = held.pop(at)
            sizes.pop(at)
            number = at[1] if key else made
            made += 1
            ids = np.concatenate([p[0] for p in parts])
            data = np.concatenate([p[1] for p in parts])
            return pa.RecordBatch.from_arrays([pa.array([at[0]], pa.int32()), pa.array([number], pa.int64()),
                                               pa.array([ids.tobytes()], pa.binary()),
                                               pa.array([data.tobytes()], pa.binary())], schema=BLOCK)
        for b in batches:
            ids = b.column(0).to_numpy(zero_copy_only=False).astype("<i8")
            dims = np.diff(b.column(1).offsets.to_numpy())
            keys = b.column(2).to_numpy(zero_copy_only=False) if key else np.zeros(len(ids), dtype=np.int64)
            flat = b.column(1).flatten().to_numpy(zero_copy_only=False).astype(dtype)
            starts = np.concatenate([[0], np.cumsum(dims)])
            for dim, k in sorted(set(zip(dims.tolist(), keys.tolist(), strict=True))):
                own = np.flatnonzero((dims == dim) & (keys == k))
                data = flat[starts[own][:, None] + np.arange(dim)[None, :]]
                for at in range(0, len(own), rows):
                    here = (dim, k)
                    held.setdefault(here, []).append((ids[own[at:at + rows]], data[at:at + rows]))
                    sizes[here] = sizes.get(here, 0) + len(own[at:at + rows])
                    if not key and sizes[here] >= rows:
                        yield block(here)
        for at in list(held):
            yield block(at)
    return vectors.mapInArrow(pack, BLOCK_DDL)


def best(found: list[Found], k: int) -> Found:
    """The k highest scores of each query, ties to the smaller vec_id."""
    q, ids, scores = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.lexsort((ids, -scores, q))
    q, ids, scores = q[order], ids[order], scores[order]
    first = np.concatenate([[True], q[1:] != q[:-1]])
    place = np.arange(len(q)) - np.maximum.accumulate(np.where(first, np.arange(len(q)), 0))
    keep = place < k
    return q[keep], ids[keep], scores[keep]


def search_blocks(queries: DataFrame, vectors: DataFrame, k: int, dtype: str, score_type: str,
                  search: Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray, Found | None], Found],
                  block_rows: int, query_rows: int, slots_per_core: int = 4) -> DataFrame:
    """query_id, rank, vec_id, score. ``search(query_ids, queries, vec_ids, vectors, held)`` gives the
    pairs of a query position and a vector that may be among the k best, held ones included."""
    n_queries, n_vectors = queries.count(), vectors.count()
    # candidate blocks are dealt over at most a few slots a core: query blocks are copied to slots, so what
    # is shuffled grows with the queries and the cluster, not with queries times vectors
    cores = queries.sparkSession.sparkContext.defaultParallelism
    blocks, slots = max(1, -(-n_queries // query_rows)), max(1, min(-(-n_vectors // block_rows), slots_per_core * cores))
    number = F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).alias("number")
    q = (packed(queries.select("vec_id", "v", number).repartition(blocks, "number"), dtype, query_rows, key="number")
         .select("dim", F.col("block").alias("qblock"), F.col("ids").alias("qids"), F.col("data").alias("qdata"),
                 F.explode(F.sequence(F.lit(0), F.lit(slots - 1))).alias("slot")))
    c = (packed(vectors, dtype, block_rows)
         .withColumn("slot", F.pmod(F.xxhash64("block"), F.lit(slots)).cast("int"))
         .withColumn("qblock", F.explode(F.expr(f"sequence(0L, {blocks - 1}L)"))))
    met = c.join(q, ["dim", "qblock", "slot"]).select("dim", "qblock", "qids", "qdata", "ids", "data")
    number_type = pa.int64() if score_type == "long" else pa.float64()
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", number_type)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, tuple] = {}

        def give(at: tuple) -> pa.RecordBatch:
            qids, (i, ids, scores) = held.pop(at)
            return pa.RecordBatch.from_arrays([pa.array(qids[i], pa.int64()), pa.array(ids, pa.int64()),
                                               pa.array(scores, number_type)], schema=schema)
        for b in batches:
            for dim, qblock, qids, qdata, ids, data in zip(*(x.to_pylist() for x in b.columns), strict=True):
                at = (dim, qblock)
                qids, ids = np.frombuffer(qids, "<i8"), np.frombuffer(ids, "<i8")
                qs, vs = np.frombuffer(qdata, dtype).reshape(-1, dim), np.frombuffer(data, dtype).reshape(-1, dim)
                old = held.get(at, (None, None))[1]
                held[at] = (qids, search(qids, qs, ids, vs, old))
                if len(held) > 8:  # what is given early is ranked with the rest
                    yield give(next(iter(held)))
        for at in list(held):
            yield give(at)

    found = met.mapInArrow(run, f"query_id long, vec_id long, score {score_type}")
    ranks = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (found.withColumn("rank", F.row_number().over(ranks)).filter(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))

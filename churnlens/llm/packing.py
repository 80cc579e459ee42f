"""Packing documents into windows by non-negative least squares over shallow length combinations.

A document of n ids gives n // window whole windows and a rest. The rests of a bounded chunk of
documents are counted in ``units`` length classes (a rest is in the class that holds it). The
combinations of at most ``depth`` classes that fill a window exactly are enumerated once; their
repeat counts x >= 0 solve min |A x - histogram|^2 by the active-set method, which gives at most as
many combinations above zero as there are classes, so that rounding down loses little. The windows
so filled lack a few ids each, since a rest may be shorter than its class; they, and then whole
windows, are filled greedily from the rests that no combination took, which are cut freely. What is
left goes on to the next chunk, and at the end of a partition the last ids, less than a window, are
cut into sequences whose lengths are powers of two. So no sequence needs padding.

Each task packs the documents it reads; nothing is shuffled, and memory is bounded by a chunk and 256
documents. Pieces share their document's buffer, so a long text costs its length. The larger a chunk,
the less rounding down leaves to fill up windows with; at about a million ids nearly all windows of
rests come from a combination, in a partition of any size. Which
sequence a document lands in follows the input's partitioning; sequence_id holds the partition in its
upper half.

A null text counts as empty and has the end id alone. Repeated rows and rows without a doc_id are
packed each. An empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlens.llm.common import batched, release
from churnlens.llm.tokens import encoder

PIECES = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
                    ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("ids", pa.binary())])
PIECES_DDL = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
              "offset long, ids binary")


class Piece(NamedTuple):
    doc_id: int | None
    start: int
    length: int
    doc_tokens: int
    ids: bytes  # four bytes each, of the document from ``base`` on
    base: int = 0

    def cut(self, length: int) -> tuple[Piece, Piece]:
        """Two pieces that share the buffer: nothing is copied."""
        return self._replace(length=length), self._replace(start=self.start + length, length=self.length - length)

    def own_ids(self) -> memoryview:
        at = 4 * (self.start - self.base)
        return memoryview(self.ids)[at:at + 4 * self.length]

    def compact(self) -> Piece:
        """The piece with a buffer of its own ids alone."""
        return self._replace(ids=bytes(self.own_ids()), base=self.start)


@lru_cache(maxsize=4)
def combinations_filling(units: int, depth: int) -> tuple[tuple[int, ...], ...]:
    """Falling class tuples of at most ``depth`` classes whose sum is ``units``."""
    out = []

    def add(head: tuple[int, ...], left: int, most: int) -> None:
        if left == 0:
            out.append(head)
        elif len(head) < depth:
            for c in range(min(left, most), 0, -1):
                if c * (depth - len(head)) < left:
                    break
                add((*head, c), left - c, c)
    add((), units, units)
    return tuple(out)


@lru_cache(maxsize=4)
def combination_matrix(units: int, depth: int) -> np.ndarray:
    """classes x combinations: how often a combination has a class (row 0: class 1)."""
    combos = combinations_filling(units, depth)
    a = np.zeros((units, len(combos)))
    for k, combo in enumerate(combos):
        for c in combo:
            a[c - 1, k] += 1
    return a


def solve_nnls(a: np.ndarray, b: np.ndarray, rounds: int | None = None) -> np.ndarray:
    """x >= 0 that minimises |a x - b|, by the active-set method."""
    n = a.shape[1]
    x, free = np.zeros(n), np.zeros(n, dtype=bool)
    ridge = 1e-13 * max(1.0, float((a * a).sum(axis=0).max(initial=0.0)))  # for sets of dependent columns
    tolerance = 1e-9 * max(1.0, float(np.abs(b).max(initial=0.0)))
    for _ in range(rounds or 3 * a.shape[0]):
        gain = a.T @ (b - a @ x)
        gain[free] = -np.inf
        best = int(np.argmax(gain))
        if gain[best] <= tolerance:
            break
        free[best] = True
        while True:
            own = np.flatnonzero(free)
            some = a[:, own]
            z = np.linalg.solve(some.T @ some + ridge * np.eye(len(own)), some.T @ b)
            if (z > 1e-12).all():
                x[:] = 0
                x[own] = z
                break
            low = z <= 1e-12
            held = x[own]
            step = np.min(np.where(low, held / np.maximum(held - z, 1e-300), np.inf))
            x[own] = np.maximum(held + step * (z - held), 0.0)
            free[own[low & (x[own] <= 1e-12)]] = False
            x[~free] = 0
            if not free.any():
                break
    return x


class Packer:
    """Packs pieces into sequences; ``out`` receives (piece, sequence, offset)."""

    def __init__(self, window: int, units: int, depth: int, first_sequence: int):
        self.window, self.units, self.depth = window, units, depth
        self.width = window // units
        self.sequence = first_sequence
        self.rests: list[Piece] = []
        self.out: list[tuple[Piece, int, int]] = []
        self.combined = self.laid = 0  # windows of rests filled by a combination, and end to end

    def _close(self, pieces: list[Piece]) -> None:
        offset = 0
        for p in pieces:
            self.out.append((p, self.sequence, offset))
            offset += p.length
        self.sequence += 1

    def add(self, piece: Piece) -> None:
        while piece.length >= self.window:
            head, piece = piece.cut(self.window)
            self._close([head])
        if piece.length:  # a long document's buffer doesn't wait with its rest
            self.rests.append(piece.compact() if piece.start else piece)

    def pack(self) -> None:
        """Fill windows from the rests; less than a window stays."""
        classes: list[list[Piece]] = [[] for _ in range(self.units + 1)]
        for p in self.rests:
            classes[-(-p.length // self.width)].append(p)
        counts = np.array([len(c) for c in classes[1:]], dtype=float)
        combos = combinations_filling(self.units, self.depth)
        x = np.floor(solve_nnls(combination_matrix(self.units, self.depth), counts) + 1e-6).astype(int)
        windows: list[list[Piece]] = []
        for k in np.argsort(-x, kind="stable"):
            if x[k] <= 0:
                break
            combo = combos[k]
            need = {c: combo.count(c) for c in combo}
            for _ in range(min(int(x[k]), *(len(classes[c]) // n for c, n in need.items()))):
                windows.append([classes[c].pop() for c in combo])
        # the largest rests first, so that they are cut into few parts
        pool = sorted((p for c in classes for p in c), key=lambda p: p.length)
        for i, held in enumerate(windows):
            lack = self.window - sum(p.length for p in held)
            while lack and pool:
                p = pool.pop()
                if p.length > lack:
                    p, rest = p.cut(lack)
                    pool.append(rest)
                held.append(p)
                lack -= p.length
            if lack:  # no rests are left: the other windows stay open
                pool = [p for w in windows[i:] for p in w]
                break
            self._close(held)
            self.combined += 1
        pool.sort(key=lambda p: p.length)
        for _ in range(sum(p.length for p in pool) // self.window):
            self._lay(pool, self.window)
            self.laid += 1
        self.rests = pool

    def _lay(self, queue: list[Piece], room: int) -> None:
        """Lay ``room`` ids from the end of ``queue`` end to end as a sequence."""
        held = []
        while room:
            p = queue.pop()
            if p.length > room:
                p, rest = p.cut(room)
                queue.append(rest)
            held.append(p)
            room -= p.length
        self._close(held)

    def finish(self) -> None:
        """Lay the last rests, less than a window, end to end in powers of two."""
        self.pack()
        left = sum(p.length for p in self.rests)
        queue, self.rests = sorted(self.rests, key=lambda p: p.length), []
        while left:
            room = 1 << (left.bit_length() - 1)
            left -= room
            self._lay(queue, room)


def pack_documents(docs: DataFrame, vocabulary: str = "byte_bpe_50k.json", end_id: int = 1, window: int = 2048,
                   units: int = 64, depth: int = 4, chunk_ids: int = 1_000_000, with_ids: bool = True,
                   cache_entries: int = 1_000_000) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids. A worker
    remembers the ids of ``cache_entries`` words: more of them cost memory, fewer cost time."""
    tail = struct.pack("<I", end_id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        enc = encoder(vocabulary, cache_entries)
        packer = Packer(window, units, depth, TaskContext.get().partitionId() << 32)

        def rows() -> Iterator[tuple]:
            held = 0
            for batch in batches:
                for at in range(0, batch.num_rows, 256):
                    doc_ids, texts = (c.to_pylist() for c in batch.slice(at, 256).columns)
                    for doc_id, ids in zip(doc_ids, enc.encode(texts), strict=True):
                        ids += tail
                        n = len(ids) // 4
                        packer.add(Piece(doc_id, 0, n, n, ids))
                        held += n % window
                    if held >= chunk_ids:
                        packer.pack()
                        held = sum(p.length for p in packer.rests)
                    yield from given()
                release()
            packer.finish()
            yield from given()
            release()

        def given() -> Iterator[tuple]:
            for p, sequence, offset in packer.out:
                ids = p.own_ids()
                yield (p.doc_id, p.start, p.length, zlib.crc32(ids), p.doc_tokens, sequence, offset,
                       bytes(ids) if with_ids else None)
            packer.out.clear()
        yield from batched(PIECES, rows())

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = slim.mapInArrow(run, PIECES_DDL)
    return out if with_ids else out.drop("ids")

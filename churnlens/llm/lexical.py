"""Ranked lexical search by range-maximum sparse tables over posting lists.

The index: each task cuts its documents into shards of at most about ``shard_postings`` postings. A
shard holds the ids and lengths of its documents and, per term, the posting list (documents and
occurrences). Documents of a shard are laid out by their most frequent term and length, so that
neighbours are alike. Tasks write the shards to files in the shared folder, a Parquet row group each, and
read them there one at a time: no shard passes through Spark, whose table of the index has one short row a
file. Statistics over all documents (documents with a term N, terms L, documents per query term df) are
sums over the shards.

The search of a shard: a posting's impact is what its term's occurrences add to the score before the
term's weight. A sparse table over each needed posting list answers which posting of any range has the
largest impact. A query keeps document intervals in a queue, ordered by their bound: the sum over its
terms of weight times the range maximum inside the interval. The interval with the largest bound is
taken first and split at the document that holds the largest of these maxima: that document is scored
exactly and the two parts get new bounds. Intervals of at most ``leaf`` postings are scored as a
whole. The search ends when no bound reaches the k-th best score found, in this shard or an earlier
one of the task; equal scores go on, so ties are exact.

Terms are maximal runs of ASCII letters, digits and non-ASCII characters, A-Z lower-cased. All is
integer arithmetic but the weight's logarithm:

    weight = floor(1000 ln((2N + 2) / (2 df + 1))), m = 100 - b + (b n N) div L with b = 75,
    score = sum over the query's terms (repeats too) of weight * ((10^9 tf) div (1000 tf + 8 m))

Queries are prepared by Spark, written to the shared folder and read from there by the tasks in blocks,
so neither the driver nor a task holds them all (a task keeps one number per query). A document
without terms (null, empty) counts for nothing and is no result. Rows without a doc_id rank like
others, last among equal scores; repeated rows are results each. Of benchmark rows that share an
item_id the smallest text asks; rows without an item_id ask nothing, and an item without terms found
gets no rows. Documents of any length fit: a shard grows to the terms of one document at most, a
batch to the rows Arrow hands over. Empty tables give an empty result; extra columns are ignored.
"""

from __future__ import annotations

import heapq
import uuid
from collections import Counter
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnlens.llm.common import batched, files_by_task, open_fs, release, run_folder, to_batch, written

# What separates terms.
SEPARATORS = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))

SHARD = pa.schema([("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())),
                   ("terms", pa.list_(pa.binary())), ("counts", pa.list_(pa.int64())),
                   ("docs", pa.binary()), ("tfs", pa.binary())])
INDEX = pa.schema([("part", pa.int32()), ("path", pa.string()), ("bytes", pa.int64()), ("docs", pa.int64()),
                   ("length", pa.int64())])
INDEX_DDL = "part int, path string, bytes long, docs long, length long"
POSTED = pa.schema([("term", pa.binary()), ("n", pa.int64())])
FOUND = pa.schema([("item_id", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])


def terms_of(text: bytes) -> list[bytes]:
    """The terms of a text in UTF-8."""
    return text.translate(BYTES).split()


class ShardBuilder:
    """Documents of one shard while it fills."""

    def __init__(self):
        self.ids: list = []
        self.lengths: list[int] = []
        self.layout: list[tuple] = []
        self.distinct: list[int] = []
        self.vocabulary: dict[bytes, int] = {}
        self.term: list[int] = []
        self.tf: list[int] = []

    def add(self, doc_id, words: list[bytes]) -> None:
        counted, known = Counter(words), self.vocabulary
        self.ids.append(doc_id)
        self.lengths.append(len(words))
        self.layout.append((max(counted, key=counted.get), len(words)))
        self.distinct.append(len(counted))
        self.term += [known.setdefault(w, len(known)) for w in counted]
        self.tf += counted.values()

    def row(self) -> tuple:
        order = sorted(range(len(self.ids)), key=self.layout.__getitem__)
        place = np.empty(len(order), dtype=np.int64)
        place[order] = np.arange(len(order))
        doc = np.repeat(place, self.distinct)
        term = np.array(self.term, dtype=np.int64)
        by_list = np.argsort(term * len(order) + doc)
        counts = np.bincount(term, minlength=len(self.vocabulary))
        return ([self.ids[i] for i in order], [self.lengths[i] for i in order], list(self.vocabulary), counts.tolist(),
                doc[by_list].astype("<i4").tobytes(), np.array(self.tf, dtype="<i8")[by_list].tobytes())


class ShardFile:
    """A file that shards are appended to, a row group each."""

    def __init__(self, folder: str, part: int):
        import pyarrow.parquet as pq

        fs, base = open_fs(folder)
        fs.create_dir(base, recursive=True)
        name = f"shards-{part:06d}-{uuid.uuid4().hex}.parquet"
        self.part, self.path, self.docs, self.length = part, f"{folder}/{name}", 0, 0
        self.stream = fs.open_output_stream(f"{base}/{name}", compression=None)
        self.writer = pq.ParquetWriter(self.stream, SHARD, use_dictionary=["lengths.list.element", "counts.list.element"],
                                       write_statistics=False)

    def add(self, shard: ShardBuilder) -> int:
        """Bytes of the file so far."""
        self.writer.write_batch(to_batch(SHARD, [shard.row()]))
        self.docs += len(shard.lengths)
        self.length += sum(shard.lengths)
        return self.stream.tell()

    def close(self) -> tuple:
        self.writer.close()
        size = self.stream.tell()
        self.stream.close()
        return self.part, self.path, size, self.docs, self.length


def read_shards(path: str, columns: list[str] | None = None) -> Iterator[pa.Table]:
    """The shards of a file, one at a time."""
    import pyarrow.parquet as pq

    fs, at = open_fs(path)
    with fs.open_input_file(at) as stream:
        file = pq.ParquetFile(stream)
        for k in range(file.num_row_groups):
            yield file.read_row_group(k, columns=columns, use_threads=False)
            release()


def build_index(docs: DataFrame, shard_postings: int = 300_000, file_mb: int = 16) -> DataFrame:
    """The index of ``docs`` (doc_id, text): part (task), path, bytes, docs and length (terms) of its files. The
    files are in the shared folder; the table names those of the task attempts that Spark committed."""
    spark = docs.sparkSession
    folder = run_folder(spark, "lexical-index")

    def files(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        from pyspark import TaskContext

        part, shard, file = TaskContext.get().partitionId(), ShardBuilder(), None
        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                if words := terms_of(text.as_py() or b""):
                    shard.add(doc_id.as_py(), words)
                    if len(shard.term) >= shard_postings:
                        file = file or ShardFile(folder, part)
                        if file.add(shard) >= file_mb << 20:
                            yield file.close()
                            file = None
                        shard = ShardBuilder()
            release()
        if shard.ids:
            file = file or ShardFile(folder, part)
            file.add(shard)
        if file:
            yield file.close()

    slim = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").cast("binary"))
    index = slim.mapInArrow(lambda batches: batched(INDEX, files(batches)), INDEX_DDL)
    return written(index.repartition("part"), "lexical-files")  # a few files, however many tasks there are


def query_terms(items: DataFrame) -> DataFrame:
    """item_id, term (bytes), n (occurrences) of the items (item_id, text)."""
    one = items.filter("item_id IS NOT NULL").groupBy(F.col("item_id").cast("long").alias("item_id")).agg(
        F.min(F.col("text").cast("string")).alias("text"))
    words = F.regexp_extract_all(F.translate("text", UPPER, LOWER), F.lit(SEPARATORS), F.lit(0))
    return one.select("item_id", F.explode(words.cast("array<binary>")).alias("term")).groupBy("item_id", "term").agg(
        F.count("*").alias("n"))


def weight(total: int, df: Column) -> Column:
    return F.floor(F.lit(1000.0) * F.log(F.lit(2.0 * total + 2.0) / (F.lit(2.0) * df + F.lit(1.0))))


def posting_lists(files: DataFrame, wanted: str, block: int = 65_536) -> DataFrame:
    """term, n (documents) of the posting lists in the files (path) whose terms are written in ``wanted``."""
    def lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                for shard in read_shards(path, ["terms", "counts"]):
                    held = pa.table([pc.list_flatten(shard["terms"]), pc.list_flatten(shard["counts"])], schema=POSTED)
                    for terms in written_blocks(wanted, block, ["term"]):
                        yield from held.filter(pc.is_in(held["term"], terms.column(0))).to_batches()
    return files.mapInArrow(lists, "term binary, n long")


def weighted_queries(files: DataFrame, items: DataFrame, total: int) -> DataFrame:
    """item_id, terms, weights (times occurrences) of the query terms that some document holds."""
    terms, wanted = written(query_terms(items), "lexical-query-terms"), run_folder(files.sparkSession, "lexical-wanted")
    terms.select("term").distinct().write.parquet(wanted)
    # written, since a join would take it for as small as the table of the files
    df = written(posting_lists(files, wanted).groupBy("term").agg(F.sum("n").alias("df")), "lexical-frequencies")
    weighed = terms.join(df, "term").withColumn("weight", F.col("n") * weight(total, F.col("df"))).filter("weight > 0")
    return weighed.groupBy("item_id").agg(F.collect_list(F.struct("term", "weight")).alias("p")).select(
        "item_id", F.col("p.term").alias("terms"), F.col("p.weight").alias("weights"))


class Shard:
    """A shard with its postings' impacts."""

    def __init__(self, doc_ids, lengths, terms, counts, docs, tfs, total: int, length: int):
        self.doc_ids = doc_ids
        self.order = np.array([(1 << 63) - 1 if i is None else i for i in doc_ids], dtype=np.int64)
        self.docs = np.frombuffer(docs, dtype="<i4").astype(np.int64)
        self.where = {t: k for k, t in enumerate(terms)}
        self.edges = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
        sizes, back = np.unique(np.array(lengths, dtype=np.int64), return_inverse=True)
        m = np.array([8 * (100 - 75 + 75 * int(n) * total // length) for n in sizes], dtype=np.int64)[back]
        tf = np.frombuffer(tfs, dtype="<i8").astype(np.int64)
        self.impact = 1_000_000_000 * tf // (1000 * tf + m[self.docs])


class RangeMaxima:
    """Sparse tables over the posting lists of some terms, laid end to end; ranges stay inside a list."""

    def __init__(self, shard: Shard, terms: list[bytes]):
        self.rank = {t: k for k, t in enumerate(t for t in terms if t in shard.where)}
        lists = [shard.where[t] for t in self.rank]
        lo, hi = shard.edges[lists], shard.edges[np.array(lists, dtype=np.int64) + 1]
        sizes = hi - lo
        self.ends = np.cumsum(sizes)
        self.starts = self.ends - sizes
        take = np.repeat(lo - self.starts, sizes) + np.arange(sizes.sum())
        self.docs, self.impact = shard.docs[take], shard.impact[take]
        self.width = len(shard.doc_ids)
        self.keys = np.repeat(np.arange(len(lists)), sizes) * self.width + self.docs
        levels = [np.arange(len(take), dtype=np.int32)]
        for k in range(int(sizes.max()).bit_length() - 1 if len(sizes) else 0):
            low, high = levels[-1][:-(1 << k)], levels[-1][1 << k:]
            up = np.where(self.impact[low] >= self.impact[high], low, high)
            levels.append(np.concatenate([up, levels[-1][len(up):]]))
        self.table = np.stack(levels)
        self.log = np.zeros(int(sizes.max()) + 1 if len(sizes) else 1, dtype=np.int64)
        for k in range(1, len(levels)):
            self.log[1 << k:] = k

    def arg(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The posting of the largest impact in each range [a, b)."""
        k = self.log[b - a]
        left, right = self.table[k, a], self.table[k, b - (1 << k)]
        return np.where(self.impact[left] >= self.impact[right], left, right)


class Search:
    """The best documents of a query in a shard; ``scored`` counts postings of leaves, ``splits`` splits."""

    def __init__(self, shard: Shard, maxima: RangeMaxima, k: int, leaf: int):
        self.shard, self.maxima, self.k, self.leaf = shard, maxima, k, leaf
        self.scored = self.splits = self.held = 0

    def run(self, terms: list[bytes], weights: list[int], floor: int) -> list[tuple[int, int]]:
        """(score, document) of the k best that score at least ``floor`` (at least 1)."""
        x, queue, ties = self.maxima, [], count()
        known = [(x.rank[t], w) for t, w in zip(terms, weights, strict=True) if t in x.rank]
        if not known:
            return []
        rank, w = (np.array(c, dtype=np.int64) for c in zip(*known, strict=True))
        found: list[tuple[int, int]] = []
        self.held += int((x.ends[rank] - x.starts[rank]).sum())

        def add(scores, docs):
            nonlocal found, floor
            found += zip(scores, docs, strict=True)
            if len(found) >= self.k:
                found.sort(key=lambda p: (-p[0], self.shard.order[p[1]]))
                found = found[:self.k]
                floor = max(floor, found[-1][0])

        def push(rank, w, a, b):
            some = a < b
            if some.all():
                pass
            elif some.any():
                rank, w, a, b = rank[some], w[some], a[some], b[some]
            else:
                return
            top = x.arg(a, b)
            gain = w * x.impact[top]
            if (bound := int(gain.sum())) >= floor:
                heapq.heappush(queue, (-bound, next(ties), rank, w, a, b, top, gain))

        push(rank, w, x.starts[rank], x.ends[rank])
        while queue and -queue[0][0] >= floor:
            _, _, rank, w, a, b, top, gain = heapq.heappop(queue)
            sizes = b - a
            n = int(sizes.sum())
            if n <= self.leaf:
                self.scored += n
                at = np.repeat(a - np.cumsum(sizes) + sizes, sizes) + np.arange(n)
                docs = x.docs[at]
                low = int(docs.min())
                score = np.zeros(int(docs.max()) - low + 1, dtype=np.int64)
                np.add.at(score, docs - low, x.impact[at] * np.repeat(w, sizes))
                good = np.flatnonzero(score >= floor)
                add(score[good].tolist(), (good + low).tolist())
                continue
            self.splits += 1
            doc = int(x.docs[top[np.argmax(gain)]])
            at = np.searchsorted(x.keys, rank * x.width + doc)
            held = at < b
            held[held] = x.docs[at[held]] == doc
            score = int((w[held] * x.impact[at[held]]).sum())
            if score >= floor:
                add([score], [doc])
            push(rank, w, a, at)
            push(rank, w, at + held, b)
        return found


def written_blocks(folder: str, rows: int, columns: list[str]) -> Iterator[pa.RecordBatch]:
    """The rows written in a folder in batches of at most ``rows``, in the same order for every reader."""
    import pyarrow.parquet as pq

    fs, path = open_fs(folder)
    from pyarrow.fs import FileSelector

    for info in sorted(fs.get_file_info(FileSelector(path)), key=lambda i: i.path):
        if info.base_name.endswith(".parquet"):
            with fs.open_input_file(info.path) as f:
                yield from pq.ParquetFile(f).iter_batches(rows, columns=columns)


def query_blocks(folder: str, rows: int) -> Iterator[list[tuple]]:
    """The written queries in blocks of at most ``rows``."""
    for batch in written_blocks(folder, rows, ["item_id", "terms", "weights"]):
        yield list(zip(*(c.to_pylist() for c in batch.columns), strict=True))


def search_index(index: DataFrame, items: DataFrame, k: int = 10, leaf: int = 512, block: int = 256) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` best documents of ``index`` for each item (item_id, text)."""
    spark = index.sparkSession
    total, length = (int(n or 0) for n in index.agg(F.sum("docs"), F.sum("length")).first())
    length = max(1, length)
    files = files_by_task(index.select("path", "bytes"), task_mb=16).select("path")
    folder = run_folder(spark, "lexical-queries")
    weighted_queries(files, items, total).write.parquet(folder)

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[Shard]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                for shard in read_shards(path):
                    yield Shard(*(c[0].as_py() for c in shard.columns), total, length)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        floors: list[int] = []  # per query, the k-th best score of a shard
        for shard in shards(batches):
            seen = 0
            for queries in query_blocks(folder, block):
                floors += [1] * (seen + len(queries) - len(floors))
                maxima = RangeMaxima(shard, sorted({t for _, terms, _ in queries for t in terms}))
                search = Search(shard, maxima, k, leaf)
                for q, (item, terms, weights) in enumerate(queries, seen):
                    found = search.run(terms, weights, floors[q])
                    if len(found) == k:
                        floors[q] = max(floors[q], found[-1][0])
                    for score, doc in found:
                        yield item, shard.doc_ids[doc], score
                seen += len(queries)

    found = files.mapInArrow(lambda batches: batched(FOUND, rows(batches)), "item_id long, doc_id long, score long")
    place = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= k).select(
        "item_id", "rank", "doc_id", "score")


def ranked_search(docs: DataFrame, items: DataFrame, k: int = 10, shard_postings: int = 300_000, **options) -> DataFrame:
    """``search_index`` over a new index of ``docs``."""
    return search_index(build_index(docs, shard_postings), items, k, **options)

"""Token ids in seekable zstandard files: one independent frame per document, a trailing seek table.

File layout: one zstandard frame per document (its ids as little-endian uint32), then two skippable
frames. The first holds the documents' ids (``DOC_INDEX``), the second is the seek table of the
public seekable format: per frame its compressed size, decompressed size and the low 32 bits of
XXH64 of its content, then the number of frames, a descriptor byte and the magic number. A reader
seeks to the end, reads the table, and decompresses only the frames of the documents it wants.

Rows with a null doc_id come last, repeated doc_ids are frames of their own in text order; a null
text counts as empty and holds the end id alone. An empty table gives no file. Other columns are
ignored.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from churnlens.llm.common import batched, files_by_task, map_rows, open_fs, release, run_folder, written
from churnlens.llm.tokens import encoder

# Magic numbers of the zstandard seekable format and of its skippable frames.
SEEK_TABLE_FRAME = 0x184D2A5E
DOC_INDEX_FRAME = 0x184D2A5D
SEEKABLE_MAGIC = 0x8F92EAB1
WITH_CHECKSUM = 0x80

MANIFEST = pa.schema([("part", pa.int32()), ("file_no", pa.int32()), ("path", pa.string()),
                      ("docs", pa.int64()), ("ids", pa.int64()), ("bytes", pa.int64()), ("first_id", pa.int64()),
                      ("last_id", pa.int64()), ("holds_null", pa.bool_())])
MANIFEST_DDL = "part int, file_no int, path string, docs long, ids long, bytes long, first_id long, last_id long, holds_null boolean"
READ = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()),
                  ("ids_crc32", pa.int64()), ("ids", pa.binary())])
READ_DDL = "doc_id long, start long, n_tokens long, ids_crc32 long, ids binary"


class SeekableWriter:
    """Appends documents to one file; ``close`` writes the index and the seek table."""

    def __init__(self, stream, level: int):
        import zstandard

        self.stream, self.pack = stream, zstandard.ZstdCompressor(level=level)
        self.entries: list[tuple[int, int, int]] = []
        self.doc_ids: list[int | None] = []
        self.ids = self.bytes = 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        import xxhash

        frame = self.pack.compress(ids)
        self.stream.write(frame)
        self.entries.append((len(frame), len(ids), xxhash.xxh64_intdigest(ids) & 0xFFFFFFFF))
        self.doc_ids.append(doc_id)
        self.ids += len(ids) // 4
        self.bytes += len(frame)

    def close(self) -> None:
        index = self.pack.compress(b"".join(struct.pack("<?q", d is not None, d or 0) for d in self.doc_ids))
        self.stream.write(struct.pack("<II", DOC_INDEX_FRAME, len(index)) + index)
        table = b"".join(struct.pack("<III", *e) for e in self.entries)
        table += struct.pack("<IBI", len(self.entries), WITH_CHECKSUM, SEEKABLE_MAGIC)
        self.stream.write(struct.pack("<II", SEEK_TABLE_FRAME, len(table)) + table)
        self.stream.close()


class SeekableReader:
    """Reads the tables from the end of a file; ``ids(k)`` decompresses frame k alone."""

    def __init__(self, stream):
        import zstandard

        self.stream, self.unpack = stream, zstandard.ZstdDecompressor()
        size = stream.size()
        frames, flags, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != SEEKABLE_MAGIC or not flags & WITH_CHECKSUM:
            raise ValueError("not a seekable file with checksums")
        table_at = size - 9 - 12 * frames - 8
        if struct.unpack("<I", self._at(table_at, 4))[0] != SEEK_TABLE_FRAME:
            raise ValueError("the seek table is damaged")
        table = np.frombuffer(self._at(table_at + 8, 12 * frames), dtype="<u4").reshape(frames, 3)
        self.sizes, self.sums = table[:, 1].astype(np.int64), table[:, 2]
        self.offsets = np.concatenate([[0], np.cumsum(table[:, 0].astype(np.int64))])
        head = int(self.offsets[-1])
        magic, length = struct.unpack("<II", self._at(head, 8))
        if magic != DOC_INDEX_FRAME:
            raise ValueError("the document index is damaged")
        index = self.unpack.decompress(self._at(head + 8, length))
        self.doc_ids = [d if known else None for known, d in struct.iter_unpack("<?q", index)]

    def _at(self, offset: int, length: int) -> bytes:
        self.stream.seek(offset)
        data = self.stream.read(length)
        if len(data) != length:
            raise ValueError("the file is cut short")
        return data

    def ids(self, k: int) -> bytes:
        import xxhash

        offset, end = int(self.offsets[k]), int(self.offsets[k + 1])
        data = self.unpack.decompress(self._at(offset, end - offset), max_output_size=int(self.sizes[k]))
        if len(data) != self.sizes[k] or xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != self.sums[k]:
            raise ValueError(f"frame {k} fails its checksum")
        return data


def write_token_files(docs: DataFrame, vocabulary: str = "word_bpe_49k.json", end_id: int = 2,
                      folder: str | None = None, file_mb: int = 64, level: int = 3) -> DataFrame:
    """Encode every whole text, append ``end_id`` and write the files in ascending doc_id order.
    Returns the manifest (part, file_no, path, docs, ids, bytes, first_id and last_id of its documents,
    holds_null: whether some have no id), itself written: it names exactly the files of the task attempts that Spark committed, whatever was lost or repeated."""
    spark = docs.sparkSession
    folder = folder or run_folder(spark, "token-files")
    tail = struct.pack("<I", end_id)
    limit = file_mb << 20

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, enc = TaskContext.get().partitionId(), encoder(vocabulary)
        fs, base = open_fs(folder)
        fs.create_dir(base, recursive=True)

        def rows() -> Iterator[tuple]:
            out, name, number = None, "", 0
            for batch in batches:
                for at in range(0, batch.num_rows, 256):
                    ids, texts = (c.to_pylist() for c in batch.slice(at, 256).columns[:2])
                    for doc_id, got in zip(ids, enc.encode(texts), strict=True):
                        if out is None:
                            name = f"tokens-{part:06d}-{number:04d}-{uuid.uuid4().hex}.zst"
                            out = SeekableWriter(fs.open_output_stream(f"{base}/{name}", compression=None), level)
                            span = (None, None, False)
                        out.add(doc_id, got + tail)
                        # doc_ids rise, nulls come last
                        first, last, nulls = span
                        span = (first, last, True) if doc_id is None else (doc_id if first is None else first, doc_id, nulls)
                        if out.bytes >= limit:
                            out.close()
                            yield part, number, f"{folder}/{name}", len(out.entries), out.ids, out.bytes, *span
                            out, number = None, number + 1
                release()
            if out is not None:
                out.close()
                yield part, number, f"{folder}/{name}", len(out.entries), out.ids, out.bytes, *span
        yield from batched(MANIFEST, rows())

    # the row number parts equal rows, which may be a third of all
    ordered = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                           F.monotonically_increasing_id().alias("row"))
               .repartitionByRange(F.col("doc_id").asc_nulls_last(), F.xxhash64("text"), "row")
               .sortWithinPartitions(F.col("doc_id").asc_nulls_last(), "text"))
    return written(ordered.mapInArrow(write, MANIFEST_DDL), "token-manifest")


def read_token_files(manifest: DataFrame, wanted: list[int] | None = None, with_ids: bool = True) -> DataFrame:
    """The documents of the files: doc_id, start (ids before it in the whole order), n_tokens,
    ids_crc32, ids. ``wanted`` opens only the files, and decompresses only the frames, of those doc_ids."""
    order = Window.orderBy("part", "file_no").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    files = manifest.withColumn("base", F.coalesce(F.sum("ids").over(order), F.lit(0)))
    keep = None if wanted is None else set(wanted)

    def read(rows: Iterator[tuple]) -> Iterator[tuple]:
        for path, base in rows:
            fs, at = open_fs(path)
            with fs.open_input_file(at) as stream:
                reader = SeekableReader(stream)
                start = base
                for k, doc_id in enumerate(reader.doc_ids):
                    n = int(reader.sizes[k]) // 4
                    if keep is None or doc_id in keep:
                        ids = reader.ids(k)
                        yield doc_id, start, n, zlib.crc32(ids), ids if with_ids else None
                    start += n

    if keep is not None:  # only files whose doc_ids span a wanted one are opened
        known = F.array(*(F.lit(w).cast("long") for w in sorted(keep - {None})))
        spans = F.exists(known, lambda w: w.between(F.col("first_id"), F.col("last_id")))
        files = files.filter(F.coalesce(spans, F.lit(False)) | (F.lit(None in keep) & F.col("holds_null")))
    dealt = files_by_task(files.select("path", "bytes", "base")).select("path", "base")
    return map_rows(dealt, read, READ, READ_DDL, batch=1024)


def token_output(docs: DataFrame, **options) -> DataFrame:
    """Write the token files and read them back: doc_id, start, n_tokens, ids_crc32."""
    return read_token_files(write_token_files(docs, **options), with_ids=False).drop("ids")

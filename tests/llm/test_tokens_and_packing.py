"""Cached encoding, token files and packing against the library itself and exact round trips."""

from __future__ import annotations

import random
import struct
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from churnlens.llm import packing, tokenfile
from churnlens.llm.common import open_fs, run_folder
from churnlens.llm.tokens import CachedEncoder, vocabulary_path
from tests.conftest import SF_SMALL
from tests.llm.helpers import documents, tuples

LETTERS = list("abAB'sé É0123 \n\t\r\x1c\xa0 .,!?|<>-_ßİıſΣς中文🙂é²½  ")
LONG = "anan ther " * 40_000
TEXTS = ["", None, " ", "  ", "a", " a", "a ", "\n", "x  y", "it's we'll", "the  \n end. \n\n Next", "<|endoftext|> x", LONG]


def reference(name):
    return Tokenizer.from_file(vocabulary_path(name))


def ids_of(tokenizer, text):
    return np.asarray(tokenizer.encode(text or "", add_special_tokens=False).ids, dtype="<u4").tobytes()


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_cached_ids_equal_the_library(name):
    rnd = random.Random(3)
    texts = TEXTS + ["".join(rnd.choices(LETTERS, k=rnd.randrange(50))) for _ in range(1500)]
    tokenizer, enc = reference(name), CachedEncoder(vocabulary_path(name), cache_entries=300)  # emptied again and again
    for at in range(0, len(texts), 100):
        part = texts[at:at + 100]
        assert enc.encode(part) == [ids_of(tokenizer, t) for t in part]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_a_word_is_learned_once_whatever_sign_follows(name):
    tokenizer, enc = reference(name), CachedEncoder(vocabulary_path(name), 10_000)
    texts = [f"so word{sign} and wörd{sign}\nword{sign}" for sign in [",", ".", ";", "!", "?!", ")", "...", ":"]]
    assert enc.encode(texts) == [ids_of(tokenizer, t) for t in texts]
    # so, and, word, wörd (with and without a space before them), eight signs, a line feed, a space
    assert len(enc.words) <= 4 + 2 + 8 + 2


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
@pytest.mark.parametrize("letters", ["ab's't're 'll d'm \n\n,.1", "aé×÷Ð \n«ª'—s'l —中١", "  a\n\n\t'— "])
def test_pieces_are_the_pre_tokens_of_each_text(name, letters):
    rnd, tokenizer, enc = random.Random(7), reference(name), CachedEncoder(vocabulary_path(name), 3000)
    for _ in range(10):
        texts = ["".join(rnd.choices(letters, k=rnd.randrange(30))) for _ in range(100)]
        assert enc.encode(texts) == [ids_of(tokenizer, t) for t in texts]


ENCODERS = {n: (reference(n), CachedEncoder(vocabulary_path(n), 10_000)) for n in ("word_bpe_49k.json", "byte_bpe_50k.json")}


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=4))
def test_any_text_encodes_as_the_library_does(texts):
    texts = [t.encode("utf-8", "replace").decode() for t in texts]
    for tokenizer, enc in ENCODERS.values():
        assert enc.encode(texts) == [ids_of(tokenizer, t) for t in texts]


ROWS = [(3, "Wer soll the"), (1, ""), (2, None), (None, "no id"), (2, "twice"), (2, "twice"), (-5, LONG), (9, "a b c")]


def expected_tokens(rows):
    tokenizer, start, out = reference("word_bpe_49k.json"), 0, []
    for d, t in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = ids_of(tokenizer, t) + struct.pack("<I", 2)
        out.append((d, start, len(ids) // 4, zlib.crc32(ids)))
        start += len(ids) // 4
    return out


def test_token_files_round_trip(spark):
    got = tokenfile.token_output(documents(spark, ROWS))
    assert tuples(got, "doc_id", "start", "n_tokens", "ids_crc32") == sorted(expected_tokens(ROWS), key=repr)
    assert tokenfile.token_output(documents(spark, [])).count() == 0


def test_only_wanted_documents_are_decompressed(spark):
    manifest = tokenfile.write_token_files(spark.read.parquet(f"{SF_SMALL}/documents.parquet"), file_mb=1)
    every = {r.doc_id: r for r in tokenfile.read_token_files(manifest).collect()}
    some = tokenfile.read_token_files(manifest, wanted=[7, 100]).collect()
    assert sorted(r.doc_id for r in some) == [7, 100] and all(r == every[r.doc_id] for r in some)
    # another document's damaged frame doesn't matter to them, but fails its own checksum
    path = manifest.orderBy("part").first().path
    fs, at = open_fs(path)
    with fs.open_input_file(at) as f:
        data = bytearray(f.read())
        f.seek(0)
        reader = tokenfile.SeekableReader(f)
        frame, ids = int(reader.offsets[1]), reader.doc_ids
    data[frame - 1] ^= 255
    copy = run_folder(spark, "damaged") + ".zst"
    fs, at = open_fs(copy)
    with fs.open_output_stream(at, compression=None) as f:
        f.write(bytes(data))
    with fs.open_input_file(at) as f:
        reader = tokenfile.SeekableReader(f)
        assert zlib.crc32(reader.ids(1)) == every[ids[1]].ids_crc32
        with pytest.raises(Exception):  # noqa: B017  the frame no longer decompresses, or its sum differs
            reader.ids(0)


def test_nnls_matches_the_conditions_of_a_minimum():
    rng = np.random.default_rng(1)
    for _ in range(20):
        a, b = rng.random((12, 30)), rng.random(12)
        x = packing.solve_nnls(a, b)
        slope = a.T @ (a @ x - b)
        assert (x >= 0).all() and (slope > -1e-6).all() and abs(slope @ x) < 1e-6


def test_combinations_fill_the_window():
    combos = packing.combinations_filling(16, 3)
    assert len(set(combos)) == len(combos) and all(sum(c) == 16 and 1 <= len(c) <= 3 for c in combos)
    assert len(combos) == sum(1 for a in range(1, 17) for b in range(a + 1) for c in range(b + 1) if a + b + c == 16)


def check_packing(rows, pieces):
    tokenizer = reference("byte_bpe_50k.json")
    by_sequence, by_doc = {}, {}
    for r in pieces:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
        by_doc.setdefault((r.doc_id, r.doc_tokens), []).append(r)
    for parts in by_sequence.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end and length > 0
            end += length
        assert end <= 2048 and (end == 2048 or end & (end - 1) == 0)  # no padding at all
    want = {}
    for d, t in rows:
        ids = ids_of(tokenizer, t) + struct.pack("<I", 1)
        want.setdefault((d, len(ids) // 4), []).append(ids)
    assert set(want) == set(by_doc)
    for key, texts in want.items():
        assert sum(r.length for r in by_doc[key]) == key[1] * len(texts)
        for r in by_doc[key]:
            assert any(zlib.crc32(ids[4 * r.start:4 * (r.start + r.length)]) == r.ids_crc32 for ids in texts)


def test_packing_awkward_rows(spark):
    check_packing(ROWS, packing.pack_documents(documents(spark, ROWS), with_ids=False).collect())
    assert packing.pack_documents(documents(spark, [])).count() == 0


def test_packing_many_documents_in_chunks(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    pieces = packing.pack_documents(docs, chunk_ids=20_000).collect()
    check_packing(rows, pieces)
    short = {r.doc_id for r in pieces if r.doc_tokens < 2048}
    cuts = sum(1 for r in pieces if r.doc_id in short) - len(short)
    assert cuts < 0.6 * len(short)  # most rests stay whole


def test_copies_of_one_length_leave_less_than_a_window():
    for length in (1100, 1, 700, 2047, 1024):
        packer = packing.Packer(2048, 64, 4, 0)
        for _ in range(3):
            for k in range(500):
                packer.add(packing.Piece(k, 0, length, length, bytes(4 * length)))
            packer.pack()
            assert sum(p.length for p in packer.rests) < 2048
        packer.finish()
        assert not packer.rests and sum(p.length for p, _, _ in packer.out) == 1500 * length
        sizes = {}
        for p, sequence, offset in packer.out:
            assert offset == sizes.get(sequence, 0)
            sizes[sequence] = offset + p.length
        assert sum(n == 2048 for n in sizes.values()) == 1500 * length // 2048


@pytest.fixture()
def small_parts(spark):
    """Partitions of small tables are not put together."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_only_files_that_span_a_wanted_id_are_opened(spark, small_parts):
    """The manifest bounds each file's doc_ids: a file that is gone doesn't matter to others' documents."""
    rows = [(k, f"some words of {k}") for k in range(400)] + [(None, "no id")]
    manifest = tokenfile.write_token_files(documents(spark, rows).repartition(8))
    files = manifest.orderBy("part").collect()
    assert len(files) > 2 and files[0].first_id == 0 and files[-1].holds_null
    assert all(a.last_id < b.first_id for a, b in zip(files, files[1:], strict=False) if b.first_id is not None)
    gone = manifest.withColumn("path", F.when(F.col("part") == files[1].part, F.lit("/tmp/no-such-file")).otherwise(F.col("path")))
    got = tokenfile.read_token_files(gone, wanted=[files[0].last_id, files[2].first_id, None]).collect()
    assert {r.doc_id for r in got} == {files[0].last_id, files[2].first_id, None}
    starts = {r.doc_id: r.start for r in tokenfile.read_token_files(manifest).collect()}
    assert all(r.start == starts[r.doc_id] for r in got)


def test_equal_rows_are_parted(spark, small_parts):
    """A third of all rows, alike in doc_id and text, is written by several tasks."""
    docs = documents(spark, [(None, "the same words again")] * 4000 + [(k, f"text {k}") for k in range(8000)]).repartition(8)
    manifest = tokenfile.write_token_files(docs)
    assert manifest.filter("holds_null").count() > 1
    assert tokenfile.read_token_files(manifest).count() == 12_000


def test_frequent_words_outlive_the_cache():
    from churnlens.llm.tokens import CachedEncoder, vocabulary_path
    tokenizer = reference("byte_bpe_50k.json")
    enc = CachedEncoder(vocabulary_path("byte_bpe_50k.json"), 40)
    for k in range(60):
        text = f"always here word{k} other{k * 7} and-more{k % 3}, again"
        assert enc.encode([text]) == [ids_of(tokenizer, text)]
        assert len(enc.words) + len(enc.old) < 120


def test_rests_come_from_combinations_in_a_partition_of_any_size():
    """Twenty million ids in one partition, in chunks of the default size: nine windows of rests in ten
    are filled by a combination."""
    import inspect
    chunk = inspect.signature(packing.pack_documents).parameters["chunk_ids"].default
    rng = np.random.default_rng(3)
    packer, held, total = packing.Packer(2048, 64, 4, 0), 0, 0
    while total < 20_000_000:
        n = int(min(60_000, rng.lognormal(6.2, 1.2))) + 1
        packer.add(packing.Piece(0, 0, n, n, b""))
        held, total = held + n % 2048, total + n
        if held >= chunk:
            packer.pack()
            packer.out.clear()
            held = sum(p.length for p in packer.rests)
    packer.finish()
    assert packer.combined >= 0.9 * (packer.combined + packer.laid)


def test_a_very_long_text_is_cut_in_linear_time():
    import time
    ids = bytes(4 * 4_000_000)
    packer = packing.Packer(2048, 64, 4, 0)
    began = time.process_time()
    packer.add(packing.Piece(1, 0, 4_000_000, 4_000_000, ids))
    assert time.process_time() - began < 0.3
    packer.finish()
    assert sum(p.length for p, _, _ in packer.out) == 4_000_000
    assert all(len(p.own_ids()) == 4 * p.length for p, _, _ in packer.out) and len(packer.out[-1][0].ids) < 4 * 2048

"""Targets, schedule and taken words against a plain version."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from churnlens.llm import mixing
from tests.conftest import SF_SMALL
from tests.llm.helpers import documents, tuples

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_targets(sizes, weights=(5, 2, 1), most=3):
    """Share by weight, cap, reshare the excess until none is above."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    w = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    capped, total = set(), sum(sizes.values())
    while True:
        left = total - sum(most * sizes[s] for s in capped)
        free = sum(w[s] for s in order if s not in capped)
        target = {s: most * sizes[s] if s in capped else left * w[s] / free for s in order}
        over = {s for s in order if s not in capped and target[s] > most * sizes[s] * (1 + 1e-12)}
        if not over:
            return target
        capped |= over


def check(rows, got):
    sizes = {}
    for r in rows:
        sizes[r[2]] = sizes.get(r[2], 0) + len(WORD.findall(r[1] or ""))
    target = plain_targets(sizes)
    assert sorted(((r.doc_id, r.size, r.source) for r in got), key=repr) == sorted(
        ((r[0], len(WORD.findall(r[1] or "")), r[2]) for r in rows), key=repr)
    taken = dict.fromkeys(sizes, 0)
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(target[r.source], abs=1e-6)
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source] += r.taken
    for s in sizes:
        assert abs(taken[s] - target[s]) <= 1


def rows_of(rnd, n, sources):
    return [(k, " ".join(rnd.choices(["aa", "b\tc", "d"], k=rnd.randrange(0, 300))), rnd.choice(sources)) for k in range(n)]


@pytest.mark.parametrize("sources", [["s0"], ["b", "a", "Z", "é", None], ["big"] * 30 + ["s1", "s2", "tiny", None]])
def test_taken_words_meet_the_targets(spark, sources):
    rows = rows_of(random.Random(len(sources)), 400, sources)
    rows += [(1000, None, "s1"), (1001, "", "nothing"), (1002, "one", "word"), (7, "same row", "s2"), (7, "same row", "s2"),
             (1003, "x " * 30_000, "a"), (None, "no id at all", "a")]
    docs = documents(spark, rows)
    got = mixing.mix(docs).collect()
    check(rows, got)
    again = mixing.mix(docs.repartition(3)).collect()
    key = lambda r: repr((r.doc_id, r.source, r.size, r.taken))
    assert sorted(map(key, got)) == sorted(map(key, again))


def test_schedule_spreads_sources_evenly(spark):
    rows = rows_of(random.Random(5), 600, ["a", "b", "c"])
    sized = documents(spark, rows).select("source", mixing.word_count("text").alias("size"))
    plan = mixing.source_plan(mixing.source_targets(sized), 16).cache()
    parts = {r.sid: r for r in plan.collect()}
    total = sum(r.slots for r in parts.values())
    slots = sorted((r.slot, r.sid, r["rank"]) for r in mixing.slot_schedule(plan, total).collect())
    seen = dict.fromkeys(parts, 0)
    for k, (_, sid, rank) in enumerate(slots):
        assert rank == seen[sid]  # ranks count a source's slots in order
        seen[sid] += 1
        for s, r in parts.items():  # at any point the mix is near its shares
            assert abs(seen[s] - r.slots / total * (k + 1)) < 6
    assert seen == {s: r.slots for s, r in parts.items()}


def test_hash_ranges_give_one_running_sum(spark, monkeypatch):
    monkeypatch.setattr(mixing, "RANGE_DOCS", 16)
    monkeypatch.setattr(mixing, "SLOT_CHUNK", 32)
    rows = rows_of(random.Random(8), 500, ["a", "a", "a", "b"])
    check(rows, mixing.mix(documents(spark, rows), block_words=8).collect())


def test_given_tables_and_empty_ones(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    check([(r.doc_id, r.text, r.source) for r in docs.collect()], mixing.mix(docs).collect())
    assert mixing.mix(documents(spark, [])).count() == 0
    assert mixing.mixed_documents(documents(spark, [])).count() == 0


def test_mixed_documents_are_repeated_as_taken(spark):
    rows = rows_of(random.Random(3), 200, ["a", "b", "c", None]) + [(500, None, "a"), (7, "twice twice", "b"), (7, "twice twice", "b")]
    docs = documents(spark, rows)
    taken = {}
    for r in mixing.mix(docs).collect():
        t = taken.setdefault((r.doc_id, r.source, r.content), [0, 0, 0])
        t[0], t[1], t[2] = t[0] + r.taken, t[1] + r.size, t[2] + 1
    want = sum(int(t / s + 0.5) * n for t, s, n in taken.values() if s)
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns and mixed.count() == want
    assert set(tuples(mixed, "doc_id", "text", "source")) <= {(r[0], r[1], r[2]) for r in rows}


def test_repeated_rows_are_rounded_one_by_one(spark):
    # one rounding for all equal rows of a source would take each of them as often
    rows = [(None, "w " * 128, s) for s in ("a", "b", "c") for _ in range(400)]
    docs = documents(spark, rows)
    target = plain_targets(dict.fromkeys("abc", 400 * 128))
    got = dict(mixing.mixed_documents(docs).groupBy("source").count().collect())
    for s in "abc":
        assert abs(got.get(s, 0) - target[s] / 128) <= 1


def stream_words(stream):
    """(source, words) in the order of the stream, partition by partition."""
    parts = stream.select("source", mixing.word_count("text").alias("n"), F.spark_partition_id().alias("p")).collect()
    assert [r.p for r in parts] == sorted(r.p for r in parts)
    return [(r.source, r.n) for r in parts]


def worst_share(stream, step=400):
    """The largest distance of a source's share of words from its share of the whole, over stretches."""
    words = stream_words(stream)
    whole = sum(n for _, n in words)
    shares = {s: sum(n for t, n in words if t == s) / whole for s, _ in words}
    worst = 0.0
    for at in range(0, len(words) - step + 1, step):
        part = words[at:at + step]
        total = sum(n for _, n in part)
        worst = max(worst, *(abs(sum(n for t, n in part if t == s) / total - share) for s, share in shares.items()))
    return worst


def test_the_mixed_stream_follows_the_schedule(spark, monkeypatch):
    """Every stretch of the stream holds the sources near their shares; with plain ranks in place of the
    schedule, one source after the other, it does not."""
    rnd = random.Random(12)
    rows = [(k, " ".join(rnd.choices(["aa", "b", "d"], k=rnd.randrange(20, 60))), s)
            for k, s in enumerate(rnd.choices(["a", "b", "c"], k=3000))]
    docs = documents(spark, rows)
    assert worst_share(mixing.mixed_documents(docs, partition_words=20_000)) < 0.05

    def plain_ranks(plan, total_slots):
        return plan.select("sid", "line_from", F.explode(F.sequence(F.lit(0).cast("long"), F.col("slots") - 1)).alias("rank")).select(
            (F.col("line_from") + F.col("rank")).alias("slot"), "sid", "rank")
    monkeypatch.setattr(mixing, "slot_schedule", plain_ranks)
    assert worst_share(mixing.mixed_documents(docs, partition_words=20_000)) > 0.3


def test_rows_carry_the_slots_that_take_them(spark):
    rows = rows_of(random.Random(4), 300, ["a", "b", "c"])
    got = mixing.mix(documents(spark, rows)).collect()
    for r in got:
        assert (r.slots > 0) == (r.taken > 0) == (r.first_slot is not None)
    last = max(r.first_slot for r in got if r.slots)
    # a source's first pass starts at once and goes on past a third of the schedule (three passes at most)
    for s in "abc":
        places = sorted(r.first_slot for r in got if r.slots and r.source == s)
        assert places[0] < 0.1 * last and places[-1] > 0.3 * last


def test_equal_rows_do_not_share_a_window(spark, monkeypatch):
    """A third of all rows are equal: they are numbered within input partitions and spread over hash ranges."""
    monkeypatch.setattr(mixing, "RANGE_DOCS", 64)
    rows = [(5, "same same same", "a")] * 1000 + [(100 + k, f"text {k} of its own", "a") for k in range(2000)]
    docs = documents(spark, rows).repartition(8)
    sized = docs.select("doc_id", "source", F.lit(3).cast("long").alias("size"), F.xxhash64("text").alias("content"),
                        F.monotonically_increasing_id().alias("row"))
    numbered = mixing.numbered_copies(sized).filter("doc_id = 5").collect()
    assert sorted(r["copy"] for r in numbered) == list(range(1000))
    ranges = {r["copy"]: hash((r["copy"],)) for r in numbered}
    assert len(ranges) == 1000
    check(rows, mixing.mix(docs).collect())


def test_columns_of_any_name_are_kept(spark):
    rows = [(k, f"word {k} and more", "s") for k in range(6)]
    docs = documents(spark, rows).withColumns({c: F.lit("mine") for c in ("__row", "__places", "__slot", "__copies", "__copy", "places", "copy", "n")})
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns and {r["__row"] for r in mixed.collect()} == {"mine"}
    from churnlens.llm import simhash
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns and {r["__row"] for r in kept.collect()} == {"mine"} and kept.count() > 0

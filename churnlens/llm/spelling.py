"""Spelling variants by an index of variable-length grams.

Words are maximal runs of ASCII letters and U+00C0 to U+00FF, A-Z lower-cased (the query of the
contract also drops a code point of some runs), of at least ``min_length`` code points and ``min_count``
occurrences. Two words are near if one inserted, deleted or replaced code point makes them equal.

Dictionary: grams of ``shortest`` to ``longest`` code points of the words with an edge mark at both
ends are counted; those in more than ``frequent`` words (the ``entries`` most frequent of them, which
bounds what the driver holds and sends out) are the grams that are too frequent to stand alone.
Decomposition: at each place of a word stands one gram, of ``shortest`` code points, made longer as long
as it is too frequent. So which gram stands at a place depends on the gram's own code points only.

Affected-gram bound: an edit changes only grams that contain its place, so a word's bound is the
largest number of its grams over one place. Near words share all grams but the bound's number, at the
same place, or if one code point longer at the same or the next place. Lists: of the grams in order
from rare to frequent, one of a word's first bound + 1 must be among the first bound + 1 of a near
word, so only these are put into lists (keyed by gram, place and length) and only they are looked up.
Merging: two words of a list stay a candidate if the grams of one that the other lacks, counted in
64-bit signatures of the whole gram lists, are no more than its bound, both ways. Verification: edit
distance 1. No near pair is lost, whatever the dictionary; it decides the lengths of the lists only.

``min_length`` must be at least ``longest``, so that no word's bound reaches all its grams. Long
lists are split by Spark's skew join: both sides are written tables. A row without a doc_id counts
with an empty one, a null or empty text has no words, repeated rows count each, texts are read whole,
an empty table gives an empty result and extra columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlens.llm.common import map_rows, replaced, written

RUNS = re.compile("[A-Za-zÀ-ÿ]+")
ASCII_LOWER = {c: c + 32 for c in range(65, 91)}
EDGES = "^$"  # marks of a word's ends: in no word

COUNTS = pa.schema([("word", pa.string()), ("n", pa.int64())])
LISTS = pa.schema([("gram", pa.string()), ("place", pa.int32()), ("size", pa.int32()), ("word", pa.string()),
                   ("n", pa.int64()), ("bound", pa.int32()), ("grams", pa.int64())])
LISTS_DDL = "gram string, place int, size int, word string, n long, bound int, grams long"


def lowered(run: str) -> str:
    return run.lower() if run.isascii() else run.translate(ASCII_LOWER)


def with_slips(doc_id, modulus: int = 97) -> Callable[[str], str]:
    """Drops a code point of a run where the crc32 of ``<doc_id>:<run>`` is a multiple of ``modulus``."""
    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())

    def change(run: str) -> str:
        h = zlib.crc32(run.encode(), start)
        if h % modulus:
            return run
        at = h % len(run)
        return run[:at] + run[at + 1:]
    return change


def as_it_is(doc_id) -> Callable[[str], str]:
    return lambda run: run


def counted(rows: Iterator[Counter], held: int = 200_000) -> Iterator[tuple[str, int]]:
    """Sums of counters, given out whenever ``held`` keys are held, so memory is bounded."""
    total: Counter = Counter()
    for some in rows:
        total.update(some)
        if len(total) >= held:
            yield from total.items()
            total.clear()
    yield from total.items()


def words(docs: DataFrame, min_length: int = 5, min_count: int = 3, change=as_it_is) -> DataFrame:
    """word, n of ``docs`` (doc_id, text); ``change(doc_id)`` gives what makes a word of a run."""
    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        def texts() -> Iterator[Counter]:
            for doc_id, text in rows:
                word, found = change(doc_id), Counter()
                for r, n in Counter(RUNS.findall(text or "")).items():
                    if len(w := word(lowered(r))) >= min_length:
                        found[w] += n
                yield found
        yield from counted(texts())
    slim = docs.select(F.col("doc_id").cast("string"), F.col("text").cast("string"))
    some = map_rows(slim, run, COUNTS, "word string, n long")
    return some.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


def frequent_grams(vocabulary: DataFrame, shortest: int, longest: int, frequent: int, entries: int) -> dict[str, int]:
    """The grams in more than ``frequent`` places of the words, at most ``entries``, with their counts."""
    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        def grams() -> Iterator[Counter]:
            for (word,) in rows:
                w = EDGES[0] + word + EDGES[1]
                yield Counter(w[p:p + q] for q in range(shortest, longest + 1) for p in range(len(w) - q + 1))
        yield from counted(grams())
    counts = map_rows(vocabulary.select("word"), run, COUNTS, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    top = counts.filter(F.col("n") > frequent).orderBy(F.desc("n"), "word").limit(entries)
    return {r["word"]: r["n"] for r in top.collect()}


def decompose(word: str, too_frequent: dict[str, int], shortest: int, longest: int) -> list[str]:
    """The gram at each place of a marked word."""
    w = EDGES[0] + word + EDGES[1]
    out = []
    for p in range(len(w) - shortest + 1):
        q = shortest
        while q < longest and p + q < len(w) and w[p:p + q] in too_frequent:
            q += 1
        out.append(w[p:p + q])
    return out


def affected(grams: list[str]) -> int:
    """The largest number of grams over one place where an edit can be: the places of the word, and of
    the end mark for what is put in before it."""
    size = len(grams) + len(grams[-1]) - 1
    over = [0] * size
    for p, g in enumerate(grams):
        for i in range(p, p + len(g)):
            over[i] += 1
    end = sum(1 for p, g in enumerate(grams) if p + len(g) == size and p < size - 1)
    return max(*over[1:-1], end)


def list_entries(vocabulary: DataFrame, too_frequent: dict[str, int], shortest: int, longest: int) -> DataFrame:
    """The rows of the lists: for each word its bound + 1 rarest grams with their places."""
    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        for word, n in rows:
            grams = decompose(word, too_frequent, shortest, longest)
            bound = affected(grams)
            signature = 0
            for g in grams:
                signature |= 1 << (xxhash.xxh32_intdigest(g.encode()) & 63)
            signature -= (signature >> 63) << 64
            rarest = sorted(range(len(grams)), key=lambda p: (too_frequent.get(grams[p], 0), grams[p], p))
            for p in rarest[:bound + 1]:
                yield grams[p], p, len(word), word, n, bound, signature
    return map_rows(vocabulary.select("word", "n"), run, LISTS, LISTS_DDL)


def near_pairs(vocabulary: DataFrame, shortest: int = 2, longest: int = 4, frequent: int = 64,
               entries: int = 100_000) -> DataFrame:
    """a, a_n, b, b_n: all near pairs of ``vocabulary`` (word, n), each once."""
    too_frequent = frequent_grams(vocabulary, shortest, longest, frequent, entries)
    lists = list_entries(vocabulary, too_frequent, shortest, longest)
    columns = ("word", "n", "bound", "grams")
    # a list is named by gram, place and word length; a word looks up its own list and those of words
    # that are one code point longer
    lists = written(lists.withColumn("list", F.xxhash64("gram", "place", "size")), "spelling-lists")
    lookups = F.array(*[F.xxhash64("gram", F.col("place") + dp, F.col("size") + ds) for dp, ds in ((0, 0), (0, 1), (1, 1))])
    a = written(lists.select(F.explode(lookups).alias("list"), *[F.col(c).alias(f"a_{c}") for c in columns]), "spelling-lookups")
    b = lists.select("list", *[F.col(c).alias(f"b_{c}") for c in columns])

    def lacks(x: str, y: str):
        return F.bit_count(F.col(f"{x}_grams").bitwiseAND(F.bitwise_not(f"{y}_grams"))) <= F.col(f"{x}_bound")
    each_once = (F.length("a_word") < F.length("b_word")) | (F.col("a_word") < F.col("b_word"))
    near = a.join(b, (a["list"] == b["list"]) & each_once & lacks("a", "b") & lacks("b", "a")
                  & (F.levenshtein("a_word", "b_word", 1) == 1))
    return near.groupBy(F.col("a_word").alias("a"), F.col("b_word").alias("b")).agg(
        F.max("a_n").alias("a_n"), F.max("b_n").alias("b_n"))


def roots(forms: DataFrame, max_rounds: int = 40) -> DataFrame:
    """word, root of ``forms`` (word, form): each round doubles the steps followed."""
    now, folder = replaced(forms.select("word", F.col("form").alias("root")), "spelling-roots", None)
    for _ in range(max_rounds):
        on = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        now, folder = replaced(now.join(on, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-roots", folder)
        if now.filter("moved").isEmpty():
            return now.select("word", "root")
    raise RuntimeError(f"forms did not end in {max_rounds} rounds")


def variants(docs: DataFrame, min_length: int = 5, min_count: int = 3, ratio: int = 2, change=as_it_is,
             longest: int = 4, **index) -> DataFrame:
    """word, form (the near word of largest n, ties the smallest, if its n is at least ``ratio`` times the
    word's; else null), root (from the word, forms followed to the last; the word itself if none), n,
    n_near, form_n."""
    if min_length < longest:
        raise ValueError("min_length must be at least longest")
    vocabulary = written(words(docs, min_length, min_count, change), "spelling-words")
    pairs = near_pairs(vocabulary, longest=longest, **index)
    both = F.explode(F.array(F.struct(F.col("a").alias("word"), F.col("b").alias("near"), F.col("b_n").alias("near_n")),
                             F.struct(F.col("b").alias("word"), F.col("a").alias("near"), F.col("a_n").alias("near_n"))))
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near"))
    near = pairs.select(both.alias("p")).select("p.*").groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    good = -F.col("best.less") >= F.lit(ratio) * F.col("n")
    judged = written(vocabulary.join(near, "word", "left").select(
        "word", F.when(good, F.col("best.near")).alias("form"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(good, -F.col("best.less")).alias("form_n")), "spelling-forms")
    ends = roots(judged.filter(F.col("form").isNotNull()))
    return judged.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")

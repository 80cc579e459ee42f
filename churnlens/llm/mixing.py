"""Mix sources to target weights by a low-discrepancy schedule of equal-word blocks.

1. Sources in code point order (null last) weigh 5, 2, 1, repeating; their targets share all words,
   none above ``max_repeat`` times its source's words, the excess reshared by weight.
2. Each source's documents, shuffled by a seeded hash, are laid end to end and cut into blocks of
   ``block_words`` words.
3. Slot k gets the golden-ratio point frac((k+1) / phi); the point falls in one source's part of the
   cumulated slot counts. A slot's rank among its source's slots names the block it takes, pass after
   pass over the source. A source whose points give more slots than its target has room for leaves
   the last ones empty; one that got fewer has them at the end, so that taken words equal the target
   rounded down.
4. A document's taken words are the overlaps of its words with the blocks that slots take; the stream
   of mixed documents follows the slots.

Ranks and running sums never sort a whole source in one task: documents are numbered within hash
ranges, slots within ranges of k, and the totals of the ranges are added. Everything is a DataFrame
operation.

Null texts have size 0, a null source is a source like any other. Documents of size 0 are returned
with taken 0. Repeated rows are documents of their own. An empty table gives an empty result; extra
columns are ignored, by ``mixed_documents`` kept, whatever their names. Orders are by seeded hash,
doc_id, size and, among equal rows, a number that doesn't depend on the partitioning, so reruns agree.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnlens.llm.common import free_names, written

WORD = r"[^\x20\x09-\x0D]+"
GOLDEN = (math.sqrt(5) - 1) / 2
SLOT_CHUNK = 1 << 16
RANGE_DOCS = 1 << 12
BINS = 1 << 12


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def _before(order: list, by: list, value: Column) -> Column:
    """Sum of ``value`` over the rows before this one."""
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(value).over(w), F.lit(0)).cast("long")


def source_targets(sized: DataFrame, weights: Sequence[int] = (5, 2, 1), max_repeat: int = 3) -> DataFrame:
    """source, sid, source_size, weight, target. Capped sources come first in the order of
    size / weight, so one running sum finds where the cap ends. The windows see one row per source."""
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    per = per.withColumn("sid", F.row_number().over(by_name) - 1)
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.col("sid") % len(weights) + 1).cast("int"))
    per = per.withColumn("weight", weight).withColumn("cap", max_repeat * F.col("source_size").cast("double"))
    order = Window.orderBy((F.col("cap") / F.col("weight")).asc(), "sid")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    per = (per.withColumn("total", F.sum("source_size").over(everything).cast("double"))
           .withColumn("level", (F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
                       / F.sum("weight").over(after)))
    # the first source in this order that its share fits gives the level of all that aren't capped
    free = F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct(F.col("cap") / F.col("weight"), "sid", "level"))
    per = per.withColumn("free_level", F.min(free).over(everything)["level"])
    target = F.least(F.col("cap"), F.coalesce(F.col("free_level") * F.col("weight"), F.col("cap")))
    return per.select("source", "sid", "source_size", "weight", target.alias("target"))


def source_plan(targets: DataFrame, block_words: int) -> DataFrame:
    """Per source also quota (words to take), blocks, slots, and its part of the line of all slots."""
    size, b = F.col("source_size"), F.lit(block_words)
    quota = F.floor(F.col("target") + 1e-6).cast("long")
    plan = targets.withColumn("quota", quota).withColumn("blocks", F.ceil(size / b).cast("long"))
    passes = F.when(size > 0, F.floor(F.col("quota") / size)).otherwise(0).cast("long")
    plan = plan.withColumn("slots", (passes * F.col("blocks")
                                     + F.ceil((F.col("quota") - passes * size) / b)).cast("long"))
    return plan.withColumn("line_from", _before(["sid"], [], F.col("slots")))


def slot_schedule(plan: DataFrame, total_slots: int) -> DataFrame:
    """slot, sid, rank: which source each slot draws from, and its rank there."""
    spark = plan.sparkSession
    k = F.col("slot")
    high, low = F.floor(k / (1 << 20)), k % (1 << 20)  # keeps the fraction exact enough for any k
    point = (high * ((1 << 20) * GOLDEN % 1.0) + (low + 1) * GOLDEN) % 1.0
    spot = F.least(F.floor(point * total_slots).cast("long"), F.lit(max(0, total_slots - 1)))
    width = max(1, math.ceil(total_slots / BINS))
    slots = (spark.range(0, total_slots).select(F.col("id").alias("slot"))
             .withColumn("spot", spot).withColumn("bin", F.floor(F.col("spot") / width).cast("long")))
    # each source's part of the line, cut at the bins: an equi-join and a range check
    end = F.col("line_from") + F.col("slots")
    parts = (plan.filter(F.col("slots") > 0)
             .select("sid", "line_from", end.alias("line_to"), "slots",
                     F.explode(F.sequence(F.floor(F.col("line_from") / width).cast("long"),
                                          F.floor((end - 1) / width).cast("long"))).alias("bin")))
    drawn = (slots.join(parts, "bin").filter((F.col("spot") >= F.col("line_from")) & (F.col("spot") < F.col("line_to")))
             .select("slot", "sid", "slots", F.floor(k / SLOT_CHUNK).cast("long").alias("chunk")))
    drawn = written(drawn, "drawn-slots")
    counts = drawn.groupBy("sid", "chunk").agg(F.count("*").alias("n"))
    counts = counts.withColumn("base", _before(["chunk"], ["sid"], F.col("n")))
    inner = F.row_number().over(Window.partitionBy("sid", "chunk").orderBy("slot")) - 1
    ranked = (drawn.withColumn("inner", inner).join(counts.select("sid", "chunk", "base"), ["sid", "chunk"])
              .select("slot", "sid", (F.col("base") + F.col("inner")).alias("rank"), "slots")
              .filter(F.col("rank") < F.col("slots")).drop("slots"))
    got = counts.groupBy("sid").agg(F.sum("n").alias("got"))
    short = (plan.join(got, "sid", "left").withColumn("got", F.coalesce(F.col("got"), F.lit(0)))
             .filter(F.col("got") < F.col("slots"))
             .select((F.lit(total_slots) + F.col("line_from")).alias("slot0"), "sid",
                     F.explode(F.sequence("got", F.col("slots") - 1)).alias("rank"))
             .select((F.col("slot0") + F.col("rank")).alias("slot"), "sid", "rank"))
    return ranked.unionByName(short)


def taken_blocks(schedule: DataFrame, plan: DataFrame, block_words: int) -> DataFrame:
    """slot, sid, block, words: the block that a slot takes and how many of its words."""
    b = F.lit(block_words)
    at = schedule.join(plan.select("sid", "source_size", "quota", "blocks"), "sid")
    at = (at.withColumn("turn", F.floor(F.col("rank") / F.col("blocks")).cast("long"))
          .withColumn("block", (F.col("rank") % F.col("blocks")).cast("long")))
    first = F.col("turn") * F.col("source_size") + F.col("block") * b
    words = F.least(b, F.col("source_size") - F.col("block") * b, F.col("quota") - first)
    return at.select("slot", "sid", "block", words.cast("long").alias("words")).filter(F.col("words") > 0)


def mix(docs: DataFrame, **options) -> DataFrame:
    """doc_id, size, source_size, target, taken, first_slot and slots (the first slot that takes words of
    the document, null if none, and how many do), source, content (hash of the text), of every row."""
    return taken_rows(docs, F.monotonically_increasing_id(), **options).drop("row", "places")


def numbered_copies(sized: DataFrame) -> DataFrame:
    """``sized`` and copy: 0, 1, ... among the rows of equal doc_id, source and content. Rows are numbered
    within their input partition, so repeated rows, however many, are not sorted in one task; the numbers
    of a group are the same for any partitioning."""
    group, part = ["doc_id", "source", "content"], F.shiftright("row", 33)
    sized = sized.withColumn("part", part)
    counts = written(sized.groupBy(*group, "part").agg(F.count("*").alias("n")), "copies-by-part")
    before = counts.withColumn("base", _before(["part"], group, F.col("n"))).filter("base > 0 OR n > 1").drop("n")
    same = [sized[c].eqNullSafe(before[c]) for c in (*group, "part")]
    joined = sized.join(before, same, "left").select(*[sized[c] for c in sized.columns], before["base"])
    inner = F.row_number().over(Window.partitionBy(*group, "part").orderBy("row")) - 1
    alone = joined.filter("base IS NULL").withColumn("copy", F.lit(0).cast("long"))
    many = joined.filter("base IS NOT NULL").withColumn("copy", F.col("base") + inner)
    return alone.unionByName(many).drop("part", "base")


def taken_rows(docs: DataFrame, row: Column, weights: Sequence[int] = (5, 2, 1), max_repeat: int = 3,
               block_words: int = 128, seed: int = 20) -> DataFrame:
    """The columns of ``mix``, row (the number of the document row that ``row`` gives) and places (the
    slots that take words of it, rising)."""
    content = F.xxhash64(F.coalesce(F.col("text"), F.lit("")))
    sized = written(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), content.alias("content"),
                                row.alias("row")), "sized-documents")
    n_docs = sized.count()
    plan = written(source_plan(source_targets(sized, weights, max_repeat), block_words), "source-plan")
    total_slots = plan.agg(F.coalesce(F.sum("slots"), F.lit(0))).first()[0]

    # hash ranges of about RANGE_DOCS documents: within them a window, between them running totals
    bits = max(0, math.ceil(math.log2(max(1, n_docs / RANGE_DOCS))))
    u = F.xxhash64(F.col("doc_id"), F.col("content"), F.col("copy"), F.lit(seed))
    numbered = numbered_copies(sized)
    named = plan.select(F.col("source").alias("name"), "sid", "source_size", "target")
    placed = (numbered.join(named, F.col("source").eqNullSafe(F.col("name"))).drop("name")
              .withColumn("u", u).withColumn("range", F.shiftright("u", 64 - bits) if bits else F.lit(0).cast("long")))
    placed = written(placed, "placed-documents")
    ranges = placed.groupBy("sid", "range").agg(F.sum("size").alias("words"))
    ranges = ranges.withColumn("base", _before(["range"], ["sid"], F.col("words"))).drop("words")
    placed = (placed.withColumn("inner", _before(["u", "doc_id", "size", "copy"], ["sid", "range"], F.col("size")))
              .join(ranges, ["sid", "range"]).withColumn("first", F.col("base") + F.col("inner")))
    b = F.lit(block_words)
    spans = F.when(F.col("size") > 0, F.sequence(F.floor(F.col("first") / b).cast("long"),
                                                 F.floor((F.col("first") + F.col("size") - 1) / b).cast("long")))
    pieces = placed.withColumn("block", F.explode_outer(spans))

    taken = taken_blocks(slot_schedule(plan, total_slots), plan, block_words)
    at = F.col("block") * b
    overlap = F.greatest(F.lit(0), F.least(F.col("first") + F.col("size"), at + F.col("words")) - F.greatest(F.col("first"), at))
    slot = F.when(overlap > 0, F.col("slot"))
    return (pieces.join(taken, ["sid", "block"], "left")
            .groupBy("row", "doc_id", "source", "content", "size", "source_size", "target")
            .agg(F.coalesce(F.sum(F.when(F.col("words").isNotNull(), overlap)), F.lit(0)).cast("long").alias("taken"),
                 F.min(slot).alias("first_slot"), F.count(slot).alias("slots"), F.sort_array(F.collect_list(slot)).alias("places")))


def mixed_documents(docs: DataFrame, partition_words: int = 2_000_000, **options) -> DataFrame:
    """The documents of ``docs`` as a stream in slot order: each row as often as its taken words make
    whole texts (taken / size, halves up), none of size 0. The copies of a row stand at slots that take
    words of it, evenly among them, so any stretch of the stream holds the sources near their shares.
    Partition i holds the i-th range of slots, sorted, of about ``partition_words`` words."""
    number, place, at = free_names(docs, "__row", "__places", "__slot")
    rows = written(docs.withColumn(number, F.monotonically_increasing_id()), "numbered-documents")
    n = F.floor(F.col("taken") / F.col("size") + 0.5).cast("int")
    chosen = taken_rows(rows, F.col(number), **options).filter(F.col("size") > 0).withColumn("n", n).filter("n > 0")
    spread = F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda k: F.element_at(
        "places", (F.floor(k * F.size("places") / F.col("n")) + 1).cast("int")))
    chosen = written(chosen.select(F.col("row").alias(number), spread.alias(place), (F.col("n") * F.col("size")).alias("words")),
                     "mix-copies")
    words, last = chosen.agg(F.coalesce(F.sum("words"), F.lit(0)), F.coalesce(F.max(F.array_max(place)), F.lit(0))).first()
    parts = max(1, math.ceil(words / partition_words))
    # chosen rows are a share of all rows, so the join is by sorting at every size
    stream = rows.join(chosen.drop("words").hint("merge"), number).withColumn(at, F.explode(place))
    part = F.least(F.floor(F.col(at) * parts / (last + 1)), F.lit(parts - 1)).cast("int")
    return (stream.repartitionById(parts, part).sortWithinPartitions(at, number).select(*docs.columns))

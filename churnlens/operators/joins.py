"""Join helpers.

Join strategy is left to Spark: with AQE on, a side whose *measured* shuffle output is under
``spark.sql.adaptive.autoBroadcastJoinThreshold`` is turned into a broadcast at run time.
Nothing here broadcasts a table whose size grows with the data.

A key may hold a large share of a table's rows. AQE splits such a partition only where both join
inputs come straight from an exchange and the hot side may be split (not the right side of a left
join), so joins of row-level tables are salted instead: the rows of the table that may be skewed
are spread over ``salts`` values (``ChurnParams.salts``: about the tasks a hot key may take), and the
rows of the side that is unique per key are copied to each.
The plan is the same for any data and building it starts no job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SALTS = 16

# A null-safe join key as two real columns: (coalesce(id, ''), isnull(id)). NULL ids match
# each other (like pandas merge / isin); because the pair is a column on every side, an
# aggregate grouped by it and a join on it share one hash partitioning (no re-shuffle between
# them), which a plain ``<=>`` condition would not give.
JOIN_KEY = ("_jk", "_jk_null")
SALT = "_salt"


def with_join_key(df: DataFrame, key: str = "customer_id") -> DataFrame:
    """``df`` with the key columns; a table that was written with them (bucketed) keeps its own."""
    if set(JOIN_KEY) <= set(df.columns):
        return df
    return df.withColumns({"_jk": F.coalesce(F.col(key), F.lit("")), "_jk_null": F.col(key).isNull()})


def spread(df: DataFrame, salts: int) -> DataFrame:
    """Rows with a salt from a hash of all their columns: the same for every attempt of a task."""
    return df.withColumn(SALT, F.pmod(F.xxhash64(*df.columns), F.lit(salts)).cast("int"))


def copied(df: DataFrame, salts: int, where=None) -> DataFrame:
    """Each row once per salt; rows that are not ``where`` only once, with salt 0."""
    every = F.sequence(F.lit(0), F.lit(salts - 1))
    return df.withColumn(SALT, F.explode(every if where is None else F.when(where, every).otherwise(F.array(F.lit(0)))))


def flag_missing_key(facts: DataFrame, keys: DataFrame, key: str, flag: str, salts: int = SALTS) -> DataFrame:
    """Add ``flag`` = True where ``facts[key]`` has no match among ``keys[key]`` (NULL matches
    NULL, as ``Series.isin`` does).

    The key side is reduced to its distinct keys, so the left join cannot multiply fact rows, and
    the join is salted, so neither an id that many facts share nor their NULL ids meet in one task.
    """
    known = with_join_key(keys.select(key)).select(*JOIN_KEY).distinct().withColumn("_hit", F.lit(True))
    joined = spread(with_join_key(facts), salts).join(copied(known, salts), [*JOIN_KEY, SALT], "left")
    return joined.withColumn(flag, F.col("_hit").isNull()).select(*facts.columns, flag)


def rows_missing_key(facts: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Fact rows whose key is absent from ``keys`` (null-safe anti join; keys need not be unique)."""
    k = keys.select(F.col(key).alias("_key"))
    return facts.join(k, facts[key].eqNullSafe(k["_key"]), "left_anti")


def left_join_unique(left: DataFrame, right: DataFrame, keys, salts: int = SALTS) -> DataFrame:
    """``left LEFT JOIN right USING (keys)`` for a ``left`` that holds each key at most once and a
    ``right`` where a key may hold many rows.

    The distinct keys of ``right`` tell each left row whether it has partners. One with partners is
    copied to all salts, one without to a single salt; then follows one left join on key and salt. Copies
    that met no partner in their salt go; ``left`` is computed once and its rows without partners
    are not multiplied.
    """
    keys = list(keys)
    present = right.select(*keys).distinct().withColumn("_partners", F.lit(True))
    flagged = left.join(present, keys, "left").withColumn("_partners", F.col("_partners").isNotNull())
    copies = copied(flagged, salts, F.col("_partners"))
    joined = copies.join(spread(right, salts).withColumn("_met", F.lit(True)), [*keys, SALT], "left")
    return joined.where(~F.col("_partners") | F.col("_met").isNotNull()).drop(SALT, "_partners", "_met")

"""Fact-to-dimension joins that survive a key holding a large share of the facts.

AQE splits a skewed partition only when both join inputs come straight out of a
shuffle. An aggregated dimension does not (its rows are already partitioned by
the key), and nothing is split when the next operator relies on the join's
partitioning. Here hot keys are split in the plan itself: their facts carry a
salt, their dimension row is repeated once per salt.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratingloom.sources.files import staged

# A key with more facts than this is split into parts of about this many.
ROWS_PER_SALT = 4_000_000
# The list of hot keys is broadcast. Parts hold at least one in so many of all facts,
# and fewer keys than that can have more facts than a part.
MOST_PARTS = 1_000_000
# A set of ids is broadcast as words of 64 neighbours each, up to so many words after they were counted.
MOST_WORDS = 500_000


def hot_keys(counts: DataFrame, key: str, rows_per_salt: int = ROWS_PER_SALT) -> DataFrame:
    """``(key, salts)`` of every key to split, from ``(key, count)``.

    A part has ``rows_per_salt`` facts or, if that is more, one in ``MOST_PARTS`` of all.
    """
    share = F.ceil(F.coalesce(counts.agg(F.sum("count")).scalar(), F.lit(0)) / MOST_PARTS)
    sized = counts.withColumn("part", F.greatest(F.lit(rows_per_salt).cast("bigint"), share))
    parts = F.ceil(F.col("count") / F.col("part")).cast("int")
    return sized.filter(F.col("count") > F.col("part")).select(key, parts.alias("salts"))


def salted_join(
    facts: DataFrame, dimension: DataFrame, key: str, hot: DataFrame, spread_by: list[str], how: str = "inner"
) -> DataFrame:
    """``facts`` joined to at most one ``dimension`` row each.

    The salt depends on the ``spread_by`` columns of the row and on the partition
    it comes from: copies of one row spread as far as their partitions do, and a
    task that runs again salts alike. ``how`` is ``inner``, ``left``, ``left_semi``
    or ``left_anti``.
    """
    spread = F.pmod(F.xxhash64(F.spark_partition_id(), *spread_by), F.col("salts")).cast("int")
    left = (
        facts.join(F.broadcast(hot), key, "left")
        .withColumn("salt", F.when(F.col("salts").isNull(), 0).otherwise(spread))
        .drop("salts")
    )
    parts = F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1)
    right = dimension.join(F.broadcast(hot), key, "left").withColumn("salt", F.explode(parts)).drop("salts")
    added = [] if how in ("left_semi", "left_anti") else [c for c in dimension.columns if c != key]
    return left.join(right, [key, "salt"], how).select(*facts.columns, *added)


def _bit(ids: Column) -> Column:
    return ids.bitwiseAND(63).cast("int")


def id_words(ids: DataFrame, key: str) -> DataFrame | None:
    """``(word, bits)``: the set of an integer column, 64 neighbouring ids a row; None if that is too many to broadcast.

    Dense ids need a 64th of their number in rows, sparse ones at most a row each.
    """
    if ids.schema[key].dataType.typeName() not in ("byte", "short", "integer", "long"):
        return None
    number = F.col(key).cast("bigint")
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), _bit(number))
    words = ids.filter(number.isNotNull()).groupBy(F.shiftright(number, 6).alias("word"))
    words = staged(words.agg(F.bit_or(bit).alias("bits")))
    return words if words.count() <= MOST_WORDS else None


def keep_members(facts: DataFrame, words: DataFrame, key: str) -> DataFrame:
    """The ``facts`` whose ``key`` is in the set; they stay where they are, so a hot key needs no care."""
    number = F.col(key).cast("bigint")
    there = F.call_function("shiftright", F.col("bits"), _bit(number)).bitwiseAND(1) == 1
    placed = facts.withColumn("word", F.shiftright(number, 6))
    return placed.join(F.broadcast(words), "word").filter(there).select(*facts.columns)

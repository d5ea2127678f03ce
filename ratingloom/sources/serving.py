"""The served lists: one row per user, batch and stream results merged by version."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratingloom.functions import strings
from ratingloom.sources import schemas
from ratingloom.sources.tiered import TieredTable
from ratingloom.sources.versioned import VersionedTable


def serving_table(spark: SparkSession, root: str) -> VersionedTable:
    """The keyed table ``(user_id, top_10, source)``, created if absent."""
    table = VersionedTable(spark, root, schemas.SERVING, ["user_id"])
    table.create_if_absent()
    return table


def tiered_serving_table(spark: SparkSession, root: str, buckets: int = 64, fan: int = 8) -> TieredTable:
    """The same table by merged runs, for many versions and single lookups."""
    return TieredTable(spark, root, schemas.SERVING, ["user_id"], buckets, fan)


def serving_rows(lists: DataFrame, source: Column | str) -> DataFrame:
    """``(userId, movies)`` as serving rows: key and list elements become text."""
    origin = F.lit(source) if isinstance(source, str) else source
    return lists.select(
        F.col("userId").cast("string").alias("user_id"),
        strings(F.col("movies")).alias("top_10"),
        origin.alias("source"),
    )


def lookup(latest: DataFrame, user_id: object) -> list[str]:
    """The list of one user; an unknown user or an empty list gives ``[]``."""
    row = latest.filter(F.col("user_id") == str(user_id)).select("top_10").first()
    return list(row.top_10) if row and row.top_10 else []


def lookup_key(table: TieredTable, user_id: object) -> list[str]:
    """What :func:`lookup` gives, from one bucket of every run."""
    row = table.latest_of(str(user_id)).select("top_10").first()
    return list(row.top_10) if row and row.top_10 else []


def lookup_many(latest: DataFrame, keys: DataFrame) -> DataFrame:
    """``(user_id, top_10, found)`` for every distinct key; unknown keys get ``[]``."""
    wanted = keys.select(F.col("user_id").cast("string").alias("user_id")).distinct()
    return wanted.join(latest.select("user_id", "top_10"), "user_id", "left").select(
        "user_id",
        F.coalesce("top_10", F.array().cast("array<string>")).alias("top_10"),
        (F.coalesce(F.size("top_10"), F.lit(0)) > 0).alias("found"),
    )

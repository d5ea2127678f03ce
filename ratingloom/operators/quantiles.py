"""Quantiles of a BIGINT column: mergeable sketch, or exact in four levels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratingloom import fixed_values as fixed

_LEVEL_BITS = 16


def approx_quantile(df: DataFrame, column: str, q: float, accuracy: int = fixed.SPLIT_ACCURACY) -> DataFrame:
    """One row ``quantile``: Spark's quantile sketch, one pass, map-side merged."""
    return df.agg(F.percentile_approx(column, F.lit(q), F.lit(accuracy)).alias("quantile"))


def exact_quantile(df: DataFrame, column: str, q: float) -> DataFrame:
    """One row ``quantile``: the smallest value whose cumulative share reaches ``q``.

    ``percentile_disc`` keeps every distinct value in one task. Here values are
    counted first (map-side combined, so a hot value costs one row per task), and
    four levels of 16 bits narrow them down: each orders the at most 65,536 blocks
    into which the block found before falls, whatever the range of the values.
    """
    values = df.groupBy(F.col(column).cast("bigint").alias("value")).agg(F.count("*").alias("n"))
    values = values.filter("value IS NOT NULL")
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    so_far = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found: DataFrame | None = None
    for shift in range(64 - _LEVEL_BITS, -1, -_LEVEL_BITS):
        block = F.shiftright("value", shift).alias("block")
        if found is None:
            blocks = values.groupBy(block).agg(F.sum("n").alias("n"))
            blocks = blocks.withColumn("total", F.sum("n").over(everything)).withColumn("before", F.lit(0))
        else:
            inside = F.shiftright("value", shift + _LEVEL_BITS) == F.col("prefix")
            blocks = values.join(F.broadcast(found), inside)  # one row
            blocks = blocks.groupBy(block, "total", "before").agg(F.sum("n").alias("n"))
        reached = F.col("before") + F.sum("n").over(so_far)
        found = (
            blocks.withColumn("reached", reached)
            .filter(_share("reached") >= q)
            .agg(
                F.min_by(
                    F.struct(F.col("block").alias("prefix"), "total", (F.col("reached") - F.col("n")).alias("before")),
                    "block",
                ).alias("t")
            )
            .select("t.*")
        )
    return found.select(F.col("prefix").alias("quantile"))


def _share(reached: str) -> Column:
    return F.col(reached).cast("double") / F.col("total")

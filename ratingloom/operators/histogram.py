"""Equal-width histogram of a BIGINT column."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def equal_width_histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """All ``bins`` intervals between minimum and maximum with their row counts.

    Columns ``bin`` (0-based), ``lower``, ``upper``, ``rows``. The last interval
    includes its upper end; when all values are equal the range is widened by a
    half on both sides. Values are counted first, so the second pass reads one row
    per distinct value, and bins are assigned in integer arithmetic.
    """
    values = df.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n")).filter("value IS NOT NULL")
    limits = values.agg(F.min("value").alias("low"), F.max("value").alias("high"))
    low, high = (limits.select(name).scalar() for name in ("low", "high"))
    spread = high - low
    slot = F.when(spread == 0, F.lit(bins // 2)).otherwise(
        F.least(F.lit(bins - 1), F.floor(F.try_divide((F.col("value") - low) * bins, spread)))
    )
    filled = values.groupBy(slot.cast("int").alias("bin")).agg(F.sum("n").alias("rows"))
    start = F.when(spread == 0, low - 0.5).otherwise(low.cast("double"))
    width = F.when(spread == 0, F.lit(1.0)).otherwise(spread.cast("double")) / bins
    frame = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return frame.join(filled, "bin", "left").select(
        "bin",
        (start + F.col("bin") * width).alias("lower"),
        (start + (F.col("bin") + 1) * width).alias("upper"),
        F.coalesce("rows", F.lit(0)).alias("rows"),
    )

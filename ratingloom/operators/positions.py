"""Global numbering of rows without sorting a table in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# An INT id falls into one of 2**16 buckets of 2**16 ids each. Both numbers are
# upper bounds by the type alone, whatever the data looks like.
_BUCKET_BITS = 16


def _require_int(df: DataFrame, column: str) -> None:
    found = df.schema[column].dataType.simpleString()
    if found != "int":
        raise TypeError(f"{column} must be INT to bound its buckets, found {found}")


def _rows_before(order: list, partition: list | None = None):
    """Running sum of ``n`` over the rows strictly before the current one."""
    window = Window.partitionBy(*(partition or [])).orderBy(*order)
    window = window.rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum("n").over(window), F.lit(0))


def dense_ids(df: DataFrame, key: str, new_key: str) -> DataFrame:
    """Distinct keys with their 0-based position in key order.

    The result of ``row_number() over (order by key) - 1``, but only the bucket
    histogram (at most 65,536 rows by the INT domain) meets in one task. Keys
    are sorted inside their bucket, at most 65,536 per bucket. The plan is a pure
    function of the keys, so a lost executor cannot shift ids.
    """
    _require_int(df, key)
    bucket = F.shiftright(F.col(key), _BUCKET_BITS).alias("bucket")
    # Stated for both uses of the keys, so that Spark computes them once: the join
    # below would infer it for one of them only.
    keys = df.select(key).distinct().select(key, bucket).filter("bucket IS NOT NULL")
    offsets = (
        keys.groupBy("bucket")
        .agg(F.count("*").alias("n"))
        .select("bucket", _rows_before([F.col("bucket")]).alias("before"))
    )
    inside = F.row_number().over(Window.partitionBy("bucket").orderBy(key))
    return keys.join(F.broadcast(offsets), "bucket").select(
        key, (F.col("before") + inside - 1).cast("int").alias(new_key)
    )


def popularity_positions(
    counts: DataFrame, key: str = "movieId", count: str = "count", position: str = "position"
) -> DataFrame:
    """1-based position of every key by descending count, ties by ascending key.

    Numbers are built from three levels: keys above this count, buckets of this
    count before this one, keys before this one in the bucket. A count shared by
    a third of the keys is therefore spread over its buckets. One task sees the
    distinct counts only; counts that differ and sum to N number below sqrt(2N).
    """
    _require_int(counts, key)
    bucketed = counts.withColumn("bucket", F.shiftright(F.col(key), _BUCKET_BITS)).filter("bucket IS NOT NULL")
    buckets = bucketed.groupBy(count, "bucket").agg(F.count("*").alias("n"))
    above = (
        buckets.groupBy(count)
        .agg(F.sum("n").alias("n"))
        .select(count, _rows_before([F.col(count).desc()]).alias("above"))
    )
    earlier = buckets.select(
        count, "bucket", _rows_before([F.col("bucket")], [count]).alias("earlier")
    ).join(above, count)
    inside = F.row_number().over(Window.partitionBy(count, "bucket").orderBy(key))
    return bucketed.join(earlier, [count, "bucket"]).select(
        key, count, (F.col("above") + F.col("earlier") + inside).alias(position)
    )

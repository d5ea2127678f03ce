"""Factor vectors between Arrow batches, numpy and Spark broadcasts."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A catalogue up to this size is shipped to every executor; a larger one is joined.
BROADCAST_LIMIT_BYTES = 128 << 20


def matrix(column: pa.Array, kind: type = np.float64) -> np.ndarray:
    """A list column of equally long vectors as a matrix (float64 unless named), one row each."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.astype(kind, copy=False).reshape(len(column), -1) if len(column) else np.zeros((0, 0), kind)


def vector_lists(rows: np.ndarray) -> pa.ListArray:
    """A matrix as a list column, one vector per row."""
    count, width = rows.shape
    offsets = pa.array(np.arange(0, (count + 1) * width, width), type=pa.int32())
    return pa.ListArray.from_arrays(offsets, pa.array(np.ascontiguousarray(rows).ravel()))


@dataclass(frozen=True)
class ItemFactors:
    """Item vectors, with a broadcast copy when their measured size allows one.

    ``table`` holds ``(movieId, features)``, one row per movie, which :meth:`of` makes
    or checks. ``packed`` is a broadcast ``(ids, matrix)`` ordered by id, or None beyond
    the limit; both give the same answers. The matrix keeps the precision of the column,
    as every Python worker holds it; what is worked out from it is in doubles.
    """

    table: DataFrame
    count: int
    rank: int
    packed: Broadcast | None

    @classmethod
    def of(
        cls, factors: DataFrame, limit_bytes: int = BROADCAST_LIMIT_BYTES, order: str | None = None
    ) -> ItemFactors:
        """Of several rows of a movie the last by the column ``order`` stays; without an order they are an error."""
        spark: SparkSession = factors.sparkSession
        table = factors.withColumn("movieId", F.col("movieId").cast("int")).filter(
            "movieId IS NOT NULL AND features IS NOT NULL"
        )
        if order is None:
            table = table.select("movieId", "features")
        else:
            last = F.max(F.struct(F.col(order).alias("at"), "features"))
            table = table.groupBy("movieId").agg(last.alias("last")).select("movieId", "last.features")
        sizes = table.agg(
            F.count("*").alias("n"),
            F.count_distinct("movieId").alias("movies"),
            F.min(F.size("features")).alias("low"),
            F.max(F.size("features")).alias("high"),
        ).first()
        if sizes.n != sizes.movies:
            raise ValueError(f"{sizes.n} item vectors for {sizes.movies} movies: name the column that orders them")
        if sizes.n and sizes.low != sizes.high:
            raise ValueError(f"item vectors differ in length: {sizes.low} to {sizes.high}")
        rank = sizes.high or 0
        packed = None
        if sizes.n * (rank * 8 + 8) <= limit_bytes:
            local = table.toArrow()
            ids = local.column("movieId").to_numpy()
            kind = np.float32 if table.schema["features"].dataType.elementType.typeName() == "float" else np.float64
            vectors = matrix(local.column("features"), kind).reshape(len(ids), rank)
            order = np.argsort(ids, kind="stable")
            packed = spark.sparkContext.broadcast((ids[order], vectors[order]))
        return cls(table, sizes.n, rank, packed)

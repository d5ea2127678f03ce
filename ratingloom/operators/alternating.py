"""The iterations of ALS over stored factor tables, for fits that are large for MLlib.

MLlib sends a factor to every block that holds a rating of it, through shuffle files, and
solves a rank x rank system per user and per movie. Here the factors of a side are a table in
the shared folder, written once per iteration; a task reads the table of the other side and
keeps the factors that its block of ratings names. Whoever has n ratings, n up to the rank, is
solved in the dual form: with rated factors X and ratings r, ``(X'X + cE)^-1 X'r`` equals
``X'(XX' + cE)^-1 r``, a system of n rows instead of rank.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratingloom.operators.vectors import matrix, vector_lists
from ratingloom.session import scratch_path
from ratingloom.sources.files import delete_path, staged

# Several ratings, or several factors, as one row of bytes: whose they are, what they rate (ratings only), and the
# ratings or the numbers of the factors.
ROWS = "ids BINARY, others BINARY, numbers BINARY"
_ROW_BYTES = 6 << 10  # 10,000 rows, the most that Arrow takes at once, stay below 64 MB
_SOLVE_BYTES = 1 << 20  # factors, as doubles, of which systems are made at once: they stay in a core's cache
# Since Spark 4.1 a union of tables of one partition has one partition, and so one task.
_UNION_CONF = "spark.sql.unionOutputPartitioning"


@contextmanager
def task_per_part(spark: SparkSession):
    """What is planned inside gives every table of a union tasks of its own; the session's own setting comes back."""
    before = spark.conf.get(_UNION_CONF, None)
    spark.conf.set(_UNION_CONF, "false")
    try:
        yield
    finally:
        spark.conf.unset(_UNION_CONF) if before is None else spark.conf.set(_UNION_CONF, before)


def alternate(
    ratings: DataFrame,
    users: DataFrame,
    items: DataFrame,
    rank: int,
    iterations: int,
    reg: float,
    user_blocks: int,
    item_blocks: int,
) -> tuple[DataFrame, DataFrame]:
    """(users, items): ``(id, features)`` after so many iterations from the given factors.

    What MLlib's explicit ALS works out: an iteration solves the items, then the users, each
    with ``reg`` times their number of ratings, in doubles; factors are kept in single
    precision. ``ratings`` is ``(userId, movieId, rating)``; repeated ratings of a pair count
    separately. ``reg`` has to be positive, or a dual system may have no solution.
    """
    spark, folder = ratings.sparkSession, scratch_path(ratings.sparkSession, "als")
    by_user = rating_blocks(ratings, "userId", "movieId", user_blocks, f"{folder}/by-user")
    by_item = rating_blocks(ratings, "movieId", "userId", item_blocks, f"{folder}/by-item")
    solve = partial(_solved, reg=reg)
    tables = {"users": _stored(factor_rows(users), f"{folder}/users-0"), "items": None}
    for number in range(1, iterations + 1):
        for side, blocks, other in (("items", by_item, "users"), ("users", by_user, "items")):
            path = f"{folder}/{side}-{number}"
            tables[side] = _stored(over_blocks(blocks, tables[other], solve, ROWS), path)
            delete_path(spark, f"{folder}/{side}-{number - 1}")
    users = staged(_features(tables["users"]))
    items = staged(_features(tables["items"]) if iterations else items.select("id", "features"))
    delete_path(spark, folder)
    return users, items


def weighted_sums(ratings: DataFrame, items: DataFrame, blocks: int) -> DataFrame:
    """``(userId, n, sums)``, stored: per user the number of ratings and the sum of each rated item's factor times the rating.

    ``items`` is ``(movieId, features)``. A task adds up the users of a block; no rating travels with a factor.
    """
    spark, folder = ratings.sparkSession, scratch_path(ratings.sparkSession, "sums")
    by_user = rating_blocks(ratings, "userId", "movieId", blocks, f"{folder}/by-user")
    factors = _stored(factor_rows(items.withColumnRenamed("movieId", "id")), f"{folder}/items")
    with task_per_part(spark):
        sums = staged(over_blocks(by_user, factors, _summed, "userId INT, n BIGINT, sums ARRAY<DOUBLE>"))
    delete_path(spark, folder)
    return sums


def rating_blocks(ratings: DataFrame, own: str, other: str, blocks: int, path: str) -> tuple[DataFrame, list[int]]:
    """Ratings as ``ROWS`` with their ``block``, stored by a hash of ``own`` and sorted, and how many each block has."""
    columns = [F.col(own).cast("int").alias("own"), F.col(other).cast("int").alias("other"), F.col("rating").cast("float")]
    # The hash of a repartition: a partition is a block.
    dealt = ratings.select(*columns).repartition(blocks, "own").withColumn("block", F.pmod(F.hash("own"), F.lit(blocks)))
    rows = dealt.sortWithinPartitions("block", "own", "other", "rating").mapInArrow(_rating_rows, f"{ROWS}, block INT")
    rows.write.partitionBy("block").parquet(path)
    stored = ratings.sparkSession.read.schema(f"{ROWS}, block INT").parquet(path)
    sizes = dict(stored.groupBy("block").agg(F.sum(F.length("ids")) / 4).collect())
    return stored, [int(sizes.get(block, 0)) for block in range(blocks)]


def over_blocks(blocks: tuple[DataFrame, list[int]], factors: DataFrame, work, schema: str) -> DataFrame:
    """``work`` of every block of ratings, a task each inside :func:`task_per_part`, that reads all factors of the other side.

    ``work`` takes (own, other, rating, vectors, place): the ratings sorted, the factors they name
    and, for each rating, the place of its factor among them.
    """
    stored, sizes = blocks
    parts = []
    for block, size in enumerate(sizes):
        if size:
            rated = stored.filter(F.col("block") == block).drop("block")
            parts.append(rated.union(factors).coalesce(1).mapInArrow(partial(_met, size=size, work=work), schema))
    if not parts:
        return factors.sparkSession.createDataFrame([], schema)
    return reduce(DataFrame.union, parts)


def _met(batches: Iterator[pa.RecordBatch], size: int, work) -> Iterator[pa.RecordBatch]:
    """The ratings of a block and the factors they name, of a stream with ratings and all factors in any order."""
    rated, waiting, seen, vectors = [], [], 0, None
    for batch in batches:
        kind = batch.column("others")
        if kind.null_count < len(kind):
            rows = batch.filter(kind.is_valid()) if kind.null_count else batch
            rated.append((_numbers(rows, "ids"), _numbers(rows, "others"), _numbers(rows, "numbers", np.float32)))
            seen += len(rated[-1][0])
            if seen == size:
                own, other, rating = (np.concatenate(column) for column in zip(*rated, strict=True))
                if (own[1:] < own[:-1]).any():  # a block of several files
                    order = np.lexsort((rating, other, own))
                    own, other, rating = own[order], other[order], rating[order]
                named, place = np.unique(other, return_inverse=True)
                rated = []
        if kind.null_count:
            waiting.append(_factors(batch.filter(kind.is_null()) if kind.null_count < len(kind) else batch))
        if seen == size:  # before that factors wait, as it is not known who is named
            for ids, factors in waiting:
                if vectors is None:
                    vectors = np.empty((len(named), factors.shape[1]), np.float32)
                at = np.minimum(np.searchsorted(named, ids), len(named) - 1)
                found = named[at] == ids
                vectors[at[found]] = factors[found]
            waiting = []
    yield from work(own, other, rating, vectors, place)


def _numbers(rows: pa.RecordBatch, name: str, kind: type = np.int32) -> np.ndarray:
    """The numbers of a binary column, all rows one after the other."""
    column = rows.column(name)
    ends = np.frombuffer(column.buffers()[1], np.int64 if pa.types.is_large_binary(column.type) else np.int32)
    first, last = ends[column.offset], ends[column.offset + len(column)]
    return np.frombuffer(column.buffers()[2], np.uint8)[first:last].view(kind)


def _factors(rows: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    ids = _numbers(rows, "ids")
    return ids, _numbers(rows, "numbers", np.float32).reshape(len(ids), -1)


def _binary(values: np.ndarray, per_row: int) -> pa.Array:
    """Numbers, or rows of them, as a binary column with so many of them a row."""
    values = np.ascontiguousarray(values)
    size = values.nbytes // len(values) * per_row
    ends = np.minimum(np.arange(-(-len(values) // per_row) + 1) * size, values.nbytes).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(ends), pa.py_buffer(values)])


def _factor_batches(ids: np.ndarray, factors: np.ndarray) -> Iterator[pa.RecordBatch]:
    per_row = max(1, _ROW_BYTES // (4 * factors.shape[1]))
    step = per_row * max(1, _SOLVE_BYTES // _ROW_BYTES)
    for start in range(0, len(ids), step):
        part = slice(start, start + step)
        columns = _binary(ids[part].astype(np.int32, copy=False), per_row), _binary(factors[part].astype(np.float32, copy=False), per_row)
        nothing = pa.nulls(len(columns[0]), pa.binary())
        yield pa.RecordBatch.from_arrays([columns[0], nothing, columns[1]], names=["ids", "others", "numbers"])


def _rating_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    per_row = _ROW_BYTES // 12
    for batch in batches:
        block = batch.column("block").to_numpy()
        starts = np.flatnonzero(np.r_[True, block[1:] != block[:-1]]) if len(block) else []
        for start, stop in zip(starts, np.r_[starts[1:], len(block)], strict=True):
            rows = batch.slice(start, stop - start)
            columns = [_binary(rows.column(name).to_numpy(), per_row) for name in ("own", "other", "rating")]
            columns.append(pa.array(np.full(len(columns[0]), block[start]), pa.int32()))
            yield pa.RecordBatch.from_arrays(columns, names=["ids", "others", "numbers", "block"])


def _solved(own, other, rating, vectors, place, reg: float) -> Iterator[pa.RecordBatch]:
    starts, rank = np.flatnonzero(np.r_[True, own[1:] != own[:-1]]), vectors.shape[1]
    counts = np.diff(np.r_[starts, len(own)])
    out = np.empty((len(starts), rank), np.float32)
    for count in np.unique(counts):
        group = np.flatnonzero(counts == count)
        if count > rank:
            for row in group:
                out[row] = _primal(vectors, place, rating, starts[row], count, reg)
            continue
        step = max(1, _SOLVE_BYTES // int(8 * count * rank))
        for at in range(0, len(group), step):
            rows = group[at : at + step]
            where = starts[rows, None] + np.arange(count)
            x = vectors[place[where]].astype(np.float64)
            systems = x @ x.transpose(0, 2, 1)
            systems[:, np.arange(count), np.arange(count)] += reg * count
            weights = np.linalg.solve(systems, rating[where].astype(np.float64)[:, :, None])
            out[rows] = (weights.transpose(0, 2, 1) @ x)[:, 0]
    yield from _factor_batches(own[starts], out)


def _primal(vectors, place, rating, start: int, count: int, reg: float) -> np.ndarray:
    """The factor of someone with more ratings than the rank, added up in parts of bounded bytes."""
    rank = vectors.shape[1]
    system, moment, step = reg * count * np.eye(rank), np.zeros(rank), max(1, _SOLVE_BYTES // (8 * rank))
    for at in range(start, start + count, step):
        part = slice(at, min(at + step, start + count))
        x = vectors[place[part]].astype(np.float64)
        system += x.T @ x
        moment += rating[part].astype(np.float64) @ x
    return np.linalg.solve(system, moment)


def _summed(own, other, rating, vectors, place) -> Iterator[pa.RecordBatch]:
    rank = vectors.shape[1]
    starts = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
    user = np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, len(own)]))
    sums, step = np.zeros((len(starts), rank)), max(1, _SOLVE_BYTES // (8 * rank))
    for at in range(0, len(own), step):
        part = slice(at, at + step)
        x = vectors[place[part]] * rating[part, None].astype(np.float64)
        first = np.flatnonzero(np.r_[True, user[part][1:] != user[part][:-1]])
        sums[user[part][first]] += np.add.reduceat(x, first)
    counts = np.diff(np.r_[starts, len(own)])
    for at in range(0, len(starts), step):
        part = slice(at, at + step)
        columns = [pa.array(own[starts[part]], pa.int32()), pa.array(counts[part], pa.int64()), vector_lists(sums[part])]
        yield pa.RecordBatch.from_arrays(columns, names=["userId", "n", "sums"])


def factor_rows(factors: DataFrame) -> DataFrame:
    """``(id, features)`` as ``ROWS``."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield from _factor_batches(batch.column("id").to_numpy(), matrix(batch.column("features"), np.float32))

    return factors.select("id", "features").mapInArrow(pack, ROWS)


def _features(rows: DataFrame) -> DataFrame:
    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                ids, factors = _factors(batch)
                yield pa.RecordBatch.from_arrays([pa.array(ids), vector_lists(factors)], names=["id", "features"])

    return rows.mapInArrow(unpack, "id INT, features ARRAY<FLOAT>")


def _stored(rows: DataFrame, path: str) -> DataFrame:
    spark = rows.sparkSession
    with task_per_part(spark):  # numbers of a factor do not compress
        rows.write.option("compression", "none").option("parquet.enable.dictionary", "false").parquet(path)
    return spark.read.schema(ROWS).parquet(path)

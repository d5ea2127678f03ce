"""User vectors from ratings and item vectors: a ridge solve per user.

For a user with rated item vectors X and ratings r the vector is
``(X'X + reg * E)^-1 X'r``. Ratings are first combined per (user, movie) pair as
``(n, total)``; X'X and X'r only need those sums. That bounds a user's rows by
the number of movies however many ratings the user sent.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratingloom import fixed_values as fixed
from ratingloom.operators.joins import hot_keys, salted_join
from ratingloom.operators.preparation import counts
from ratingloom.operators.vectors import ItemFactors, matrix, vector_lists
from ratingloom.sources.files import staged

_SCHEMA = "userId INT, features ARRAY<DOUBLE>, n_items BIGINT"
# A user with more rated movies than this is solved in parts of about as many.
PAIRS_PER_PART = 100_000
# So many such users are broadcast, after they were counted; more are joined.
LARGE_USERS = 100_000


def combine(ratings: DataFrame) -> DataFrame:
    """``(userId, movieId, n, total)``: repeated ratings of a movie count once each."""
    return ratings.groupBy("userId", "movieId").agg(
        F.count("*").alias("n"), F.sum(F.col("rating").cast("double")).alias("total")
    )


def probe(ratings: DataFrame, items: ItemFactors) -> DataFrame:
    """Rating rows with a flag ``known``: whether their movie has an item vector."""
    ids = items.table.select("movieId", F.lit(True).alias("known"))
    if items.packed is not None:  # size checked when the factors were packed
        joined = ratings.join(F.broadcast(ids), "movieId", "left").select(*ratings.columns, "known")
    else:
        hot = hot_keys(counts(ratings, "movieId"), "movieId")
        joined = salted_join(ratings, ids, "movieId", hot, ["userId"], "left")
    return joined.withColumn("known", F.coalesce("known", F.lit(False)))


def _with_vectors(pairs: DataFrame, items: ItemFactors, *keep: str):
    """Rows to solve from, and the broadcast catalogue to look movies up in, or None with the vectors in the rows."""
    if items.packed is not None:
        return pairs.select("userId", *keep, "movieId", "n", "total"), items.packed
    hot = hot_keys(counts(pairs, "movieId"), "movieId")
    joined = salted_join(pairs, items.table, "movieId", hot, ["userId"])
    return joined.select("userId", *keep, "n", "total", "features"), None


def fold_in(ratings: DataFrame, items: ItemFactors, reg: float = fixed.FOLD_IN_REG) -> DataFrame:
    """``(userId, features, n_items)`` for every user with at least one known movie.

    Rows travel sorted by user, so a task adds up one user at a time over as many
    Arrow batches as needed and holds one rank x rank matrix. A catalogue small
    enough to be broadcast is looked up in the task and the shuffle carries four
    numbers per pair; otherwise the vectors are joined first.
    """
    rows, catalogue = _with_vectors(combine(ratings), items)
    by_user = rows.repartition("userId").sortWithinPartitions("userId")
    rank = items.rank

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_user: int | None = None
        gram, moment, n_items = np.zeros((rank, rank)), np.zeros(rank), 0
        for batch in batches:
            users, vectors, n, total = _known_rows(batch, catalogue, rank)
            if not len(users):
                continue
            starts = np.flatnonzero(np.r_[True, users[1:] != users[:-1]])
            stops = np.r_[starts[1:], len(users)]
            done_ids, done_vectors, done_items = [], [], []
            for start, stop in zip(starts, stops, strict=True):
                user = int(users[start])
                if user != open_user:
                    if open_user is not None:
                        done_ids.append(open_user)
                        done_vectors.append(_ridge(gram, moment, reg))
                        done_items.append(n_items)
                    open_user, gram, moment, n_items = user, np.zeros((rank, rank)), np.zeros(rank), 0
                part = vectors[start:stop]
                gram = gram + part.T @ (part * n[start:stop, None])
                moment = moment + part.T @ total[start:stop]
                n_items += stop - start
            if done_ids:
                yield _user_batch(done_ids, done_vectors, done_items)
        if open_user is not None:
            yield _user_batch([open_user], [_ridge(gram, moment, reg)], [n_items])

    return by_user.mapInArrow(solve, _SCHEMA)


def fold_in_split(
    ratings: DataFrame, items: ItemFactors, reg: float = fixed.FOLD_IN_REG, pairs_per_part: int = PAIRS_PER_PART
) -> DataFrame:
    """What :func:`fold_in` gives, with the work on a user of very many movies spread over tasks.

    X'X and X'r are sums over pairs. The pairs of a user are dealt into parts by movie, a
    task adds up one part at a time, and where a user has several, the partial sums
    (rank squared / 2 numbers each) meet in a second, far smaller exchange. Users of one
    part are solved at once and move nothing but their vector.
    """
    pairs = staged(combine(ratings))  # counted and read
    sizes = pairs.groupBy("userId").agg(F.count("*").alias("pairs")).filter(F.col("pairs") > pairs_per_part)
    large = staged(sizes.select("userId", F.ceil(F.col("pairs") / pairs_per_part).cast("int").alias("parts")))
    # Every listed user holds more than ``pairs_per_part`` pairs, so the list is that much shorter than the table.
    listed = F.broadcast(large) if large.count() <= LARGE_USERS else large
    dealt = pairs.join(listed, "userId", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    dealt = dealt.withColumn("part", F.pmod(F.xxhash64("movieId"), F.col("parts")).cast("int"))
    rows, catalogue = _with_vectors(dealt, items, "part", "parts")
    # Rows are small and the work on them is not: a given number of partitions is not coalesced by size.
    tasks = int(ratings.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by_part = rows.repartition(tasks, "userId", "part").sortWithinPartitions("userId", "part")
    rank = items.rank

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_key, sums, waiting = None, None, []

        def closed() -> tuple:
            (user, part, parts), (gram, moment, n_items) = open_key, sums
            solved = _ridge(gram, moment, reg) if parts == 1 else None
            upper = None if parts == 1 else np.r_[gram[np.triu_indices(rank)], moment]
            return user, part, n_items, solved, upper

        for batch in batches:
            users, vectors, n, total, part, parts = _known_rows(batch, catalogue, rank, "part", "parts")
            if not len(users):
                continue
            starts = np.flatnonzero(np.r_[True, (users[1:] != users[:-1]) | (part[1:] != part[:-1])])
            for start, stop in zip(starts, np.r_[starts[1:], len(users)], strict=True):
                key = int(users[start]), int(part[start]), int(parts[start])
                if key != open_key:
                    if open_key is not None:
                        waiting.append(closed())
                    open_key, sums = key, (np.zeros((rank, rank)), np.zeros(rank), 0)
                x, (gram, moment, n_items) = vectors[start:stop], sums
                sums = (gram + x.T @ (x * n[start:stop, None]), moment + x.T @ total[start:stop], n_items + int(stop - start))
            if waiting:
                yield _part_batch(waiting)
                waiting = []
        if open_key is not None:
            yield _part_batch([closed()])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_user, sums, n_items = None, None, 0

        def solved() -> pa.RecordBatch:
            gram = np.zeros((rank, rank))
            gram[np.triu_indices(rank)] = sums[:-rank]
            gram = gram + np.triu(gram, 1).T
            return _user_batch([open_user], [_ridge(gram, sums[-rank:], reg)], [n_items])

        for batch in batches:
            users, counted = batch.column("userId").to_numpy(), batch.column("n_items").to_numpy()
            for user, more, upper in zip(users, counted, matrix(batch.column("sums")), strict=True):
                if user != open_user:
                    if open_user is not None:
                        yield solved()
                    open_user, sums, n_items = int(user), np.zeros(len(upper)), 0
                sums, n_items = sums + upper, n_items + int(more)
        if open_user is not None:
            yield solved()

    parts = staged(by_part.mapInArrow(add_up, _PARTS))
    meeting = parts.filter("sums IS NOT NULL").select("userId", "part", "n_items", "sums")
    meeting = meeting.repartition("userId").sortWithinPartitions("userId", "part")  # always added in one order
    alone = parts.filter("sums IS NULL").select("userId", "features", "n_items")
    return alone.unionByName(meeting.mapInArrow(merge, _SCHEMA))


_PARTS = "userId INT, part INT, n_items BIGINT, features ARRAY<DOUBLE>, sums ARRAY<DOUBLE>"


def _part_batch(closed: list[tuple]) -> pa.RecordBatch:
    users, parts, n_items, features, sums = zip(*closed, strict=True)
    kinds = (pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.float64()), pa.list_(pa.float64()))
    columns = [pa.array(values, kind) for values, kind in zip((users, parts, n_items, features, sums), kinds, strict=True)]
    return pa.RecordBatch.from_arrays(columns, names=["userId", "part", "n_items", "features", "sums"])


def _known_rows(batch: pa.RecordBatch, catalogue, rank: int, *keep: str):
    """Users, item vectors, counts, totals and columns to ``keep`` of the rows whose movie is known."""
    more = [batch.column(name).to_numpy() for name in keep]
    users = batch.column("userId").to_numpy()
    n = batch.column("n").to_numpy().astype(np.float64)
    total = batch.column("total").to_numpy()
    if catalogue is None:
        return users, matrix(batch.column("features")).reshape(len(users), rank), n, total, *more
    ids, vectors = catalogue.value
    if not len(ids):
        return users[:0], vectors, n[:0], total[:0], *(column[:0] for column in more)
    wanted = batch.column("movieId").to_numpy()
    slot = np.minimum(np.searchsorted(ids, wanted), len(ids) - 1)
    known = ids[slot] == wanted
    return users[known], vectors[slot[known]].astype(np.float64, copy=False), n[known], total[known], *(column[known] for column in more)


def _ridge(gram: np.ndarray, moment: np.ndarray, reg: float) -> np.ndarray:
    system = gram + reg * np.eye(len(moment))
    try:
        return np.linalg.solve(system, moment)
    except np.linalg.LinAlgError:
        return np.linalg.pinv(system) @ moment


def _user_batch(ids: list[int], vectors: list[np.ndarray], n_items: list[int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.int32()), vector_lists(np.vstack(vectors)), pa.array(n_items, pa.int64())],
        names=["userId", "features", "n_items"],
    )


def gram_sums(ratings: DataFrame, items: DataFrame, rank: int) -> DataFrame:
    """X'X (upper triangle) and X'r per user over the first ``rank`` dimensions, as plain sums.

    Built-in aggregates only, combined before the shuffle. Meant for small ranks:
    the number of columns grows with rank squared.
    """
    x = [F.get("features", F.lit(i)).cast("double") for i in range(rank)]
    joined = combine(ratings).join(items, "movieId")
    squares = [F.sum(F.col("n") * x[i] * x[j]).alias(f"a{i}{j}") for i in range(rank) for j in range(i, rank)]
    moments = [F.sum(F.col("total") * x[i]).alias(f"b{i}") for i in range(rank)]
    return joined.groupBy("userId").agg(*squares, *moments)


def fold_in_two(ratings: DataFrame, items: DataFrame, reg: float = fixed.FOLD_IN_REG) -> DataFrame:
    """The fold-in on the first two dimensions in closed form: ``(userId, u0, u1)``."""
    a, b, d = F.col("a00") + reg, F.col("a01"), F.col("a11") + reg
    determinant = a * d - b * b
    return gram_sums(ratings, items, 2).select(
        "userId",
        ((d * F.col("b0") - b * F.col("b1")) / determinant).alias("u0"),
        ((a * F.col("b1") - b * F.col("b0")) / determinant).alias("u1"),
    )

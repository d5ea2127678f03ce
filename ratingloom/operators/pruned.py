"""Exact top-k by inner product that skips items by the length of their vectors.

No score of an item can pass |u| * |v|. Items sorted by falling length are cut into
blocks, and a user is done once |u| times the longest vector of the next block stays
below their k-th best score so far. What was skipped could not have entered the list,
equal scores included, so lists are those of :func:`ratingloom.operators.scoring.top_items`.

A catalogue that is broadcast is walked block by block inside the task that holds the
users. A larger one is cut into tiers of rising size: each tier meets only the users
whose bound it can still pass, by the grid that scores everything.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratingloom import fixed_values as fixed
from ratingloom.operators.scoring import USER_BLOCK, best_by_score, top_items
from ratingloom.operators.vectors import ItemFactors, matrix
from ratingloom.sources.files import staged

#: Items of a block in a task, and of the first tier; each later tier holds ``GROWTH`` times the one before.
BLOCK = 256
FIRST_TIER, GROWTH = 4096, 4
#: Bounds and rough scores are taken as wrong by so many rounding errors per dimension.
_ROUNDINGS = 4

_SCHEMA = "userId INT, movieId INT, score DOUBLE, scored BIGINT"


def pruned_top_items(
    users: DataFrame,
    items: ItemFactors,
    k: int = fixed.LIST_LENGTH,
    exclude: DataFrame | None = None,
    block: int = BLOCK,
    first_tier: int = FIRST_TIER,
) -> DataFrame:
    """``(userId, movieId, score, rank, scored)``: the ``k`` best items of every user vector.

    ``scored`` is the number of items whose score was worked out for the user; its sum over
    the users against users times items is the share of the work that was left.
    """
    users = users.select("userId", "features")
    if k <= 0 or not items.count:
        return users.sparkSession.createDataFrame([], "userId INT, movieId INT, score DOUBLE, rank INT, scored BIGINT")
    if exclude is not None:
        exclude = exclude.select("userId", "movieId").dropna().distinct()
    if items.packed is not None:
        candidates = _in_tasks(users, items, k, exclude, block)
        if exclude is not None:
            candidates = candidates.join(exclude, ["userId", "movieId"], "left_anti")
        order = Window.partitionBy("userId").orderBy(F.col("score").desc(), F.col("movieId").desc())
        ranked = candidates.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        return ranked.select("userId", "movieId", "score", "rank", "scored")
    return _by_tiers(users, items, k, exclude, first_tier)


def length(features: Column) -> Column:
    """Euclidean length of a vector in double precision."""
    squares = F.transform(features, lambda x: x.cast("double") * x.cast("double"))
    return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda total, x: total + x))


def _in_tasks(users: DataFrame, items: ItemFactors, k: int, exclude: DataFrame | None, block: int) -> DataFrame:
    """Candidates of every user; as many more than ``k`` as the user has excluded items."""
    catalogue = items.packed
    if exclude is None:
        users = users.withColumn("spare", F.lit(0))
    else:
        excluded = exclude.groupBy("userId").agg(F.count("*").cast("int").alias("spare"))
        users = users.join(excluded, "userId", "left").withColumn("spare", F.coalesce("spare", F.lit(0)))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, vectors = catalogue.value
        vectors = vectors.astype(np.float64, copy=False)
        lengths = np.sqrt((vectors * vectors).sum(axis=1))
        order = np.argsort(-lengths, kind="stable")  # once per task, not per user
        ids, vectors, lengths = ids[order], vectors[order], lengths[order]
        for batch in batches:
            for start in range(0, batch.num_rows, USER_BLOCK):
                part = batch.slice(start, USER_BLOCK)
                takes = k + part.column("spare").to_numpy().astype(np.int64)
                yield _walk(part.column("userId").to_numpy(), matrix(part.column("features")), takes, ids, vectors, lengths, block)

    return users.mapInArrow(score, _SCHEMA)


def _walk(
    user_ids: np.ndarray, users: np.ndarray, takes: np.ndarray, ids: np.ndarray, items: np.ndarray, lengths: np.ndarray, block: int
) -> pa.RecordBatch:
    """Candidates of a block of users: items by falling length, until every user is done."""
    own = np.sqrt((users * users).sum(axis=1))
    slack = _ROUNDINGS * items.shape[1] * np.finfo(np.float64).eps * own * lengths[0]
    takes = np.minimum(takes, len(ids))
    held_at = [[] for _ in user_ids]  # places of items that may be among the best
    held = [np.zeros(0) for _ in user_ids]  # and their rough scores
    cut = np.full(len(user_ids), -np.inf)  # the takes[i]-th best rough score so far
    scored = np.zeros(len(user_ids), np.int64)
    active = np.arange(len(user_ids))
    for start in range(0, len(ids), block):
        active = active[own[active] * lengths[start] >= cut[active] - 2 * slack[active]]
        if not len(active):
            break
        rough = users[active] @ items[start : start + block].T
        scored[active] += rough.shape[1]
        for row, user in enumerate(active):
            near = np.flatnonzero(rough[row] >= cut[user] - 2 * slack[user])
            if len(near):
                scores = np.r_[held[user], rough[row, near]]
                places = np.r_[held_at[user], start + near].astype(np.int64)
                if len(scores) >= takes[user]:
                    at = len(scores) - takes[user]
                    cut[user] = np.partition(scores, at)[at]
                    kept = scores >= cut[user] - 2 * slack[user]
                    scores, places = scores[kept], places[kept]
                held[user], held_at[user] = scores, places
    out_users, out_items, out_scores, out_scored = [], [], [], []
    for user, vector in enumerate(users):
        places = np.asarray(held_at[user], np.int64)
        # One by one in a fixed order of summation, so that equal vectors tie wherever they stand.
        exact = (items[places] * vector).sum(axis=1)
        order = np.lexsort((-ids[places].astype(np.int64), -exact))[: takes[user]]
        out_users.append(np.full(len(order), user_ids[user], np.int32))
        out_items.append(ids[places][order].astype(np.int32))
        out_scores.append(exact[order])
        out_scored.append(np.full(len(order), scored[user]))
    columns = [pa.array(np.concatenate(part)) for part in (out_users, out_items, out_scores, out_scored)]
    return pa.RecordBatch.from_arrays(columns, names=["userId", "movieId", "score", "scored"])


def _by_tiers(users: DataFrame, items: ItemFactors, k: int, exclude: DataFrame | None, first_tier: int) -> DataFrame:
    """Tiers of items by falling length, each against the users it can still change.

    The cuts between tiers are approximate quantiles: where they fall changes the work, not the lists.
    """
    measured = staged(items.table.withColumn("length", length(F.col("features"))))
    users = staged(users.withColumn("own", length(F.col("features"))).withColumn("scored", F.lit(0).cast("bigint")))
    if exclude is not None:  # every tier reads its part
        exclude = staged(exclude.join(users.select("userId"), "userId", "left_semi"))
    shares, upper = [], first_tier
    while upper < items.count:
        shares.append(1 - upper / items.count)
        upper *= 1 + GROWTH
    cuts = measured.agg(F.percentile_approx("length", shares, 10_000)).first()[0] if shares else []
    slack = 1 + 2 * _ROUNDINGS * items.rank * float(np.finfo(np.float64).eps)
    best, above = None, None
    for cut in [*dict.fromkeys(cuts), None]:
        tier = measured if cut is None else measured.filter(F.col("length") >= cut)
        tier = tier if above is None else tier.filter(F.col("length") < above)
        above = cut if cut is not None else above
        size = tier.agg(F.count("*").alias("n"), F.max("length").alias("longest")).first()
        if not size.n:
            continue
        if best is None:
            reached = users
        else:
            done = best.filter(F.col("rank") == k).select("userId", F.col("score").alias("least"))
            reached = users.join(done, "userId", "left")
            # |u| |v| and the score are rounded; a user near the bound goes on.
            passes = F.col("own") * size.longest * slack + F.abs("least") * (slack - 1) >= F.col("least")
            reached = staged(reached.filter(F.col("least").isNull() | passes).drop("least"))
        factors = ItemFactors(staged(tier.select("movieId", "features")), size.n, items.rank, None)
        found = top_items(reached, factors, k, exclude).drop("rank")
        best = staged(best_by_score(found if best is None else best.drop("rank").unionByName(found), k))
        met = reached.select("userId", F.lit(True).alias("met"))
        more = F.when(F.col("met"), F.lit(size.n)).otherwise(F.lit(0))
        users = staged(users.join(met, "userId", "left").withColumn("scored", F.col("scored") + more).drop("met"))
    return best.join(users.select("userId", "scored"), "userId")

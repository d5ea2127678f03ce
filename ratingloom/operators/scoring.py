"""Top-k items for many user vectors by inner product.

Scores are double precision; the order is score descending, then movieId
descending. Matrix products in blocks, in single precision where the vectors' lengths allow
it, only shortlist: the candidates within rounding distance of the k-th score are scored again
one by one in a fixed summation order, so equal vectors tie exactly wherever they sit in a block.
The k-th score so far is carried from one block of items to the next, where whatever stays
below it is not looked at again.

Items a user must not get are handled without shipping anybody's history to one
task: a block returns as many extra candidates as the user has excluded items in
it, and the excluded pairs are then anti-joined away. At least k allowed items
survive per block, if it has them, so the merged result is exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratingloom import fixed_values as fixed
from ratingloom.operators.vectors import ItemFactors, matrix
from ratingloom.sources.files import staged

_SCHEMA = "userId INT, movieId INT, score DOUBLE"
_CELL_BUDGET = 8_000_000  # scores held at once in a task (64 MB)
_CUT_BUDGET = 1_000_000  # of them, copied at once to be cut (8 MB)
_NEAR_BUDGET = 10_000  # candidates, beyond those of one user, scored again at once
_SINGLE = 1e-15, 1e15  # lengths of vectors between which single precision has no overflow or underflow
_MET_BYTES = 16 << 20  # vectors of items that a block of users meets at once
_ARROW = pa.schema([("userId", pa.int32()), ("movieId", pa.int32()), ("score", pa.float64())])
USER_BLOCK = 1024
ITEM_BLOCK_BYTES = 16 << 20  # vectors of one block of items
TASKS_PER_CORE = 4  # cells of the grid


def top_items(
    users: DataFrame,
    items: ItemFactors,
    k: int = fixed.LIST_LENGTH,
    exclude: DataFrame | None = None,
    user_block: int = USER_BLOCK,
    item_block: int | None = None,
) -> DataFrame:
    """``(userId, movieId, score, rank)``: the ``k`` best items of every user vector.

    ``users`` holds one row ``(userId, features)`` per user; ``exclude`` holds
    ``(userId, movieId)`` pairs. With a broadcast catalogue the users are scored
    where they are; a larger catalogue is cut into blocks (of ``item_block`` items, or
    of bounded bytes) that meet the user blocks on a grid of equi-join keys.
    """
    users = users.select("userId", "features")
    if k <= 0 or not items.count:
        return users.sparkSession.createDataFrame([], _SCHEMA + ", rank INT")
    if exclude is not None:
        exclude = exclude.select("userId", "movieId").dropna().distinct()
    if items.packed is not None:
        candidates = _score_broadcast(users, items, k, exclude)
    else:
        if exclude is not None:  # read twice; a pair without an item of the catalogue excludes nothing
            exclude = staged(exclude.join(items.table.select("movieId"), "movieId", "left_semi"))
        candidates = _score_grid(users, items, k, exclude, user_block, item_block)
    if exclude is not None:
        candidates = candidates.join(exclude, ["userId", "movieId"], "left_anti")
    return best_by_score(candidates, k)


def best_by_score(candidates: DataFrame, k: int) -> DataFrame:
    """The ``k`` best rows per user, limited inside each map task before the shuffle."""
    order = Window.partitionBy("userId").orderBy(F.col("score").desc(), F.col("movieId").desc())
    ranked = candidates.select("userId", "movieId", "score", F.row_number().over(order).alias("rank"))
    return ranked.filter(F.col("rank") <= k)


def as_lists(ranked: DataFrame, score: str = "score") -> DataFrame:
    """``(userId, recommendations)``: ranked rows as an array of ``(movieId, rating)``."""
    entry = F.struct("rank", "movieId", F.col(score).cast("float").alias("rating"))
    ordered = F.array_sort(F.collect_list(entry))
    picked = F.transform("ordered", lambda e: F.struct(e["movieId"].alias("movieId"), e["rating"].alias("rating")))
    return ranked.groupBy("userId").agg(ordered.alias("ordered")).select("userId", picked.alias("recommendations"))


def _score_broadcast(users: DataFrame, items: ItemFactors, k: int, exclude: DataFrame | None) -> DataFrame:
    catalogue = items.packed
    if exclude is None:
        users = users.withColumn("spare", F.lit(0))
    else:
        excluded = exclude.groupBy("userId").agg(F.count("*").cast("int").alias("spare"))
        users = users.join(excluded, "userId", "left").withColumn("spare", F.coalesce("spare", F.lit(0)))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, vectors = catalogue.value
        for batch in batches:
            user_ids = batch.column("userId").to_numpy()
            takes = k + batch.column("spare").to_numpy()
            yield from _best_of_all(user_ids, matrix(batch.column("features")), takes, ids, vectors)

    return users.mapInArrow(score, _SCHEMA)


def _block(column: str, blocks: int) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(blocks)).cast("int")


def grid_shape(tasks: int, users: int, user_blocks: int, items: int, item_blocks: int) -> tuple[int, int]:
    """(groups of items, salts of users): with g * s tasks users are copied g times and items s times."""
    groups = max(1, min(item_blocks, round((tasks * items / max(1, users)) ** 0.5)))
    return groups, max(1, min(user_blocks, -(-tasks // groups)))


def _score_grid(
    users: DataFrame,
    items: ItemFactors,
    k: int,
    exclude: DataFrame | None,
    user_block: int,
    item_block: int | None,
) -> DataFrame:
    """Score block by block. Ids are unique, so hashing fills the blocks evenly.

    A task joins some blocks of users to one group of item blocks and carries a
    running top-k of a user block from one item block to the next, so at most k rows
    (and as many as a user has excluded items) leave it per user. The copies that are
    shuffled grow with the square root of the number of tasks, not with the items: tasks
    are as many as the cores need, and items are cut into blocks enough for a square grid.
    """
    spark = users.sparkSession
    if exclude is None:
        users = users.withColumn("spare", F.lit(0))
    else:
        excluded = exclude.groupBy("userId").agg(F.count("*").cast("int").alias("spare"))
        users = users.join(excluded, "userId", "left").withColumn("spare", F.coalesce("spare", F.lit(0)))
    users = staged(users)  # counted and read: the vectors are solved once
    n_users = users.count()
    user_blocks = max(1, -(-n_users // user_block))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tasks = min(tasks, TASKS_PER_CORE * spark.sparkContext.defaultParallelism, max(1, user_blocks * items.count))
    if not item_block:
        wanted, _ = grid_shape(tasks, n_users, user_blocks, items.count, items.count)
        item_block = max(1, min(ITEM_BLOCK_BYTES // (8 * max(1, items.rank)), -(-items.count // wanted)))
    item_blocks = -(-items.count // item_block)
    groups, salts = grid_shape(tasks, n_users, user_blocks, items.count, item_blocks)

    def packed(table: DataFrame, key: str, blocks: int, name: str, *more: str) -> DataFrame:
        rows = table.groupBy(_block(key, blocks).alias(f"{name}_block")).agg(
            F.collect_list(F.struct(key, "features", *more)).alias("rows")
        )
        return rows.select(
            f"{name}_block",
            F.col(f"rows.{key}").alias(f"{name}_ids"),
            F.flatten("rows.features").alias(f"{name}_vectors"),
            *(F.col(f"rows.{column}").alias(column) for column in more),
        )

    left = packed(users, "userId", user_blocks, "user", "spare").select(
        "*",
        F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"),
        (F.col("user_block") % salts).alias("salt"),
    )
    right = packed(items.table, "movieId", item_blocks, "item").select(
        "*",
        (F.col("item_block") % groups).alias("group"),
        F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"),
    )
    cells = left.join(right, ["group", "salt"])

    columns = ["user_block", "user_ids", "user_vectors", "spare", "item_ids", "item_vectors"]
    return cells.select(*columns).mapInArrow(partial(_meet_blocks, k=k), _SCHEMA)


def _meet_blocks(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """The best items of each user block, whose item blocks come one after the other; small ones are met together."""
    open_block, best, met, held = None, None, [], 0

    def meet() -> pa.Table:
        ids, vectors = (np.concatenate(parts) for parts in zip(*met, strict=True))
        floors = _floors(best, user_ids, takes)
        fresh = pa.Table.from_batches(_best(user_ids, user_vectors, takes, ids, vectors, floors), _ARROW)
        return fresh if best is None else _cut(pa.concat_tables([best, fresh]), user_ids, takes)

    for batch in batches:
        for row in range(batch.num_rows):
            cell = {name: batch.column(name)[row] for name in batch.schema.names}
            if cell["user_block"].as_py() != open_block:
                if met:
                    best = meet()
                if best is not None:
                    yield from best.to_batches()
                open_block, best, met, held = cell["user_block"].as_py(), None, [], 0
                user_ids = cell["user_ids"].values.to_numpy()
                user_vectors = _unpack(cell["user_vectors"], len(user_ids))
                takes = k + cell["spare"].values.to_numpy()
            ids = cell["item_ids"].values.to_numpy()
            met.append((ids, _unpack(cell["item_vectors"], len(ids))))
            held += met[-1][1].nbytes
            if held >= _MET_BYTES:
                best, met, held = meet(), [], 0
    if met:
        best = meet()
    if best is not None:
        yield from best.to_batches()


def _best_of_all(
    user_ids: np.ndarray, users: np.ndarray, takes: np.ndarray, ids: np.ndarray, items: np.ndarray
) -> Iterator[pa.RecordBatch]:
    """What :func:`_best` gives, over a catalogue of either precision that is met in parts of bounded bytes."""
    step = max(1, _MET_BYTES // (8 * max(1, items.shape[1])))
    if len(ids) <= step:
        yield from _best(user_ids, users, takes, ids, items.astype(np.float64, copy=False))
        return
    places, best = np.arange(len(user_ids), dtype=np.int32), None  # a place names a row, even if an id comes twice
    for start in range(0, len(ids), step):
        part, floors = items[start : start + step].astype(np.float64), _floors(best, places, takes)
        fresh = pa.Table.from_batches(_best(places, users, takes, ids[start : start + step], part, floors), _ARROW)
        best = fresh if best is None else _cut(pa.concat_tables([best, fresh]), places, takes)
    owners = pa.array(user_ids.astype(np.int32)[best.column("userId").to_numpy()])
    yield from best.set_column(0, "userId", owners).to_batches()


def _cut(table: pa.Table, user_ids: np.ndarray, takes: np.ndarray) -> pa.Table:
    """The ``takes[i]`` best rows of every user of a table of candidates."""
    users, ids, scores = (table.column(name).to_numpy() for name in ("userId", "movieId", "score"))
    order = np.lexsort((-ids.astype(np.int64), -scores, users))
    starts = np.flatnonzero(np.r_[True, users[order][1:] != users[order][:-1]]) if len(order) else order
    place = np.arange(len(order)) - np.repeat(starts, np.diff(np.r_[starts, len(order)]))
    by_id = np.argsort(user_ids)
    take = takes[by_id][np.searchsorted(user_ids[by_id], users[order])]
    return table.take(pa.array(order[place < take]))


def _unpack(flat: pa.ListScalar, rows: int) -> np.ndarray:
    return flat.values.to_numpy(zero_copy_only=False).astype(np.float64, copy=False).reshape(rows, -1)


def _floors(best: pa.Table | None, user_ids: np.ndarray, takes: np.ndarray) -> np.ndarray:
    """The score that an item has to reach for every user: the least of those found, once they are enough."""
    least = np.full(len(user_ids), np.inf)
    if best is None:
        return -least
    by_id = np.argsort(user_ids)
    owner = by_id[np.searchsorted(user_ids[by_id], best.column("userId").to_numpy())]
    np.minimum.at(least, owner, best.column("score").to_numpy())
    return np.where(np.bincount(owner, minlength=len(user_ids)) >= takes, least, -np.inf)


def _precision(lengths: np.ndarray, longest: float) -> type:
    """Single precision, if no product of the vectors leaves its range."""
    low, high = _SINGLE
    some = lengths[lengths != 0]
    fits = low < longest < high and (not len(some) or (low < some.min() and some.max() < high))
    return np.float32 if fits else np.float64


def _best(
    user_ids: np.ndarray,
    users: np.ndarray,
    takes: np.ndarray,
    ids: np.ndarray,
    items: np.ndarray,
    floors: np.ndarray | None = None,
) -> Iterator[pa.RecordBatch]:
    """The ``takes[i]`` best items of every user, best first; those below ``floors[i]`` may be left out."""
    if not len(user_ids) or not len(ids):
        return
    longest = float(np.sqrt(np.einsum("ij,ij->i", items, items).max()))
    lengths = np.sqrt(np.einsum("ij,ij->i", users, users))
    kind = _precision(lengths, longest)
    slack = 4 * items.shape[1] * np.finfo(kind).eps * longest
    across = items.astype(kind, copy=False).T
    step = max(1, _CELL_BUDGET // len(ids))
    for start in range(0, len(user_ids), step):
        block = users[start : start + step]
        rough = block.astype(kind, copy=False) @ across
        own = np.minimum(takes[start : start + step], len(ids)).astype(np.int64)
        cuts = np.full(len(block), -np.inf) if floors is None else floors[start : start + step].copy()
        unknown = np.flatnonzero(cuts == -np.inf)
        for take in np.unique(own[unknown]):  # users of equal takes are cut together
            rows = unknown[own[unknown] == take]
            at = len(ids) - int(take)
            for few in np.array_split(rows, -(-len(rows) * len(ids) // _CUT_BUDGET)):
                cuts[few] = np.partition(rough[few], at, axis=1)[:, at]
        least = np.nextafter((cuts - slack * lengths[start : start + step]).astype(kind), kind(-np.inf))
        near = rough >= least[:, None]
        yield from _scored_again(user_ids[start : start + step], block, own, ids, items, near)


def _scored_again(
    user_ids: np.ndarray, users: np.ndarray, takes: np.ndarray, ids: np.ndarray, items: np.ndarray, near: np.ndarray
) -> Iterator[pa.RecordBatch]:
    """The best of the items that are marked ``near`` for a user, some users at a time."""
    before = np.cumsum(np.count_nonzero(near, axis=1))
    first = 0
    while first < len(users):
        done = before[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(before, done + _NEAR_BUDGET, side="right")))
        row, item = np.divmod(np.flatnonzero(near[first:last]), len(ids))
        exact = (items[item] * users[first + row]).sum(axis=1)
        order = np.lexsort((-ids[item].astype(np.int64), -exact, row))
        row, item, exact = row[order], item[order], exact[order]
        starts = np.searchsorted(row, np.arange(last - first))
        kept = np.arange(len(row)) - starts[row] < takes[first + row]
        columns = user_ids[first + row[kept]].astype(np.int32), ids[item[kept]].astype(np.int32), exact[kept]
        yield pa.RecordBatch.from_arrays([pa.array(column) for column in columns], names=["userId", "movieId", "score"])
        first = last

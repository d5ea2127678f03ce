"""Explicit-feedback ALS: fit, predict, recommend, factor tables, stored models."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratingloom import fixed_values as fixed
from ratingloom.operators.alternating import alternate
from ratingloom.operators.preparation import IdMappings
from ratingloom.operators.scoring import as_lists, top_items
from ratingloom.operators.vectors import ItemFactors
from ratingloom.session import ensure_checkpointing

#: Iterations whose shuffle files lie on disk together. A checkpoint works out the items' factors once more.
CHECKPOINT_INTERVAL = 1
#: What a task of ALS holds, at most: factors that came to its block (a row of 4 bytes a number and a header),
#: and ratings of the block.
BLOCK_BYTES, BLOCK_RATINGS = 512 << 20, 8_000_000
#: What the blocks of one fit send each other, at most, where memory allows: all of it goes through shuffle files.
FIT_BYTES = 32 << 30
#: Multiplications of an iteration of MLlib beyond which the iterations run over stored factor tables instead
#: (some 60 s of one core), and blocks a side up to which they do: each of them reads a whole table.
MLLIB_WORK, STORED_BLOCKS = 50_000_000_000, 200


def iteration_work(ratings: int, factors: int, rank: int) -> int:
    """Multiplications of one iteration of MLlib: half a square of the rank for each rating and side, a Cholesky for each factor."""
    return ratings * rank**2 + factors * rank**3 // 3


def factor_bytes(rank: int) -> int:
    """A factor as a row: 4 bytes a number and a header."""
    return 4 * rank + 32


def affordable_blocks(factors: int, rank: int, iterations: int) -> int:
    """Blocks a side for which a fit stays within ``FIT_BYTES``: an iteration sends every factor to all blocks."""
    return max(1, FIT_BYTES // max(1, iterations * factors * factor_bytes(rank)))


def block_count(ratings: int, others: int, rank: int, tasks: int, affordable: int | None = None) -> int:
    """Blocks for one side: one a task, or ``fixed_values.ALS_BLOCKS`` and more if those would be too large.

    A block is sent no more factors of ``others`` than there are, and no more than it has ratings.
    Fewer than one a task, as few as memory allows, if only so many are ``affordable``.
    """
    row = factor_bytes(rank)
    by_factors = 1 if others * row <= BLOCK_BYTES else -(-ratings * row // BLOCK_BYTES)
    least = max(by_factors, -(-ratings // BLOCK_RATINGS))
    if least > tasks:
        return max(least, fixed.ALS_BLOCKS)
    return tasks if affordable is None else max(least, min(tasks, affordable))


def fit(
    train: DataFrame,
    rank: int = fixed.ALS_RANK,
    iterations: int = fixed.ALS_ITERATIONS,
    reg: float = fixed.ALS_REG,
    user_blocks: int | None = None,
    item_blocks: int | None = None,
    seed: int = 0,
) -> ALSModel:
    """A seeded ALS model over ``(userId, movieId, rating)``.

    ALS spreads the ratings over its own blocks, so they are not repartitioned
    first. A factor travels to every block that holds a rating of it, so blocks are as
    few as memory allows (:func:`block_count`), unless given; what an iteration sends grows
    with their number, so many factors get fewer blocks than there are tasks. Factors are checkpointed to
    the shared folder every iteration: that bounds what a lost executor costs, and the
    shuffle files of the iterations before are deleted then.

    A fit that is a lot of work (``MLLIB_WORK``) takes its checks and its random start from
    MLlib and its iterations from :func:`alternate`: the same steps, so the same model but for
    rounding. Nothing is sent between blocks then, and there is a block a task.
    """
    ensure_checkpointing(train.sparkSession)
    size = train.agg(
        F.count("*").alias("ratings"),
        F.approx_count_distinct("userId").alias("users"),
        F.approx_count_distinct("movieId").alias("movies"),
    ).first()
    tasks = train.sparkSession.sparkContext.defaultParallelism
    least = [block_count(size.ratings, others, rank, tasks) for others in (size.movies, size.users)]
    stored = (
        reg > 0
        and iteration_work(size.ratings, size.users + size.movies, rank) > MLLIB_WORK
        and max(user_blocks or least[0], item_blocks or least[1]) <= STORED_BLOCKS
    )
    affordable = None if stored else affordable_blocks(size.users + size.movies, rank, iterations)
    user_blocks = user_blocks or block_count(size.ratings, size.movies, rank, tasks, affordable)
    item_blocks = item_blocks or block_count(size.ratings, size.users, rank, tasks, affordable)
    als = ALS(
        userCol="userId",
        itemCol="movieId",
        ratingCol="rating",
        coldStartStrategy=fixed.ALS_COLD_START,
        nonnegative=False,
        rank=rank,
        maxIter=0 if stored else iterations,
        regParam=reg,
        numUserBlocks=user_blocks,
        numItemBlocks=item_blocks,
        checkpointInterval=CHECKPOINT_INTERVAL,
        intermediateStorageLevel=fixed.ALS_INTERMEDIATE_STORAGE,
        finalStorageLevel=fixed.ALS_FINAL_STORAGE,
        seed=seed,
    )
    train = train.select("userId", "movieId", "rating")
    model = als.fit(train)
    if not stored:
        return model
    users, items = alternate(
        train, model.userFactors, model.itemFactors, rank, iterations, reg, user_blocks, item_blocks
    )
    made = train.sparkSession._jvm.org.apache.spark.ml.recommendation.ALSModel
    return als._copyValues(ALSModel(made(model.uid, rank, users._jdf, items._jdf)))


def predict(model: ALSModel, pairs: DataFrame) -> DataFrame:
    """``pairs`` with a ``prediction``; pairs of unknown users or movies drop out."""
    return model.transform(pairs).filter("prediction IS NOT NULL")


def evaluate_rmse(predictions: DataFrame) -> float:
    """RMSE as MLlib's evaluator computes it."""
    evaluator = RegressionEvaluator(metricName="rmse", labelCol="rating", predictionCol="prediction")
    return evaluator.evaluate(predictions)


def recommend_all(model: ALSModel, n: int = fixed.LIST_LENGTH) -> DataFrame:
    """``(userId, recommendations)`` for every user of the model, seen items included.

    The lists of ``model.recommendForAllUsers``, scored by :func:`top_items` in
    double precision and without MLlib's cross join of factor blocks.
    """
    users, items = factor_tables(model)
    return as_lists(top_items(users, ItemFactors.of(items), n))


def recommend_for(model: ALSModel, users: DataFrame, n: int = fixed.LIST_LENGTH) -> DataFrame:
    """The same for the distinct ``userId`` of ``users``; strangers to the model get no row."""
    known, items = factor_tables(model)
    asked = known.join(users.select("userId").distinct(), "userId", "left_semi")
    return as_lists(top_items(asked, ItemFactors.of(items), n))


def movie_ids(recommendations: DataFrame) -> DataFrame:
    """``(userId, movies)``: the lists without their scores."""
    return recommendations.select("userId", F.col("recommendations.movieId").alias("movies"))


def restore_lists(recommendations: DataFrame, mappings: IdMappings) -> DataFrame:
    """Lists over dense ids as lists over original ids, order kept."""
    entries = recommendations.select(
        "userId", F.posexplode("recommendations").alias("place", "entry")
    ).select("userId", "place", F.col("entry.movieId").alias("movieId"), F.col("entry.rating").alias("rating"))
    ordered = F.array_sort(F.collect_list(F.struct("place", "movieId", "rating")))
    without_place = F.transform(
        "ordered", lambda e: F.struct(e["movieId"].alias("movieId"), e["rating"].alias("rating"))
    )
    return (
        mappings.restore(entries)
        .groupBy("userId")
        .agg(ordered.alias("ordered"))
        .select("userId", without_place.alias("recommendations"))
    )


def factor_tables(model: ALSModel, mappings: IdMappings | None = None) -> tuple[DataFrame, DataFrame]:
    """(users, items): ``(userId | movieId, features)``, under original ids if mappings are given.

    Relabelling the factors once is cheaper than translating every list made
    from them: they have one row per user or movie.
    """
    users = model.userFactors.select(F.col("id").alias("userId"), "features")
    items = model.itemFactors.select(F.col("id").alias("movieId"), "features")
    if mappings is not None:
        users, items = mappings.restore(users), mappings.restore(items)
    return users, items


def save(model: ALSModel, *paths: str) -> None:
    """Replace the stored model at every path (the first, and its mirrors)."""
    for path in paths:
        model.write().overwrite().save(path)


def load_order(local: str, hdfs: str, strategy: str = "local-first") -> list[str]:
    """Paths in the order a strategy tries them; unknown names mean ``local-first``."""
    places = {"local": local, "hdfs": hdfs}
    orders = fixed.MODEL_LOAD_ORDERS
    return [places[name] for name in orders.get(strategy.lower(), orders["local-first"])]


def load_first(spark: SparkSession, paths: Sequence[str]) -> ALSModel:
    """The model at the first readable path; if there is none, an error with the last cause."""
    cause: Exception | None = None
    for path in paths:
        try:
            return ALSModel.load(path)
        except Exception as error:  # a missing, foreign or damaged model all mean: try the next
            cause = error
    raise RuntimeError(f"no model could be read from {list(paths)}") from cause

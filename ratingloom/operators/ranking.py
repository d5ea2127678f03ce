"""Ranks and top-k per user, and the metrics built on them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ratingloom import fixed_values as fixed
from ratingloom.functions import guarded_ratio, ideal_dcg, is_good
from ratingloom.operators.joins import hot_keys, salted_join
from ratingloom.operators.preparation import counts


def top_k_per_user(predictions: DataFrame, k: int = fixed.METRIC_K, ties: bool = True) -> DataFrame:
    """The ``k`` best predictions of every user with their ``rank``.

    With ``ties`` equal predictions share a rank and more than ``k`` rows may pass:
    ranks are taken over *groups* of equal predictions, and rows find theirs by a join
    that splits hot groups, so copies of one row never meet in one task. Without ties
    the smaller movieId goes first and exactly ``k`` stay; Spark limits every user
    inside each map task before the shuffle (WindowGroupLimit).
    """
    if not ties:
        window = Window.partitionBy("userId").orderBy(F.col("prediction").desc(), F.col("movieId").asc())
        return predictions.withColumn("rank", F.row_number().over(window)).filter(F.col("rank") <= k)
    rows = predictions.withColumn("pair", F.struct("userId", "prediction"))
    groups = rows.groupBy("pair").agg(F.count("*").alias("count"))
    best_first = Window.partitionBy("pair.userId").orderBy(F.col("pair.prediction").desc())
    before = F.sum("count").over(best_first.rowsBetween(Window.unboundedPreceding, -1))
    ranked = (
        groups.withColumn("place", F.row_number().over(best_first))
        .filter(F.col("place") <= k)
        .withColumn("rank", (F.coalesce(before, F.lit(0)) + 1).cast("int"))
        .filter(F.col("rank") <= k)
    )
    hot = hot_keys(groups, "pair")
    return salted_join(rows, ranked.select("pair", "rank"), "pair", hot, ["movieId"]).drop("pair")


def ranked_labels(
    predictions: DataFrame, k: int = fixed.METRIC_K, threshold: float = fixed.GOOD_RATING
) -> DataFrame:
    """Top-k test predictions ``(userId, movieId, is_good_item, prediction, rank)``."""
    labelled = predictions.filter("prediction IS NOT NULL").select(
        "userId", "movieId", is_good(F.col("rating"), threshold).alias("is_good_item"), "prediction"
    )
    return top_k_per_user(labelled, k)


def ranked_groups(
    predictions: DataFrame, k: int = fixed.METRIC_K, threshold: float = fixed.GOOD_RATING
) -> DataFrame:
    """The rows of :func:`ranked_labels`, equal predictions of a user folded into one row.

    Columns ``(userId, prediction, items, good, rank)``. Equal predictions share
    their rank, so counts of all and of good items say as much as the rows do, and
    a user with any number of copies has one row per copy group. At most ``k``
    groups per user reach the rank computation.
    """
    groups = (
        predictions.filter("prediction IS NOT NULL")
        .groupBy("userId", "prediction")
        .agg(F.count("*").alias("items"), F.sum(is_good(F.col("rating"), threshold)).alias("good"))
    )
    best_first = Window.partitionBy("userId").orderBy(F.col("prediction").desc())
    before = best_first.rowsBetween(Window.unboundedPreceding, -1)
    return (
        groups.withColumn("place", F.row_number().over(best_first))
        .filter(F.col("place") <= k)
        .withColumn("rank", F.coalesce(F.sum("items").over(before), F.lit(0)) + 1)
        .filter(F.col("rank") <= k)
        .drop("place")
    )


def user_hits(ranked: DataFrame) -> DataFrame:
    """Per user of :func:`ranked_groups`: whether a good item is in the list, and its DCG."""
    gain = F.col("good") / F.log2(F.col("rank") + 1)
    hit = F.max(F.when(F.col("good") > 0, 1).otherwise(0))
    return ranked.groupBy("userId").agg(hit.alias("has_hit"), F.sum(gain).alias("dcg"))


def good_items(test: DataFrame, threshold: float = fixed.GOOD_RATING) -> DataFrame:
    """Number of good test items of every user who has one."""
    good = test.filter(F.col("rating") >= threshold)
    return good.groupBy("userId").agg(F.count("*").alias("num_good_items"))


def user_ndcg(
    ranked: DataFrame, test: DataFrame, k: int = fixed.METRIC_K, threshold: float = fixed.GOOD_RATING
) -> DataFrame:
    """NDCG of every user with a good test item and a ranked list."""
    ideal = ideal_dcg(F.col("num_good_items"), k)
    return (
        user_hits(ranked)
        .join(good_items(test, threshold), "userId")
        .select("userId", "dcg", ideal.alias("ideal_dcg"))
        .withColumn("ndcg", guarded_ratio(F.col("dcg"), F.col("ideal_dcg")))
    )


def hit_rate(ranked: DataFrame, test: DataFrame) -> DataFrame:
    """One row: hit rate over ranked users, and over all test users for comparison."""
    totals = user_hits(ranked).agg(
        F.avg("has_hit").alias("hit_rate"),
        F.count("*").alias("ranked_users"),
        F.sum("has_hit").alias("hits"),
    )
    everyone = test.select("userId").distinct().agg(F.count("*")).scalar()
    return totals.select(
        "hit_rate",
        "ranked_users",
        everyone.alias("test_users"),
        F.try_divide("hits", everyone).alias("hit_rate_all_users"),
    )


def ndcg(
    ranked: DataFrame, test: DataFrame, k: int = fixed.METRIC_K, threshold: float = fixed.GOOD_RATING
) -> DataFrame:
    """One row: mean NDCG and the number of users it covers."""
    return user_ndcg(ranked, test, k, threshold).agg(F.avg("ndcg").alias("ndcg"), F.count("*").alias("users"))


def rmse(predictions: DataFrame) -> DataFrame:
    """One row: root mean squared error of the rows that have a prediction."""
    error = F.col("prediction").cast("double") - F.col("rating").cast("double")
    scored = predictions.filter("prediction IS NOT NULL")
    return scored.agg(F.sqrt(F.avg(error * error)).alias("rmse"), F.count("*").alias("scored"))


def item_mean_predictions(train: DataFrame, test: DataFrame) -> DataFrame:
    """Test ratings with the train mean of their movie; unknown movies drop out."""
    means = train.groupBy("movieId").agg(F.avg("rating").alias("prediction"))
    hot = hot_keys(counts(test, "movieId"), "movieId")
    return salted_join(test, means, "movieId", hot, ["userId"])

"""From raw ratings to an evaluated model."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.recommendation import ALSModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratingloom import fixed_values as fixed
from ratingloom.functions import ideal_dcg
from ratingloom.operators import als
from ratingloom.operators.preparation import IdMappings, active_only, split_at, split_point
from ratingloom.operators.ranking import good_items, ranked_groups, rmse, user_hits
from ratingloom.session import scratch_path
from ratingloom.sources.files import staged


@dataclass(frozen=True)
class Prepared:
    """Ratings under dense ids, split by time, and the way back to original ids."""

    mappings: IdMappings
    train: DataFrame
    test: DataFrame


def prepare(
    ratings: DataFrame,
    workspace: str | None = None,
    min_user: int = fixed.MIN_USER_RATINGS,
    min_movie: int = fixed.MIN_MOVIE_RATINGS,
    split: float = fixed.SPLIT_QUANTILE,
    exact_split: bool = False,
) -> Prepared:
    """Activity filter, dense ids, re-keying and the time-ordered split.

    Each step is written to ``workspace`` because several later jobs read it: the
    active ratings give both mappings and are re-keyed; the re-keyed ratings give
    both parts. The split point is one number, taken once, so the filter on time
    reaches the parquet scan as a constant and skips row groups.
    """
    workspace = workspace or scratch_path(ratings.sparkSession, "train")
    active = staged(active_only(ratings, min_user, min_movie), f"{workspace}/active")
    found = IdMappings.of(active)
    mappings = IdMappings(
        staged(found.users, f"{workspace}/users"), staged(found.movies, f"{workspace}/movies")
    )
    rekeyed = staged(mappings.rekey(active), f"{workspace}/ratings")
    point = split_point(rekeyed, split, exact_split).first().quantile
    train, test = split_at(rekeyed, F.lit(point))
    return Prepared(mappings, train, test)


def evaluate(predictions: DataFrame, test: DataFrame, k: int = fixed.METRIC_K) -> DataFrame:
    """One row: RMSE, hit rate and NDCG of test predictions.

    Hit rate and NDCG come from one pass over the users; a user without a good
    item has no NDCG and counts in the hit rate only. The predictions are read
    twice; pass a stored or persisted table.
    """
    per_user = user_hits(ranked_groups(predictions, k)).join(good_items(test), "userId", "left")
    error = rmse(predictions)
    return per_user.agg(
        F.avg("has_hit").alias("hit_rate"),
        F.avg(F.col("dcg") / ideal_dcg(F.col("num_good_items"), k)).alias("ndcg"),
    ).select(
        error.select("rmse").scalar().alias("rmse"),
        error.select("scored").scalar().alias("scored"),
        "hit_rate",
        "ndcg",
    )


def train_and_evaluate(
    ratings: DataFrame, workspace: str | None = None, **als_options
) -> tuple[ALSModel, Prepared, DataFrame]:
    """(model over dense ids, prepared data, one row of metrics)."""
    workspace = workspace or scratch_path(ratings.sparkSession, "train")
    prepared = prepare(ratings, workspace)
    model = als.fit(prepared.train, **als_options)
    predictions = stored_predictions(model, prepared, workspace)
    return model, prepared, evaluate(predictions, prepared.test)


def stored_predictions(model: ALSModel, prepared: Prepared, workspace: str | None = None) -> DataFrame:
    """``(userId, movieId, rating, prediction)`` of the test ratings, dense ids, stored."""
    scored = als.predict(model, prepared.test.select("userId", "movieId", "rating"))
    return staged(scored, workspace and f"{workspace}/predictions")


def predictions_in_original_ids(model: ALSModel, prepared: Prepared) -> DataFrame:
    """``(userId, movieId, rating, prediction)`` of the test ratings."""
    scored = als.predict(model, prepared.test.select("userId", "movieId", "rating"))
    return prepared.mappings.restore(scored).withColumn("prediction", F.col("prediction").cast("double"))

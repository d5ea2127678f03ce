"""Cleaning, activity filter, dense ids and the time-ordered split."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratingloom import fixed_values as fixed
from ratingloom.operators.joins import hot_keys, id_words, keep_members, salted_join
from ratingloom.operators.positions import dense_ids
from ratingloom.operators.quantiles import approx_quantile, exact_quantile
from ratingloom.sources.files import staged
from ratingloom.sources.landing import RatingSummaries


def clean(raw: DataFrame) -> DataFrame:
    """Typed rating rows; a row with any value missing or unreadable is dropped."""
    return raw.select(
        F.col("userId").try_cast("int").alias("userId"),
        F.col("movieId").try_cast("int").alias("movieId"),
        F.col("rating").try_cast("float").alias("rating"),
        F.col("timestamp").try_cast("bigint").alias("timestamp"),
    ).dropna("any")


def counts(ratings: DataFrame | RatingSummaries, *keys: str) -> DataFrame:
    """Rows per key, combined before the shuffle: a hot key is one row per task. Summaries have them stored."""
    if isinstance(ratings, RatingSummaries):
        return ratings.counts(*keys)
    return ratings.groupBy(*keys).agg(F.count("*").alias("count"))


def active_only(
    ratings: DataFrame,
    min_user: int = fixed.MIN_USER_RATINGS,
    min_movie: int = fixed.MIN_MOVIE_RATINGS,
) -> DataFrame:
    """Ratings of users and movies with enough ratings, both counted on the input.

    The ratings are stored once, as three passes read them: two for the counts, one for
    what stays. Who stays is broadcast as a set of ids, so that no rating is shuffled. Ids
    too many for that are joined; then the counts also name the hot users and movies, whose
    ratings are spread over several tasks.
    """
    ratings = kept = staged(ratings.dropna(subset=["userId", "movieId"]))
    for key, other, enough in (("userId", "movieId", min_user), ("movieId", "userId", min_movie)):
        sizes = counts(ratings, key)
        active = sizes.filter(F.col("count") >= enough).select(key)
        words = id_words(active, key)
        if words is not None:
            kept = keep_members(kept, words, key)
        else:
            kept = salted_join(kept, active, key, hot_keys(sizes, key), [other], "left_semi")
    return kept


@dataclass(frozen=True)
class IdMappings:
    """Original to dense ids: ``(userId, new_userId)`` and ``(movieId, new_movieId)``."""

    users: DataFrame
    movies: DataFrame

    @classmethod
    def of(cls, ratings: DataFrame) -> IdMappings:
        return cls(
            dense_ids(ratings, "userId", "new_userId"),
            dense_ids(ratings, "movieId", "new_movieId"),
        )

    def rekey(self, ratings: DataFrame) -> DataFrame:
        """Ratings under dense ids. Rows without a mapping drop out.

        Both sides of each join come straight out of a shuffle and the next step
        shuffles again or writes, so AQE splits the partition of a hot id.
        """
        rest = [name for name in ratings.columns if name not in ("userId", "movieId")]
        return (
            ratings.join(self.users, "userId")
            .join(self.movies, "movieId")
            .select(F.col("new_userId").alias("userId"), F.col("new_movieId").alias("movieId"), *rest)
        )

    def restore(self, rekeyed: DataFrame) -> DataFrame:
        """Dense ids back to the original ones, for whichever of the two are present."""
        out = rekeyed
        for key, mapping in (("userId", self.users), ("movieId", self.movies)):
            if key in rekeyed.columns:
                back = mapping.select(F.col(key).alias(f"original_{key}"), F.col(f"new_{key}").alias(key))
                out = out.join(back, key).drop(key).withColumnRenamed(f"original_{key}", key)
        return out.select(*rekeyed.columns)


def split_point(
    ratings: DataFrame | RatingSummaries, q: float = fixed.SPLIT_QUANTILE, exact: bool = False
) -> DataFrame:
    """One row ``quantile``: the timestamp up to which ratings train the model; summaries give an approximate one."""
    if isinstance(ratings, RatingSummaries):
        return ratings.quantile(q)
    pick = exact_quantile if exact else approx_quantile
    return pick(ratings, "timestamp", q)


def time_split(
    ratings: DataFrame, q: float = fixed.SPLIT_QUANTILE, exact: bool = False
) -> tuple[DataFrame, DataFrame]:
    """(train, test): ratings up to the split point, and later ones.

    The split point stays in the plan as a scalar subquery. Where both parts are
    read again and again, take it once and use :func:`split_at`.
    """
    return split_at(ratings, split_point(ratings, q, exact).scalar())


def split_at(ratings: DataFrame, point: Column) -> tuple[DataFrame, DataFrame]:
    moment = F.col("timestamp")
    return ratings.filter(moment <= point), ratings.filter(moment > point)

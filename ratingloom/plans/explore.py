"""Exploration of a ratings data set: distributions, popularity, sparsity, long tail.

Every function returns a small DataFrame and leaves it to the caller what to do
with it. Facts are aggregated before they meet a dimension, so joins here see one
row per movie or user, never one per rating. In place of the ratings every function
takes their :class:`ratingloom.sources.landing.RatingSummaries` as well.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ratingloom import fixed_values as fixed
from ratingloom.functions import rating_year, release_year
from ratingloom.operators.histogram import equal_width_histogram
from ratingloom.operators.positions import popularity_positions
from ratingloom.operators.preparation import counts
from ratingloom.sources.landing import RatingSummaries


def rating_distribution(ratings: DataFrame) -> DataFrame:
    return counts(ratings, "rating").orderBy("rating")


def ratings_per_year(ratings: DataFrame) -> DataFrame:
    if isinstance(ratings, RatingSummaries):
        return ratings.counts("year").orderBy("year")
    years = ratings.select(rating_year(F.col("timestamp")).alias("year"))
    return counts(years, "year").orderBy("year")


def with_release_year(movies: DataFrame) -> DataFrame:
    return movies.withColumn("ReleaseYear", release_year(F.col("title")))


def movies_per_release_year(movies: DataFrame) -> DataFrame:
    dated = with_release_year(movies).filter("ReleaseYear IS NOT NULL")
    return counts(dated, "ReleaseYear").orderBy("ReleaseYear")


def dataset_totals(ratings: DataFrame, movies: DataFrame) -> DataFrame:
    """One row: ratings, movies in the catalogue, users who rated. One pass over the ratings."""
    per_user = counts(ratings, "userId").agg(F.sum("count").alias("ratings"), F.count("*").alias("users"))
    return per_user.select("ratings", movies.agg(F.count("*")).scalar().alias("movies"), "users")


def matrix_sparsity(ratings: DataFrame) -> DataFrame:
    """One row: share of the user-movie matrix without a rating, in percent.

    Users and movies are counted in separate aggregates; ``count_distinct`` of both
    in one would expand every rating into two rows.
    """
    per_user = counts(ratings, "userId").agg(F.sum("count").alias("ratings"), F.count("*").alias("users"))
    movies = counts(ratings, "movieId").agg(F.count("*")).scalar()
    sizes = per_user.select("ratings", "users", movies.alias("movies"))
    filled = F.try_divide(F.col("ratings").cast("double"), F.col("users") * F.col("movies"))
    return sizes.withColumn("sparsity_percent", (1.0 - filled) * 100)


def count_histogram(ratings: DataFrame, key: str, bins: int = fixed.HISTOGRAM_BINS) -> DataFrame:
    """Equal-width histogram of ratings per user or per movie."""
    return equal_width_histogram(counts(ratings, key), "count", bins)


def top_movies(ratings: DataFrame, movies: DataFrame, n: int = fixed.SHOWN_LENGTH) -> DataFrame:
    return (
        counts(ratings, "movieId")
        .join(movies.select("movieId", "title"), "movieId")
        .select("movieId", "title", "count")
        .orderBy(F.col("count").desc(), "movieId")
        .limit(n)
    )


def top_users(ratings: DataFrame, n: int = fixed.SHOWN_LENGTH) -> DataFrame:
    return (
        counts(ratings, "userId")
        .orderBy(F.col("count").desc(), "userId")
        .limit(n)
        .select(F.col("userId").cast("string").alias("userId"), "count")
    )


def _rated_by_year(ratings: DataFrame, movies: DataFrame) -> DataFrame:
    dated = with_release_year(movies).filter("ReleaseYear IS NOT NULL").select("movieId", "ReleaseYear")
    return counts(ratings, "movieId").join(dated, "movieId").withColumnRenamed("count", "rating_count")


def ratings_by_release_year(ratings: DataFrame, movies: DataFrame) -> DataFrame:
    totals = _rated_by_year(ratings, movies).groupBy("ReleaseYear")
    return totals.agg(F.sum("rating_count").alias("total_ratings")).orderBy("ReleaseYear")


def avg_ratings_by_release_year(ratings: DataFrame, movies: DataFrame) -> DataFrame:
    means = _rated_by_year(ratings, movies).groupBy("ReleaseYear")
    return means.agg(F.avg("rating_count").alias("avg_ratings_per_movie")).orderBy("ReleaseYear")


def release_year_summary(ratings: DataFrame, movies: DataFrame) -> DataFrame:
    """One row: mean over the years of their averages, and the first peak year."""
    yearly = avg_ratings_by_release_year(ratings, movies)
    peak = F.max(F.struct("avg_ratings_per_movie", (-F.col("ReleaseYear")).alias("reversed_year")))
    return yearly.agg(
        F.avg("avg_ratings_per_movie").alias("mean_of_years"), peak.alias("peak")
    ).select(
        "mean_of_years",
        (-F.col("peak.reversed_year")).alias("peak_year"),
        F.col("peak.avg_ratings_per_movie").alias("peak_value"),
    )


def long_tail(ratings: DataFrame) -> DataFrame:
    """Movies with their rating count and popularity position (1 = most rated)."""
    return popularity_positions(counts(ratings, "movieId"))


def head_share(ratings: DataFrame, fraction: float = fixed.HEAD_FRACTION) -> DataFrame:
    """One row: percent of the ratings that fall on the most rated ``fraction`` of movies.

    Movies of one count are interchangeable, so the histogram of counts is enough;
    no movie is ranked.
    """
    histogram = counts(ratings, "movieId").groupBy("count").agg(F.count("*").alias("movies"))
    downwards = Window.orderBy(F.col("count").desc())
    before = downwards.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    head = F.floor(F.sum("movies").over(everything) * F.lit(fraction))
    placed = histogram.select(
        "count",
        "movies",
        head.alias("head_size"),
        F.coalesce(F.sum("movies").over(before), F.lit(0)).alias("above"),
    )
    inside = F.greatest(F.lit(0), F.least(F.col("movies"), F.col("head_size") - F.col("above")))
    return placed.agg(
        F.max("head_size").alias("head_size"),
        F.sum(F.col("count") * inside).alias("head_ratings"),
        F.sum(F.col("count") * F.col("movies")).alias("total_ratings"),
    ).withColumn("head_percent", F.try_divide("head_ratings", "total_ratings") * 100)

"""Lists with titles, and movie details."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratingloom import fixed_values as fixed
from ratingloom.functions import last_n
from ratingloom.operators.joins import hot_keys, salted_join
from ratingloom.operators.preparation import counts


def movie_map(movies: DataFrame, links: DataFrame, order: Column | None = None) -> DataFrame:
    """``(movieId, title, genres, tmdbId)``, one row per movie that has a link.

    Of several rows for one id the last in ``order`` stays. Without an order the
    inputs have none, and the largest row does.
    """
    columns = ["title", "genres", "tmdbId"]
    merged = movies.join(links.select("movieId", "tmdbId"), "movieId")
    entry = F.struct(*columns)
    newest = F.max(entry) if order is None else F.max_by(entry, order)
    return merged.groupBy("movieId").agg(newest.alias("entry")).select("movieId", "entry.*")


def movie_details(requests: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Stored attributes of every requested movieId, with ``found`` for the missing ones."""
    known = catalogue.withColumn("found", F.lit(True))
    return requests.join(known, "movieId", "left").withColumn("found", F.coalesce("found", F.lit(False)))


def with_titles(lists: DataFrame, catalogue: DataFrame) -> DataFrame:
    """``(user_id, recs)``: every list as ``(movieId, title)`` entries in list order.

    Unreadable ids, unknown movies and movies without a proper title are left
    out; a user whose list loses everything keeps an empty one.
    """
    entries = lists.select("user_id", F.posexplode("top_10").alias("place", "id")).select(
        "user_id", "place", F.col("id").try_cast("int").alias("movieId")
    )
    proper = (F.col("title") != "") & ~F.col("title").startswith(fixed.UNKNOWN_TITLE_PREFIX)
    titled = catalogue.filter(proper).select("movieId", "title")
    ordered = F.array_sort(F.collect_list(F.struct("place", "movieId", "title")))
    shown = F.transform(
        "ordered", lambda e: F.struct(e["movieId"].alias("movieId"), e["title"].alias("title"))
    )
    hot = hot_keys(counts(entries, "movieId"), "movieId")  # some movies are in most lists
    joined = salted_join(entries, titled, "movieId", hot, ["user_id"])
    found = joined.groupBy("user_id").agg(ordered.alias("ordered"))
    nothing = F.array().cast("array<struct<movieId:int,title:string>>")
    return lists.select("user_id").join(found, "user_id", "left").select(
        "user_id", F.coalesce(shown, nothing).alias("recs")
    )


def shown_page(titled: DataFrame, n: int = fixed.SHOWN_LENGTH, from_end: bool = False) -> DataFrame:
    """The entries of a list that a page shows: its first ``n``, or its last ``n``."""
    part = last_n(F.col("recs"), n) if from_end else F.slice("recs", 1, n)
    return titled.select("user_id", part.alias("recs"))

"""Column expressions. All of them run inside the JVM; none is a Python UDF."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from ratingloom import fixed_values as fixed


def release_year(title: Column) -> Column:
    """First parenthesised four-digit number of a title as INT, else null."""
    return F.regexp_extract(title, fixed.RELEASE_YEAR_PATTERN, 1).try_cast("int")


def rating_year(seconds: Column) -> Column:
    """UTC calendar year of an epoch-second column, whatever the session zone."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.year(F.timestamp_add("SECOND", seconds, epoch))


def epoch_seconds(timestamp: Column) -> Column:
    """Epoch seconds of a zone-less timestamp, whatever the session zone."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_diff("SECOND", epoch, timestamp)


def is_good(rating: Column, threshold: float = fixed.GOOD_RATING) -> Column:
    """Binary relevance label of a rating."""
    return F.when(rating >= threshold, 1).otherwise(0)


def guarded_ratio(numerator: Column, denominator: Column) -> Column:
    """``numerator / denominator`` where the denominator is positive, else 0."""
    return F.when(denominator > 0, numerator / denominator).otherwise(F.lit(0.0))


def ideal_dcg(good_items: Column, k: int = fixed.METRIC_K) -> Column:
    """Best reachable DCG with ``good_items`` relevant items in a list of ``k``; null for null.

    The k + 1 possible values are folded into one literal array, so the lookup
    stays inside generated code (a lambda over ``sequence`` would not).
    """
    ladder = [0.0]
    for position in range(1, k + 1):
        ladder.append(ladder[-1] + 1.0 / math.log2(position + 1))
    slot = F.greatest(F.lit(0), F.least(good_items, F.lit(k))).cast("int")
    value = F.get(F.array(*[F.lit(value) for value in ladder]), slot)
    return F.when(good_items.isNotNull(), value)


def dot(left: Column, right: Column) -> Column:
    """Inner product of two arrays in double precision.

    For a handful of vectors next to other columns. Scoring many users against
    many items belongs to :func:`ratingloom.operators.scoring.top_items`.
    """
    products = F.zip_with(left, right, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, value: total + value)


def last_n(items: Column, n: int = fixed.SHOWN_LENGTH) -> Column:
    """The last ``n`` elements, or all of them when the array is shorter."""
    start = F.greatest(F.size(items) - F.lit(n) + F.lit(1), F.lit(1))
    return F.slice(items, start, F.lit(n))


def strings(items: Column) -> Column:
    """Every array element as STRING."""
    return items.cast("array<string>")


def to_message(*fields: Column) -> Column:
    """The text form of a rating event: ``user,movie,rating``."""
    return F.concat_ws(fixed.MESSAGE_SEPARATOR, *[field.cast("string") for field in fields])


def message_fields(value: Column) -> list[Column]:
    """userId, movieId and rating of a message; null where a part is missing or no number."""
    parts = F.split(value, fixed.MESSAGE_SEPARATOR)
    rating = F.get(parts, F.lit(2)).try_cast("float")
    finite = F.abs(rating) < F.lit(float("inf"))
    return [
        F.get(parts, F.lit(0)).try_cast("int").alias("userId"),
        F.get(parts, F.lit(1)).try_cast("int").alias("movieId"),
        F.when(finite, rating).alias("rating"),
    ]

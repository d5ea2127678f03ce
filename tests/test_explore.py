import random

import pytest

from ratingloom.operators.histogram import equal_width_histogram
from ratingloom.plans import explore
from tests.conftest import rows

RATINGS = "userId INT, movieId INT, rating DOUBLE, timestamp BIGINT"
MOVIES = "movieId INT, title STRING, genres STRING"


def filled(df):
    return [row for row in rows(df, "bin", "rows") if row[1]]


def test_histogram_closes_the_last_bin(spark):
    df = spark.createDataFrame([(0,), (50,), (100,)], "x BIGINT")
    histogram = equal_width_histogram(df, "x", 10)
    assert filled(histogram) == [(0, 1), (5, 1), (9, 1)]
    assert histogram.count() == 10
    assert rows(histogram, "lower", "upper")[9] == (90.0, 100.0)


def test_histogram_of_equal_values_and_of_nothing(spark):
    df = spark.createDataFrame([(7,)] * 3, "x BIGINT")
    assert filled(equal_width_histogram(df, "x", 100)) == [(50, 3)]
    assert rows(equal_width_histogram(df, "x", 100), "lower")[0] == (6.5,)
    assert filled(equal_width_histogram(df.filter("x > 9"), "x", 100)) == []


def test_histogram_counts_every_value(spark):
    rng = random.Random(8)
    values = [rng.randint(3, 900) for _ in range(2000)]
    df = spark.createDataFrame([(v,) for v in values], "x BIGINT")
    low, high = min(values), max(values)
    expected = {}
    for v in values:
        slot = min((v - low) * 100 // (high - low), 99)
        expected[slot] = expected.get(slot, 0) + 1
    assert dict(filled(equal_width_histogram(df, "x", 100))) == expected


@pytest.fixture(scope="module")
def small(spark):
    ratings = [(1, 10, 4.0, 0), (1, 11, 3.0, 0), (2, 10, 5.0, 31_536_000), (3, 10, 1.0, 0), (3, 12, 2.0, 0)]
    movies = [(10, "A (1999)", "x"), (11, "B (1999)", "x"), (12, "C (2001)", "x"), (13, "D", "x")]
    return spark.createDataFrame(ratings, RATINGS), spark.createDataFrame(movies, MOVIES)


def test_totals_sparsity_and_years(small):
    ratings, movies = small
    assert rows(explore.dataset_totals(ratings, movies)) == [(5, 4, 3)]
    assert explore.matrix_sparsity(ratings).first().sparsity_percent == pytest.approx((1 - 5 / 9) * 100)
    assert rows(explore.ratings_per_year(ratings)) == [(1970, 4), (1971, 1)]
    assert rows(explore.movies_per_release_year(movies)) == [(1999, 2), (2001, 1)]
    assert rows(explore.ratings_by_release_year(ratings, movies)) == [(1999, 4), (2001, 1)]


def test_sparsity_of_nothing_is_null(small):
    ratings, _ = small
    assert explore.matrix_sparsity(ratings.filter("userId > 9")).first().sparsity_percent is None


def test_peak_year_is_the_first_of_equal_ones(spark, small):
    ratings, movies = small
    summary = explore.release_year_summary(ratings, movies).first()
    assert (summary.mean_of_years, summary.peak_year, summary.peak_value) == (1.5, 1999, 2.0)
    even = spark.createDataFrame([(1, 10, 1.0, 0), (1, 12, 1.0, 0)], RATINGS)
    assert explore.release_year_summary(even, movies).first().peak_year == 1999


def test_top_lists_break_ties_by_id(small):
    ratings, movies = small
    assert [r.movieId for r in explore.top_movies(ratings, movies).collect()] == [10, 11, 12]
    assert [r.userId for r in explore.top_users(ratings, 2).collect()] == ["1", "3"]


def test_head_share_matches_the_ranked_movies(spark):
    rng = random.Random(6)
    data = [(u, int(rng.paretovariate(0.9)) % 60, 1.0, 0) for u in range(3000)]
    ratings = spark.createDataFrame(data, RATINGS)
    for fraction in (0.0, 0.2, 0.55, 1.0):
        ranked = rows(explore.long_tail(ratings), "position", "count")
        head = int(len(ranked) * fraction)
        share = explore.head_share(ratings, fraction).first()
        assert share.head_size == head
        assert share.head_percent == pytest.approx(sum(c for p, c in ranked if p <= head) / 3000 * 100)

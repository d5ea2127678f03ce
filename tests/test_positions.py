import random

import pytest
from pyspark.sql import functions as F

from ratingloom.operators.positions import dense_ids, popularity_positions
from ratingloom.operators.preparation import IdMappings
from ratingloom.operators.quantiles import approx_quantile, exact_quantile
from tests.conftest import rows


def test_dense_ids_follow_key_order_over_the_whole_int_range(spark):
    rng = random.Random(3)
    keys = {rng.randint(-(2**31), 2**31 - 1) for _ in range(500)} | set(range(65530, 65545)) | {-1, 0, 2**31 - 1, -(2**31)}
    data = [(k,) for k in keys for _ in range(rng.randint(1, 3))]
    got = rows(dense_ids(spark.createDataFrame(data, "userId INT"), "userId", "new"))
    assert got == [(key, i) for i, key in enumerate(sorted(keys))]


def test_dense_ids_never_put_the_keys_into_one_partition(spark):
    df = spark.range(200_000).select(F.col("id").cast("int").alias("userId"))
    plan = dense_ids(df, "userId", "new")._jdf.queryExecution().executedPlan().toString()
    after_numbering = plan.split("row_number")[1]
    # The only single-partition exchange is the bucket histogram below its window.
    assert after_numbering.count("SinglePartition") <= 1
    assert "hashpartitioning(bucket" in plan
    assert dense_ids(df, "userId", "new").filter("userId <> new").isEmpty()


def test_dense_ids_refuse_keys_without_a_bucket_bound(spark):
    with pytest.raises(TypeError):
        dense_ids(spark.range(3).withColumnRenamed("id", "userId"), "userId", "new")


def test_popularity_positions_match_a_sort(spark):
    rng = random.Random(5)
    # One count is shared by a third of the movies, in several buckets.
    counted = [(i * 997, 1 if i % 3 == 0 else rng.randint(1, 40)) for i in range(900)]
    got = rows(popularity_positions(spark.createDataFrame(counted, "movieId INT, count BIGINT")), "movieId", "position")
    ordered = sorted(counted, key=lambda row: (-row[1], row[0]))
    assert got == sorted((movie, place + 1) for place, (movie, _) in enumerate(ordered))


def test_mappings_are_bijections_and_restore_what_they_rekey(spark):
    data = [(u * 7, m * 11, float(u + m), 1) for u in range(20) for m in range(u % 5 + 1)]
    ratings = spark.createDataFrame(data, "userId INT, movieId INT, rating DOUBLE, timestamp BIGINT")
    mappings = IdMappings.of(ratings)
    assert rows(mappings.users, "new_userId") == [(i,) for i in range(20)]
    rekeyed = mappings.rekey(ratings)
    assert rekeyed.agg(F.max("userId"), F.max("movieId")).first() == (19, 4)
    assert rows(mappings.restore(rekeyed)) == sorted(data)


@pytest.mark.parametrize("q", [0.0001, 0.2, 0.5, 0.8, 1.0])
def test_exact_quantile_matches_the_definition(spark, q):
    rng = random.Random(11)
    values = [rng.choice([5, 70_000, rng.randint(-200_000, 2_000_000)]) for _ in range(700)]
    wanted = next(v for v in sorted(values) if sum(x <= v for x in values) / len(values) >= q)
    df = spark.createDataFrame([(v,) for v in values], "x BIGINT")
    assert exact_quantile(df, "x", q).first().quantile == wanted


def test_quantiles_of_one_hot_value_and_of_nothing(spark):
    hot = spark.range(3000).select(F.when(F.col("id") < 1000, F.col("id")).otherwise(5000).alias("x"))
    assert exact_quantile(hot, "x", 0.8).first().quantile == 5000
    assert approx_quantile(hot, "x", 0.8).first().quantile == 5000
    assert exact_quantile(hot.filter("x < 0"), "x", 0.8).first().quantile is None


def test_exact_quantile_of_millisecond_stamps_and_negative_values(spark):
    stamps = spark.range(1000).selectExpr("1700000000000 + id * 31536000 as x")
    assert exact_quantile(stamps, "x", 0.8).first().quantile == 1700000000000 + 799 * 31536000
    signed = spark.createDataFrame([(-(2**62),), (-5,), (-4,), (7,), (2**62,)], "x BIGINT")
    assert [exact_quantile(signed, "x", q).first().quantile for q in (0.2, 0.4, 0.6, 1.0)] == [-(2**62), -5, -4, 2**62]

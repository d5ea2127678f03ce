import random

import pytest
from pyspark.sql import functions as F

from ratingloom.operators import joins
from ratingloom.operators.joins import hot_keys, salted_join
from ratingloom.operators.preparation import IdMappings, active_only, clean, counts, time_split
from ratingloom.plans.train import prepare
from ratingloom.sources import tables
from ratingloom.sources.files import staged
from tests.conftest import rows

RATINGS = "userId INT, movieId INT, rating DOUBLE, timestamp BIGINT"


def test_clean_drops_rows_with_missing_or_unreadable_values(spark):
    raw = [("1", "10", "4.5", "100"), ("x", "10", "4.0", "100"), ("2", "", "3.0", "100"), ("3", "11", "", None)]
    df = spark.createDataFrame(raw, "userId STRING, movieId STRING, rating STRING, timestamp STRING")
    cleaned = clean(df)
    assert rows(cleaned) == [(1, 10, 4.5, 100)]
    assert [f.dataType.simpleString() for f in cleaned.schema] == ["int", "int", "float", "bigint"]


def skewed(spark, n=6000):
    """User 1 holds a third of the rows, mostly copies of one rating; movie 2 another third."""
    rng = random.Random(1)
    data = [(1, rng.choice([7, 7, 7, 8]), 4.0, 1) for _ in range(n // 3)]
    data += [(rng.randint(2, 400), 2, 3.0, 2) for _ in range(n // 3)]
    data += [(rng.randint(2, 400), rng.randint(3, 300), 2.5, rng.randint(3, 900)) for _ in range(n // 3)]
    return spark.createDataFrame(data, RATINGS), data


def brute_active(data, min_user, min_movie):
    users, movies = {}, {}
    for user, movie, *_ in data:
        users[user] = users.get(user, 0) + 1
        movies[movie] = movies.get(movie, 0) + 1
    return sorted(r for r in data if users[r[0]] >= min_user and movies[r[1]] >= min_movie)


@pytest.mark.parametrize("rows_per_salt", [50, 4_000_000])
def test_activity_filter_counts_once_on_the_input(spark, monkeypatch, rows_per_salt):
    monkeypatch.setattr(joins.hot_keys, "__defaults__", (rows_per_salt,))
    df, data = skewed(spark)
    assert rows(active_only(df, 8, 10)) == brute_active(data, 8, 10)


@pytest.mark.parametrize("most_words", [0, 500_000])
def test_activity_filter_over_sparse_negative_and_missing_ids(spark, monkeypatch, most_words):
    monkeypatch.setattr(joins, "MOST_WORDS", most_words)
    rng = random.Random(2)
    ids = [-(2**31), -65, -64, -63, -1, 0, 1, 63, 64, 2**31 - 1]
    data = [(rng.choice(ids), rng.choice(ids), 1.0, i) for i in range(300)] + [(5, 5, 2.0, 1), (0, 6, 2.0, 1)]
    missing = [(None, 0, 1.0, 1), (0, None, 1.0, 1)] * 40
    kept = active_only(spark.createDataFrame(data + missing, RATINGS), 30, 28)
    assert rows(kept) == brute_active(data, 30, 28)
    assert 0 < kept.count() < len(data)


def test_activity_filter_moves_no_rating(spark, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1")
    df, data = skewed(spark)
    kept = active_only(df, 8, 10)
    assert "hashpartitioning" not in kept._jdf.queryExecution().executedPlan().toString()
    assert rows(kept) == brute_active(data, 8, 10)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_the_plain_join(spark, how):
    df, _ = skewed(spark)
    dimension = spark.createDataFrame([(i, f"u{i}") for i in range(0, 300)], "userId INT, name STRING")
    hot = hot_keys(counts(df, "userId"), "userId", rows_per_salt=100)
    assert rows(hot) == [(1, 20)]
    got = salted_join(df, dimension, "userId", hot, ["movieId"], how)
    plain = df.join(dimension, "userId", how)
    assert got.columns == plain.columns
    key = lambda df: sorted(map(repr, df.collect()))
    assert key(got) == key(plain)


def test_salted_join_spreads_copies_of_one_row(spark, conf):
    conf(spark__sql__adaptive__enabled="false", spark__sql__autoBroadcastJoinThreshold="-1")
    df = spark.range(8000, numPartitions=16).select(
        F.lit(1).alias("userId"), F.lit(2).alias("movieId"), F.lit(3.0).alias("rating")
    )
    dimension = spark.createDataFrame([(1, "a")], "userId INT, name STRING")
    hot = hot_keys(counts(df, "userId"), "userId", rows_per_salt=500)
    joined = salted_join(df, dimension, "userId", hot, ["movieId"])
    sizes = [r.n for r in joined.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert sum(sizes) == 8000 and len(sizes) >= 4 and max(sizes) <= 4000


def test_adaptive_execution_splits_a_hot_id_when_rekeying(spark, conf):
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="4k",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="2k",
        spark__sql__adaptive__coalescePartitions__enabled="false",
    )
    df = spark.range(40_000, numPartitions=16).select(
        F.when(F.col("id") % 2 == 0, 1).otherwise(F.col("id") % 1000).cast("int").alias("userId"),
        (F.col("id") % 37).cast("int").alias("movieId"),
        F.col("id").cast("double").alias("rating"),
    )
    found = IdMappings.of(df)
    rekeyed = IdMappings(staged(found.users), staged(found.movies)).rekey(df)
    rekeyed.collect()
    assert "skew=true" in rekeyed._jdf.queryExecution().executedPlan().toString()


def test_time_split_covers_the_input_and_is_ordered(spark):
    df, data = skewed(spark)
    train, test = time_split(df, exact=True)
    assert sorted(rows(train) + rows(test)) == sorted(data)
    assert train.agg(F.max("timestamp")).first()[0] < test.agg(F.min("timestamp")).first()[0]
    assert train.count() >= 0.8 * len(data)


def test_prepare_stores_what_later_jobs_read(spark, scratch):
    df, data = skewed(spark)
    workspace = scratch("prepare")
    prepared = prepare(df, workspace, 8, 10, exact_split=True)
    kept = brute_active(data, 8, 10)
    back = prepared.mappings.restore(prepared.train.unionByName(prepared.test))
    assert rows(back) == kept
    assert spark.read.parquet(f"{workspace}/users").count() == len({r[0] for r in kept})
    plan = prepared.test._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(timestamp," in plan.split("PushedFilters")[1]


def test_ratings_are_worked_out_before_they_are_joined(spark, scratch):
    folder = scratch()
    line = "SELECT 1L l_orderkey, 7L l_partkey, 12D l_quantity, TIMESTAMP_NTZ'1970-01-02 00:00:00' l_shipdate"
    spark.sql(line).write.parquet(f"{folder}/lineitem.parquet")
    spark.sql("SELECT 1L o_orderkey, 3L o_custkey").write.parquet(f"{folder}/orders.parquet")
    found = tables.ratings(spark, folder)
    assert rows(found) == [(3, 7, 1.5, 86400)]
    joined = found._jdf.queryExecution().optimizedPlan().toString().split("Join Inner")
    assert "l_quantity" not in joined[0] and "l_quantity" in joined[1]

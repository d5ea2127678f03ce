import math
import random

import pytest
from pyspark.sql import functions as F

from ratingloom.operators.ranking import (
    good_items,
    hit_rate,
    ndcg,
    ranked_groups,
    ranked_labels,
    rmse,
    top_k_per_user,
    user_hits,
    user_ndcg,
)
from ratingloom.plans.train import evaluate
from tests.conftest import rows

PREDICTIONS = "userId INT, movieId INT, rating DOUBLE, prediction DOUBLE"


def test_rank_keeps_ties_and_row_number_does_not(spark):
    df = spark.createDataFrame([(1, m, 4.0, p) for m, p in enumerate([5.0, 5.0, 5.0, 4.0])], PREDICTIONS)
    assert top_k_per_user(df, 2).count() == 3
    assert rows(top_k_per_user(df, 2, ties=False), "movieId") == [(0,), (1,)]


def test_ndcg_by_hand(spark):
    df = spark.createDataFrame([(1, 1, 5.0, 3.0), (1, 2, 1.0, 2.0), (1, 3, 4.0, 1.0), (2, 1, 1.0, 3.0)], PREDICTIONS)
    ranked = ranked_groups(df)
    (row,) = user_ndcg(ranked, df).collect()
    assert row.userId == 1  # user 2 has no good item and is absent
    assert row.dcg == pytest.approx(1.5)
    assert row.ideal_dcg == pytest.approx(1 + 1 / math.log2(3))
    assert row.ndcg == pytest.approx(0.919721, abs=1e-6)
    assert rows(user_hits(ranked), "userId", "has_hit") == [(1, 1), (2, 0)]
    assert rows(good_items(df)) == [(1, 2)]
    assert hit_rate(ranked, df).first().hit_rate == 0.5
    assert ndcg(ranked, df).first().users == 1
    summary = evaluate(df, df).first()
    assert (summary.hit_rate, summary.ndcg) == (0.5, pytest.approx(row.ndcg))


def test_groups_say_the_same_as_rows(spark):
    rng = random.Random(2)
    data = [(rng.randint(1, 6), m % 40, rng.choice([1.0, 3.5, 5.0]), float(rng.randint(1, 9))) for m in range(400)]
    df = spark.createDataFrame(data, PREDICTIONS)
    labelled = ranked_labels(df, 10)
    by_rows = labelled.groupBy("userId").agg(
        F.max("is_good_item").alias("h"), F.round(F.sum(F.col("is_good_item") / F.log2(F.col("rank") + 1)), 9).alias("d")
    )
    by_groups = user_hits(ranked_groups(df, 10)).select("userId", "has_hit", F.round("dcg", 9).alias("d"))
    assert rows(by_rows) == rows(by_groups)
    assert labelled.count() == ranked_groups(df, 10).agg(F.sum("items")).first()[0]


def test_a_user_of_many_copies_sends_few_rows_to_the_window(spark):
    copies = spark.range(20_000).select(
        F.lit(1).alias("userId"), F.lit(2).alias("movieId"), F.lit(4.0).alias("rating"), F.lit(3.3).alias("prediction")
    )
    (group,) = ranked_groups(copies).collect()
    assert (group["items"], group.good, group["rank"]) == (20_000, 20_000, 1)


def test_rmse_and_summary(spark):
    df = spark.createDataFrame([(1, 1, 4.0, 3.0), (1, 2, 4.0, 4.0), (2, 1, 2.0, None)], PREDICTIONS)
    assert rmse(df).first().rmse == pytest.approx(math.sqrt(0.5))
    summary = evaluate(df, df).first()
    assert summary.scored == 2 and 0 <= summary.ndcg <= 1 and 0 <= summary.hit_rate <= 1


def test_limits_are_applied_before_the_shuffle(spark):
    df = spark.createDataFrame([(1, 1, 4.0, 3.0)], PREDICTIONS)
    plan = top_k_per_user(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2  # partial and final


def test_copies_of_a_hot_user_are_not_ranked_in_one_task(spark):
    hot = spark.range(20_000).selectExpr("1 as userId", "cast(id as int) as movieId", "5.0 as prediction")
    assert top_k_per_user(hot, 10).count() == 20_000
    plan = top_k_per_user(hot, 10)._jdf.queryExecution().executedPlan().toString()
    assert "functions=[partial_count(1)]" in plan

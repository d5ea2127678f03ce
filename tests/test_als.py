import numpy as np
import pytest
from pyspark.ml.recommendation import ALSModel
from pyspark.sql import functions as F

from ratingloom.operators import als
from ratingloom.operators.ranking import rmse
from ratingloom.operators.scoring import top_items
from ratingloom.operators.vectors import ItemFactors
from ratingloom.plans.publish import publish
from ratingloom.plans.train import predictions_in_original_ids, train_and_evaluate
from ratingloom.sources.files import read_factors
from ratingloom.sources.serving import lookup, serving_table
from ratingloom.sources.versioned import version_of
from tests.conftest import rows

OPTIONS = {"rank": 6, "iterations": 6, "user_blocks": 4, "item_blocks": 4, "seed": 3}


@pytest.fixture(scope="module")
def trained(spark):
    """Ratings of a planted low-rank matrix under scattered ids; a third belong to one movie."""
    rng = np.random.default_rng(0)
    left, right = rng.normal(size=(80, 3)), rng.normal(size=(60, 3))
    data = []
    for user in range(80):
        for movie in {0, *rng.integers(0, 60, 30).tolist()}:
            value = 3 + float(left[user] @ right[movie]) / 2
            data.append((user * 13 + 5, movie * 7 + 2, value, int(rng.integers(0, 1000))))
    ratings = spark.createDataFrame(data, "userId INT, movieId INT, rating DOUBLE, timestamp BIGINT").persist()
    return ratings, *train_and_evaluate(ratings, **OPTIONS)


def test_model_beats_the_global_mean_on_a_planted_matrix(trained):
    ratings, _, _, metrics = trained
    row = metrics.first()
    spread = ratings.agg(F.stddev_pop("rating")).first()[0]
    assert row.rmse < 0.6 * spread
    assert 0 <= row.ndcg <= 1 and 0 <= row.hit_rate <= 1


def test_evaluator_and_formula_agree(trained):
    _, model, prepared, _ = trained
    scored = als.predict(model, prepared.test)
    assert als.evaluate_rmse(scored) == pytest.approx(rmse(scored).first().rmse)


def test_predictions_come_back_under_original_ids(trained):
    ratings, model, prepared, _ = trained
    back = predictions_in_original_ids(model, prepared)
    assert back.join(ratings, ["userId", "movieId"], "left_anti").isEmpty()


def test_a_seed_fixes_the_model(trained):
    _, model, prepared, _ = trained
    again = als.fit(prepared.train, **OPTIONS)
    assert rows(model.userFactors) == rows(again.userFactors)


def test_lists_equal_those_of_the_model_itself(trained):
    _, model, prepared, _ = trained
    users, items = als.factor_tables(model, prepared.mappings)
    relabelled = top_items(users, ItemFactors.of(items), 5)
    mllib = als.restore_lists(model.recommendForAllUsers(5), prepared.mappings)
    for lists in (mllib, als.restore_lists(als.recommend_all(model, 5), prepared.mappings)):
        entries = lists.select("userId", F.posexplode("recommendations").alias("place", "e"))
        theirs = rows(entries, "userId", F.col("place") + 1, "e.rating")
        ours = rows(relabelled, "userId", "rank", "score")
        assert [row[:2] for row in ours] == [row[:2] for row in theirs]
        assert [row[2] for row in ours] == pytest.approx([row[2] for row in theirs], abs=1e-4)


def test_strangers_get_no_row(spark, trained):
    _, model, _, _ = trained
    asked = spark.createDataFrame([(0,), (0,), (10_000,)], "userId INT")
    assert rows(als.recommend_for(model, asked, 3), "userId") == [(0,)]


def test_first_readable_model_wins(spark, trained, scratch):
    _, model, _, _ = trained
    path, mirror = scratch("model"), scratch("mirror")
    als.save(model, path, mirror)
    loaded = als.load_first(spark, [scratch("missing"), mirror])
    assert isinstance(loaded, ALSModel)
    assert rows(loaded.itemFactors) == rows(model.itemFactors)
    with pytest.raises(RuntimeError) as error:
        als.load_first(spark, [scratch("missing"), scratch("missing")])
    assert error.value.__cause__ is not None


def test_publish_serves_every_user_once(spark, trained, scratch):
    ratings, model, prepared, _ = trained
    table, export = serving_table(spark, scratch("serving")), scratch("export")
    for _ in range(2):
        publish(model, prepared.mappings, table, 1, export, n=4, exclude_seen=ratings)
    latest = table.latest()
    trained_users = rows(read_factors(spark, f"{export}/users", "userId"), "userId")
    assert rows(latest, F.col("user_id").cast("int")) == trained_users
    assert latest.filter(f"version <> {version_of(1)} OR source <> 'batch'").isEmpty()
    user = trained_users[0][0]
    seen = {str(m) for (m,) in rows(ratings.filter(F.col("userId") == user), "movieId")}
    listed = lookup(latest, user)
    assert 0 < len(listed) <= 4 and not seen & set(listed)


def test_blocks_are_one_a_task_until_memory_asks_for_more():
    # The rows of 60 and of 360 times sf0.1 on 12 cores: factors of 650,000 movies fit a task, those of 4 million do not.
    assert als.block_count(17_500_000, 650_000, 100, 12) == 12
    assert als.block_count(105_000_000, 4_000_000, 100, 12) == 100
    assert als.block_count(1_000_000_000, 4_000_000, 100, 12) > 800
    assert als.block_count(500_000_000, 1_000, 100, 12) == 100
    assert als.block_count(0, 0, 100, 4) == 4


def test_shuffle_files_of_at_most_two_iterations_lie_together(spark, trained, monkeypatch):
    given = {}

    class Watched(als.ALS):
        def __init__(self, **options):
            given.update(options)
            super().__init__(**options)

    monkeypatch.setattr(als, "ALS", Watched)
    als.fit(trained[2].train, rank=2, iterations=3, seed=1)
    assert given["checkpointInterval"] <= 2
    assert given["numUserBlocks"] == given["numItemBlocks"] == spark.sparkContext.defaultParallelism


def test_factors_are_checkpointed_every_iteration(trained, monkeypatch):
    given = {}

    class Watched(als.ALS):
        def __init__(self, **options):
            given.update(options)
            super().__init__(**options)

    monkeypatch.setattr(als, "ALS", Watched)
    als.fit(trained[2].train, rank=2, iterations=2, seed=1)
    assert given["checkpointInterval"] == 1


def test_blocks_are_fewer_where_factors_would_fill_the_disk():
    # 60 times sf0.1: an iteration sends 1.5 million factors to every block.
    affordable = als.affordable_blocks(899_400 + 630_660, 100, 15)
    assert affordable * 15 * (899_400 + 630_660) * 432 <= als.FIT_BYTES
    assert als.block_count(17_219_400, 630_660, 100, 12, affordable) == 3
    assert als.block_count(290_000, 10_000, 100, 12, als.affordable_blocks(25_000, 100, 15)) == 12
    # Memory goes first.
    assert als.block_count(30_000_000, 630_660, 100, 12, 1) == 4
    assert als.block_count(105_000_000, 4_000_000, 100, 12, 1) == 100


def test_a_fit_with_many_factors_takes_fewer_blocks_than_tasks(trained, monkeypatch):
    given = {}

    class Watched(als.ALS):
        def __init__(self, **options):
            given.update(options)
            super().__init__(**options)

    monkeypatch.setattr(als, "ALS", Watched)
    monkeypatch.setattr(als, "FIT_BYTES", 1)
    model = als.fit(trained[2].train, rank=2, iterations=2, seed=1)
    assert given["numUserBlocks"] == given["numItemBlocks"] == 1
    assert model.userFactors.count() == trained[2].train.select("userId").distinct().count()

"""Top-k with items skipped by the length of their vectors, and fold-in with large users in parts."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ratingloom.operators.fold_in import fold_in, fold_in_split
from ratingloom.operators.pruned import length, pruned_top_items
from ratingloom.operators import scoring
from ratingloom.operators.scoring import top_items
from ratingloom.operators.vectors import ItemFactors
from tests.conftest import rows

LISTED = ["userId", "rank", "movieId", "score"]


def factors(spark, vectors, key):
    data = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    return spark.createDataFrame(data, f"{key} INT, features ARRAY<DOUBLE>")


@pytest.fixture(scope="module")
def tables(spark):
    rng = np.random.default_rng(11)
    items = rng.normal(size=(900, 6)) * (1 / (1 + np.arange(900) // 30))[:, None]
    items[500:520] = items[3]  # equal vectors tie, wherever they stand
    items[700:] = 0
    users = rng.normal(size=(70, 6))
    users[5] = 0
    rated = [(int(u), int(m)) for u, m in zip(rng.integers(0, 70, 3000), rng.integers(0, 120, 3000))]
    rated += [(9, m) for m in range(880)]
    exclude = spark.createDataFrame(rated, "userId INT, movieId INT")
    return factors(spark, users, "userId"), factors(spark, items, "movieId"), exclude


def test_tiers_work_the_excluded_pairs_out_once(spark, tables):
    users, items, exclude = tables
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    pairs = exclude.mapInArrow(counted, exclude.schema)
    found = pruned_top_items(users, ItemFactors.of(items, limit_bytes=0), 10, pairs, first_tier=50)
    assert rows(found, *LISTED) == rows(top_items(users, ItemFactors.of(items), 10, exclude), *LISTED)
    assert seen.value == exclude.count()


@pytest.mark.parametrize("path", ["tasks", "tiers"])
@pytest.mark.parametrize("without", [False, True])
@pytest.mark.parametrize("k", [1, 10, 40])
def test_lists_are_those_of_scoring_everything(spark, tables, path, without, k):
    users, items, exclude = tables
    exclude = exclude if without else None
    everything = top_items(users, ItemFactors.of(items), k, exclude)
    catalogue = ItemFactors.of(items, **({"limit_bytes": 0} if path == "tiers" else {}))
    found = pruned_top_items(users, catalogue, k, exclude, block=32, first_tier=50)
    assert rows(found, *LISTED) == rows(everything, *LISTED)
    effort = {r.userId: r.scored for r in found.select("userId", "scored").distinct().collect()}
    share = sum(effort.values()) / (70 * 900)
    assert share < (0.9 if k == 40 or without else 0.5)
    assert effort[5] == 900  # a user without direction: every item ties at zero


def test_nothing_can_be_skipped_among_equal_lengths(spark):
    rng = np.random.default_rng(2)
    items = rng.normal(size=(300, 4))
    items /= np.sqrt((items * items).sum(axis=1))[:, None]
    users = factors(spark, rng.normal(size=(20, 4)), "userId")
    found = pruned_top_items(users, ItemFactors.of(factors(spark, items, "movieId")), 5, block=50)
    assert rows(found, *LISTED) == rows(top_items(users, ItemFactors.of(factors(spark, items, "movieId")), 5), *LISTED)


def test_few_items_and_none(spark, tables):
    users, items, _ = tables
    few = ItemFactors.of(items.filter("movieId < 3"))
    assert pruned_top_items(users, few, 10).groupBy("userId").count().filter("count <> 3").count() == 0
    assert pruned_top_items(users, few, 0).count() == 0
    for limit in ({}, {"limit_bytes": -1}):
        assert pruned_top_items(users, ItemFactors.of(items.limit(0), **limit), 5).count() == 0
        assert pruned_top_items(users.limit(0), ItemFactors.of(items, **limit), 5).count() == 0


def test_length(spark):
    frame = spark.createDataFrame([([3.0, 4.0],), ([],)], "v ARRAY<FLOAT>")
    assert [r[0] for r in frame.select(length(F.col("v"))).collect()] == [5.0, 0.0]


@pytest.mark.parametrize("limit", [{}, {"limit_bytes": 0}])
def test_users_in_parts_have_the_same_vector(spark, tables, limit):
    _, items, _ = tables
    rng = np.random.default_rng(4)
    data = [(int(u), int(m), float(r)) for u, m, r in zip(rng.integers(0, 30, 800), rng.integers(0, 950, 800), rng.integers(1, 11, 800) / 2)]
    data += [(99, m, (m % 9 + 1) / 2) for m in range(900)]  # the whole catalogue
    data += [(98, m, 3.0) for m in range(2000, 2100)]  # only movies without a vector
    ratings = spark.createDataFrame(data, "userId INT, movieId INT, rating FLOAT")
    catalogue = ItemFactors.of(items, **limit)
    whole = {r.userId: r for r in fold_in(ratings, catalogue).collect()}
    split = {r.userId: r for r in fold_in_split(ratings, catalogue, pairs_per_part=50).collect()}
    assert whole.keys() == split.keys() and 98 not in split
    for user, row in whole.items():
        assert split[user].n_items == row.n_items
        assert np.allclose(split[user].features, row.features, atol=1e-9)
    again = {r.userId: r for r in fold_in_split(ratings.repartition(9), catalogue, pairs_per_part=50).collect()}
    assert again[99].n_items == 900


def test_a_large_user_is_worked_on_by_many_tasks(spark, tables):
    _, items, _ = tables
    ratings = spark.range(900).select(F.lit(1).alias("userId"), F.col("id").cast("int").alias("movieId"), F.lit(4.0).cast("float").alias("rating"))
    seen = {}
    import ratingloom.operators.fold_in as module

    staged = module.staged

    def spy(df, *args):
        result = staged(df, *args)
        if "sums" in df.columns:
            seen["parts"] = result
        return result

    module.staged = spy
    try:
        assert fold_in_split(ratings, ItemFactors.of(items), pairs_per_part=30).count() == 1
    finally:
        module.staged = staged
    parts = seen["parts"].withColumn("file", F.input_file_name())
    assert parts.count() == 30 and parts.select("file").distinct().count() > 1
    assert parts.agg(F.max("n_items")).first()[0] < 100


def test_small_blocks_of_items_are_scored_together(monkeypatch):
    rng = np.random.default_rng(3)
    users, items = rng.normal(size=(2, 4, 6)), rng.normal(size=(40, 6))
    cells = [
        {"user_block": b, "user_ids": [4 * b + u for u in range(4)], "user_vectors": users[b].ravel().tolist(),
         "spare": [0, 1, 0, 2], "item_ids": list(range(i, i + 2)), "item_vectors": items[i : i + 2].ravel().tolist()}
        for b in range(2) for i in range(0, 40, 2)
    ]
    calls, best = [], scoring._best
    monkeypatch.setattr(scoring, "_best", lambda *arguments: calls.append(1) or best(*arguments))

    def listed():
        batches = [pa.RecordBatch.from_pylist(cells[i : i + 7]) for i in range(0, len(cells), 7)]
        return [tuple(row.values()) for batch in scoring._meet_blocks(iter(batches), 3) for row in batch.to_pylist()]

    found = listed()
    assert len(calls) == 2  # one pass for each block of users
    for block in range(2):
        for u, spare in enumerate([0, 1, 0, 2]):
            scores = (items * users[block][u]).sum(axis=1)
            wanted = sorted(range(40), key=lambda i: (-scores[i], -i))[: 3 + spare]
            assert [m for user, m, _ in found if user == 4 * block + u] == wanted
    monkeypatch.setattr(scoring, "_MET_BYTES", 200)
    assert sorted(listed()) == sorted(found) and len(calls) > 6


def test_a_grid_is_as_even_as_its_tables(spark, conf, monkeypatch):
    conf(spark__sql__shuffle__partitions=16)
    shapes, shape = [], scoring.grid_shape
    monkeypatch.setattr(scoring, "grid_shape", lambda *sizes: shapes.append(shape(*sizes)) or shapes[-1])
    vectors = spark.range(256).select(
        F.col("id").cast("int").alias("userId"),
        F.array(F.sin("id").cast("float"), F.cos("id").cast("float")).alias("features"),
    )
    items = vectors.withColumnRenamed("userId", "movieId")
    gridded = scoring.top_items(vectors, ItemFactors.of(items, limit_bytes=0), 3, user_block=16)
    assert shapes[-1] == (4, 4)  # one group of items would be copied to each of 16 tasks
    assert rows(gridded) == rows(scoring.top_items(vectors, ItemFactors.of(items), 3))


def test_a_catalogue_of_floats_stays_one_and_is_met_in_parts(spark, monkeypatch):
    rng = np.random.default_rng(5)
    data = [(i, rng.normal(size=4).astype(np.float32).tolist()) for i in range(60)]
    ids, vectors = ItemFactors.of(spark.createDataFrame(data, "movieId INT, features ARRAY<FLOAT>")).packed.value
    assert vectors.dtype == np.float32
    users, user_ids, takes = rng.normal(size=(3, 4)), np.array([9, 4, 9]), np.array([2, 5, 3])
    seen, best = [], scoring._best
    monkeypatch.setattr(scoring, "_best", lambda *given: seen.append(given[4]) or best(*given))
    monkeypatch.setattr(scoring, "_MET_BYTES", 7 * 4 * 8)
    found = [tuple(r.values()) for batch in scoring._best_of_all(user_ids, users, takes, ids, vectors) for r in batch.to_pylist()]
    assert max(len(part) for part in seen) == 7 and all(part.dtype == np.float64 for part in seen)
    wanted = []
    for user, vector, take in zip(user_ids.tolist(), users, takes, strict=True):
        scores = (vectors.astype(np.float64) * vector).sum(axis=1)
        wanted += [(user, i, scores[i]) for i in sorted(range(60), key=lambda i: (-scores[i], -i))[:take]]
    assert sorted(found) == sorted(wanted)

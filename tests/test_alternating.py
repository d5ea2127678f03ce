import numpy as np
import pyarrow as pa
import pytest

from ratingloom.operators import als, alternating
from tests.conftest import rows


@pytest.fixture(scope="module")
def ratings(spark):
    """A user and a movie with more ratings than the rank, pairs that come twice, users with one rating."""
    rng = np.random.default_rng(5)
    data = [(int(u) * 7 - 40, int(m) * 3, float(rng.integers(1, 11)) / 2) for u, m in rng.integers(0, 40, (300, 2))]
    data += data[:20] + [(2, m * 3, 4.0) for m in range(40)] + [(u, 6, 2.5) for u in range(1000, 1030)]
    return spark.createDataFrame(data, "userId INT, movieId INT, rating DOUBLE").repartition(5).persist()


def _factors(model):
    return [{row.id: row.features for row in table.collect()} for table in (model.userFactors, model.itemFactors)]


@pytest.mark.parametrize("options", [{}, {"user_blocks": 3, "item_blocks": 5}, {"reg": 0.5, "iterations": 1}])
def test_a_large_fit_gives_the_factors_of_mllib(ratings, monkeypatch, options):
    options = {"rank": 8, "iterations": 4, "seed": 2} | options
    wanted = als.fit(ratings, **options)
    monkeypatch.setattr(als, "MLLIB_WORK", 0)
    monkeypatch.setattr(alternating, "_SOLVE_BYTES", 1000)  # several parts, also of one user
    found = als.fit(ratings, **options)
    for ours, theirs in zip(_factors(found), _factors(wanted), strict=True):
        assert ours.keys() == theirs.keys()
        for key, factor in theirs.items():
            assert ours[key] == pytest.approx(factor, abs=1e-4)
    assert rows(als.predict(found, ratings), "userId", "movieId") == rows(ratings, "userId", "movieId")
    assert (found.rank, found.getColdStartStrategy()) == (wanted.rank, wanted.getColdStartStrategy())


def test_a_large_fit_is_repeatable_and_can_be_stored(spark, ratings, monkeypatch, scratch):
    monkeypatch.setattr(als, "MLLIB_WORK", 0)
    model, again = (als.fit(ratings, rank=4, iterations=2, seed=3) for _ in range(2))
    assert rows(model.userFactors) == rows(again.userFactors)
    path = scratch("model")
    als.save(model, path)
    assert rows(als.load_first(spark, [path]).itemFactors) == rows(model.itemFactors)


def test_a_large_fit_has_a_block_a_task_whatever_it_would_send(spark, ratings, monkeypatch):
    given = {}

    class Watched(als.ALS):
        def __init__(self, **options):
            given.update(options)
            super().__init__(**options)

    monkeypatch.setattr(als, "ALS", Watched)
    monkeypatch.setattr(als, "FIT_BYTES", 1)
    monkeypatch.setattr(als, "MLLIB_WORK", 0)
    als.fit(ratings, rank=2, iterations=1, seed=1)
    assert given["numUserBlocks"] == given["numItemBlocks"] == spark.sparkContext.defaultParallelism
    assert given["maxIter"] == 0


def test_every_block_is_a_task(spark, ratings, scratch):
    blocks = alternating.rating_blocks(ratings, "userId", "movieId", 6, scratch("blocks"))
    assert sum(blocks[1]) == ratings.count()
    factors = spark.createDataFrame([(m * 3, [1.0, 2.0]) for m in range(40)], "id INT, features ARRAY<FLOAT>")
    before = spark.conf.get("spark.sql.unionOutputPartitioning", None)

    def count(own, other, rating, vectors, place):
        yield pa.RecordBatch.from_arrays([pa.array([len(own)], pa.int32()), pa.array([vectors[place].sum()])], names=["n", "total"])

    counted = alternating.over_blocks(blocks, alternating.factor_rows(factors), count, "n INT, total FLOAT")
    with alternating.task_per_part(spark):
        assert counted.rdd.getNumPartitions() == 6
    assert spark.conf.get("spark.sql.unionOutputPartitioning", None) == before
    assert rows(counted, "n") == sorted((n,) for n in blocks[1])
    assert sum(total for (total,) in rows(counted, "total")) == 3 * ratings.count()


def test_factors_may_come_before_the_ratings_that_name_them():
    own, other = np.array([1, 1, 2], np.int32), np.array([7, 9, 9], np.int32)
    rating, vectors = np.array([1, 2, 3], np.float32), np.arange(8, dtype=np.float32).reshape(4, 2)
    rated = pa.RecordBatch.from_arrays(
        [alternating._binary(values, 2) for values in (own, other, rating)], names=["ids", "others", "numbers"]
    )
    factors = next(alternating._factor_batches(np.array([5, 7, 8, 9]), vectors))
    seen = []

    def look(own, other, rating, vectors, place):
        seen.append((own.tolist(), rating.tolist(), vectors[place].tolist()))
        return iter(())

    mixed = pa.Table.from_batches([factors, rated]).combine_chunks().to_batches()
    for order in ([factors, rated], [rated, factors], [factors, rated.slice(0, 1), rated.slice(1)], mixed):
        list(alternating._met(iter(order), 3, look))
    assert seen == [([1, 1, 2], [1, 2, 3], [[2, 3], [6, 7], [6, 7]])] * 4


def test_factors_are_added_up_by_user_without_a_row_per_number(spark, ratings, monkeypatch):
    monkeypatch.setattr(alternating, "_SOLVE_BYTES", 100)  # several parts a user
    vectors = np.random.default_rng(1).normal(size=(120, 3)).astype(np.float32)
    items = spark.createDataFrame([(m, v.tolist()) for m, v in enumerate(vectors)], "movieId INT, features ARRAY<FLOAT>")
    wanted = {}
    for user, movie, rating in rows(ratings):
        n, total = wanted.get(user, (0, 0))
        wanted[user] = n + 1, total + vectors[movie].astype(np.float64) * rating
    found = alternating.weighted_sums(ratings, items, 4).collect()
    assert {row.userId: row.n for row in found} == {user: n for user, (n, _) in wanted.items()}
    for row in found:
        assert row.sums == pytest.approx(wanted[row.userId][1].tolist(), abs=1e-6)

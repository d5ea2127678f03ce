import numpy as np
import pytest
from pyspark.sql import functions as F

from ratingloom.operators.fold_in import fold_in, fold_in_two, gram_sums, probe
from ratingloom.operators.scoring import as_lists, top_items
from ratingloom.operators.vectors import ItemFactors
from tests.conftest import rows

ITEMS = "movieId INT, features ARRAY<FLOAT>"
RATED = "userId INT, movieId INT, rating FLOAT"
USERS = "userId INT, features ARRAY<DOUBLE>"


def items_of(spark, data, packed=True):
    return ItemFactors.of(spark.createDataFrame(data, ITEMS), 1 << 20 if packed else 0)


@pytest.mark.parametrize("packed", [True, False])
def test_fold_in_by_hand(spark, packed):
    items = items_of(spark, [(10, [1.0, 0.0]), (11, [0.0, 1.0])], packed)
    ratings = spark.createDataFrame([(1, 10, 4.0), (1, 11, 2.0), (2, 10, 4.0), (2, 10, 2.0), (3, 99, 5.0)], RATED)
    got = {r.userId: (r.features, r.n_items) for r in fold_in(ratings, items).collect()}
    assert sorted(got) == [1, 2]  # user 3 rated no movie with a vector
    assert got[1][0] == pytest.approx([4 / 1.1, 2 / 1.1]) and got[1][1] == 2
    assert got[2][0] == pytest.approx([6 / 2.1, 0.0]) and got[2][1] == 1


@pytest.fixture(scope="module")
def world(spark):
    rng = np.random.default_rng(4)
    vectors = rng.normal(size=(300, 64)).astype(np.float32)
    data = [(i * 3, vectors[i].tolist()) for i in range(300)]
    rated = [(u, int(rng.integers(0, 320)) * 3, float(rng.integers(1, 11)) / 2) for u in range(60) for _ in range(u % 17 + 1)]
    rated += [(7, int(i) * 3, 4.0) for i in rng.integers(0, 300, 3000)]  # a user with most of the rows
    return data, rated


@pytest.mark.parametrize("packed", [True, False])
def test_fold_in_solves_the_ridge_system(spark, conf, world, packed):
    conf(spark__sql__execution__arrow__maxRecordsPerBatch="7")  # users straddle batches
    data, rated = world
    known = {i: np.array(v, dtype=np.float64) for i, v in data}
    got = {r.userId: r.features for r in fold_in(spark.createDataFrame(rated, RATED), items_of(spark, data, packed)).collect()}
    expected = {u for u, m, _ in rated if m in known}
    assert set(got) == expected
    for user, vector in got.items():
        x = np.array([known[m] for u, m, _ in rated if u == user and m in known])
        r = np.array([s for u, m, s in rated if u == user and m in known])
        residual = (x.T @ x + 0.1 * np.eye(64)) @ np.array(vector) - x.T @ r
        assert np.abs(residual).max() < 1e-8


def test_two_dimensions_in_closed_form_agree_with_the_solve(spark, world):
    data, rated = world
    flat = [(i, v[:2]) for i, v in data]
    ratings = spark.createDataFrame(rated, RATED)
    closed = {r.userId: (r.u0, r.u1) for r in fold_in_two(ratings, spark.createDataFrame(flat, ITEMS)).collect()}
    for row in fold_in(ratings, items_of(spark, flat)).collect():
        assert closed[row.userId] == pytest.approx(tuple(row.features))
    sums = gram_sums(ratings, spark.createDataFrame(flat, ITEMS), 2)
    assert sums.columns == ["userId", "a00", "a01", "a11", "b0", "b1"]


@pytest.mark.parametrize("packed", [True, False])
def test_probe_flags_unknown_movies(spark, packed):
    ratings = spark.createDataFrame([(1, 10, 4.0), (1, 12, 2.0)], RATED)
    items = items_of(spark, [(10, [1.0])], packed)
    assert rows(probe(ratings, items), "movieId", "known") == [(10, True), (12, False)]


def test_vectors_of_different_length_are_refused(spark):
    with pytest.raises(ValueError):
        items_of(spark, [(1, [1.0]), (2, [1.0, 2.0])])


# --- scoring -------------------------------------------------------------------


def brute(users, items, k, exclude=()):
    out = []
    for user, u in users:
        scored = [(float((np.array(v, np.float64) * np.array(u)).sum()), i) for i, v in items if (user, i) not in exclude]
        for place, (score, i) in enumerate(sorted(scored, key=lambda s: (-s[0], -s[1]))[:k]):
            out.append((user, place + 1, i))
    return sorted(out)


@pytest.mark.parametrize("packed", [True, False])
def test_larger_id_wins_a_tie(spark, packed):
    items = items_of(spark, [(3, [1.0]), (7, [1.0]), (9, [0.5])], packed)
    users = spark.createDataFrame([(1, [1.0])], USERS)
    assert rows(top_items(users, items, 1), "movieId") == [(7,)]
    assert rows(top_items(users, items, 5), "rank", "movieId") == [(1, 7), (2, 3), (3, 9)]
    assert top_items(users, items, 0).count() == 0


@pytest.mark.parametrize("packed", [True, False])
def test_top_items_match_brute_force(spark, packed):
    rng = np.random.default_rng(9)
    vectors = rng.normal(size=(120, 12)).astype(np.float32)
    vectors[40:80] = vectors[rng.integers(0, 40, 40)]  # many exact ties
    data = [(int(i) * 5 - 200, vectors[i].tolist()) for i in range(120)]
    users = [(u, rng.normal(size=12).tolist()) for u in range(45)] + [(99, [0.0] * 12)]
    exclude = {(int(u), int(i) * 5 - 200) for u, i in zip(rng.integers(0, 45, 400), rng.integers(0, 130, 400))}
    exclude |= {(3, i) for i, _ in data}  # nothing left for this user
    exclude |= {(4, i) for i, _ in data[:115]}  # fewer left than asked for
    pairs = spark.createDataFrame(sorted(exclude) * 2, "userId INT, movieId INT")
    df = spark.createDataFrame(users, USERS)
    items = items_of(spark, data, packed)
    for k in (1, 10, 200):
        assert rows(top_items(df, items, k, user_block=8, item_block=16), "userId", "rank", "movieId") == brute(users, data, k)
        got = top_items(df, items, k, pairs, user_block=8, item_block=16)
        assert rows(got, "userId", "rank", "movieId") == brute(users, data, k, exclude)


def test_lists_keep_rank_order(spark):
    items = items_of(spark, [(i, [float(i)]) for i in range(50)])
    users = spark.createDataFrame([(1, [1.0]), (2, [-1.0])], USERS)
    lists = {r.userId: [e.movieId for e in r.recommendations] for r in as_lists(top_items(users, items, 12)).collect()}
    assert lists == {1: list(range(49, 37, -1)), 2: list(range(12))}


def test_scoring_has_no_cross_join(spark):
    users = spark.createDataFrame([(1, [1.0])], USERS)
    pairs = spark.createDataFrame([(1, 3)], "userId INT, movieId INT")
    for packed in (True, False):
        ranked = top_items(users, items_of(spark, [(3, [1.0]), (4, [1.0])], packed), 1, pairs)
        plan = ranked._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan
        assert rows(ranked, "movieId") == [(4,)]
        assert ranked.filter(F.col("rank") > 1).isEmpty()


def test_movies_with_two_vectors_count_once_by_the_last(spark):
    data = [(10, [1.0, 0.0], 1), (10, [2.0, 0.0], 2), (11, [0.0, 1.0], 1)]
    factors = spark.createDataFrame(data, "movieId INT, features ARRAY<FLOAT>, written INT")
    ratings = spark.createDataFrame([(1, 10, 4.0), (1, 11, 2.0)], "userId INT, movieId INT, rating FLOAT")
    with pytest.raises(ValueError, match="3 item vectors for 2 movies"):
        ItemFactors.of(factors)
    answers = []
    for limit in (0, 1 << 20):
        items = ItemFactors.of(factors, limit, order="written")
        (user,) = fold_in(ratings, items).collect()
        assert user.n_items == 2 and user.features == pytest.approx([8 / 4.1, 2 / 1.1])
        answers.append(rows(top_items(fold_in(ratings, items), items, 5), "userId", "movieId", "rank"))
    assert answers[0] == answers[1] and len(answers[0]) == 2

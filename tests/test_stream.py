import numpy as np
import pytest
from pyspark.sql import functions as F

from ratingloom.operators.vectors import ItemFactors
from ratingloom.sources import messages as msg
from ratingloom.sources.serving import lookup, serving_table
from ratingloom.streaming.refresh import LiveRefresh, fallback_causes, online_lists, rating_log, start, start_dead_letters
from tests.conftest import rows

RATED = "userId INT, movieId INT, rating FLOAT"


def texts(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value STRING")


def test_parsing_and_dead_letters(spark):
    parsed = msg.parse(texts(spark, "1,10,4.5", "1,11,3.0", "2,10,x", "bad", "2,12,5", "3,1,NaN", "3,1,Infinity", "4,5,", ""))
    assert rows(msg.well_formed(parsed), "userId", "movieId", "rating") == [(1, 10, 4.5), (1, 11, 3.0), (2, 12, 5.0)]
    assert rows(msg.malformed(parsed), "value") == [("",), ("2,10,x",), ("3,1,Infinity",), ("3,1,NaN",), ("4,5,",), ("bad",)]


def test_encoding_round_trip(spark):
    ratings = spark.createDataFrame([(1, 10, 4.5), (2, 11, 5.0)], RATED)
    assert rows(msg.encode(ratings)) == [("1,10,4.5",), ("2,11,5.0",)]
    assert rows(msg.parse(msg.encode(ratings)).drop("value")) == [(1, 10, 4.5), (2, 11, 5.0)]


def test_replay_drops_headers_and_short_rows(spark, tmp_path):
    for name in ("a", "b"):  # every file has its header
        (tmp_path / f"{name}.csv").write_text("userId,movieId,rating,timestamp\n1,2,3.5,99\n7,8\n4,5,,98\n")
    got = rows(msg.replay_file(spark, str(tmp_path)))
    assert got == [("1,2,3.5",), ("1,2,3.5",), ("4,5,",), ("4,5,",)]


@pytest.fixture(scope="module")
def items(spark):
    rng = np.random.default_rng(1)
    data = [(i, rng.normal(size=5).tolist()) for i in range(40)]
    return ItemFactors.of(spark.createDataFrame(data, "movieId INT, features ARRAY<FLOAT>"))


@pytest.fixture
def job(spark, items, scratch):
    user_factors = spark.createDataFrame([(50, [1.0] * 5), (51, [0.5] * 5)], "userId INT, features ARRAY<FLOAT>")
    popular = spark.createDataFrame([([3, 1],)], "movies ARRAY<INT>")

    def build(**changes):
        options = dict(
            items=items,
            serving=serving_table(spark, scratch("serving")),
            dead_letters=scratch("dead"),
            generation=1,
            user_factors=user_factors,
            log=rating_log(spark, scratch("log")),
            popular=popular,
            scope="history",
            n=6,
        )
        return LiveRefresh(**{**options, **changes})

    return build


class Topic:
    def __init__(self, spark, folder):
        self.spark, self.folder, self.sent = spark, folder, 0

    def send(self, *values):
        msg.publish(texts(self.spark, *values).coalesce(1), "text", path=self.folder)

    def run(self, refresh, checkpoint):
        stream = msg.subscribe(self.spark, "text", path=self.folder, maxFilesPerTrigger="1")
        start(stream, refresh, checkpoint, available_now=True).awaitTermination()


@pytest.fixture
def topic(spark, scratch):
    return Topic(spark, scratch("topic"))


def served(refresh):
    return {r.user_id: (list(r.top_10), r.source) for r in refresh.serving.latest().collect()}


@pytest.mark.parametrize("scope", ["history", "state"])
def test_stream_in_batches_equals_the_batch_operator_over_all_ratings(spark, topic, job, items, scratch, scope):
    rng = np.random.default_rng(3)
    sent = [(int(u), int(m), float(r)) for u, m, r in zip(rng.integers(0, 9, 60), rng.integers(0, 45, 60), rng.integers(1, 11, 60) / 2)]
    latest, refresh, checkpoint = {}, job(scope=scope), scratch("cp")
    for part in range(3):
        chunk = sent[part * 20 : part * 20 + 20]
        seen = {}
        for user, movie, rating in chunk:
            seen[user, movie] = max(rating, seen.get((user, movie), 0.0))
        latest.update(seen)
        topic.send(*[f"{u},{m},{r}" for u, m, r in chunk])
        topic.run(refresh, checkpoint)
    everything = spark.createDataFrame([(u, m, r) for (u, m), r in latest.items()], RATED)
    expected = {str(r.userId): [str(m) for m in r.movies] for r in online_lists(everything, items, 6).collect()}
    assert {user: movies for user, (movies, source) in served(refresh).items() if source == "online"} == expected
    if scope == "history":
        assert rows(refresh.log.latest(), *["userId", "movieId", "rating"]) == sorted((u, m, r) for (u, m), r in latest.items())


def test_batch_scope_forgets_earlier_batches(spark, topic, job, items, scratch):
    refresh, checkpoint = job(scope="batch", log=None), scratch("cp")
    topic.send("1,2,5.0", "1,2,1.0", "1,3,4.0")
    topic.run(refresh, checkpoint)
    topic.send("1,4,2.0")
    topic.run(refresh, checkpoint)
    last = spark.createDataFrame([(1, 4, 2.0)], RATED)
    (expected,) = online_lists(last, items, 6).collect()
    assert served(refresh) == {"1": ([str(m) for m in expected.movies], "online")}


def test_fallback_order_and_dead_letters(spark, topic, job, scratch):
    refresh = job()
    # 1 knows one movie of two; 50 is in the model, 60 is nowhere; both rated unknown movies only.
    topic.send("1,2,5.0", "1,999,5.0", "50,998,3.0", "60,999,3.0", "oops", "51,x,1")
    topic.run(refresh, scratch("cp"))
    got = served(refresh)
    assert {user: source for user, (_, source) in got.items()} == {"1": "online", "50": "fallback", "60": "popular"}
    assert "2" not in got["1"][0] and len(got["1"][0]) == 6
    assert got["60"][0] == ["3", "1"]
    assert rows(spark.read.parquet(refresh.dead_letters), "value") == [("51,x,1",), ("oops",)]


def test_without_popular_list_strangers_are_left_out(spark, topic, job, scratch):
    refresh = job(popular=None)
    topic.send("50,998,3.0", "60,999,3.0")
    topic.run(refresh, scratch("cp"))
    assert list(served(refresh)) == ["50"]


def test_restart_and_replay_leave_one_result(spark, topic, job, scratch):
    refresh, checkpoint = job(), scratch("cp")
    topic.send("1,2,5.0", "2,3,1.0")
    topic.run(refresh, checkpoint)
    topic.run(refresh, checkpoint)  # nothing new
    before, log = served(refresh), rows(refresh.log.latest())
    batch = msg.parse(texts(spark, "1,2,5.0", "2,3,1.0"))
    refresh(batch, 0)  # the same batch once more, as after a failure before the commit
    assert served(refresh) == before and rows(refresh.log.latest()) == log
    assert refresh.serving.versions().count() == 2
    topic.send("1,4,1.0")
    topic.run(refresh, checkpoint)
    assert {r.version & 0xFFFFFFFF for r in refresh.serving.versions().collect()} == {1, 2}


def test_state_survives_restarts_and_dead_letters_have_their_own_query(spark, topic, job, items, scratch):
    refresh, checkpoint, letters = job(scope="state", log=None), scratch("cp"), scratch("cp")
    for messages in (["1,2,5.0", "1,2,4.0", "bad"], ["1,3,1.0", "9,999,1.0"], ["1,2,0.5"]):
        topic.send(*messages)
        topic.run(refresh, checkpoint)
        stream = msg.subscribe(spark, "text", path=topic.folder)
        start_dead_letters(stream, refresh.dead_letters, letters, available_now=True).awaitTermination()
    (expected,) = online_lists(spark.createDataFrame([(1, 2, 0.5), (1, 3, 1.0)], RATED), items, 6).collect()
    assert served(refresh) == {"1": ([str(m) for m in expected.movies], "online"), "9": (["3", "1"], "popular")}
    assert rows(spark.read.parquet(refresh.dead_letters)) == [("bad",)]


def test_empty_batches_write_nothing(spark, job):
    refresh = job()
    refresh(msg.parse(texts(spark)), 5)
    assert served(refresh) == {} and refresh.serving.versions().isEmpty()


def test_a_hot_user_with_copies_gets_the_list_of_their_ratings(spark, job):
    refresh = job()
    hot = spark.range(30_000).select(F.concat(F.lit("1,"), (F.col("id") % 20).cast("string"), F.lit(",4.0")).alias("value"))
    refresh(msg.parse(hot), 0)
    movies = [int(m) for m in lookup(refresh.serving.latest(), 1)]
    assert len(movies) == 6 and min(movies) >= 20


def test_causes_of_fallback(spark, items):
    ratings = spark.createDataFrame([(1, 2, 5.0), (1, 999, 5.0), (2, 998, 1.0), (3, 4, 1.0)], RATED)
    causes = fallback_causes(ratings, items, online_lists(ratings, items, 6))
    assert rows(causes) == [(1, "unknown_movie"), (2, "no_list"), (2, "unknown_movie")]


def test_history_needs_a_log(job):
    with pytest.raises(ValueError):
        job(log=None)
    with pytest.raises(ValueError):
        job(scope="all")


def test_log_is_cut_to_the_users_before_it_is_sorted_by_key(spark, scratch):
    log = rating_log(spark, scratch("log"))
    log.append(spark.createDataFrame([(1, 2, 3.0)], RATED), 1)
    users = spark.createDataFrame([(1,)], "userId INT")
    plan = log.latest(only=users)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Aggregate") < plan.index("LeftSemi")


def test_lists_follow_the_generation_that_is_served(spark, topic, job, scratch):
    refresh, checkpoint = job(), scratch("cp")
    topic.send("1,2,5.0")
    topic.run(refresh, checkpoint)
    published = spark.createDataFrame([("1", ["7"], "batch")], refresh.serving.schema)
    refresh.serving.append(published, 2 << 32)
    assert served(refresh)["1"] == (["7"], "batch")
    topic.send("1,3,5.0")
    topic.run(refresh, checkpoint)
    assert served(refresh)["1"][1] == "online"


def test_model_first_order(spark, topic, job, scratch):
    refresh = job(fallback="unknown_movie")
    topic.send("50,2,5.0", "50,999,5.0", "1,2,5.0", "1,999,1.0", "60,998,2.0")
    topic.run(refresh, scratch("cp"))
    assert {user: source for user, (_, source) in served(refresh).items()} == {"50": "fallback", "1": "online", "60": "popular"}

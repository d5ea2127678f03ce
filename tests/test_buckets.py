"""Tables stored by buckets of their keys, and state by entry."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from ratingloom.sources import messages as msg
from ratingloom.sources.versioned import BUCKET, version_of
from ratingloom.streaming import histories as module
from ratingloom.streaming.histories import _PROVIDER_CONF, entry_state, histories, map_histories
from ratingloom.streaming.refresh import rating_log
from tests.conftest import rows

RATED = "userId INT, movieId INT, rating FLOAT"


def rated(spark, data):
    return spark.createDataFrame(data, RATED)


def files_read(df, column="rating"):
    """Files that the scans of a table's log and snapshot opened when ``df`` ran."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.finalPhysicalPlan() if "Adaptive" in plan.getClass().getName() else plan
    total, open_nodes = 0, [plan]
    while open_nodes:
        node = open_nodes.pop()
        if "QueryStage" in node.getClass().getName():
            open_nodes.append(node.plan())
        if "FileSourceScan" in node.getClass().getName() and column in node.output().mkString(","):
            total += node.metrics().apply("numFiles").value()
        open_nodes += [node.children().apply(i) for i in range(node.children().length())]
    return total


def filled(spark, scratch, buckets, versions=6, users=200):
    log = rating_log(spark, scratch("log"), buckets)
    for v in range(versions):
        log.append(rated(spark, [(u, (u + v) % 7, float(v)) for u in range(users)]), version_of(1, v))
    return log


@pytest.mark.parametrize("compacted", [False, True])
def test_bucketed_log_answers_like_a_plain_one(spark, scratch, compacted):
    plain, bucketed = filled(spark, scratch, 0), filled(spark, scratch, 8)
    for log in (plain, bucketed):
        if compacted:
            log.compact(version_of(1, 3))
    assert rows(plain.latest()) == rows(bucketed.latest())
    only = spark.createDataFrame([(3,), (77,), (999,)], "userId INT")
    assert rows(plain.latest(only=only)) == rows(bucketed.latest(only=only))
    assert BUCKET not in bucketed.latest().columns + bucketed.versions().columns
    up_to = version_of(1, 4)
    assert rows(plain.latest(up_to=up_to, only=only)) == rows(bucketed.latest(up_to=up_to, only=only))


def test_only_the_buckets_of_the_users_are_opened(spark, scratch):
    log = filled(spark, scratch, 16)
    log.compact(version_of(1, 2))
    one = spark.createDataFrame([(5,)], "userId INT")
    plan = log.latest(only=one)._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan.lower()
    everybody = files_read(log.latest())
    assert everybody >= 4 * 16
    # One file in the snapshot and one in each of the three versions after it.
    assert files_read(log.latest(only=one)) == 4
    # The history of others grows, and what is opened for this user does not, but for the versions.
    log.append(rated(spark, [(u, m, 1.0) for u in range(1000, 3000) for m in range(3)]), version_of(1, 6))
    assert files_read(log.latest(only=one)) <= 5


def test_repeated_batch_and_empty_batch(spark, scratch):
    log = rating_log(spark, scratch("log"), 4)
    log.append(rated(spark, [(1, 2, 3.0), (2, 2, 1.0)]), 1)
    log.append(rated(spark, [(1, 2, 4.0)]), 2)
    log.append(rated(spark, [(1, 2, 4.0)]), 2)
    log.append(rated(spark, []), 3)
    assert rows(log.latest().drop("version")) == [(1, 2, 4.0), (2, 2, 1.0)]
    log.compact(3)
    assert rows(log.latest().drop("version")) == [(1, 2, 4.0), (2, 2, 1.0)]


class Topic:
    def __init__(self, spark, scratch, remembered):
        self.spark, self.folder, self.checkpoint, self.remembered = spark, scratch("topic"), scratch("cp"), remembered
        self.out = {}

    def send(self, *values):
        frame = self.spark.createDataFrame([(v,) for v in values], "value STRING")
        msg.publish(frame.coalesce(1), "text", path=self.folder)
        stream = msg.subscribe(self.spark, "text", path=self.folder)
        keep = lambda batch, n: self.out.update({n: rows(batch)})
        output = self.remembered(msg.well_formed(msg.parse(stream)))
        writer = output.writeStream.outputMode("update").option("checkpointLocation", self.checkpoint).foreachBatch(keep)
        with entry_state(self.spark):
            query = writer.trigger(availableNow=True).start()
        query.awaitTermination()
        return [p for p in query.recentProgress if p.stateOperators and p.numInputRows]


SENT = (["1,1,5", "1,2,3", "1,2,4", "2,9,1", "bad"], ["1,2,1", "3,3,3"], ["1,4,2", "2,9,1"])


def test_map_state_emits_the_same_histories(spark, scratch):
    mapped, whole = Topic(spark, scratch, map_histories), Topic(spark, scratch, histories)
    for values in SENT:
        mapped.send(*values)
        whole.send(*values)
    assert mapped.out == whole.out
    assert mapped.out[2] == [(1, 1, 5.0), (1, 2, 1.0), (1, 4, 2.0), (2, 9, 1.0)]


def test_one_rating_writes_one_entry(spark, scratch):
    topic = Topic(spark, scratch, map_histories)
    topic.send(*[f"1,{movie},3" for movie in range(500)])
    (progress,) = topic.send("1,7,5")
    assert progress.stateOperators[0].numRowsUpdated == 1
    assert len(topic.out[1]) == 500 and (1, 7, 5.0) in topic.out[1]
    (progress,) = topic.send("1,7,5")  # nothing new
    assert progress.stateOperators[0].numRowsUpdated == 0


def test_the_sessions_state_provider_comes_back(spark, conf):
    before = spark.conf.get(_PROVIDER_CONF)
    with entry_state(spark):
        assert "RocksDB" in spark.conf.get(_PROVIDER_CONF)
    assert spark.conf.get(_PROVIDER_CONF) == before


class _Entries(dict):
    """A map state that counts its calls."""

    def iterator(self):
        self.calls.append("iterator")
        return iter([((movie,), (rating,)) for movie, rating in self.items()])

    def getValue(self, key):
        self.calls.append("get")
        return (self[key[0]],) if key[0] in self else None

    def updateValue(self, key, value):
        self.calls.append("update")
        self[key[0]] = value[0]


def test_a_history_is_read_in_one_call_and_changes_are_written(monkeypatch):
    processor = module.MovieRatings()
    processor.ratings = _Entries({1: 2.0, 2: 3.0, 3: 4.0})
    processor.ratings.calls = calls = []
    monkeypatch.setattr(module, "_EMITTED", 2)
    fresh = pd.DataFrame({"movieId": [2, 3, 5, 5], "rating": [3.0, 1.0, 1.0, 2.0]})
    frames = list(processor.handleInputRows((7,), iter([fresh]), None))
    assert calls == ["iterator", "update", "update"]
    assert processor.ratings == {1: 2.0, 2: 3.0, 3: 1.0, 5: 2.0}
    emitted = pd.concat(frames)
    assert sorted(emitted.itertuples(index=False, name=None)) == [(7, 1, 2.0), (7, 2, 3.0), (7, 3, 1.0), (7, 5, 2.0)]


def test_no_frame_is_grouped_per_user(monkeypatch):
    class State:
        exists, get = True, ([1, 2], [2.0, 3.0])

        def update(self, value):
            self.value = value

    state, fresh = State(), pd.DataFrame({"movieId": [2, 5, 5], "rating": [1.0, 1.0, 2.0]})
    monkeypatch.setattr(pd.DataFrame, "groupby", None)
    (frame,) = module._remember((7,), iter([fresh]), state)
    assert state.value == ([1, 2, 5], [2.0, 1.0, 2.0])
    assert sorted(frame.itertuples(index=False, name=None)) == [(7, 1, 2.0), (7, 2, 1.0), (7, 5, 2.0)]

"""The topic of numbered messages as a streaming source with offsets."""

import json

import pytest

from ratingloom.sources import messages as msg
from ratingloom.sources.topic import NumberedTopic, TopicReader, publish_numbered
from tests.conftest import rows


@pytest.fixture
def topic(spark, scratch):
    spark.dataSource.register(NumberedTopic)
    return scratch("topic")


def send(spark, topic, values, partitions=2):
    publish_numbered(spark.createDataFrame([(v,) for v in values], "value STRING"), topic, partitions)


class Reader:
    def __init__(self, spark, topic, scratch, **options):
        self.spark, self.topic, self.options = spark, topic, options
        self.checkpoint, self.batches = scratch("cp"), []

    def run(self, at_once=True):
        stream = msg.subscribe(self.spark, NumberedTopic.name(), path=self.topic, **self.options)
        keep = lambda batch, n: self.batches.append([r.value for r in batch.collect()])
        writer = stream.writeStream.option("checkpointLocation", self.checkpoint).foreachBatch(keep)
        before = len(self.batches)
        if at_once:
            writer.trigger(availableNow=True).start().awaitTermination()
        else:
            query = writer.trigger(processingTime="0 seconds").start()
            try:
                query.processAllAvailable()
            finally:
                query.stop()
        return sorted(value for batch in self.batches[before:] for value in batch)


def test_latest_sees_only_later_messages_and_resumes(spark, topic, scratch):
    send(spark, topic, ["a", "b", "c"])
    late, early = Reader(spark, topic, scratch, group="g"), Reader(spark, topic, scratch, startingOffsets="earliest")
    assert late.run() == [] and early.run() == ["a", "b", "c"]
    send(spark, topic, ["d", "e"])
    send(spark, topic, ["f"], partitions=3)
    assert late.run() == ["d", "e", "f"]
    assert late.run() == []
    send(spark, topic, ["g"])
    assert late.run() == ["g"] and early.run() == ["d", "e", "f", "g"]


def test_named_offsets(spark, topic, scratch):
    send(spark, topic, [str(i) for i in range(10)], partitions=1)
    some = Reader(spark, topic, scratch, startingOffsets=json.dumps({"0": 7}))
    assert len(some.run()) == 3


def test_batches_are_bounded(spark, topic, scratch):
    send(spark, topic, [f"{i:03}" for i in range(50)], partitions=3)
    reader = Reader(spark, topic, scratch, startingOffsets="earliest", maxOffsetsPerBatch="8", group="g")
    assert reader.run(at_once=False) == [f"{i:03}" for i in range(50)]
    assert max(map(len, reader.batches)) <= 8 and len(reader.batches) >= 7
    send(spark, topic, [f"{i:03}" for i in range(50, 70)], partitions=3)
    assert reader.run(at_once=False) == [f"{i:03}" for i in range(50, 70)]
    assert max(map(len, reader.batches)) <= 16


def test_offsets_are_consecutive_and_segments_appear_whole(spark, topic):
    for part in range(3):
        send(spark, topic, [f"{part}-{i}" for i in range(5 + part)], partitions=2)
    send(spark, topic, [])
    reader = TopicReader({"path": topic, "startingoffsets": "earliest"})
    ends = reader.latestOffset()
    assert sum(ends.values()) == 18 and reader.initialOffset() == {}
    # A segment without a finished log entry is not there yet.
    spark.range(3).selectExpr("id AS offset", "'x' AS value", "0 AS partition").write.partitionBy("partition").parquet(
        f"{topic}/segments/segment=000000000099"
    )
    assert reader.latestOffset() == ends
    for partition, end in ends.items():
        spans = [s for s in reader.partitions({}, ends) if str(s.partition) == partition]
        offsets = [o for s in spans for batch in reader.read(s) for o in batch.column("offset").to_pylist()]
        assert sorted(offsets) == list(range(end))
    some = reader.partitions({"0": 3}, {"0": 4})
    assert [(s.first, s.last) for s in some] == [(3, 3)]


def test_a_topic_that_does_not_exist_yet(spark, topic, scratch):
    reader = Reader(spark, topic, scratch, group="g")
    assert reader.run() == []
    send(spark, topic, ["a"])
    assert reader.run() == ["a"]


def test_parsed_messages(spark, topic, scratch):
    reader = Reader(spark, topic, scratch, startingOffsets="earliest")
    send(spark, topic, ["1,2,3.5", "bad"])
    parsed = msg.parse(spark.createDataFrame([(v,) for v in reader.run()], "value STRING"))
    assert rows(msg.well_formed(parsed), "userId", "movieId", "rating") == [(1, 2, 3.5)]

"""A topic of numbered messages in a folder, as a streaming source with offsets.

Layout below the path::

    segments/segment=<n>/partition=<p>/   messages with their offset, as parquet
    log/segment=<n>/                      first and last offset of each partition in the segment
    groups/<group>/                       where a group of readers began, and what it has finished

A segment is one publish; it can be read once its log entry is complete. Offsets of a
partition are consecutive. Publishing is a distributed write: a partition's numbers are
counted where its rows are written, and nothing is sorted. Readers plan from the log alone
and open the segments that overlap the offsets they were asked for.

Register the source with ``spark.dataSource.register(NumberedTopic)``, then read it with
``subscribe(spark, NumberedTopic.name(), path=...)``. Options:

* ``startingOffsets``: ``latest`` (the default), ``earliest`` or JSON of first offsets by partition;
* ``group``: its first start is remembered in the topic, so a query that began at the latest
  offset while nothing came still begins there when it is started again;
* ``maxOffsetsPerBatch``: bound on a micro-batch, over all partitions. The first one after a
  restart is bounded from what the group has finished, so it may hold one batch more; without
  a group it is not bounded. A run
  with ``availableNow`` reads up to the bound and leaves the rest to the next run.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as ds
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

from ratingloom.sources.files import folder_names, path_exists

_LOG = "partition INT, first BIGINT, last BIGINT"
_LOCAL = (1 << 33) - 1  # the part of monotonically_increasing_id that counts inside a task


def publish_numbered(messages: DataFrame, path: str, partitions: int = 4) -> None:
    """Append messages (``value``) to a topic as one segment. One publisher at a time."""
    spark = messages.sparkSession
    names = folder_names(spark, f"{path}/segments") if path_exists(spark, f"{path}/segments") else []
    number = 1 + max((int(name.removeprefix("segment=")) for name in names if name.startswith("segment=")), default=-1)
    begun = spark.createDataFrame(sorted(_ends(spark, path).items()), "partition INT, next BIGINT")
    dealt = messages.select(F.col("value").cast("string").alias("value")).repartition(partitions)
    dealt = dealt.select("value", F.spark_partition_id().alias("partition"), F.monotonically_increasing_id().alias("id"))
    # One row a partition, so broadcast. Joined after the rows were numbered.
    placed = dealt.join(F.broadcast(begun), "partition", "left").select(
        "partition", (F.coalesce("next", F.lit(0)) + F.col("id").bitwiseAND(_LOCAL)).alias("offset"), "value"
    )
    segment = f"segment={number:012d}"
    placed.write.mode("overwrite").partitionBy("partition").parquet(f"{path}/segments/{segment}")
    if not any(name.startswith("partition=") for name in folder_names(spark, f"{path}/segments/{segment}")):
        return  # an empty publish
    written = spark.read.schema("offset BIGINT, value STRING, partition INT").parquet(f"{path}/segments/{segment}")
    spans = written.groupBy("partition").agg(F.min("offset").alias("first"), F.max("offset").alias("last"))
    spans.coalesce(1).write.mode("overwrite").parquet(f"{path}/log/{segment}")


def _ends(spark, path: str) -> dict[int, int]:
    """The next offset of every partition, by the log: a row for each partition of each segment."""
    if not path_exists(spark, f"{path}/log"):
        return {}
    spans = spark.read.schema(_LOG).parquet(f"{path}/log").groupBy("partition").agg(F.max("last").alias("last"))
    return {row.partition: row["last"] + 1 for row in spans.collect()}


class NumberedTopic(DataSource):
    """``value STRING, partition INT, offset BIGINT`` of a topic."""

    @classmethod
    def name(cls) -> str:
        return "numbered_topic"

    def schema(self) -> str:
        return "value STRING, partition INT, offset BIGINT"

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return TopicReader(dict(self.options))


@dataclass
class Span(InputPartition):
    """Offsets ``first`` to ``last`` of a partition, all in one segment."""

    segment: str
    partition: int
    first: int
    last: int


class TopicReader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.path = options["path"]
        self.starting = options.get("startingoffsets", options.get("startingOffsets", "latest"))
        self.group = options.get("group")
        self.most = int(options.get("maxoffsetsperbatch", options.get("maxOffsetsPerBatch", "0")))
        self.reached: dict[str, int] | None = None

    def _files(self) -> tuple[pafs.FileSystem, str]:
        return pafs.FileSystem.from_uri(self.path)

    def _log(self) -> list[tuple[str, int, int, int]]:
        """(segment, partition, first, last) of every finished segment, in order."""
        system, root = self._files()
        found = system.get_file_info(pafs.FileSelector(f"{root}/log", allow_not_found=True))
        spans = []
        for folder in sorted(info.path for info in found if "segment=" in info.base_name):
            if system.get_file_info(f"{folder}/_SUCCESS").type == pafs.FileType.File:
                table = ds.dataset(folder, filesystem=system, format="parquet").to_table()
                segment = folder.rpartition("/")[2]
                spans += [(segment, row["partition"], row["first"], row["last"]) for row in table.to_pylist()]
        return spans

    def _latest(self) -> dict[str, int]:
        ends: dict[str, int] = {}
        for _, partition, _, last in self._log():
            ends[str(partition)] = max(ends.get(str(partition), 0), last + 1)
        return ends

    def _recall(self, what: str) -> dict[str, int] | None:
        system, root = self._files()
        place = f"{root}/groups/{self.group}/{what}"
        if self.group is None or system.get_file_info(place).type != pafs.FileType.File:
            return None
        with system.open_input_stream(place) as stream:
            return json.loads(stream.read())

    def _remember(self, what: str, offsets: dict[str, int]) -> None:
        if self.group is not None:
            system, root = self._files()
            place = f"{root}/groups/{self.group}/{what}"
            system.create_dir(place.rpartition("/")[0], recursive=True)
            with system.open_output_stream(f"{place}.new") as stream:
                stream.write(json.dumps(offsets).encode())
            system.move(f"{place}.new", place)

    def initialOffset(self) -> dict[str, int]:
        start = self._recall("start")
        if start is None:
            if self.starting == "latest":
                start = self._latest()
            else:
                start = {} if self.starting == "earliest" else {k: int(v) for k, v in json.loads(self.starting).items()}
            self._remember("start", start)
        self.reached = start
        return start

    def latestOffset(self) -> dict[str, int]:
        ends, left = self._latest(), self.most
        if not left:
            return ends
        begun = self.reached
        if begun is None and self.group is not None:
            begun = self._recall("finished")
            if begun is None:
                begun = self.initialOffset()
            else:
                left *= 2  # what was finished last may be one batch behind
        if begun is None:
            return ends  # where the query stands is not known before its first batch
        bounded = {}
        for at, (partition, end) in enumerate(sorted(ends.items())):
            start = min(begun.get(partition, 0), end)
            share = -(-left // (len(ends) - at))  # what earlier partitions leave over goes to later ones
            bounded[partition] = min(end, start + share)
            left -= bounded[partition] - start
        return bounded

    def partitions(self, start: dict[str, int], end: dict[str, int]) -> list[Span]:
        self.reached = end
        spans = []
        for segment, partition, first, last in self._log():
            low, high = max(first, start.get(str(partition), 0)), min(last, end.get(str(partition), 0) - 1)
            if low <= high:
                spans.append(Span(segment, partition, low, high))
        return spans

    def read(self, partition: Span) -> Iterator[pa.RecordBatch]:
        system, root = self._files()
        folder = f"{root}/segments/{partition.segment}/partition={partition.partition}"
        files = ds.dataset(folder, filesystem=system, format="parquet")
        wanted = (pc.field("offset") >= partition.first) & (pc.field("offset") <= partition.last)
        for batch in files.to_batches(columns=["value", "offset"], filter=wanted):
            if batch.num_rows:
                number = pa.array([partition.partition] * batch.num_rows, pa.int32())
                columns = [batch.column("value"), number, batch.column("offset")]
                yield pa.RecordBatch.from_arrays(columns, names=["value", "partition", "offset"])

    def commit(self, end: dict[str, int]) -> None:
        self._remember("finished", end)

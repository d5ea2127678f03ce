"""Keyed tables of many versions whose lookups open a bounded number of files.

Layout below the root::

    runs/run=<level>-<first>-<last>/key_bucket=<b>/   newest row per key of the versions first to last
    merged/run=<level>-<first>-<last>/                the versions that went into a merged run

A version arrives as a run of level 0. When a level has ``fan`` runs, they are merged into
one of the next level, so that a table of n versions keeps about ``fan`` times log n runs
and every row is rewritten log n times, not once a compaction. A run counts once its write
is finished, and hides the runs whose span it contains: readers see either the parts or the
whole, and nothing has to be switched. Rows go by a fixed number of buckets of the first
key and are sorted inside; files carry a bloom filter on the keys. A lookup thus opens one
bucket of every run and skips the row groups that cannot hold its key.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratingloom.sources.files import delete_path, folder_names, path_exists
from ratingloom.sources.versioned import BUCKET, VersionedTable


class Run(NamedTuple):
    level: int
    first: int
    last: int

    @property
    def name(self) -> str:
        return f"run={self.level}-{self.first}-{self.last}"

    def hides(self, other: Run) -> bool:
        return self.level > other.level and self.first <= other.first and other.last <= self.last


@dataclass(frozen=True)
class TieredTable(VersionedTable):
    """A :class:`VersionedTable` by runs. Merge after appending, from one job at a time."""

    buckets: int = 64
    fan: int = 8

    def create_if_absent(self) -> None:
        """Nothing to lay down: a table without runs is empty."""

    def _runs(self) -> list[Run]:
        """Every finished run, hidden ones included, the oldest first."""
        if not path_exists(self.spark, f"{self.root}/runs"):
            return []
        found = [
            Run(*map(int, name.removeprefix("run=").split("-")))
            for name in folder_names(self.spark, f"{self.root}/runs")
            if name.startswith("run=") and path_exists(self.spark, f"{self.root}/runs/{name}/_SUCCESS")
        ]
        return sorted(found, key=lambda run: (run.first, run.last))

    def runs(self) -> list[Run]:
        """The runs that readers use."""
        runs = self._runs()
        return [run for run in runs if not any(other.hides(run) for other in runs)]

    def newest_version(self) -> int:
        return max((run.last for run in self._runs()), default=-1)

    def append(self, rows: DataFrame, version: int) -> None:
        """Upsert ``rows`` (one per key) as ``version``, 0 or more. A repeated write changes nothing.

        A version that was merged already is left as it is; one that comes late, between
        merged versions, is an error, as the merge cannot have seen it.
        """
        for run in self.runs():
            if run.level and run.first <= version <= run.last:
                if self._merged(run).filter(F.col("version") == version).isEmpty():
                    raise ValueError(f"version {version} comes after {run.first} to {run.last} were merged")
                return
        columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema]
        stamped = rows.select(*columns, F.lit(version).cast("bigint").alias("version"))
        self._write(stamped, f"{self.root}/runs/{Run(0, version, version).name}")

    def _merged(self, run: Run) -> DataFrame:
        return self.spark.read.schema("version BIGINT").parquet(f"{self.root}/merged/{run.name}")

    def _write(self, rows: DataFrame, path: str) -> None:
        bucketed = rows.withColumn(BUCKET, self.bucket(F.col(self.keys[0])))
        dealt = bucketed.hint("rebalance", F.col(BUCKET)).sortWithinPartitions(BUCKET, *self.keys)
        writer = dealt.write.mode("overwrite").partitionBy(BUCKET)
        for key in self.keys:
            writer = writer.option(f"parquet.bloom.filter.enabled#{key}", "true")
        writer.parquet(path)

    def _read(self, runs: list[Run]) -> DataFrame:
        if not runs:
            return self.spark.createDataFrame([], self._stored)
        paths = [f"{self.root}/runs/{run.name}" for run in runs]
        # Each run is read from its own folder: runs without a row have no bucket below it.
        frames = [self.spark.read.schema(self._stored).parquet(path) for path in paths]
        rows = frames[0]
        for frame in frames[1:]:
            rows = rows.unionByName(frame)
        return rows

    def versions(self, only: DataFrame | None = None) -> DataFrame:
        return self._only(self._read(self.runs()), only)

    def latest_of(self, key: object) -> DataFrame:
        """The newest row of one value of the first key, with its ``version``: one bucket of every run is opened."""
        rows = self._read(self.runs())
        rows = rows.filter((F.col(BUCKET) == self.bucket(F.lit(key))) & (F.col(self.keys[0]) == F.lit(key)))
        return self._newest(rows.drop(BUCKET))

    def merge(self) -> int:
        """Merge every level that has ``fan`` runs into a run of the next; returns the number of merges."""
        merges, level = 0, 0
        while True:
            same = [run for run in self.runs() if run.level == level]
            if not same and all(run.level < level for run in self.runs()):
                return merges
            if len(same) >= self.fan:
                whole = Run(level + 1, same[0].first, same[-1].last)
                if level:
                    covered = [self._merged(run) for run in same]
                    versions = covered[0]
                    for more in covered[1:]:
                        versions = versions.unionByName(more)
                else:
                    versions = self.spark.createDataFrame([(run.last,) for run in same], "version BIGINT")
                versions.write.mode("overwrite").parquet(f"{self.root}/merged/{whole.name}")
                self._write(self._newest(self._read(same).drop(BUCKET)), f"{self.root}/runs/{whole.name}")
                merges += 1
            level += 1

    def compact(self, version: int) -> None:
        """Runs are merged by their number, see :meth:`merge`; there is no snapshot."""
        self.merge()

    def expire(self) -> None:
        """Delete the runs that merged ones hide; call it when no reader opened the table before the last merge."""
        live = set(self.runs())
        for run in self._runs():
            if run not in live:
                delete_path(self.spark, f"{self.root}/runs/{run.name}")
                if run.level:
                    delete_path(self.spark, f"{self.root}/merged/{run.name}")

"""Keyed tables on plain parquet: upserts as versions, newest version per key wins.

Layout below the root::

    log/version=<v>/        rows written as version v
    snapshot/as_of=<v>/     newest row per key among all versions up to v
    pointer/                one row as_of per finished snapshot; the largest counts

A table with ``buckets`` has folders ``key_bucket=<b>`` below each of these, by a hash of
its first key. Reads for some keys then open the files of their buckets only.

A version is written by overwriting its own folder, so a repeated write (a
restarted batch) changes nothing. A compaction writes a new snapshot, then its
pointer; what readers hold is never overwritten.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from ratingloom.sources.files import delete_path, folder_names, path_exists

# Versions of one model generation are consecutive below this number.
GENERATION = 1 << 32
BUCKET = "key_bucket"


def version_of(generation: int, batch_id: int | None = None) -> int:
    """Version of a generation's batch publish, or of a stream batch on top of it."""
    return generation * GENERATION + (0 if batch_id is None else batch_id + 1)


@dataclass(frozen=True)
class VersionedTable:
    spark: SparkSession
    root: str
    schema: StructType
    keys: Sequence[str]
    buckets: int = 0

    @property
    def _stored(self) -> StructType:
        bucket = [StructField(BUCKET, IntegerType())] if self.buckets else []
        return StructType([*self.schema.fields, StructField("version", LongType()), *bucket])

    def bucket(self, key: Column) -> Column:
        """The bucket of a value of the first key."""
        return F.pmod(F.xxhash64(key.cast(self.schema[self.keys[0]].dataType)), F.lit(self.buckets)).cast("int")

    def _write(self, rows: DataFrame, path: str) -> None:
        """``rows`` to a folder of its own; buckets are split or joined to files of even size."""
        if self.buckets:
            bucket = self.bucket(F.col(self.keys[0])).alias(BUCKET)
            rows.select("*", bucket).hint("rebalance", F.col(BUCKET)).write.mode("overwrite").partitionBy(BUCKET).parquet(path)
        else:
            rows.write.mode("overwrite").parquet(path)

    def create_if_absent(self) -> None:
        """Lay down an empty log and pointer; an existing table is left alone."""
        if path_exists(self.spark, f"{self.root}/pointer"):
            return
        empty = self.spark.createDataFrame([], self.schema)
        leaf = f"/{BUCKET}=0" if self.buckets else ""
        empty.write.mode("overwrite").parquet(f"{self.root}/log/version=-1{leaf}")
        self._point_to(-1)

    def append(self, rows: DataFrame, version: int) -> None:
        """Upsert ``rows`` (one per key) as ``version``; a failed write fails the caller."""
        columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema]
        self._write(rows.select(*columns), f"{self.root}/log/version={version}")

    def versions(self, only: DataFrame | None = None) -> DataFrame:
        """Every row since the last snapshot, and the snapshot's, with their ``version``.

        ``only`` holds distinct values of some key columns; other rows are left out, and in
        a table with buckets the folders of other buckets are not opened.
        """
        as_of = self.as_of()
        log = self.spark.read.schema(self._stored).parquet(f"{self.root}/log")
        rows = self._only(log.filter(F.col("version") > as_of), only)
        if as_of < 0:
            return rows
        snapshot = self.spark.read.schema(self._stored).parquet(f"{self.root}/snapshot/as_of={as_of}")
        return self._only(snapshot, only).unionByName(rows)

    def _only(self, rows: DataFrame, only: DataFrame | None) -> DataFrame:
        if only is None:
            return rows.drop(BUCKET)
        if self.buckets and self.keys[0] in only.columns:
            wanted = only.select(self.bucket(F.col(self.keys[0])).alias(BUCKET)).distinct()
            # At most ``buckets`` rows, so broadcast; the filter, always true, has the optimizer prune by them at run time.
            rows = rows.join(F.broadcast(wanted.filter(F.col(BUCKET) < self.buckets)), BUCKET, "left_semi")
        return rows.drop(BUCKET).join(only, only.columns, "left_semi")

    def newest_version(self) -> int:
        """The largest version written so far, read from the names of the folders; -1 if there is none."""
        names = [name for name in folder_names(self.spark, f"{self.root}/log") if name.startswith("version=")]
        return max([self.as_of(), *(int(name.removeprefix("version=")) for name in names)])

    def latest(self, up_to: int | None = None, only: DataFrame | None = None) -> DataFrame:
        """The newest row of every key with its ``version``.

        A filter on the keys moves below the aggregate into the parquet scans.
        The aggregate combines before its shuffle, so a key with very many
        versions arrives as one row per task. ``only`` holds distinct values of some key
        columns; other rows are dropped before anything is sorted or shuffled by key.
        """
        rows = self.versions(only)
        if up_to is not None:
            rows = rows.filter(F.col("version") <= up_to)
        return self._newest(rows)

    def _newest(self, rows: DataFrame) -> DataFrame:
        values = [f.name for f in self.schema if f.name not in self.keys]
        newest = F.max_by(F.struct(*values), F.col("version"))
        return (
            rows.groupBy(*self.keys)
            .agg(newest.alias("newest"), F.max("version").alias("version"))
            .select(*[self._pick(f.name) for f in self.schema], "version")
        )

    def _pick(self, name: str):
        return F.col(name) if name in self.keys else F.col(f"newest.{name}").alias(name)

    def compact(self, version: int) -> None:
        """Fold all versions up to ``version`` into a new snapshot, sorted by key.

        Sorting by range lets row-group statistics skip most of the snapshot in a
        lookup by key.
        """
        if version <= self.as_of():
            return
        folded = self.latest(up_to=version)
        if not self.buckets:
            folded = folded.repartitionByRange(*self.keys).sortWithinPartitions(*self.keys)
        self._write(folded, f"{self.root}/snapshot/as_of={version}")
        self._point_to(version)

    def expire(self) -> None:
        """Delete the log versions that the current snapshot contains.

        Readers that opened the table before its last compaction still use them;
        call this when none is running.
        """
        as_of = self.as_of()
        stored = self.spark.read.schema(self._stored).parquet(f"{self.root}/log").select("version").distinct()
        for row in stored.filter((F.col("version") >= 0) & (F.col("version") <= as_of)).collect():
            delete_path(self.spark, f"{self.root}/log/version={row.version}")

    def as_of(self) -> int:
        """Version of the current snapshot, -1 before the first."""
        pointer = self.spark.read.schema("as_of BIGINT").parquet(f"{self.root}/pointer")
        return pointer.agg(F.max("as_of")).first()[0]

    def _point_to(self, version: int) -> None:
        entry = self.spark.range(1).select(F.lit(version).cast("bigint").alias("as_of"))
        entry.write.mode("append").parquet(f"{self.root}/pointer")

"""Landing that takes new files only, and summaries that are refreshed by merging.

A landing run reads the files it has not seen, as one numbered part, and writes that part
to a folder of its own; the ledger of files is the checkpoint of a file stream. A run that
died repeats its part under the same number. What exploration and the time split need is
kept per part as counts and quantile sketches, which add up: after a landing only the new
part is read, however large the table has grown.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from ratingloom import fixed_values as fixed
from ratingloom.functions import rating_year
from ratingloom.sources import schemas
from ratingloom.sources.files import folder_names, path_exists, write_fitting

PART = "part"
#: Size of a quantile sketch: ranks are off by about 2.3 / K ** 0.9 of all rows, here one in 800.
SKETCH_K = 4096
#: What ratings are counted by, with the type that the counts are stored under.
COUNTED = {"userId": "INT", "movieId": "INT", "rating": "FLOAT", "year": "INT"}


def land_new(
    spark: SparkSession,
    folder: str,
    schema: StructType,
    target: str,
    rejects: str,
    ledger: str,
    sep: str = ",",
    header: bool = True,
    landed: Callable[[int, DataFrame], None] | None = None,
) -> None:
    """Land the files of ``folder`` that came since the last run as a new part of ``target``.

    Lines that fit the schema go to ``target/part=<n>``, the others to ``rejects/part=<n>``,
    as :func:`ratingloom.sources.files.land_raw` writes them. ``landed`` is called with the
    number and the rows of every part. Files are told apart by their names and have to
    appear whole (moved into the folder); a run without new files changes nothing.
    """
    text = StructType([*schemas.as_text(schema).fields, StructField("line", StringType())])
    reader = spark.readStream.option("header", header).option("sep", sep).option("columnNameOfCorruptRecord", "line")

    def land(lines: DataFrame, number: int) -> None:
        write_fitting(lines, schema, f"{target}/{PART}={number}", f"{rejects}/{PART}={number}")
        if landed is not None:
            landed(number, spark.read.schema(schema).parquet(f"{target}/{PART}={number}"))

    writer = reader.schema(text).csv(folder).writeStream.option("checkpointLocation", ledger).foreachBatch(land)
    writer.trigger(availableNow=True).start().awaitTermination()


def landed_table(spark: SparkSession, target: str, schema: StructType) -> DataFrame:
    """Everything that has landed, with the number of its ``part``."""
    return spark.read.schema(StructType([*schema.fields, StructField(PART, IntegerType())])).parquet(target)


@dataclass(frozen=True)
class RatingSummaries:
    """Counts by user, movie, rating and year, and sketches of the timestamps, by part.

    The functions of :mod:`ratingloom.plans.explore` take an object of this class in place
    of the ratings and give the same tables. A part counts once all of its summaries are
    written; writing one again replaces it.
    """

    spark: SparkSession
    root: str

    def add(self, part: int, ratings: DataFrame) -> None:
        """Summarise ``ratings`` as a part. One pass per column; counts combine before they are shuffled."""
        dated = ratings.withColumn("year", rating_year(F.col("timestamp")))
        for key, kind in COUNTED.items():
            counted = dated.groupBy(F.col(key).cast(kind).alias(key)).agg(F.count("*").alias("count"))
            counted.write.mode("overwrite").parquet(f"{self.root}/{key}/{PART}={part}")
        sketch = ratings.agg(F.kll_sketch_agg_bigint("timestamp", F.lit(SKETCH_K)).alias("sketch"))
        sketch.write.mode("overwrite").parquet(f"{self.root}/timestamp/{PART}={part}")
        done = self.spark.range(1).select(F.lit(part).alias("done"))
        done.write.mode("overwrite").parquet(f"{self.root}/done/{PART}={part}")

    def parts(self) -> list[int]:
        """Numbers of the finished parts."""
        if not path_exists(self.spark, f"{self.root}/done"):
            return []
        names = folder_names(self.spark, f"{self.root}/done")
        numbers = [int(name.removeprefix(f"{PART}=")) for name in names if name.startswith(f"{PART}=")]
        return sorted(n for n in numbers if path_exists(self.spark, f"{self.root}/done/{PART}={n}/_SUCCESS"))

    def _read(self, name: str, schema: str) -> DataFrame:
        parts = self.parts()
        if not parts:
            return self.spark.createDataFrame([], schema)
        stored = self.spark.read.schema(f"{schema}, {PART} INT").parquet(f"{self.root}/{name}")
        return stored.filter(F.col(PART).isin(parts)).drop(PART)

    def counts(self, key: str) -> DataFrame:
        """``(key, count)`` over all parts: what counting the whole table gives."""
        stored = self._read(key, f"{key} {COUNTED[key]}, count BIGINT")
        return stored.groupBy(key).agg(F.sum("count").alias("count"))

    def quantile(self, q: float = fixed.SPLIT_QUANTILE) -> DataFrame:
        """One row ``quantile`` of the timestamps, from the merged sketches; null without a row."""
        merged = self._read("timestamp", "sketch BINARY").agg(F.kll_merge_agg_bigint("sketch").alias("sketch"))
        n = F.kll_sketch_get_n_bigint("sketch")
        found = F.when(n > 0, F.kll_sketch_get_quantile_bigint("sketch", F.lit(q)))
        return merged.select(found.alias("quantile"))

"""Rating events as text messages: encoding, sources, sinks, parsing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratingloom import fixed_values as fixed
from ratingloom.functions import message_fields, to_message

RATINGS_FILE_HEADER = "userId,movieId,rating,timestamp"


def encode(ratings: DataFrame, *keep: str) -> DataFrame:
    """Ratings as one STRING column ``value`` of the form ``user,movie,rating``."""
    return ratings.select(*keep, to_message(F.col("userId"), F.col("movieId"), F.col("rating")).alias("value"))


def replay_file(spark: SparkSession, path: str | list[str], header: str = RATINGS_FILE_HEADER) -> DataFrame:
    """The messages of a ratings file: no header, rows of three or more fields, first three kept."""
    return replay_lines(spark.read.option("encoding", "ISO-8859-1").text(path), header)


def replay_lines(lines: DataFrame, header: str = RATINGS_FILE_HEADER) -> DataFrame:
    parts = F.split("value", fixed.MESSAGE_SEPARATOR)
    return lines.filter((F.col("value") != header) & (F.size(parts) >= 3)).select(
        F.array_join(F.slice(parts, 1, 3), fixed.MESSAGE_SEPARATOR).alias("value")
    )


def publish(messages: DataFrame, format: str = "kafka", **options: str) -> None:
    """Write messages to a topic or, with ``format="text"``, to a folder.

    A topic wants ``options`` such as ``{"kafka.bootstrap.servers": ...}``.
    """
    writer = messages.select("value").write.format(format).mode("append")
    if format == "kafka":
        options = {"topic": fixed.RATINGS_TOPIC, **options}
    path = options.pop("path", None)
    writer.options(**options).save(path)


def subscribe(spark: SparkSession, format: str = "kafka", **options: str) -> DataFrame:
    """Streaming messages as a STRING column ``value``.

    ``kafka`` starts at the latest offsets unless told otherwise; afterwards the
    checkpoint decides. Any source with a ``value`` column works (``text`` on a folder).
    """
    if format == "kafka":
        options = {"subscribe": fixed.RATINGS_TOPIC, "startingOffsets": "latest", **options}
    path = options.pop("path", None)
    stream = spark.readStream.format(format).options(**options).load(path)
    return stream.select(F.col("value").cast("string").alias("value"))


def parse(messages: DataFrame, *keep: str) -> DataFrame:
    """``value`` next to its userId, movieId and rating; works on batches and streams."""
    return messages.select(*keep, "value", *message_fields(F.col("value")))


_COMPLETE = "userId IS NOT NULL AND movieId IS NOT NULL AND rating IS NOT NULL"


def well_formed(parsed: DataFrame) -> DataFrame:
    return parsed.filter(_COMPLETE)


def malformed(parsed: DataFrame) -> DataFrame:
    """Messages for the dead-letter table."""
    return parsed.filter(f"NOT ({_COMPLETE})")

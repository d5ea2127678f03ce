"""Views of an order database as rating data (the test tables of this repository)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratingloom.functions import epoch_seconds
from ratingloom.sources.files import is_file


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _half_stars(amount: Column) -> Column:
    """An amount as a rating between 0.5 and 5 in half steps."""
    return F.least(F.lit(5.0), F.greatest(F.lit(0.5), F.ceil(amount) * 0.5))


def ratings(spark: SparkSession, folder: str) -> DataFrame:
    """Every order line as one rating of its part by its customer; values are worked out before they are shuffled."""
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        _half_stars(F.col("l_quantity") / 5).alias("rating"),
        epoch_seconds(F.col("l_shipdate")).alias("timestamp"),
    )
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        F.col("o_custkey").cast("int").alias("userId"), F.col("l_partkey").cast("int").alias("movieId"), "rating", "timestamp"
    )


def movies(spark: SparkSession, folder: str) -> DataFrame:
    """Parts as movies; every tenth title carries no year."""
    year = (F.lit(1950) + F.col("p_partkey") % 75).cast("string")
    dated = F.concat("p_name", F.lit(" ("), year, F.lit(")"))
    return table(spark, folder, "part").select(
        F.col("p_partkey").cast("int").alias("movieId"),
        F.when(F.col("p_partkey") % 10 == 0, F.col("p_name")).otherwise(dated).alias("title"),
        F.col("p_type").alias("genres"),
    )


def links(spark: SparkSession, folder: str) -> DataFrame:
    """External ids of the movies that have one."""
    return table(spark, folder, "part").filter("p_partkey % 13 <> 0").select(
        F.col("p_partkey").cast("int").alias("movieId"),
        (F.col("p_partkey") * 7).cast("string").alias("tmdbId"),
    )


def item_factors(spark: SparkSession, folder: str) -> DataFrame:
    """Embeddings as item factors; movies beyond the last vector have none."""
    return table(spark, folder, "embeddings").select(
        F.col("vec_id").cast("int").alias("movieId"), F.col("embedding").alias("features")
    )


def messages_of(events: DataFrame) -> DataFrame:
    """Events as rating messages. Errors lack the rating, sign-ups carry ``NA``."""
    user = F.col("user_id").cast("string")
    item = (F.lit(10) * F.get_json_object("props", "$.k").cast("int")).cast("string")
    rating = (
        F.when(F.col("event_type") == "error", F.lit(None).cast("string"))
        .when(F.col("event_type") == "signup", F.lit("NA"))
        .otherwise(_half_stars(F.col("value") / 10).cast("string"))
    )
    return events.select("event_id", F.concat_ws(",", user, item, rating).alias("value"))


def messages(spark: SparkSession, folder: str) -> DataFrame:
    return messages_of(table(spark, folder, "events"))


def message_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The events table as a file stream of rating messages."""
    events = table(spark, folder, "events")
    reader = spark.readStream.schema(events.schema)
    path = f"{folder}/events.parquet"
    if is_file(spark, path):  # a file stream watches folders
        reader, path = reader.option("pathGlobFilter", "events.parquet"), folder
    return messages_of(reader.parquet(path))

"""Declared schemas. Nothing in the library infers a schema from data."""

from pyspark.sql.types import (
    ArrayType,
    FloatType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

RATINGS = StructType(
    [
        StructField("userId", IntegerType()),
        StructField("movieId", IntegerType()),
        StructField("rating", FloatType()),
        StructField("timestamp", LongType()),
    ]
)

MOVIES = StructType(
    [
        StructField("movieId", IntegerType()),
        StructField("title", StringType()),
        StructField("genres", StringType()),
    ]
)

LINKS = StructType(
    [
        StructField("movieId", IntegerType()),
        StructField("imdbId", StringType()),
        StructField("tmdbId", StringType()),
    ]
)

FACTORS = StructType(
    [
        StructField("id", IntegerType()),
        StructField("features", ArrayType(FloatType())),
    ]
)

SERVING = StructType(
    [
        StructField("user_id", StringType()),
        StructField("top_10", ArrayType(StringType())),
        StructField("source", StringType()),
    ]
)

RATING_LOG = StructType(
    [
        StructField("userId", IntegerType()),
        StructField("movieId", IntegerType()),
        StructField("rating", FloatType()),
    ]
)


def as_text(schema: StructType) -> StructType:
    """The same columns, all STRING: for files whose values still need checking."""
    return StructType([StructField(field.name, StringType()) for field in schema])

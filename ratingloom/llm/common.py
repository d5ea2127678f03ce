"""Helpers that the text operators share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratingloom.session import scratch_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()

#: A word: everything between ASCII white space (fixed by the contract of several queries).
WORD = r"[^\x20\x09-\x0D]+"

#: Tables of up to so many rows of bounded width are broadcast after their rows were counted.
BROADCAST_ROWS = 100_000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back.

    Several consumers then share one computation, a lost executor costs no more than
    a read, and joins on the result exchange both sides, which lets AQE split hot keys.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small(df: DataFrame) -> DataFrame:
    """A staged table with the broadcast hint if its counted rows are few, else as it is."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def text_of(column: str = "text") -> Column:
    """The text; null counts as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """``text`` with A-Z, and nothing else, in lower case."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed and spelled out once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def held_out(modulus: int, remainder: int) -> Column:
    """Whether crc32 of doc_id, as text, leaves ``remainder``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % modulus == remainder


def pieces(text: str, longest: int = 1_000_000):
    """``text`` in pieces of bounded length, cut at spaces where there are any."""
    start = 0
    while len(text) - start > longest:
        end = text.rfind(" ", start + 1, start + longest)
        end = start + longest if end < 0 else end
        yield text[start:end]
        start = end
    yield text[start:] if start else text


def most_frequent(counts: DataFrame, bound: int) -> DataFrame:
    """The rows of ``counts`` with the largest n: whole powers of two, as many as keep to ``bound`` rows."""
    level = F.floor(F.log2("n")).cast("int").alias("level")
    least, total = 62, 0
    for row in sorted(counts.groupBy(level).agg(F.count("*").alias("rows")).collect(), reverse=True):
        total += row["rows"]
        if total > bound:
            break
        least = row["level"]
    return counts.filter(F.col("n") >= 2**least)

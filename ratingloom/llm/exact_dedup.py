"""Exact deduplication by content-defined chunk recipes.

A text is cut where its own characters say so, each distinct chunk gets an
identifier, and two texts are equal when their ordered lists of identifiers are. The
text of a chunk moves once, to verify identifiers; documents move as recipes of
eight bytes a chunk.

Defined results: null and empty texts are equal to each other. A row that repeats
another's doc_id and text counts as one more copy, and only one of such rows stays. A
null doc_id is below all others. Very long texts are cut into chunks of bounded length.
Other columns are ignored, and an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratingloom.llm.common import ascii_lower, staged, text_of

#: A chunk ends between words of which the first ends and the next begins with some of these
#: letters, at ``LONGEST`` characters or with the text. What stands at a cut decides it, and
#: such places are some hundreds of characters apart, so cuts fall in step again after an
#: insertion.
CUT = r"[dmty]\s(?=[abio][nstu])"
SHORTEST, LONGEST = 128, 8192


def chunks_of(text: Column, shortest: int = SHORTEST, longest: int = LONGEST) -> Column:
    """The chunks of a text, in order; together they are the text."""
    return F.regexp_extract_all(
        text, F.lit(rf"(?s).{{{shortest},{longest - 2}}}?(?:{CUT}|\z)|.{{1,{longest}}}"), F.lit(0)
    )


def _hashes(chunk: Column, width: int, bits: int) -> list[Column]:
    return [F.shiftrightunsigned(F.xxhash64(F.lit(i), chunk), 64 - bits) for i in range(width)]


def identifier_width(chunks: DataFrame, bits: int = 64) -> int:
    """How many hashes make an identifier that no two distinct chunks share.

    ``chunks`` has the column ``chunk``. Distinct texts are compared byte by byte, after
    a map-side combine, so a chunk in a third of all rows costs one row a task.
    """
    distinct = chunks.select("chunk").distinct()
    for width in range(1, 129):
        shared = (
            distinct.select(F.array(*_hashes(F.col("chunk"), width, bits)).alias("id"))
            .groupBy("id")
            .count()
            .filter("count > 1")
        )
        if shared.isEmpty():
            return width
    raise ValueError("chunks do not differ under 128 hashes")


def recipes(docs: DataFrame, bits: int = 64, **lengths: int) -> DataFrame:
    """doc_id, recipe (verified identifiers in order) and text_sha256 of every row."""
    texts = docs.select("doc_id", ascii_lower(text_of()).alias("text"))
    cut = texts.select("doc_id", "text", chunks_of(F.col("text"), **lengths).alias("chunks"))
    width = identifier_width(cut.select(F.explode("chunks").alias("chunk")), bits)
    identifiers = F.transform("chunks", lambda chunk: F.array(*_hashes(chunk, width, bits)))
    return cut.select("doc_id", F.flatten(identifiers).alias("recipe"), F.sha2("text", 256).alias("text_sha256"))


def exact_duplicates(docs: DataFrame, bits: int = 64, **lengths: int) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts (A-Z counts as a-z) the row with the largest doc_id stays.
    """
    numbered = recipes(docs, bits, **lengths).withColumn("row", F.monotonically_increasing_id())
    held = staged(numbered, "recipes")  # numbers are those that were written
    groups = held.groupBy("recipe").agg(F.max(F.struct("doc_id", "row")).alias("keep"), F.count("*").alias("group_size"))
    keep_id, keep_row = F.col("keep.doc_id").alias("keep_id"), F.col("keep.row").alias("keep_row")
    groups = staged(groups.select("recipe", keep_id, keep_row, "group_size"), "recipe-groups")
    # Both sides are tables, so a text of very many rows is split by the join, and rows stay single.
    return held.join(groups, "recipe").select(
        "doc_id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"), "text_sha256"
    )

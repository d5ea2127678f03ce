"""The corpus pipeline: documents through five text operators, each stage written and reread.

Language ID drops documents without a recognisable language, exact dedup and the n-gram
join leave one document of each group, mixing repeats and drops documents towards the
target weights of the sources, and the last stage encodes the mix. ``doc_id`` names a
document; rows that repeat doc_id and text are one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratingloom.llm import exact_dedup, language, mixing, ngram_join, sentence_pieces
from ratingloom.llm.common import BROADCAST_ROWS, ascii_lower, small, staged, table, text_of
from ratingloom.llm.queries import piece_model

#: Running text scores 0.45 and more, even a single word; unordered characters score below this.
LEAST_LANGUAGE_SCORE = 0.3


def _without(docs: DataFrame, removed: DataFrame) -> DataFrame:
    """``docs`` but for the ids in ``removed``; few of them are broadcast, so that no text moves."""
    removed = staged(removed.select(F.col("doc_id").alias("removed_id")), "removed")
    if removed.count() <= 10 * BROADCAST_ROWS:  # one number a row
        removed = F.broadcast(removed)
    return docs.join(removed, F.col("doc_id").eqNullSafe(F.col("removed_id")), "left_anti")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = docs.select(F.struct("*").alias("row"), "doc_id", "text")
    judged = language.predicted(rows, language.learn(docs))
    known = (F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= LEAST_LANGUAGE_SCORE)
    return judged.filter(known).select("row.*")


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    decisions = staged(exact_dedup.exact_duplicates(docs), "decisions")
    repeated = decisions.groupBy("doc_id").count().filter("count > 1")
    if repeated.isEmpty():
        return _without(docs, decisions.filter("NOT kept"))
    kept = decisions.filter("kept").select(F.col("doc_id").alias("kept_id"), "text_sha256")
    digest = F.sha2(ascii_lower(text_of()), 256)
    rows = docs.select(F.struct("*").alias("row"), "doc_id", digest.alias("digest")).dropDuplicates(["doc_id", "digest"])
    same = F.col("doc_id").eqNullSafe(F.col("kept_id")) & (F.col("digest") == F.col("text_sha256"))
    return rows.join(kept, same, "left_semi").select("row.*")


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component: the smallest by doc_id, null ids last, then by the digest of its text."""
    digest = F.md5(text_of())
    # The join sees each doc_id with its text as one name, so equal and null ids stay apart.
    name = F.struct(F.col("doc_id").isNull().alias("unnamed"), F.col("doc_id").alias("id"), digest.alias("digest"))
    decisions = staged(ngram_join.joined(docs.select(name.alias("doc_id"), "text")), "near-decisions")
    rows = docs.select(F.struct("*").alias("row"), "doc_id", digest.alias("digest"))
    if not decisions.groupBy("doc_id").count().filter("count > 1").isEmpty():
        rows = rows.dropDuplicates(["doc_id", "digest"])
    removed = staged(
        decisions.filter(~F.col("doc_id").eqNullSafe(F.col("component_id")))
        .select(F.col("doc_id.id").alias("removed_id"), F.col("doc_id.digest").alias("removed_digest"))
        .distinct(),
        "near-removed",
    )
    same = (F.col("digest") == F.col("removed_digest")) & F.col("doc_id").eqNullSafe(F.col("removed_id"))
    return rows.join(small(removed), same, "left_anti").select("row.*")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs, shard_column="to_shard").select(*(F.col(f"`{c}`") for c in docs.columns))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sentence_pieces.encoded(docs, sentence_pieces.Pieces.load(piece_model()))


STAGES = [
    ("language ID", language_id),
    ("exact dedup", exact),
    ("n-gram join", near),
    ("mixing", mix),
    ("SentencePiece", encode),
]

#: SQL expresses neither the profiles nor the encoding; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs

"""Ranked lexical search over a length-stratified index.

Documents of one normaliser ``m`` (a function of their length) form a stratum. Inside a
stratum a posting's impact depends on its tf alone, so postings are kept as lists of
documents by (stratum, term, tf) and the impact is worked out once a list. The largest tf
of a term in a stratum bounds what the term can add there, and the sum over the terms of
an item bounds every score of the stratum. A search goes by these bounds:

1. The documents that hold an item's rarest terms are scored in full. The k-th best of
   these scores is the item's threshold.
2. Strata whose bound stays below the threshold are not visited. In the others the terms
   of least bound, that together stay below half of it, are left closed; the lists of
   the rest are opened and give every document they name a partial score.
3. Where partial score and bound of the closed terms reach the threshold, the closed
   terms are looked up in the document itself.

Only what provably cannot be among the k best is left out, ties included, so results
are those of scoring everything.

The index is built where the documents lie: they are ranged by ``m`` once, and every
sorted run is inverted into lists of bounded length. Given the terms to be asked for, the
index holds their postings alone; counts of documents and terms always cover everything.

Defined results: null texts and texts without a term are no documents (N leaves them
out). Rows that repeat an id are documents of their own. Items of one id are one item
with the terms of all its rows; items without a term that occurs give no rows, nor does
an empty table. Very long texts are counted piece by piece. Equal scores rank by
ascending doc_id, a null id first. Other columns of either table are ignored.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratingloom.llm.common import BROADCAST_ROWS, UPPER, pieces, small, staged

#: Listed documents of an item.
TOP = 50
#: Documents that hold the rarest terms of an item are scored first, so many for each listed one.
SEEDS = 16
#: Items that are scored together against a run of a stratum, about.
ITEM_BLOCK = 256
#: Postings of one list, at most.
LIST = 4096

_PLAIN = frozenset(b"0123456789" + UPPER.encode() + UPPER.lower().encode() + bytes(range(128, 256)))
#: Maps A-Z to a-z and what no term holds to a space.
_FOLD = bytes((b + 32 if 65 <= b <= 90 else b) if b in _PLAIN else 32 for b in range(256))


def term_counts(text: str | None) -> Counter[bytes]:
    """How often every term stands in a text: runs of ASCII letters, digits and other than ASCII, A-Z folded."""
    found: Counter[bytes] = Counter()
    rest = b""
    for piece in pieces(text or ""):
        data = rest + piece.encode("utf-8", "surrogatepass").translate(_FOLD)
        cut = data.rfind(b" ") + 1  # a piece may end inside a term
        found.update(data[:cut].split())
        rest = data[cut:]
    if rest:
        found[rest] += 1
    return found


def _counted(docs: DataFrame, wanted: frozenset[bytes] | None) -> DataFrame:
    """``(doc_id, n, terms, tfs)``: length and term frequencies, those of the ``wanted`` terms if given."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    known = docs.sparkSession.sparkContext.broadcast(wanted)

    def count(batches):
        for batch in batches:
            lengths, terms, tfs = [], [], []
            for text in batch.column("text").to_pylist():
                found = term_counts(text)
                lengths.append(sum(found.values()))
                kept = found if known.value is None else found.keys() & known.value
                terms.append([term.decode("utf-8", "replace") for term in kept])
                tfs.append([found[term] for term in kept])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(lengths, pa.int64()),
                    pa.array(terms, pa.list_(pa.string())),
                    pa.array(tfs, pa.list_(pa.int64())),
                ],
                ["doc_id", "n", "terms", "tfs"],
            )

    schema = f"doc_id {kind}, n bigint, terms array<string>, tfs array<bigint>"
    return docs.select("doc_id", "text").mapInArrow(count, schema)


def _inverted(batches):
    """Lists ``(run, m, term, tf, rows)`` of runs of documents sorted by m; a run goes by its first row."""
    for batch in batches:
        lists = batch.column("terms")
        spelled = lists.flatten().dictionary_encode()
        code = spelled.indices.to_numpy(zero_copy_only=False)
        if not len(code):
            continue
        sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
        m, row = (np.repeat(batch.column(name).to_numpy(), sizes) for name in ("m", "row"))
        tf = batch.column("tfs").flatten().to_numpy()
        order = np.lexsort((row, tf, code, m))
        m, code, tf, row = m[order], code[order], tf[order], row[order]
        fresh = np.r_[True, (m[1:] != m[:-1]) | (code[1:] != code[:-1]) | (tf[1:] != tf[:-1])]
        place = np.arange(len(m)) - np.maximum.accumulate(np.where(fresh, np.arange(len(m)), 0))
        starts = np.flatnonzero(fresh | (place % LIST == 0))
        run = batch.column("row")[0].as_py()
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(len(starts), run, np.int64)),
                pa.array(m[starts]),
                spelled.dictionary.take(pa.array(code[starts])),
                pa.array(tf[starts]),
                pa.ListArray.from_arrays(pa.array(np.r_[starts, len(m)], pa.int32()), pa.array(row)),
            ],
            ["run", "m", "term", "tf", "rows"],
        )


def impact(tf: Column, m: Column) -> Column:
    """What an occurrence count is worth in a stratum, before the weight of the term."""
    return F.call_function("div", F.lit(1_000_000_000).cast("bigint") * tf, F.lit(1000) * tf + F.lit(20) * m)


@dataclass(frozen=True)
class Index:
    """Staged tables.

    ``documents``: row, doc_id, m, terms, tfs, ranged by m; ``postings``: run, m, term,
    tf, rows; ``strata``: m, term, max_tf, docs; ``words``: term, docs, weight.
    """

    documents: DataFrame
    postings: DataFrame
    strata: DataFrame
    words: DataFrame


def build(docs: DataFrame, terms: DataFrame | None = None) -> Index:
    """The index of every document; ``terms`` (``term``, distinct) names those that will be asked for.

    The names go to the tasks if they are few; more of them select postings by a join.
    """
    wanted = None
    if terms is not None and terms.count() <= BROADCAST_ROWS:
        wanted = frozenset(row.term.encode("utf-8") for row in terms.collect())
    counted = staged(_counted(docs, wanted), "term-counts").filter("n > 0")
    totals = counted.agg(F.count("*").alias("N"), F.sum("n").alias("L")).first()
    # 50 * n * N passes 64 bits on very large tables, so the product is a decimal; the quotient fits.
    product = F.lit(50) * F.col("n").cast("decimal(18,0)") * F.lit(totals.N).cast("decimal(16,0)")
    quotient = F.call_function("div", product, F.lit(totals.L or 1).cast("decimal(20,0)"))
    m = (F.lit(100 - 50).cast("bigint") + quotient.cast("bigint")).alias("m")
    spread = F.xxhash64("doc_id", "n", F.spark_partition_id())  # a stratum of many documents fills several runs
    ranged = counted.select("doc_id", m, "terms", "tfs", spread.alias("spread"))
    ranged = ranged.repartitionByRange("m", "spread").sortWithinPartitions("m").drop("spread")
    documents = staged(ranged.withColumn("row", F.monotonically_increasing_id()), "strata")
    postings = documents.select("m", "row", "terms", "tfs").mapInArrow(
        _inverted, "run bigint, m bigint, term string, tf bigint, rows array<bigint>"
    )
    if terms is not None and wanted is None:
        postings = postings.join(terms, "term", "left_semi")
    postings = staged(postings, "postings")
    sizes = F.size("rows").cast("bigint")
    strata = postings.groupBy("m", "term").agg(F.max("tf").alias("max_tf"), F.sum(sizes).alias("docs"))
    strata = staged(strata, "strata-terms")
    ratio = F.lit(2 * totals.N + 2).cast("double") / (2 * F.sum("docs") + 1).cast("double")
    weight = F.floor(F.lit(1000.0) * F.log(ratio)).cast("bigint")
    words = strata.groupBy("term").agg(F.sum("docs").alias("docs"), weight.alias("weight"))
    return Index(documents, postings, strata, staged(words, "words"))


def item_terms(items: DataFrame) -> DataFrame:
    """``(item_id, term)``, distinct: the terms of every item."""

    def spell(batches):
        for batch in batches:
            found = [[t.decode("utf-8", "replace") for t in term_counts(x)] for x in batch.column("text").to_pylist()]
            lists = pa.array(found, pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([batch.column("item_id"), lists], ["item_id", "terms"])

    kind = items.schema["item_id"].dataType.simpleString()
    spelled = items.select("item_id", "text").mapInArrow(spell, f"item_id {kind}, terms array<string>")
    return spelled.select("item_id", F.explode("terms").alias("term")).distinct()


def _thresholds(scores: DataFrame, k: int) -> DataFrame:
    """``(item, least)``: the k-th best of ``scores`` (item, row, score), if an item has as many."""
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), "row")
    ranked = scores.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k)
    return ranked.filter(F.col("place") == k).select("item", F.col("score").alias("least"))


def _seeds(index: Index, asked: DataFrame, wanted: int) -> DataFrame:
    """``(item, row, score)``: whole scores of documents that hold the rarest terms of an item, ``wanted`` or more."""
    rare = Window.partitionBy("item").orderBy("docs", "term").rowsBetween(Window.unboundedPreceding, -1)
    rarest = asked.withColumn("before", F.coalesce(F.sum("docs").over(rare), F.lit(0)))
    rarest = rarest.filter(F.col("before") < wanted).select("item", "term")
    rows = index.postings.select("term", "rows").join(small(staged(rarest, "rarest")), "term")
    rows = rows.select("item", F.explode("rows").alias("row")).distinct()
    rows = staged(rows.withColumn("score", F.lit(0).cast("bigint")), "seeds")
    whole = asked.groupBy("item").agg(F.collect_list(F.struct("term", "weight")).alias("closed"))
    return _completed(index, rows.join(whole, "item"))


def _completed(index: Index, met: DataFrame) -> DataFrame:
    """``(item, row, score)``: partial scores of ``met`` and what the terms in ``closed`` add in the document itself.

    Files of repeated terms are small next to what they hold, so their size must not make a join broadcast them.
    """
    held = index.documents.select("row", "m", F.map_from_arrays("terms", "tfs").alias("held"))
    both = met.join(held.hint("merge"), "row").select("item", "row", "m", "held", F.explode("closed").alias("one"))
    tf = F.element_at("held", F.col("one.term"))
    more = both.select("item", "row", "m", F.col("one.weight").alias("weight"), tf.alias("tf")).filter("tf IS NOT NULL")
    gain = F.col("weight") * impact(F.col("tf"), F.col("m"))
    more = more.groupBy("item", "row").agg(F.sum(gain).alias("score"))
    return met.select("item", "row", "score").unionByName(more).groupBy("item", "row").agg(F.sum("score").alias("score"))


_PARTIAL = pa.schema([("item", pa.int64()), ("m", pa.int64()), ("row", pa.int64()), ("score", pa.int64())])


def _partial_scores(lists: pa.Table, asked: pa.Table) -> pa.Table:
    """Partial scores of the documents of one stratum and run, where they and ``rest`` reach ``least``.

    ``lists`` are their postings, ``asked`` the opened terms of a block of items.
    """
    if not len(lists) or not len(asked):
        return _PARTIAL.empty_table()
    m = lists.column("m")[0].as_py()
    spelled = pc.unique(asked.column("term"))
    code = pc.index_in(lists.column("term"), spelled)
    lists = lists.append_column("code", code).filter(pc.is_valid(code)).sort_by("code")
    rows = lists.column("rows").combine_chunks()
    sizes = rows.value_lengths().to_numpy(zero_copy_only=False)
    tf = lists.column("tf").to_numpy()
    worth = np.repeat((1_000_000_000 * tf) // (1000 * tf + 20 * m), sizes)  # once a list
    row, place = np.unique(rows.flatten().to_numpy(), return_inverse=True)
    ends = np.searchsorted(np.repeat(lists.column("code").to_numpy(), sizes), np.arange(len(spelled) + 1))

    item, column = np.unique(asked.column("item").to_numpy(), return_inverse=True)
    wanted = pc.index_in(asked.column("term"), spelled).to_numpy()
    order = np.argsort(wanted, kind="stable")
    column_of, weight = column[order], asked.column("weight").to_numpy()[order]
    opened = np.searchsorted(wanted[order], np.arange(len(spelled) + 1))
    limit = np.zeros(len(item), np.int64)
    limit[column] = asked.column("least").to_numpy() - asked.column("rest").to_numpy()

    scores = np.zeros((len(row), len(item)), np.int64)
    for term in range(len(spelled)):
        by, to = slice(ends[term], ends[term + 1]), slice(opened[term], opened[term + 1])
        scores[np.ix_(place[by], column_of[to])] += worth[by, None] * weight[None, to]
    at, to = np.nonzero((scores > 0) & (scores >= limit))
    columns = [item[to], np.full(len(at), m, np.int64), row[at], scores[at, to]]
    return pa.table([pa.array(values) for values in columns], schema=_PARTIAL)


def search(index: Index, terms: DataFrame, k: int = TOP) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` best documents with a score above 0 of every item of ``terms``."""
    # Items go by a number of their own, so that a null id is an item like any other.
    items = staged(terms.select("item_id").distinct().withColumn("item", F.monotonically_increasing_id()), "items")
    asked = terms.join(items, terms.item_id.eqNullSafe(items.item_id)).select("item", "term")
    asked = asked.join(index.words.filter("weight > 0"), "term")
    asked = staged(asked, "asked")  # item, term, docs, weight

    least = staged(_thresholds(_seeds(index, asked, SEEDS * k), k), "least")

    # Terms by rising bound: what those up to here can add together in a document of the stratum.
    inside = Window.partitionBy("item", "m")
    rising = inside.orderBy("bound", "term").rowsBetween(Window.unboundedPreceding, 0)
    bound = F.col("weight") * impact(F.col("max_tf"), F.col("m"))
    bounds = index.strata.join(small(asked), "term").select("item", "m", "term", "weight", bound.alias("bound"))
    bounds = bounds.join(small(least), "item", "left").withColumn("least", F.coalesce("least", F.lit(1)))
    visited = bounds.withColumn("up_to", F.sum("bound").over(rising)).withColumn("all", F.sum("bound").over(inside))
    visited = visited.filter(F.col("all") >= F.col("least"))
    visited = visited.withColumn("opened", 2 * F.col("up_to") >= F.col("least"))
    rest = F.coalesce(F.max(F.when(~F.col("opened"), F.col("up_to"))).over(inside), F.lit(0))
    visited = staged(visited.withColumn("rest", rest).drop("up_to", "all", "bound"), "visited")

    # All postings of a document have one run and stratum, so partial scores are summed where these meet.
    blocks = -(-items.count() // ITEM_BLOCK) or 1
    block = F.pmod(F.xxhash64("item"), F.lit(blocks)).cast("int").alias("block")
    runs = staged(index.postings.select("run", "m").distinct(), "runs")
    opened = visited.filter("opened").select("item", "m", "term", "weight", "least", "rest", block)
    opened = opened.join(small(runs), "m").groupBy("run", "m", "block")
    lists = index.postings.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    partial = lists.groupBy("run", "m", "block").cogroup(opened)
    met = staged(partial.applyInArrow(_partial_scores, "item bigint, m bigint, row bigint, score bigint"), "met")
    closed = visited.filter("NOT opened").groupBy("item", "m")
    closed = closed.agg(F.collect_list(F.struct("term", "weight")).alias("closed"))
    met = met.join(closed.hint("merge"), ["item", "m"], "left").select("item", "row", "score", "closed")
    scores = _completed(index, met)
    scores = scores.filter("score > 0").join(index.documents.select("row", "doc_id"), "row")
    best = Window.partitionBy("item").orderBy(F.col("score").desc(), "doc_id", "row")
    ranked = scores.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.join(items, "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def ranked(docs: DataFrame, items: DataFrame, k: int = TOP) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` best of ``docs`` for every one of ``items`` (item_id, text)."""
    terms = staged(item_terms(items), "item-terms")
    return search(build(docs, terms.select("term").distinct()), terms, k)

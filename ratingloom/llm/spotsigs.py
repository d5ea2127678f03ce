"""Document fingerprints by SpotSigs.

A signature is a common word (an anchor) with the next two content words; the start of
a text counts as an anchor too. The fingerprint of a text is its set of signatures,
written in order, and two texts are as alike as the Jaccard coefficient of their sets.
Function words are everywhere in running text and hardly anywhere in menus and tables,
so a fingerprint follows the prose.

Defined results: null counts as empty. A text without words has the empty fingerprint;
two empty fingerprints are alike (1), an empty and another are not (0). Rows that share the
doc_id stand in the order of a hash of their texts; rows that repeat doc_id and text have
their equals as next, but for the last of them. A null doc_id stands last. Long texts are
taken whole. In the search over all documents a text without signatures is near to nothing
but its equals, and a null doc_id is a member like any other. Extra columns are ignored, an empty table gives an empty result, and a single
document is its own next. Text without spaces between words is one word.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ratingloom.llm.common import let, staged, text_of

#: Common words of English, German, French and Spanish that open a signature. (Fixed values.)
ANCHORS = (
    "a an and are as at be but by can did do does for from had has have he her his if in is it its not of on or "
    "she so that the their then there they this to was we were which will with would you "
    "aber als am auf aus bei das dem den der des die ein eine einen einer er es für im ist mit nach nicht sich sie "
    "sind über um und von vor war werden wie wird zu zum zur "
    "au aux avec ce cette dans de du elle en est et il ils je la le les leur mais ne nous ou par pas pour qui que "
    "sa ses son sont sur un une vous "
    "al como con del el ella ellos esta este ha la las lo los más no o para pero por se sin su sus una uno y"
).split()
CHAIN = 2
#: Equal rows that one row of the last step stands for, at most.
COPIES = 1 << 16
#: Documents are near from this many hundredths of likeness on.
NEAR = 75
_WORD_BREAK = r"[^\p{L}\p{N}]+"


def signatures(text: Column) -> Column:
    """The distinct signatures of a text, sorted: six characters of a base-64 digest each."""
    words = F.filter(F.split(F.lower(text), _WORD_BREAK), lambda word: word != "")
    is_anchor = lambda word: word.isin(ANCHORS)
    # The k-th anchor, at position i of the words, has i - k content words before it.
    parts = F.struct(
        words.alias("words"),
        F.filter(words, lambda word: ~is_anchor(word)).alias("content"),
        F.filter(
            F.transform(words, lambda word, i: F.when(is_anchor(word), i)), lambda i: i.isNotNull()
        ).alias("anchors"),
    )

    def all_of(part: Column) -> Column:
        def signature(anchor: Column, at: Column) -> Column:
            chain = F.array_join(F.slice(part["content"], at + 1, CHAIN), " ")
            return F.concat_ws(" ", anchor, chain)

        opening = F.when(F.size(part["words"]) > 0, F.array(signature(F.lit("^"), F.lit(0))))
        spots = F.transform(part["anchors"], lambda i, k: signature(F.get(part["words"], i), i - k))
        return F.concat(F.coalesce(opening, F.array().cast("array<string>")), spots)

    every = let(parts, all_of)
    digest = lambda s: F.substring(F.base64(F.unhex(F.substring(F.md5(s), 1, 18))), 1, 6)
    return F.array_sort(F.array_distinct(F.transform(every, digest)))


def fingerprint(text: Column) -> Column:
    return F.array_join(signatures(text), " ")


def likeness(one: Column, other: Column) -> Column:
    """Jaccard coefficient of two fingerprints; sets without a common element skip the union."""
    sets = F.struct(*(F.filter(F.split(x, " "), lambda s: s != "").alias(n) for x, n in ((one, "a"), (other, "b"))))
    sizes = let(
        sets, lambda s: F.struct(F.size(F.array_intersect(s["a"], s["b"])), F.size(s["a"]) + F.size(s["b"]))
    )
    share = let(sizes, lambda n: n["col1"].cast("double") / (n["col2"] - n["col1"]))
    return F.when(one == other, 1.0).when((one == "") | (other == ""), 0.0).otherwise(share)


def _in_order(keys: DataFrame) -> DataFrame:
    """``keys`` (doc_id, text_hash, n_chars) with the key of the next document, by descending doc_id.

    Ranges of keys are sorted side by side; only the first key of each range meets in one place.
    """
    order = [F.col("doc_id").desc_nulls_last(), F.col("text_hash")]
    ranges = staged(keys.repartitionByRange(*order).withColumn("range", F.spark_partition_id()), "ranges")
    within = W.partitionBy("range").orderBy(*order)
    ranges = (
        ranges.withColumn("next", F.lead(F.struct("doc_id", "text_hash")).over(within))
        .withColumn("place", F.row_number().over(within))
    )
    firsts = ranges.filter("place = 1").select("range", F.struct("doc_id", "text_hash").alias("first"))
    along = W.orderBy("range")
    firsts = firsts.select(
        "range",
        F.coalesce(
            F.lead("first").over(along),
            F.first("first").over(along.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)),
        ).alias("first_after"),
    )
    return ranges.join(F.broadcast(staged(firsts, "firsts")), "range").select(
        "doc_id", "text_hash", "n_chars", F.coalesce("next", "first_after").alias("next")
    )


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every document and of its edited text.

    doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.
    The edited text ends with the start of the next document in place of its own last third.
    Texts move once; of the next document only its first characters and fingerprint move on.
    """
    texts = docs.select("doc_id", text_of().alias("text")).withColumn("text_hash", F.xxhash64("text"))
    keys = texts.select("doc_id", "text_hash", F.char_length("text").cast("long").alias("n_chars"))
    counted = staged(keys.groupBy("doc_id", "text_hash", "n_chars").agg(F.count("*").alias("times")), "keys")
    ordered = _in_order(counted.drop("times")).withColumn("copies", F.lit(1).cast("long"))
    is_repeated = not counted.filter("times > 1").isEmpty()
    if is_repeated:
        texts = texts.dropDuplicates(["doc_id", "text_hash"])
        further = counted.filter("times > 1").select(
            "doc_id",
            "text_hash",
            "n_chars",
            F.struct("doc_id", "text_hash").alias("next"),
            (F.col("times") - 1).alias("copies"),
        )
        ordered = ordered.unionByName(further)
    order = staged(
        ordered.select(
            F.col("doc_id").alias("of_id"),
            F.col("text_hash").alias("of_hash"),
            "n_chars",
            "copies",
            F.col("next.doc_id").alias("next_id"),
            F.col("next.text_hash").alias("next_hash"),
        ),
        "order",
    )
    here = lambda i, h: F.col("doc_id").eqNullSafe(F.col(i)) & (F.col("text_hash") == F.col(h))
    starts = texts.join(order, here("next_id", "next_hash")).select(
        "of_id",
        "of_hash",
        "n_chars",
        "copies",
        F.expr("substring(text, 1, int(n_chars div 3))").alias("start"),
        fingerprint(F.col("text")).alias("next_fingerprint"),
    )
    both = texts.join(starts, here("of_id", "of_hash")).select(
        "doc_id",
        "n_chars",
        "copies",
        F.concat(F.expr("substring(text, 1, int(n_chars - n_chars div 3))"), "start").alias("edited"),
        fingerprint(F.col("text")).alias("fingerprint"),
        "next_fingerprint",
    )
    marked = both.select(
        "doc_id",
        "n_chars",
        "copies",
        F.sha2("edited", 256).alias("edited_sha256"),
        "fingerprint",
        fingerprint(F.col("edited")).alias("edited_fingerprint"),
        "next_fingerprint",
    )
    compared = marked.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        "fingerprint",
        "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
        "copies",
    )
    return _each(staged(compared, "compared")) if is_repeated else compared.drop("copies")


def _each(rows: DataFrame) -> DataFrame:
    """A row for each of the ``copies`` of every row, large numbers spread over tasks."""
    single, many = rows.filter("copies = 1").drop("copies"), rows.filter("copies > 1")
    parts = (
        many.withColumn("part", F.explode(F.expr(f"sequence(0L, (copies - 1) div {COPIES})")))
        .withColumn("copies", F.expr(f"least({COPIES}, copies - part * {COPIES})"))
        .repartition("doc_id", "edited_sha256", "part")
    )
    each = parts.withColumn("copy", F.explode(F.expr("sequence(1, copies)")))
    return single.unionByName(each.drop("part", "copy", "copies"))


def _ordered_sets(members: DataFrame) -> DataFrame:
    """class and set, rarest signature first, of every distinct set that is not empty."""
    sets = staged(
        members.groupBy("class").agg(F.first("set").alias("set")).filter(F.size("set") > 0), "signature-sets"
    )
    spots = sets.select("class", F.explode("set").alias("signature"))
    common = staged(spots.groupBy("signature").agg(F.count("*").alias("held")), "signature-counts")
    rarest = F.sort_array(F.collect_list(F.struct("held", "signature")))
    return spots.join(common, "signature").groupBy("class").agg(rarest["signature"].alias("set"))


def near_documents(docs: DataFrame, near: int = NEAR) -> tuple[DataFrame, DataFrame]:
    """All documents whose fingerprints are alike by ``near`` hundredths or more.

    Two tables: members (doc_id, class: documents of one class have one fingerprint) and
    pairs (a, b, shared, likeness) of different classes, each pair once.

    Sets are partitioned by length so that a set's partners are in its own partition or the
    one below. In a partition, sets meet by their rarest signatures only: sets that are near
    share one of their first n - ceil(near n) + 1. Pairs whose lengths differ too much, or
    whose signatures behind the common one are too few, go before the sets are compared.
    Classes are compared, not rows, so copies cost nothing; near but different texts are
    links of the result each.
    """
    signed = docs.select("doc_id", signatures(text_of()).alias("set"))
    signed = staged(signed.withColumn("class", F.md5(F.array_join("set", " "))), "signed")
    # A little wider than the ratio, so that rounding can't put partners two partitions apart.
    width = math.log(100 / near) * (1 + 1e-9) if near < 100 else 1.0
    sets = staged(
        _ordered_sets(signed)
        .withColumn("n", F.size("set").cast("long"))
        .withColumn("lengths", F.floor(F.ln("n") / width)),
        "ordered-sets",
    )
    prefix = F.expr(f"slice(set, 1, int(n - ({near} * n + 99) div 100 + 1))")
    index = staged(sets.select("class", "n", "lengths", F.posexplode(prefix).alias("place", "signature")), "signature-index")
    shorter = index.select(
        "lengths", "signature", F.col("class").alias("a"), F.col("n").alias("n_a"), F.col("place").alias("place_a")
    )
    longer = index.select(
        F.explode(F.array("lengths", F.col("lengths") - 1)).alias("lengths"),
        "signature",
        F.col("class").alias("b"),
        F.col("n").alias("n_b"),
        F.col("place").alias("place_b"),
    )
    still = 1 + F.least(F.col("n_a") - F.col("place_a") - 1, F.col("n_b") - F.col("place_b") - 1)
    met = (
        shorter.join(longer, ["lengths", "signature"])
        .filter("n_a < n_b OR (n_a = n_b AND a < b)")
        .filter(f"100 * n_a >= {near} * n_b")
        .filter((100 + near) * still >= near * (F.col("n_a") + F.col("n_b")))
        .select("a", "b")
        .distinct()
    )
    side = lambda name: sets.select(F.col("class").alias(name), F.col("set").alias(f"set_{name}"))
    shared = F.size(F.array_intersect("set_a", "set_b"))
    union = F.size("set_a") + F.size("set_b") - F.col("shared")
    pairs = (
        staged(met, "met")
        .join(side("a"), "a")
        .join(side("b"), "b")
        .withColumn("shared", shared.cast("long"))
        .withColumn("union", union)
        .filter(f"100 * shared >= {near} * union")
        .select("a", "b", "shared", (F.col("shared") / F.col("union")).alias("likeness"))
    )
    return signed.select("doc_id", "class"), pairs

"""Mixing sources to target weights by a hypergeometric splitting tree.

Each source has a target in words. Its documents stand in an order given by a hash of
their ids and texts and are cut into blocks of a few hundred. The blocks that reach the target,
whole passes first, form the source's quota; a tree splits the vector of quotas among
the output shards, halving the shards at each level and drawing the left half's share
from the multivariate hypergeometric distribution, so every shard is a fair sample of
the mix without looking at data. Blocks then go to shards by their number, and each
shard orders its rows by a hash.

Defined results: null or empty texts have no words and are never taken. Null sources
form one source, the last. Every row has a place and fate of its own, rows that share
the id or repeat each other included; repeated rows are interchangeable. Long texts are
hashed and counted whole. Other columns are ignored. An empty table gives an empty result. There is one row of the source table per source;
the sources are numbered in one task, which takes a few million of them.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ratingloom.llm.common import WORD, let, small, staged, text_of

#: Weights of the sources in order of their names, repeating.
WEIGHTS = (5, 2, 1)
#: The mix holds this share (a fraction) of all words; no source counts more than ``REPEAT`` times.
SHARE = (3, 2)
REPEAT = 2
#: A block holds some 2**BLOCK_BITS to 2**(BLOCK_BITS + 1) documents.
BLOCK_BITS = 8
#: Blocks whose sums one window task adds up, as a power of two.
FINE_BITS = 10
WORDS_PER_SHARD = 5_000_000
SEED = "mix"
KEY_BITS = 60
#: Repeated rows are numbered in so many parts.
PARTS = 4096


def _mark() -> Column:
    """What tells documents apart: doc_id and text."""
    return F.concat(F.lit(f"{SEED}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.md5(text_of()))


def _keyed(rows: DataFrame) -> DataFrame:
    """``rows`` (with source and mark) with a key of their own each, in place of the mark.

    Rows that repeat source, doc_id and text are numbered from 0, so which of them is which
    makes no difference. They are dealt into parts, numbered within each and shifted by the
    rows of the parts before, so a group of any size is spread over tasks.
    """
    same = F.concat("mark", F.coalesce(F.concat(F.lit(":"), "source"), F.lit("")))
    rows = rows.withColumn("same", same)
    repeated = staged(rows.groupBy("same").agg(F.count("*").alias("n")).filter("n > 1").select("same"), "mix-repeated")
    if repeated.isEmpty():
        numbered = rows.withColumn("nth", F.lit(0).cast("long"))
    else:
        repeated = small(repeated)
        part = F.monotonically_increasing_id() % PARTS
        many = staged(rows.join(repeated, "same", "left_semi").withColumn("part", part), "mix-copies")
        earlier = W.partitionBy("same").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
        parts = (
            many.groupBy("same", "part")
            .agg(F.count("*").alias("n"))
            .select("same", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
        )
        within = F.row_number().over(W.partitionBy("same", "part").orderBy("part")) - 1
        numbered = (
            many.withColumn("within", within)
            .join(parts, ["same", "part"])
            .withColumn("nth", F.col("before") + F.col("within"))
            .select(*rows.columns, "nth")
            .unionByName(rows.join(repeated, "same", "left_anti").withColumn("nth", F.lit(0).cast("long")))
        )
    digest = F.md5(F.concat("mark", F.lit(":"), F.col("nth").cast("string")))
    key = F.conv(F.substring(digest, 1, KEY_BITS // 4), 16, 10).cast("long")
    return numbered.withColumn("key", key).drop("mark", "same", "nth")


def _size() -> Column:
    return F.regexp_count(text_of(), F.lit(WORD)).cast("long")


def source_targets(sized: DataFrame) -> DataFrame:
    """source, ordinal, docs, words, target of every source in ``sized`` (source, size).

    Targets follow the weights. One that would pass ``REPEAT`` times its source stops
    there and the excess is shared anew; taken in order of words per weight, a source
    stops exactly if its share of what the earlier ones leave passes its limit.
    """
    share, of = SHARE
    everything = W.partitionBy()
    named = W.orderBy(F.col("source").asc_nulls_last())
    by_need = W.orderBy(F.col("words") / F.col("weight"), "ordinal").rowsBetween(W.unboundedPreceding, -1)
    weights = F.array(*map(F.lit, WEIGHTS))
    return (
        sized.groupBy("source")
        .agg(F.count("*").alias("docs"), F.sum("size").alias("words"))
        .withColumn("ordinal", F.row_number().over(named) - 1)
        .withColumn("weight", F.get(weights, F.col("ordinal") % len(WEIGHTS)).cast("long"))
        .withColumn("all_words", F.sum("words").over(everything))
        .withColumn("before", F.coalesce(F.sum("words").over(by_need), F.lit(0)))
        .withColumn("open", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(by_need), F.lit(0)))
        .withColumn(
            "stops",
            F.expr(f"{of * REPEAT} * words * open < weight * ({share} * all_words - {of * REPEAT} * before)"),
        )
        .withColumn("stopped", F.sum(F.when(F.col("stops"), F.col("words")).otherwise(0)).over(everything))
        .withColumn("sharing", F.sum(F.when(F.col("stops"), 0).otherwise(F.col("weight"))).over(everything))
        .withColumn(
            "target",
            F.when(F.col("stops"), F.lit(float(REPEAT)) * F.col("words")).otherwise(
                F.col("weight")
                * (F.lit(share / of) * F.col("all_words") - F.lit(float(REPEAT)) * F.col("stopped"))
                / F.col("sharing")
            ),
        )
        .select("source", "ordinal", "docs", "words", "target")
    )


def _cuts(sized: DataFrame, sources: DataFrame) -> DataFrame:
    """Where the last pass over each source ends: whole blocks before ``cut``, and ``picks`` within it.

    Sums run over blocks, in two levels of bounded length; only the block in which the
    target falls is looked at by document, largest first while they fit.
    """
    placed = sized.join(small(sources), sized.source.eqNullSafe(sources.source)).select(
        "ordinal", "size", "key", "rest", F.expr(f"shiftright(key, {KEY_BITS} - bits)").alias("block")
    )
    blocks = staged(placed.groupBy("ordinal", "rest", "block").agg(F.sum("size").alias("words")), "mix-blocks")
    blocks = blocks.withColumn("stretch", F.shiftright("block", FINE_BITS))
    until = lambda *keys: W.partitionBy("ordinal").orderBy(*keys)
    falls = (F.col("until") > F.col("rest")) & (F.col("until") - F.col("words") <= F.col("rest"))
    stretch = (
        blocks.groupBy("ordinal", "rest", "stretch")
        .agg(F.sum("words").alias("words"))
        .withColumn("until", F.sum("words").over(until("stretch")))
        .filter(falls)
        .select("ordinal", "stretch", (F.col("until") - F.col("words")).alias("before"))
    )
    cut = staged(
        blocks.join(stretch, ["ordinal", "stretch"])
        .withColumn("until", F.col("before") + F.sum("words").over(until("block")))
        .filter(falls)
        .select("ordinal", F.col("block").alias("cut"), (F.col("rest") - F.col("until") + F.col("words")).alias("gap")),
        "mix-cuts",
    )
    inside = placed.join(
        small(cut), (placed.ordinal == cut.ordinal) & (placed.block == cut.cut)
    ).select(cut.ordinal, "cut", "gap", (-F.col("size")).alias("lost"), "key")
    none = F.array().cast("array<bigint>")
    picks = F.aggregate(
        F.sort_array(F.collect_list(F.struct("lost", "key"))),
        F.struct(F.first("gap").alias("gap"), none.alias("picks")),
        lambda state, doc: F.when(
            (doc["lost"] < 0) & (state["gap"] + doc["lost"] >= 0),
            F.struct(
                (state["gap"] + doc["lost"]).alias("gap"), F.array_append(state["picks"], doc["key"]).alias("picks")
            ),
        ).otherwise(state),
        lambda state: state["picks"],
    )
    return inside.groupBy("ordinal", "cut").agg(picks.alias("picks"))


def _log_factorial(n: Column) -> Column:
    """ln n!, by Stirling's series at n + 8."""

    def series(x: Column) -> Column:
        product = x
        for i in range(1, 8):
            product = product * (x - i)
        return x * F.ln(x) - x + F.ln(x * (2 * math.pi)) / 2 + 1 / (x * 12) - 1 / (x * x * x * 360) - F.ln(product)

    return let(n + 8, series)


def _log_choices(n: Column, k: Column) -> Column:
    return _log_factorial(n) - _log_factorial(k) - _log_factorial(n - k)


def hypergeometric(u: Column, total: Column, marked: Column, drawn: Column) -> Column:
    """How many of ``drawn`` out of ``total`` are among the ``marked``, for a uniform ``u``.

    Inversion from the mode outwards: the values next to it are tried in turn, and what
    lies twenty standard deviations away is left out.
    """

    def limits(x: Column) -> Column:
        least = F.greatest(F.lit(0.0), x["drawn"] - (x["total"] - x["marked"]))
        most = F.least(x["drawn"], x["marked"])
        likely = F.floor((x["drawn"] + 1) * (x["marked"] + 1) / (x["total"] + 2)).cast("double")
        share = x["marked"] / F.greatest(x["total"], F.lit(1.0))
        return F.struct(
            *(x[c].alias(c) for c in ("u", "total", "marked", "drawn")),
            F.least(most, F.greatest(least, likely)).alias("mode"),
            F.greatest(likely - least, most - likely).alias("reach"),
            F.sqrt(x["drawn"] * share * (1 - share)).alias("spread"),
        )

    def inverted(x: Column) -> Column:
        marked, drawn, mode = x["marked"], x["drawn"], x["mode"]
        others = x["total"] - marked

        def step(state: Column, i: Column) -> Column:
            k, j = mode + i - 1, mode - i + 1
            up = state["up"] * (marked - k) * (drawn - k) / ((k + 1) * (others - drawn + k + 1))
            down = state["down"] * j * (others - drawn + j) / ((marked - j + 1) * (drawn - j + 1))
            tried = let(
                F.struct(up.alias("up"), down.alias("down")),
                lambda p: F.struct(
                    (state["left"] - p["up"] - p["down"]).alias("left"),
                    p["up"].alias("up"),
                    p["down"].alias("down"),
                    F.when(state["left"] < p["up"], mode + i)
                    .when(state["left"] < p["up"] + p["down"], mode - i)
                    .alias("found"),
                ),
            )
            return F.when((i == 0) | state["found"].isNotNull(), state).otherwise(tried)

        chance = F.exp(
            _log_choices(marked, mode) + _log_choices(others, drawn - mode) - _log_choices(x["total"], drawn)
        )
        start = let(
            chance,
            lambda p: F.struct(
                (x["u"] - p).alias("left"), p.alias("up"), p.alias("down"), F.when(x["u"] < p, mode).alias("found")
            ),
        )
        reach = F.least(x["reach"], F.ceil(x["spread"] * 20) + 20).cast("int")
        return F.aggregate(
            F.sequence(F.lit(0), F.greatest(reach, F.lit(0))),
            start,
            step,
            lambda state: F.coalesce(state["found"], mode).cast("long"),
        )

    numbers = (("u", u), ("total", total), ("marked", marked), ("drawn", drawn))
    given = F.struct(*(x.cast("double").alias(name) for name, x in numbers))
    return let(let(given, limits), inverted)


def splitting_tree(quotas: DataFrame, shards: int) -> DataFrame:
    """shard and quotas of every shard, from one row with the array ``quotas``.

    Quotas of a node are kept by its children exactly; shards get equal numbers of
    blocks but for rounding.
    """
    nodes = quotas.select(F.lit(0).cast("long").alias("lo"), F.lit(shards).cast("long").alias("hi"), "quotas")
    for level in range(max(0, shards - 1).bit_length()):
        if level == 8:
            nodes = nodes.repartition("lo")
        inner = F.col("hi") - F.col("lo") > 1
        mid = F.expr("(lo + hi) div 2")
        held = F.aggregate("quotas", F.lit(0).cast("long"), lambda a, b: a + b)
        share = F.round(held * (mid - F.col("lo")) / (F.col("hi") - F.col("lo"))).cast("long")

        def draw(state: Column, i: Column) -> Column:
            marked = F.get("quotas", i)
            u = F.shiftrightunsigned(F.xxhash64(F.lit(SEED), "lo", "hi", i), 11) * F.lit(2.0**-53)
            return let(
                hypergeometric(u, state["total"], marked, state["left"]),
                lambda taken: F.struct(
                    (state["total"] - marked).alias("total"),
                    (state["left"] - taken).alias("left"),
                    F.array_append(state["out"], taken).alias("out"),
                ),
            )

        left = F.aggregate(
            F.sequence(F.lit(0), F.size("quotas") - 1),
            F.struct(held.alias("total"), share.alias("left"), F.array().cast("array<bigint>").alias("out")),
            draw,
            lambda state: state["out"],
        )
        nodes = nodes.select("lo", "hi", "quotas", F.when(inner, left).alias("left"))
        halves = F.array(
            F.struct("lo", mid.alias("hi"), F.col("left").alias("quotas")),
            F.struct(mid.alias("lo"), "hi", F.zip_with("quotas", "left", lambda a, b: a - b).alias("quotas")),
        )
        whole = F.array(F.struct("lo", "hi", "quotas"))
        nodes = nodes.select(F.explode(F.when(inner, halves).otherwise(whole)).alias("node")).select("node.*")
    return nodes.select(F.col("lo").alias("shard"), "quotas")


def _plan(docs: DataFrame, words_per_shard: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The sized documents, the sources with their cuts, and the blocks with the shards that draw them."""
    rows = staged(docs.select("doc_id", "source", _size().alias("size"), _mark().alias("mark")), "mix-marks")
    sized = staged(_keyed(rows), "mix-sizes")
    full = F.when(F.col("words") > 0, F.least(F.floor(F.col("target") / F.col("words")), F.lit(REPEAT))).otherwise(0)
    targets = staged(
        source_targets(sized)
        .withColumn("full", full.cast("long"))
        .withColumn("rest", F.greatest(F.lit(0.0), F.col("target") - F.col("full") * F.col("words")))
        .withColumn("bits", F.length(F.bin(F.shiftright("docs", BLOCK_BITS))) - 1),
        "mix-targets",
    )
    cuts = _cuts(sized, targets)
    none = F.array().cast("array<bigint>")
    sources = staged(
        targets.join(cuts, "ordinal", "left")
        .withColumn("blocks", F.expr("shiftleft(1L, bits)"))
        .withColumn("picks", F.coalesce("picks", none))
        .withColumn("cut", F.when(F.col("rest") <= 0, 0).otherwise(F.coalesce("cut", "blocks")))
        .withColumn("quota", F.expr("full * blocks + cut + least(size(picks), 1)")),
        "mix-sources",
    )
    # The mix holds SHARE of all words; without any there is one shard.
    words = sources.agg(F.sum("target")).first()[0] or 0.0
    shards = max(1, math.ceil(words / words_per_shard))
    quotas = sources.agg(F.array_sort(F.collect_list(F.struct("ordinal", "quota"))).alias("pairs")).select(
        F.col("pairs.quota").alias("quotas")
    )
    quotas = quotas.filter(F.size("quotas") > 0)
    shares = splitting_tree(quotas, shards).select("shard", F.posexplode("quotas").alias("ordinal", "n"))
    upto = F.sum("n").over(W.partitionBy("ordinal").orderBy("shard"))
    drawn = (
        shares.withColumn("end", upto)
        .filter("n > 0")
        .select("ordinal", "shard", F.explode(F.expr("sequence(end - n, end - 1)")).alias("instance"))
        .join(small(sources.select("ordinal", "blocks")), "ordinal")
        .groupBy("ordinal", F.expr("instance % blocks").alias("block"))
        .agg(F.collect_list(F.struct(F.expr("instance div blocks").alias("pass"), "shard")).alias("draws"))
    )
    return sized, sources, staged(drawn, "mix-draws")


def _drawn(rows: DataFrame, sources: DataFrame, draws: DataFrame) -> DataFrame:
    """``rows`` (with source, key, size) and the shards that take each, one entry per copy."""
    placed = rows.join(small(sources.withColumnRenamed("source", "named")), F.col("source").eqNullSafe(F.col("named")))
    placed = placed.withColumn("block", F.expr(f"shiftright(key, {KEY_BITS} - bits)"))
    taken = F.filter(
        "draws",
        lambda draw: (F.col("size") > 0)
        & (
            (draw["pass"] < F.col("full"))
            | (F.col("block") < F.col("cut"))
            | F.array_contains(F.col("picks"), F.col("key"))
        ),
    )
    none = F.array().cast("array<struct<pass:bigint,shard:bigint>>")
    return placed.join(small(draws), ["ordinal", "block"], "left").withColumn("copies", F.coalesce(taken, none))


def mix_counts(docs: DataFrame, words_per_shard: int = WORDS_PER_SHARD) -> DataFrame:
    """doc_id, size, source_size, target, taken of every document."""
    sized, sources, draws = _plan(docs, words_per_shard)
    return _drawn(sized, sources, draws).select(
        "doc_id",
        "size",
        F.col("words").alias("source_size"),
        "target",
        (F.col("size") * F.size("copies")).alias("taken"),
    )


def mixed(docs: DataFrame, words_per_shard: int = WORDS_PER_SHARD, shard_column: str = "shard") -> DataFrame:
    """The mix itself: a row for each copy of a document, with its shard, in the shard's order."""
    _, sources, draws = _plan(docs, words_per_shard)
    rows = docs.select(F.struct("*").alias("row"), "source", _size().alias("size"), _mark().alias("mark"))
    copies = _drawn(_keyed(rows), sources, draws).select("row", "key", F.explode("copies").alias("copy"))
    order = F.xxhash64(F.lit(SEED), "copy.shard", "copy.pass", "key")
    return (
        copies.select("row", F.col("copy.shard").alias("to_shard"), order.alias("place"))
        .repartition("to_shard")
        .sortWithinPartitions("to_shard", "place")
        .select("row.*", F.col("to_shard").alias(shard_column))
    )

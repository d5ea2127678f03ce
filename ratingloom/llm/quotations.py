"""Chat formatting by quotation linking.

A message may quote others: lines led by one or more ``>``. Each line's quote level is
parsed. The passages of a message are its lines and its sentences; a sentence runs on over
adjacent lines of one level, so a quote that was wrapped anew still holds it. Passages are
normalised, hashed and joined to the message of the same conversation that said them first
and unquoted. The message that said most of the first-level passages is the one replied to.
Following replies upwards, by jumps that double, gives each message its thread (the turn at
its root) and its depth there. Conversations come out without quotes, in reply order: thread
by thread, and within a thread by turn, so that a message follows what it answers.

Defined results: null texts count as empty. A message does not quote itself or a later
one. Messages with equal conv_id and turn are parsed each for itself but share their
links; null conv_id or turn are not linked to anything. Lines without letters or digits
are not linked and end a sentence. Attribution lines directly above a quote ("... wrote:")
go with the quote. Of messages that said equally many passages the later is the parent. Long
texts are parsed whole, in time that grows with their length. Extra columns are ignored, and
an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratingloom.llm.common import let, staged, text_of

#: The marks that lead a quoted line.
MARKS = r"^\s{0,3}((?:>\s?)+)"
ATTRIBUTION = r"(?i)^.{0,200}\b(wrote|schrieb|a écrit|escribió)\s*:\s*$"
#: The end of a sentence.
STOP = r"[.!?]+(?:[ \t]|\z)"
_RUN, _LEVEL = "\x01", "\x02"


def _parsed(text: Column) -> Column:
    """level and body of every line of a text."""

    def line(raw: Column) -> Column:
        marks = F.regexp_extract(raw, MARKS, 1)
        return F.struct(
            F.length(F.translate(marks, " \t", "")).alias("level"),
            F.regexp_replace(raw, MARKS, "").alias("body"),
        )

    lines = F.transform(F.split(text, "\r\n|\r|\n"), line)

    def attributed(lines: Column) -> Column:
        def level(line: Column, i: Column) -> Column:
            below = F.get(lines, i + 1)["level"]
            heads = F.coalesce((below > line["level"]) & line["body"].rlike(ATTRIBUTION), F.lit(False))
            return F.struct(
                F.when(heads, below).otherwise(line["level"]).alias("level"), line["body"].alias("body"), heads.alias("head")
            )

        return F.transform(lines, level)

    return let(lines, attributed)


def normalised(body: Column) -> Column:
    """A line as it is compared: lower case, runs of anything but letters and digits as one space."""
    return F.trim(F.regexp_replace(F.lower(body), r"[^\p{L}\p{N}]+", " "))


def _sentences(lines: Column) -> Column:
    """level and said of every sentence. Adjacent lines of one level are put together first."""
    filled = lambda line: ~line["head"] & line["body"].rlike(r"[\p{L}\p{N}]")

    def opened(line: Column, i: Column) -> Column:
        before = F.get(lines, i - 1)
        goes_on = filled(line) & filled(before) & (before["level"] == line["level"])
        body = F.when(line["head"], "").otherwise(F.translate(line["body"], _RUN + _LEVEL, "  "))
        opening = F.concat(F.lit(_RUN), line["level"].cast("string"), F.lit(_LEVEL))
        return F.concat(F.when(goes_on, " ").otherwise(opening), body)

    def of_run(run: Column) -> Column:
        level = F.substring_index(run, _LEVEL, 1).cast("int")
        return F.transform(
            F.split(F.substring_index(run, _LEVEL, -1), STOP),
            lambda sentence: F.struct(level.alias("level"), normalised(sentence).alias("said")),
        )

    runs = F.filter(F.split(F.array_join(F.transform(lines, opened), ""), _RUN), lambda run: run != "")
    return F.flatten(F.transform(runs, of_run))


def _threads(replies: DataFrame) -> DataFrame:
    """conv_id, turn, thread and depth of every reply in ``replies`` (conv_id, turn, up).

    Each round joins what a reply answers to what that answers, so a chain of n replies
    takes log n rounds.
    """
    at = staged(replies.select("conv_id", "turn", "up", F.lit(1).cast("long").alias("depth")), "replies")
    while True:
        above = at.select("conv_id", F.col("turn").alias("up"), F.col("up").alias("higher"), F.col("depth").alias("more"))
        at = staged(
            at.join(above, ["conv_id", "up"], "left").select(
                "conv_id",
                "turn",
                F.coalesce("higher", "up").alias("up"),
                (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"),
                F.col("higher").isNotNull().alias("moved"),
            ),
            "replies",
        )
        if at.filter("moved").isEmpty():
            return at.select("conv_id", "turn", F.col("up").alias("thread"), "depth")


def linked(messages: DataFrame) -> DataFrame:
    """One row per message, in reply order.

    conv_id, turn, role, text (without quotes), quote_levels (depth of the deepest quote),
    quoted_lines, linked_lines (of these, found in an earlier message), linked_passages (lines
    and sentences found there), parent_turn (the message replied to, null without a linked
    first-level quote), quoted_turns (all earlier messages quoted at any level, ascending),
    thread (the turn at the root of its replies), depth (replies up to there).
    """
    parsed = staged(
        messages.select("conv_id", "turn", "role", _parsed(text_of()).alias("lines")), "parsed-messages"
    )
    lines = parsed.select("conv_id", "turn", F.explode("lines").alias("line")).filter("NOT line.head").select(
        "conv_id", "turn", "line.level", normalised(F.col("line.body")).alias("said"), F.lit(True).alias("is_line")
    )
    sentences = parsed.select("conv_id", "turn", F.explode(_sentences(F.col("lines"))).alias("sentence")).select(
        "conv_id", "turn", "sentence.*", F.lit(False).alias("is_line")
    )
    # A hash of 128 bits stands for a passage from here on.
    passages = (
        lines.unionByName(sentences)
        .filter("said <> ''")
        .select("conv_id", "turn", "level", F.md5("said").alias("passage"), "is_line")
    )
    origins = staged(
        passages.filter("level = 0").groupBy("conv_id", "passage").agg(F.min("turn").alias("origin")), "origins"
    )
    # What is a line and a sentence as well counts once each time.
    quotes = staged(
        passages.filter("level > 0")
        .groupBy("conv_id", "turn", "level", "passage")
        .agg(F.count_if("is_line").alias("lines"), F.count_if(~F.col("is_line")).alias("sentences")),
        "quotes",
    ).withColumn("times", F.greatest("lines", "sentences"))
    found = (
        quotes.join(origins, ["conv_id", "passage"])
        .filter("origin < turn")
        .groupBy("conv_id", "turn", "origin")
        .agg(
            F.sum("lines").alias("lines"),
            F.sum("times").alias("times"),
            F.sum(F.when(F.col("level") == 1, F.col("times")).otherwise(0)).alias("direct"),
        )
    )
    links = staged(
        found.groupBy("conv_id", "turn").agg(
            F.sum("lines").alias("linked_lines"),
            F.sum("times").alias("linked_passages"),
            F.max(F.when(F.col("direct") > 0, F.struct("direct", "origin"))).alias("parent"),
            F.sort_array(F.collect_set("origin")).alias("quoted_turns"),
        ),
        "links",
    )
    threads = _threads(links.filter("parent IS NOT NULL").select("conv_id", "turn", F.col("parent.origin").alias("up")))
    own = F.array_join(
        F.transform(F.filter("lines", lambda line: line["level"] == 0), lambda line: line["body"]), "\n"
    )
    quoted = F.filter("lines", lambda line: (line["level"] > 0) & ~line["head"] & (normalised(line["body"]) != ""))
    return (
        parsed.join(links, ["conv_id", "turn"], "left")
        .join(threads, ["conv_id", "turn"], "left")
        .select(
            "conv_id",
            "turn",
            "role",
            F.regexp_replace(own, r"^\s*\n|\s+$", "").alias("text"),
            F.array_max(F.transform("lines", lambda line: line["level"])).alias("quote_levels"),
            F.size(quoted).cast("long").alias("quoted_lines"),
            F.coalesce("linked_lines", F.lit(0)).cast("long").alias("linked_lines"),
            F.coalesce("linked_passages", F.lit(0)).cast("long").alias("linked_passages"),
            F.col("parent.origin").alias("parent_turn"),
            F.coalesce("quoted_turns", F.array().cast("array<bigint>")).alias("quoted_turns"),
            F.coalesce("thread", "turn").alias("thread"),
            F.coalesce("depth", F.lit(0)).cast("long").alias("depth"),
        )
        .repartitionByRange("conv_id", "thread", "turn")
        .sortWithinPartitions("conv_id", "thread", "turn")
    )

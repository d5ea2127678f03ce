"""URL filtering by fixed rules and mined association rules.

Fixed rules (host, path) decide the URLs they fit; those verdicts are the labels. FP-growth
mines combinations of URL tokens that go with a verdict, rules below a support or confidence
or no better than a shorter one are pruned, and what is left judges the URLs that no fixed
rule fits: an inverted index from each mined rule's rarest token finds the rules that may
fit, and the most confident of those that do wins. Without one the default stands.

Mining counts all tokens of all labelled URLs. Tokens that are too rare for a rule, or decide
alone (every URL with them has one verdict), are in no longer rule that would stay, so
FP-growth goes without them. Where a URL has more than ``MINED_TOKENS`` others, all
combinations would be too many, and rules grow token by token instead, only from
combinations that are rarer than each of their parts; this finds the same rules.

Defined results: a null URL, and one without ``://``, has empty host and path, no rule and
the default verdict. Equal URLs are judged once and get equal verdicts. An empty table
gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratingloom.llm.common import ascii_lower, small, staged

#: (verdict, host, path); a rule fits its host and all subdomains, and paths that start with its own.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
DEFAULT = "allow"
SUPPORT, CONFIDENCE = 0.002, 0.8
#: Up to so many undecided tokens of one URL FP-growth may combine; above, rules grow token by token.
MINED_TOKENS = 12


def parsed(url: Column) -> tuple[Column, Column]:
    """Host (A-Z in lower case) and path of a URL."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.expr("substring(url, locate('://', url) + 3)")).otherwise("")
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return ascii_lower(host), path


def _fixed(rules, what) -> Column:
    """``what`` of the longest rule that fits host and path, else null."""
    chain = None
    for rule in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r)):
        _, host, path = rule
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        value = F.lit(what(rule))
        chain = F.when(fits, value) if chain is None else chain.when(fits, value)
    return chain if chain is not None else F.lit(None).cast("string")


def tokens() -> Column:
    """What a URL is made of: labels of its host from the right, segments of its path by place."""
    labels = F.transform(
        F.reverse(F.split("host", r"\.")), lambda label, i: F.concat(F.lit("h"), F.least(i, F.lit(3)), F.lit(":"), label)
    )
    segments = F.transform(
        F.filter(F.split("path", "/"), lambda s: s != ""),
        lambda s, i: F.concat(F.lit("p"), F.least(i, F.lit(3)), F.lit(":"), s),
    )
    return F.array_distinct(F.concat(F.filter(labels, lambda t: ~t.endswith(":")), segments))


def _counted(parts: DataFrame, labels: int, support: float) -> DataFrame:
    """freq, verdicts (of support enough, with their n) and decides of every ``part`` (with verdict and n)."""
    enough = F.filter("by", lambda x: x["n"] >= support * labels)
    return (
        parts.groupBy("part", "verdict")
        .agg(F.sum("n").alias("n"))
        .groupBy("part")
        .agg(F.sum("n").alias("freq"), F.collect_list(F.struct("verdict", "n")).alias("by"))
        .select("part", "freq", enough.alias("verdicts"), (F.size("by") == 1).alias("decides"))
        .filter(F.size("verdicts") > 0)
    )


def _rules(counted: DataFrame, labels: int, confidence: float) -> DataFrame:
    return counted.select("part", "freq", F.explode("verdicts").alias("v")).select(
        F.col("part").alias("antecedent"),
        "v.verdict",
        (F.col("v.n") / F.col("freq")).alias("confidence"),
        (F.col("v.n") / F.lit(labels)).alias("support"),
    ).filter(F.col("confidence") >= confidence)


def _grown(baskets: DataFrame, singles: DataFrame, labels: int, support: float, confidence: float) -> DataFrame:
    """Rules of two tokens and more from baskets (id, items, verdict, n), level by level.

    A combination stays only if every part of it, one token shorter, stayed, does not decide
    alone and is more frequent: else a shorter rule is as confident.
    """
    kept = singles.select("part", "freq")
    held = baskets.select("id", "items", "verdict", "n", F.explode(F.transform("items", lambda t: F.array(t))).alias("part"))
    rules = []
    while True:
        more = F.filter("items", lambda t: t > F.element_at("part", -1))
        grown = held.withColumn("token", F.explode(more)).withColumn("part", F.array_append("part", F.col("token"))).drop("token")
        counted = staged(_counted(grown.select("part", "verdict", "n"), labels, support), "url-level")
        shorter = kept.select(F.col("part").alias("shorter"), F.col("freq").alias("most"))
        counted = staged(
            counted.withColumn("shorter", F.explode(F.transform("part", lambda t: F.array_remove("part", t))))
            .join(small(shorter), "shorter")
            .filter("freq < most")
            .groupBy("part", "freq", "verdicts", "decides")
            .count()
            .filter(F.col("count") == F.size("part"))
            .drop("count"),
            "url-kept",
        )
        rules.append(_rules(counted, labels, confidence))
        kept = staged(counted.filter("NOT decides").select("part", "freq"), "url-open")
        if kept.isEmpty():
            return reduce(DataFrame.union, rules)
        held = staged(grown.join(small(kept.select("part")), "part", "left_semi").select(*held.columns), "url-held")


def mined_rules(labelled: DataFrame, support: float = SUPPORT, confidence: float = CONFIDENCE) -> DataFrame:
    """antecedent (tokens, sorted), verdict, confidence, support, rarest token, from tokens and verdict.

    A rule stays if every rule of its verdict over fewer of its tokens is less confident.
    """
    labels = labelled.count()
    one = F.lit(1).cast("long").alias("n")
    tokens_of = labelled.select(F.explode("tokens").alias("token"), "verdict").select(
        F.array("token").alias("part"), "verdict", one
    )
    singles = staged(_counted(tokens_of, labels, support), "url-tokens")
    alone = _rules(singles, labels, confidence)
    undecided = staged(singles.filter("NOT decides"), "url-undecided")
    # Equal baskets are one with a count; a URL without undecided tokens needs none.
    keyed = labelled.select(F.xxhash64("url").alias("at"), "url", "verdict", F.explode("tokens").alias("token"))
    baskets = staged(
        keyed.join(small(undecided.select(F.col("part")[0].alias("token"))), "token")
        .groupBy("at", "url", "verdict")
        .agg(F.array_sort(F.collect_list("token")).alias("items"))
        .groupBy("items", "verdict")
        .agg(F.count("*").alias("n"))
        .withColumn("id", F.xxhash64("items", "verdict")),
        "url-baskets",
    )
    longest = baskets.agg(F.max(F.size("items"))).first()[0] or 0
    if longest > MINED_TOKENS:
        longer = _grown(baskets, undecided, labels, support, confidence)
    elif longest > 1:
        verdict = F.concat(F.lit("verdict:"), "verdict")
        # One basket for each label: supports are shares of all labels.
        items = baskets.select(
            F.explode(F.sequence(F.lit(1).cast("long"), "n")), F.array_append("items", verdict).alias("items")
        ).select("items")
        rest = labels - items.count()
        empty = labelled.sparkSession.range(rest).select(F.array().cast("array<string>").alias("items"))
        model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=confidence).fit(items.union(empty))
        longer = (
            model.associationRules.filter(F.col("consequent")[0].startswith("verdict:"))
            .filter(~F.exists("antecedent", lambda t: t.startswith("verdict:")))
            .filter(F.size("antecedent") > 1)
            .select(
                F.array_sort("antecedent").alias("antecedent"),
                F.substring(F.col("consequent")[0], len("verdict:") + 1, 1000).alias("verdict"),
                "confidence",
                "support",
            )
        )
    else:
        longer = alone.limit(0)
    rules = staged(alone.union(longer), "rules")
    # A shorter rule shares a token with the longer.
    longer = rules.select(
        F.col("antecedent").alias("own"), "verdict", F.col("confidence").alias("own_confidence"),
        F.explode("antecedent").alias("token"),
    )
    shorter = rules.select(
        F.col("antecedent").alias("part"), "verdict", "confidence", F.col("antecedent")[0].alias("token")
    )
    beaten = (
        longer.join(shorter, ["token", "verdict"])
        .filter("size(part) < size(own) AND confidence >= own_confidence AND size(array_except(part, own)) = 0")
        .select(F.col("own").alias("antecedent"), "verdict")
        .distinct()
    )
    best = rules.join(beaten, ["antecedent", "verdict"], "left_anti")
    rarest = (
        best.withColumn("token", F.explode("antecedent"))
        .join(singles.select(F.col("part")[0].alias("token"), "freq"), "token")
        .groupBy("antecedent", "verdict", "confidence", "support")
        .agg(F.min(F.struct("freq", "token")).alias("rarest"))
    )
    return rarest.select("antecedent", "verdict", "confidence", "support", F.col("rarest.token").alias("token"))


def judged_urls(urls: DataFrame, rules=RULES, support: float = SUPPORT, confidence: float = CONFIDENCE) -> DataFrame:
    """url, host, path, rule, verdict, mined of every distinct ``url``; ``mined`` is the mined rule that decided."""
    host, path = parsed(F.col("url"))
    known = staged(
        urls.select(F.coalesce("url", F.lit("")).alias("url"))
        .distinct()
        .select("url", host.alias("host"), path.alias("path"))
        .withColumn("rule", _fixed(rules, lambda r: r[1] + r[2]))
        .withColumn("fixed", _fixed(rules, lambda r: r[0]))
        .withColumn("tokens", tokens()),
        "urls",
    )
    labelled = known.filter("fixed IS NOT NULL").withColumn("verdict", F.col("fixed"))
    if labelled.isEmpty():
        return known.select("url", "host", "path", "rule", F.lit(DEFAULT).alias("verdict"), _no_rule().alias("mined"))
    index = staged(mined_rules(labelled, support, confidence), "index")
    open_urls = known.filter("fixed IS NULL").select("url", "tokens", F.explode("tokens").alias("token"))
    order = F.struct(
        "confidence", "support", (-F.size("antecedent")).alias("length"), "verdict", "antecedent"
    )
    decided = (
        open_urls.join(small(index), "token")
        .filter(F.size(F.array_except("antecedent", "tokens")) == 0)
        .groupBy("url")
        .agg(F.max(order).alias("best"))
        .select(F.col("url"), F.col("best.verdict").alias("by_method"), F.col("best.antecedent").alias("mined"))
    )
    return known.join(staged(decided, "decided"), "url", "left").select(
        "url",
        "host",
        "path",
        "rule",
        F.coalesce("fixed", "by_method", F.lit(DEFAULT)).alias("verdict"),
        "mined",
    )


def _no_rule() -> Column:
    return F.lit(None).cast("array<string>")


def judged(pages: DataFrame, **options) -> DataFrame:
    """page_id, host, path, rule, verdict, mined of every page."""
    verdicts = staged(judged_urls(pages, **options), "verdicts")
    keyed = pages.select("page_id", F.coalesce("url", F.lit("")).alias("url"))
    return keyed.join(verdicts, "url").select("page_id", "host", "path", "rule", "verdict", "mined")

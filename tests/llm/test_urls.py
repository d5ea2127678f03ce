from itertools import combinations

from pyspark.sql import functions as F

from ratingloom.llm import urls

PAGES = (
    [(i, f"https://spam{i % 3}.example.net/shop/item{i}?x=1") for i in range(30)]
    + [(100 + i, f"http://www.a{i % 5}.com/de/shop/{i}") for i in range(20)]
    + [(200 + i, f"http://b{i % 5}.org/en/{i % 12}") for i in range(20)]
    + [
        (300, "HTTP://Www.EXAMPLE.org/es/x#y"),
        (301, "http://example.org"),
        (302, "http://notexample.org/es/"),
        (303, "http://sub.example.org/en/123"),
        (304, "http://x.com/FR/"),
        (305, None),
        (306, "no scheme"),
        (307, ""),
        (None, "http://a.org/"),
        (308, "a://b://c/d"),
        (309, "http://" + "l." * 300 + "com/" + "s/" * 300),
        (310, "http://x.org?q=/es/"),
        (300, "HTTP://Www.EXAMPLE.org/es/x#y"),
    ]
)


def parse(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
    tail = rest[cut:]
    end = min([tail.index(c) for c in "?#" if c in tail], default=len(tail))
    return rest[:cut].lower(), tail[:end]


def fixed(host, path):
    fits = [
        (len(h + p), v, h + p)
        for v, h, p in urls.RULES
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    return max(fits)[1:] if fits else (None, None)


def tokens(host, path):
    labels = [f"h{min(i, 3)}:{x}" for i, x in enumerate(reversed(host.split("."))) if x]
    segments = [f"p{min(i, 3)}:{x}" for i, x in enumerate(s for s in path.split("/") if s)]
    return list(dict.fromkeys(labels + segments))


def brute(pages, support, confidence):
    """Rules from all combinations of the first tokens, then the verdict of each URL."""
    seen = {}
    for url in {u or "" for _, u in pages}:
        host, path = parse(url)
        verdict, rule = fixed(host, path)
        seen[url] = (host, path, rule, verdict, tokens(host, path))
    labelled = [(t[: urls.MINED_TOKENS], v) for _, _, _, v, t in seen.values() if v]
    counts = {}
    for items, verdict in labelled:
        for n in range(1, len(items) + 1):
            for part in combinations(sorted(items), n):
                counts.setdefault(part, {}).setdefault(verdict, 0)
                counts[part][verdict] += 1
    least = support * len(labelled)
    rules = [
        (n / sum(by.values()), n / len(labelled), part, verdict)
        for part, by in counts.items()
        for verdict, n in by.items()
        if n >= least and n / sum(by.values()) >= confidence
    ]
    rules = [
        r for r in rules
        if not any(o[3] == r[3] and len(o[2]) < len(r[2]) and o[0] >= r[0] and set(o[2]) <= set(r[2]) for o in rules)
    ]
    found = []
    for page_id, url in pages:
        host, path, rule, verdict, items = seen[url or ""]
        fits = [(c, s, -len(p), v) for c, s, p, v in rules if set(p) <= set(items)]
        found.append((page_id, host, path, rule, verdict or (max(fits)[3] if fits else urls.DEFAULT)))
    return sorted(found, key=repr)


def test_equals_brute_force(spark):
    pages = spark.createDataFrame(PAGES, "page_id bigint, url string")
    pages = pages.withColumn("host", F.lit("mine")).withColumn("tokens", F.lit(1))
    result = urls.judged(pages, support=0.05, confidence=0.8).select("page_id", "host", "path", "rule", "verdict")
    assert sorted(map(tuple, result.collect()), key=repr) == brute(PAGES, 0.05, 0.8)


def test_mined_rules_decide_urls_without_a_fixed_rule(spark):
    pages = [(i, f"http://h{i}.com/de/{i}") for i in range(20)] + [(i, f"http://h{i}.com/fr/{i}") for i in range(20, 40)]
    pages += [(50, "http://other.net/de/9"), (51, "http://other.net/fr/9"), (52, "http://other.net/")]
    found = {r.page_id: r for r in urls.judged(spark.createDataFrame(pages, "page_id bigint, url string")).collect()}
    assert (found[50].verdict, found[50].mined, found[50].rule) == ("block", ["p0:de"], None)
    assert found[51].verdict == "allow"
    assert (found[52].verdict, found[52].mined) == ("allow", None)


def test_tokens_far_back_enter_rules_and_their_counts(spark):
    host = ".".join(f"x{i}" for i in range(13))
    deep = lambda mark, i: f"http://{host}.com/{'de' if mark == 'bad' else 'fr'}/{mark}/{i}"
    pages = [(i, deep("bad" if i % 2 else "good", i)) for i in range(40)]
    # Stands at the front of URLs that are allowed; counted there alone it would have the wrong verdict.
    pages += [(100 + i, f"http://y.com/fr/bad/{i}") for i in range(4)]
    pages += [(200, "http://z.net/q/bad/1"), (201, "http://z.net/q/good/1")]
    found = {r.page_id: r for r in urls.judged(spark.createDataFrame(pages, "page_id bigint, url string")).collect()}
    assert (found[200].verdict, found[200].mined) == ("block", ["p1:bad"])
    assert (found[201].verdict, found[201].mined) == ("allow", ["p1:good"])


def test_growing_token_by_token_gives_the_rules_of_fp_growth(spark, monkeypatch):
    blocked = [((i % 2 == 0) == (i % 3 == 0)) != (i % 7 == 0) for i in range(240)]
    pages = [
        (i, f"http://a{i % 2}.b{i % 3}.com/{'de' if b else 'fr'}/c{i % 4}/d{i % 3}/e{i * 7 % 5}") for i, b in enumerate(blocked)
    ]
    host, path = urls.parsed(F.col("url"))
    labelled = (
        spark.createDataFrame(pages, "page_id bigint, url string")
        .select("url", host.alias("host"), path.alias("path"))
        .withColumn("tokens", F.filter(urls.tokens(), lambda t: ~t.startswith("p0:")))
        .withColumn("verdict", F.when(F.col("path").startswith("/de"), "block").otherwise("allow"))
    )

    def mined():
        found = urls.mined_rules(labelled, 0.01, 0.6).collect()
        return sorted((r.antecedent, r.verdict, round(r.confidence, 9), round(r.support, 9)) for r in found)

    by_growth = mined()
    assert any(len(r[0]) > 1 for r in by_growth)
    monkeypatch.setattr(urls, "MINED_TOKENS", 1)
    assert mined() == by_growth


def test_no_labels_and_no_rows(spark):
    none = spark.createDataFrame([(1, "http://a.net/x"), (2, None)], "page_id bigint, url string")
    assert {r.verdict for r in urls.judged(none).collect()} == {"allow"}
    assert urls.judged(none.limit(0)).count() == 0

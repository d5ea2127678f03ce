import math
import re
from collections import Counter

import numpy as np
import pytest

from ratingloom.llm import lexical

DOCS, ITEMS = "doc_id bigint, text string", "item_id bigint, text string"
TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
FOLD = {c: c + 32 for c in range(65, 91)}


def terms(text):
    return TERM.findall((text or "").translate(FOLD))


def ranked_by_hand(docs, items, k):
    counted = [(i, Counter(terms(text))) for i, text in docs]
    counted = [(i, c) for i, c in counted if c]
    n, total = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    weight = {t: math.floor(1000 * math.log((2 * n + 2) / (2 * d + 1))) for t, d in df.items()}
    asked = {}
    for item, text in items:
        asked.setdefault(item, set()).update(terms(text))
    result = []
    for item, wanted in asked.items():
        scores = []
        for i, c in counted:
            m = 50 + (50 * sum(c.values()) * n) // total
            score = sum(weight[t] * ((1_000_000_000 * c[t]) // (1000 * c[t] + 20 * m)) for t in wanted if t in c)
            if score > 0:
                scores.append((-score, (i is not None, i or 0), i))
        result += [(item, rank, i, -score) for rank, (score, _, i) in enumerate(sorted(scores)[:k], 1)]
    return result


def corpus(n, seed=1):
    rng = np.random.default_rng(seed)
    words = [f"{a}{b}" for a in ("ba", "Co", "dü", "ef") for b in ("r", "st", "9", "ns", "lé", "m", "t")]
    share = 1 / np.arange(1, len(words) + 1)
    share /= share.sum()
    docs = []
    for i in range(n):
        size = int(rng.choice([1, 3, 8, 20, 60, 200]))
        docs.append((i, ", ".join(rng.choice(words, size, p=share))))
    return docs, words


def by_id(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))


@pytest.mark.parametrize(("k", "seeds"), [(5, 16), (50, 16), (3, 1)])
def test_ranks_are_those_of_scoring_everything(spark, monkeypatch, k, seeds):
    monkeypatch.setattr(lexical, "SEEDS", seeds)
    docs, words = corpus(400)
    rng = np.random.default_rng(9)
    items = [(i, " ".join(rng.choice(words, 6)) + " nowhere") for i in range(12)]
    found = lexical.ranked(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS), k)
    assert [tuple(r) for r in by_id(found.collect())] == by_id(ranked_by_hand(docs, items, k))


def test_hot_stratum_and_ties(spark):
    """A third of all rows is one text: they tie, and rank by id."""
    docs, _ = corpus(200)
    docs += [(1000 - i, "bar Cost bar 9") for i in range(100)]
    items = [(1, "BAR cost"), (2, "9")]
    found = lexical.ranked(spark.createDataFrame(docs, DOCS).repartition(7), spark.createDataFrame(items, ITEMS), 50)
    assert [tuple(r) for r in by_id(found.collect())] == by_id(ranked_by_hand(docs, items, 50))


def test_strata_are_left_out_and_lists_stay_closed(spark):
    """Bounds do what they are for: fewer lists are opened than the items' terms have."""
    docs, words = corpus(1500, 4)
    docs += [(5000 + i, "rare rarer " + docs[i][1]) for i in range(30)]
    items = spark.createDataFrame([(1, "rare rarer " + " ".join(words[:6]))], ITEMS)
    asked = lexical.item_terms(items)
    index = lexical.build(spark.createDataFrame(docs, DOCS), asked.select("term").distinct())
    seen = {}
    staged = lexical.staged

    def spy(df, name):
        seen[name] = staged(df, name)
        return seen[name]

    lexical.staged = spy
    try:
        result = lexical.search(index, asked, 5).collect()
    finally:
        lexical.staged = staged
    assert {r.doc_id for r in result} <= set(range(5000, 5030))
    opened = seen["visited"].filter("opened").count()
    assert opened < 0.5 * index.strata.count()


def test_index_without_named_terms_answers_alike(spark, monkeypatch):
    docs, words = corpus(150, 3)
    d = spark.createDataFrame(docs, DOCS)
    items = lexical.item_terms(spark.createDataFrame([(1, " ".join(words[:5]))], ITEMS))
    whole = lexical.search(lexical.build(d), items, 9).collect()
    named = lexical.search(lexical.build(d, items.select("term")), items, 9).collect()
    monkeypatch.setattr(lexical, "BROADCAST_ROWS", 0)
    joined = lexical.search(lexical.build(d, items.select("term")), items, 9).collect()
    assert by_id(whole) == by_id(named) == by_id(joined)


def test_terms_across_pieces(monkeypatch):
    text = "Äpfel und Birnen-9x " * 50
    whole = lexical.term_counts(text)
    monkeypatch.setattr(lexical, "pieces", lambda t: [t[i : i + 7] for i in range(0, len(t), 7)])
    assert lexical.term_counts(text) == whole == Counter({"Äpfel".encode(): 50, b"und": 50, b"birnen": 50, b"9x": 50})


def test_odd_rows(spark):
    docs = [(1, None), (2, ""), (3, " .,"), (None, "bar co"), (4, "bar co"), (4, "bar co"), (5, "bar " * 400_000), (6, "É co")]
    items = [(1, "Bar"), (None, "co"), (2, None), (3, "nowhere"), (4, ".."), (5, "bar"), (5, "é É")]
    d, i = spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)
    clash = d.selectExpr("*", "'x' AS m", "1 AS row", "2 AS item_id", "3 AS score")
    found = [tuple(r) for r in by_id(lexical.ranked(clash, i.selectExpr("*", "7 AS doc_id", "8 AS item")).collect())]
    assert found == by_id(ranked_by_hand(docs, items, 50))
    assert lexical.ranked(d.limit(0), i).count() == 0 and lexical.ranked(d, i.limit(0)).count() == 0

import random
import re

import pytest
from pyspark.sql import functions as F

from ratingloom.llm import graph, ngram_join
from ratingloom.llm.graph import components
from ratingloom.llm.shingles import shingle_sets

SCHEMA = "doc_id bigint, text string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute(data):
    sets = [shingles(text) for _, text in data]
    group = list(range(len(data)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(data)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                group[root(i)] = root(j)
    least = {}
    for i, (doc_id, _) in enumerate(data):
        if doc_id is not None:
            least[root(i)] = min(least.get(root(i), doc_id), doc_id)
    return sorted(((d, len(s), least.get(root(i))) for i, ((d, _), s) in enumerate(zip(data, sets))), key=repr)


def found(spark, data):
    docs = spark.createDataFrame(data, SCHEMA).withColumn("shingle", F.lit("mine")).withColumn("n", F.lit(1))
    result = ngram_join.joined(docs.repartition(4))
    assert result.columns == ["doc_id", "n_shingles", "component_id"]
    return sorted(map(tuple, result.collect()), key=repr)


def corpus(seed, n=260):
    """Texts with chains of edits, a passage common to a third of them, copies and short ones."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = [rng.choice(vocabulary) for _ in range(25)]
    data, texts = [], []
    for i in range(n):
        kind = rng.random()
        if texts and kind < 0.5:
            words = list(rng.choice(texts[-40:]))
            for _ in range(rng.randint(0, 3)):
                at = rng.randrange(len(words) + 1)
                words[at:at] = [rng.choice(vocabulary)] if rng.random() < 0.5 else []
                if len(words) > 6 and rng.random() < 0.5:
                    del words[rng.randrange(len(words))]
        else:
            words = [rng.choice(vocabulary) for _ in range(rng.randint(1, 70))]
            if kind > 0.8:
                words = passage + words[: rng.randint(0, 12)]
        texts.append(words)
        data.append((i * 7919 % 10007, " ".join(words).title() if rng.random() < 0.2 else "\t".join(words)))
    return data


@pytest.mark.parametrize("seed, most_frequent, list_length", [(1, 1_000_000, 4096), (2, 0, 4096), (3, 1_000_000, 3)])
def test_equals_brute_force(spark, monkeypatch, seed, most_frequent, list_length):
    monkeypatch.setattr(ngram_join, "MOST_FREQUENT", most_frequent)
    monkeypatch.setattr(ngram_join, "LIST_LENGTH", list_length)
    data = corpus(seed)
    expected = brute(data)
    assert sum(1 for d, _, c in expected if d != c) > 30
    assert found(spark, data) == expected


def test_links_at_the_threshold(spark):
    # 7 of 8 + 2 words: |A & B| / |A | B| is 3/4 and just below it.
    a = "a b c d e f g h i j k l m n o p q r s"
    data = [(1, a), (2, a + " x y z u v"), (3, a + " x y z u v w")]
    assert found(spark, data) == brute(data)


def test_odd_rows(spark):
    data = [
        (1, None), (2, ""), (3, " \n\t"), (4, "one two"), (5, "ONE two"), (6, "one two three four five"), (7, "É x"),
        (8, "é x"), (9, "word " * 60_000), (10, "word " * 9), (None, "one two"), (None, "lonely text here"), (4, "one two"),
        (11, "a" * 300_000),
    ]
    assert found(spark, data) == brute(data)
    assert ngram_join.joined(spark.createDataFrame(data, SCHEMA).limit(0)).count() == 0


def test_shingles_are_those_of_the_words():
    texts = [t for _, t in corpus(5, 80)] + [None, "", "a b c d", "A B c d e", "x" * 2_000_000 + " y"]
    sets = list(shingle_sets(texts))
    assert [len(s) for s in sets] == [len(shingles(t)) for t in texts]
    for i in range(0, 80, 3):
        for j in range(i):
            assert len(set(sets[i]) & set(sets[j])) == len(shingles(texts[i]) & shingles(texts[j]))


def test_components_of_a_path_a_star_and_a_ring(spark):
    path = [(i, i + 1) for i in range(100, 140)]
    star = [(5, i) for i in range(200, 230)]
    ring = [(i, 300 + (i - 299) % 20) for i in range(300, 320)]
    edges = spark.createDataFrame([*path, *star, *ring, (5, 5), (200, 5)], "a bigint, b bigint")
    result = dict(components(edges).collect())
    assert result == {i: 100 for i in range(100, 141)} | {i: 5 for i in (5, *range(200, 230))} | {i: 300 for i in range(300, 320)}
    assert components(edges.limit(0)).count() == 0


def test_turns_of_neighbours_save_pairs_across_components(spark, monkeypatch):
    rng = random.Random(4)
    base = [f"b{i}" for i in range(100)]
    data = []
    for i in range(80):
        words = list(base)
        for at in rng.sample(range(100), rng.randint(1, 4)):
            words[at] = f"e{i}x{at}"
        data.append((i, " ".join(words)))
    compared, real = [], ngram_join._compared

    def counted(docs, classes, pairs, class_at):
        compared[-1] += pairs.count()
        return real(docs, classes, pairs, class_at)

    monkeypatch.setattr(ngram_join, "_compared", counted)
    for turns in (ngram_join.MOST_TURNS, 0):
        monkeypatch.setattr(ngram_join, "MOST_TURNS", turns)
        compared.append(0)
        assert found(spark, data) == brute(data)
    assert compared[0] < compared[1]


def edited(n, seed=6, length=150):
    """Copies of one text with up to ten words changed: near ones link in a cluster, the others with little or nothing."""
    rng = random.Random(seed)
    base = [f"b{i}" for i in range(length)]
    data = []
    for i in range(n):
        words = list(base)
        for at in rng.sample(range(length), rng.randint(1, 10)):
            words[at] = f"e{i}x{at}"
        data.append((i, " ".join(words)))
    return data


def test_pairs_of_a_group_of_near_copies_grow_with_the_group(spark, monkeypatch):
    compared, real = [], ngram_join._compared

    def counted(docs, classes, pairs, class_at):
        compared[-1] += pairs.count()
        return real(docs, classes, pairs, class_at)

    monkeypatch.setattr(ngram_join, "_compared", counted)
    for n in (100, 400):
        data = edited(n)
        compared.append(0)
        assert found(spark, data) == brute(data)
    assert compared[1] < 6 * compared[0]  # sixteen times as many pairs in the group
    assert compared[1] < 8 * 400


def test_sets_differ_in_as_many_elements_as_their_sketches():
    rng = random.Random(7)
    sets = list(shingle_sets([t for _, t in corpus(7, 60)] + [t for _, t in edited(30)] + ["", "a b"]))
    for _ in range(500):
        u, v = rng.choice(sets), rng.choice(sets)
        bits = int.from_bytes((ngram_join._sketch(u) ^ ngram_join._sketch(v)).tobytes(), "big").bit_count()
        assert bits <= len(set(u.tolist()) ^ set(v.tolist()))


def test_components_of_few_and_of_many_edges_are_the_same(spark, monkeypatch):
    rng = random.Random(8)
    edges = spark.createDataFrame([(rng.randrange(300), rng.randrange(300)) for _ in range(170)], "a bigint, b bigint")
    few = sorted(map(tuple, components(edges).collect()))
    monkeypatch.setattr(graph, "BROADCAST_ROWS", 0)
    assert sorted(map(tuple, components(edges).collect())) == few

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratingloom.llm import quality
from ratingloom.llm.common import pieces


def labelled(n=500):
    rng = np.random.default_rng(5)
    docs, labels = [], []
    for i in range(n):
        good = i % 5 != 0
        words = [f"word{rng.integers(400)}" for _ in range(int(rng.integers(5, 200)))]
        if not good:
            words = [w.upper() + "!!" for w in words] if i % 2 else [words[0]] * len(words)
        docs.append((i, " ".join(words) + "."))
        labels.append((i, int(good)))
    return docs, labels


def frames(spark, docs, labels):
    return (
        spark.createDataFrame(docs, "doc_id bigint, text string"),
        spark.createDataFrame(labels, "doc_id bigint, quality int"),
    )


def test_held_out_documents_are_told_apart(spark):
    docs, labels = frames(spark, *labelled())
    result = quality.scored(docs.withColumn("score", F.lit("mine")), quality.train(docs, labels))
    both = result.join(labels, "doc_id").filter("held_out").collect()
    assert len(both) > 50
    assert sum(r.predicted == r.quality for r in both) >= 0.97 * len(both)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in both)


def test_held_out_labels_are_not_learned(spark):
    docs, labels = labelled(300)
    d, l = frames(spark, docs, labels)
    held = {r.doc_id for r in quality.scored(d, quality.Model()).filter("held_out").collect()}
    one = quality.train(d, l)
    other = quality.train(*frames(spark, docs, [(i, 1 - q if i in held else q) for i, q in labels]))
    assert all(np.array_equal(a, b) for a, b in zip(one.tables, other.tables, strict=True))
    assert one.bias == other.bias and one.pairs.keys() == other.pairs.keys()


def plain_features(text):
    """The word and line counts by hand."""
    words, lines = text.split(), [line for line in text.split("\n") if line]
    return {
        "words": np.log1p(len(words)),
        "distinct_words": len(set(words)) / len(words),
        "most_frequent": max(map(words.count, set(words))) / len(words),
        "repeated_next": sum(a == b for a, b in zip(words, words[1:])) / len(words),
        "distinct_lines": len(set(lines)) / len(lines),
        "capitals": sum("A" <= c <= "Z" for c in text) / sum(c.isalpha() or ord(c) > 127 for c in text),
        "sentence_ends": sum(w[-1] in ".!?" for w in words) / len(words),
        "letterless": sum(not any(c.isalpha() for c in w) for w in words) / len(words),
    }


@pytest.mark.parametrize("text", ["One two two\nthree. 12 -- A!\nOne two two", "x " * 400 + "\nx\n" + "y z? " * 90])
def test_features_are_the_counts(text):
    found = dict(zip(quality.FEATURES, quality.features(text), strict=True))
    for name, value in plain_features(text).items():
        assert found[name] == pytest.approx(value), name


def test_pieces_count_like_the_whole(monkeypatch):
    text = " ".join(f"w{i * i % 97} Ä{i % 7}\n" for i in range(3000))
    whole = quality.features(text)
    monkeypatch.setattr(quality, "pieces", lambda t: list(pieces(t, 50)))
    assert quality.features(text)[:-1] == pytest.approx(whole[:-1])  # the squeezed size depends on flushes


def test_a_score_is_a_sum_of_table_entries():
    rng = np.random.default_rng(2)
    rows = rng.random((800, 3))
    labels = ((rows[:, 0] > 0.5) ^ (rows[:, 1] > 0.5)).astype(float)
    model = quality.fit(rows, labels)
    for row, score in zip(rows[:50], model.scores(rows[:50]), strict=True):
        logit = model.bias
        for i, table in enumerate(model.tables):
            logit += table[sum(edge <= row[i] for edge in model.edges[i])]
        for (a, b), table in model.pairs.items():
            cell = [sum(edge <= row[i] for edge in model.pair_edges[i]) for i in (a, b)]
            logit += table[cell[0], cell[1]]
        assert score == pytest.approx(1 / (1 + np.exp(-logit)))


def test_a_pair_learns_what_no_single_feature_shows():
    rng = np.random.default_rng(2)
    rows = rng.random((2000, 4))
    labels = ((rows[:, 0] > 0.5) ^ (rows[:, 2] > 0.5)).astype(float)
    right = lambda model: np.mean((model.scores(rows) >= 0.5) == labels)
    with_pairs = quality.fit(rows[:1000], labels[:1000])
    assert (0, 2) in with_pairs.pairs
    assert right(with_pairs) > 0.9 > right(quality.fit(rows[:1000], labels[:1000], n_pairs=0))


def test_odd_rows(spark):
    docs, labels = labelled(200)
    docs += [(None, "A word."), (500, None), (501, ""), (502, "A word. " * 300_000), (503, "\n\t"), (0, docs[0][1]), (504, "x" * 3_000_000)]
    d, l = frames(spark, docs, [*labels, (1, None), (None, 1), (0, 0), (9999, 1)])
    model = quality.train(d, l)
    rows = quality.scored(d, model).collect()
    found = {r.doc_id: r.score for r in rows}
    assert len(rows) == len(docs) and found[500] == found[501]
    assert len({r.score for r in rows if r.doc_id == 0}) == 1
    assert quality.scored(d.limit(0), model).count() == 0
    assert {r.score for r in quality.scored(d, quality.train(d, l.limit(0))).collect()} == {0.5}
    alike = quality.train(d, l.filter("quality = 1"))
    assert {r.predicted for r in quality.scored(d, alike).collect()} == {1}


def test_a_hot_id_is_one_row_of_the_sample(spark):
    docs, labels = labelled(90)
    hot = [(7, f"text {i} of a hot id") for i in range(45)]
    d, l = frames(spark, docs + hot, labels + [(7, 0)] * 30)
    rows = quality.sample(d, l).collect()
    assert len(rows) == len({r.doc_id for r in rows}) <= 90
    few = quality.sample(d, l, 20)
    assert few.count() == 20
    assert sorted(few.collect()) == sorted(quality.sample(d.repartition(5), l.repartition(3), 20).collect())

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from ratingloom.llm import toxicity


def labelled(n=600):
    docs, labels = [], []
    for i in range(n):
        toxic = i % 4 == 0
        words = [f"w{i * j % 37}" for j in range(1, 15)]
        words += ["idiot" if i % 8 else "moron"] if toxic else []
        # A group is mentioned mostly, yet not only, next to insults.
        words += ["women"] if toxic and i % 12 or i % 7 == 0 else []
        docs.append((i, " ".join(words).capitalize() + "."))
        labels.append((i, int(toxic)))
    return docs, labels


def frames(spark, docs, labels):
    return (
        spark.createDataFrame(docs, "doc_id bigint, text string"),
        spark.createDataFrame(labels, "doc_id bigint, toxic int"),
    )


def test_held_out_documents_are_told_apart(spark):
    docs, labels = frames(spark, *labelled())
    result = toxicity.scored(docs.withColumn("score", F.lit("mine")), toxicity.train(docs, labels))
    both = result.join(labels, "doc_id").filter("held_out").collect()
    assert len(both) > 50
    assert all(r.predicted == r.toxic for r in both)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in both)


def test_swapped_terms_lose_their_weight(spark):
    docs, labels = frames(spark, *labelled())
    rows = toxicity.sample(docs, labels).mapInArrow(toxicity._word_lists, "words array<string>, toxic int").toArrow()
    plain, fair = toxicity.fit(rows, counterfactual=0.0), toxicity.fit(rows)
    gap = lambda m: abs(m.score("w1 women") - m.score("w1 men"))
    assert gap(fair) < 0.3 * gap(plain)
    assert fair.score("women w1 w2") < 0.5 < fair.score("you idiot w1 w2")


def test_held_out_labels_are_not_learned(spark):
    docs, labels = labelled(200)
    d, l = frames(spark, docs, labels)
    held = {r.doc_id for r in toxicity.scored(d, toxicity.Model({}, 0.0)).filter("held_out").collect()}
    changed = [(i, 1 - t if i in held else t) for i, t in labels]
    one, other = toxicity.train(d, l), toxicity.train(*frames(spark, docs, changed))
    assert one.weights == other.weights and one.bias == other.bias


def test_odd_rows(spark):
    docs, labels = labelled(100)
    docs += [(None, "idiot"), (500, None), (501, ""), (502, "idiot " * 400_000), (503, "\n\t"), (0, docs[0][1])]
    d, l = frames(spark, docs, [*labels, (1, None), (None, 1), (0, 0), (9999, 1)])
    model = toxicity.train(d, l)
    found = {(r.doc_id): r.score for r in toxicity.scored(d, model).collect()}
    assert found[500] == found[501] == found[503] and found[502] == found[None]
    assert toxicity.scored(d, model).count() == len(docs)
    assert toxicity.scored(d.limit(0), model).count() == 0
    empty = toxicity.train(d, l.limit(0))
    assert {r.predicted for r in toxicity.scored(d, empty).collect()} == {0}


def test_sample_is_bounded_and_reproducible(spark):
    docs, labels = frames(spark, *labelled(300))
    few = toxicity.sample(docs, labels, 40)
    assert few.count() == 40
    assert sorted(few.collect()) == sorted(toxicity.sample(docs.repartition(7), labels.repartition(3), 40).collect())


def test_penalty_charges_the_change_of_the_logit():
    lists = [["people", "x"], ["women", "bad"], ["women", "bad"], ["men", "x"]] * 10
    rows = pa.table({"words": pa.array(lists), "toxic": pa.array([0, 1, 1, 0] * 10, pa.int32())})
    loose, tight = toxicity.fit(rows, counterfactual=0.0), toxicity.fit(rows, counterfactual=1000.0)
    spread = lambda m: np.ptp([m.weights[w] for w in ("people", "women", "men")])
    assert spread(tight) < 0.1 < spread(loose)


def test_a_hot_id_is_one_row_of_the_sample(spark):
    docs, labels = labelled(90)
    d, l = frames(spark, docs + [(7, f"text {i} of a hot id") for i in range(45)], labels + [(7, 0)] * 30)
    assert toxicity.sample(d, l).count() == toxicity.sample(*frames(spark, docs, labels)).count()


def test_slope_of_the_penalty_is_that_of_swapped_rows():
    """One row with each swap made has the gap of logits that the closed form charges: brute force over the swaps."""
    lists = [["women", "x"], ["men", "y"], ["women", "y"], ["x"]]
    vocabulary = {w: i for i, w in enumerate(sorted({w for row in lists for w in row} | {"people"}))}
    present = np.zeros(len(vocabulary))
    for row in lists:
        for word in row:
            present[vocabulary[word]] += 1
    weights = np.linspace(-1, 1, len(vocabulary))
    closed = sum(
        times * (weights[a] - (weights[b] if b >= 0 else 0)) ** 2 for a, b, times in toxicity.swap_pairs(vocabulary, present)
    )
    logit = lambda row: sum(weights[vocabulary[w]] for w in row if w in vocabulary)
    swapped = 0.0
    for row in lists:
        for group in toxicity.IDENTITIES:
            for term in set(row) & set(group):
                for other in group:
                    if other != term:
                        swapped += (logit(row) - logit([other if w == term else w for w in row])) ** 2
    assert np.isclose(closed, swapped)

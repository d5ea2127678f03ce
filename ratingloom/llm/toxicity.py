"""Toxicity by a counterfactually regularised linear classifier.

Logistic regression on the words of a text. Labelled texts that mention an identity
term are read a second time with the term swapped for each other term of its group, a
neutral one included, and the training loss charges the squared change of the logit. A
term that only tends to stand near toxic words thus keeps no weight of its own, and
neutral mentions of a group stay low.

Training takes at most ``SAMPLE`` labelled documents, those with the smallest hash of
their ids. Scoring reads every whole text.

Defined results: null and empty texts get the score of the bias alone, an empty table gives
no rows, very long texts are read piece by piece. Of several labels of one document the largest counts, of several texts one; null labels count not at all. Without labels every score
is 0.5 or less (the bias is 0 and nothing is predicted toxic). Repeated rows get equal
scores; other columns are ignored.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratingloom.llm.common import held_out, pieces

#: Bound on the labelled documents of one fit.
SAMPLE = 20_000
#: A word counts from so many sampled documents on.
LEAST_DOCUMENTS = 5
RIDGE, COUNTERFACTUAL, ROUNDS = 2.0, 10.0, 300

#: Identity terms by group; the first of each group is the neutral one. (Fixed values.)
IDENTITIES = (
    ("people", "women", "men", "woman", "man", "girls", "boys", "transgender", "female", "male"),
    ("believers", "muslim", "muslims", "christian", "christians", "jewish", "jews", "hindu", "buddhist", "catholic"),
    ("persons", "gay", "lesbian", "straight", "bisexual", "queer", "homosexual", "heterosexual"),
    ("citizens", "black", "white", "asian", "african", "latino", "mexican", "chinese", "european", "immigrants"),
    ("adults", "old", "young", "elderly", "disabled", "blind", "deaf"),
    ("menschen", "frauen", "männer", "muslime", "christen", "juden", "ausländer", "schwule"),
    ("personas", "mujeres", "hombres", "musulmanes", "cristianos", "judíos", "inmigrantes"),
    ("personnes", "femmes", "hommes", "musulmans", "chrétiens", "juifs", "immigrés"),
)

_WORD = re.compile(r"[^\W_]+")


def words(text: str | None) -> set[str]:
    """The distinct words of a text: runs of letters and digits in lower case."""
    if not text:
        return set()
    found: set[str] = set()
    for piece in pieces(text):
        found.update(_WORD.findall(piece.lower()))
    return found


def _word_lists(batches):
    for batch in batches:
        lists = [sorted(words(text)) for text in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(lists, pa.list_(pa.string())), batch.column("toxic")], ["words", "toxic"]
        )


def sample(docs: DataFrame, labels: DataFrame, size: int = SAMPLE) -> DataFrame:
    """text and toxic of the labelled documents to learn from: one row an id, ``size`` rows at most.

    Of several texts under one id the one with the smallest hash counts; rows of an id combine
    before they are shuffled.
    """
    chosen = (
        labels.filter("toxic IS NOT NULL AND doc_id IS NOT NULL")
        .filter(~held_out(5, 0))
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(size)
    )
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    one = F.min_by("text", F.struct(F.xxhash64("text"), "text"))
    return texts.groupBy("doc_id", "toxic").agg(one.alias("text")).select("text", "toxic")


class Model:
    """Weights of words and a bias."""

    def __init__(self, weights: dict[str, float], bias: float):
        self.weights, self.bias, self.known = weights, bias, frozenset(weights)

    def score(self, text: str | None) -> float:
        # Sorted, as the sum of floats depends on the order.
        logit = self.bias + sum(self.weights[word] for word in sorted(self.known & words(text)))
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, logit))))


def swap_pairs(vocabulary: dict[str, int], present: np.ndarray) -> list[tuple[int, int, float]]:
    """(term, other term, number of documents in which the swap is made); -1 is a word without a weight."""
    pairs = []
    for group in IDENTITIES:
        for term in group:
            if term in vocabulary:
                number = vocabulary[term]
                pairs += [(number, vocabulary.get(other, -1), float(present[number])) for other in group if other != term]
    return pairs


def fit(rows: pa.Table, counterfactual: float = COUNTERFACTUAL, ridge: float = RIDGE, rounds: int = ROUNDS) -> Model:
    """A model of ``rows`` (words: distinct words of a document, toxic)."""
    toxic = np.asarray(rows.column("toxic").to_numpy(zero_copy_only=False), float)
    if not len(toxic):
        return Model({}, -1e-9)
    lists = rows.column("words").combine_chunks()
    encoded = lists.flatten().dictionary_encode()
    spelled, column = encoded.dictionary.to_pylist(), encoded.indices.to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(toxic)), lists.value_lengths().to_numpy(zero_copy_only=False))
    present = np.bincount(column, minlength=len(spelled))
    identities = {term for group in IDENTITIES for term in group}
    wanted = (present >= LEAST_DOCUMENTS) | np.fromiter((w in identities for w in spelled), bool, len(spelled))
    order = sorted(np.flatnonzero(wanted), key=spelled.__getitem__)
    number = np.full(len(spelled), -1)
    number[order] = np.arange(len(order))
    names = [spelled[i] for i in order]
    kept = number[column] >= 0
    row, column = row[kept], number[column[kept]]
    present = np.bincount(column, minlength=len(names))
    pairs = swap_pairs({w: i for i, w in enumerate(names)}, present)
    first, other, times = (np.array(x) for x in zip(*pairs, strict=True)) if pairs else (np.zeros(0, int),) * 3
    paired = np.where(other < 0, 0, other) if len(pairs) else other

    weight, bias = np.zeros(len(names)), math.log((toxic.sum() + 1) / (len(toxic) - toxic.sum() + 1))
    mean, square = np.zeros(len(names) + 1), np.zeros(len(names) + 1)
    for i in range(1, rounds + 1):
        logit = np.bincount(row, weight[column], len(toxic)) + bias
        error = 1 / (1 + np.exp(-np.clip(logit, -500, 500))) - toxic
        slope = np.bincount(column, error[row], len(names)) + ridge * weight
        if len(pairs):
            change = 2 * counterfactual * times * (weight[first] - np.where(other < 0, 0.0, weight[paired]))
            slope += np.bincount(first, change, len(names))
            slope -= np.bincount(paired, np.where(other < 0, 0.0, change), len(names))
        slope = np.append(slope, error.sum()) / len(toxic)
        mean, square = 0.9 * mean + 0.1 * slope, 0.999 * square + 0.001 * slope**2
        step = 0.1 * (1 - i / (rounds + 1)) * (mean / (1 - 0.9**i)) / (np.sqrt(square / (1 - 0.999**i)) + 1e-8)
        weight, bias = weight - step[:-1], bias - step[-1]
    return Model(dict(zip(names, map(float, weight), strict=True)), float(bias))


def train(docs: DataFrame, labels: DataFrame, **options) -> Model:
    rows = sample(docs, labels).mapInArrow(_word_lists, "words array<string>, toxic int")
    return fit(rows.toArrow(), **options)


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted of every document; a score is a function of the text alone."""
    schema = docs.select("doc_id", F.lit(0.0).alias("score")).schema

    def judge(batches):
        for batch in batches:
            scores = [model.score(text) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64())], ["doc_id", "score"])

    return (
        docs.select("doc_id", "text")
        .mapInArrow(judge, schema)
        .select("doc_id", held_out(5, 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
    )

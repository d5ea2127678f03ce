"""Quality by a generalised additive model with pairwise interactions.

A text is described by counts of its bytes, words and lines. Every feature is cut into
bins; cyclic boosting visits the features in turn, fits a tree of up to three leaves to
the gradient over the bins of one feature and adds it to that feature's lookup table.
Pairs of features are ranked by what a tree of four leaves over both would still gain,
and the best ones get a two-dimensional table each, boosted in the same way. A score is
the sum of one entry per table: bins are looked up and added as arrays.

Training takes at most ``SAMPLE`` labelled documents, those with the smallest hash of
their ids, one row each. Scoring reads every whole text; a long one is counted piece by piece.

Defined results: null and empty texts have the features of no words, and a score by
them. Of several labels of one document the largest counts, of several texts under one
labelled id the one with the smallest features; null labels count not at all. Labels of
one kind only give the share of that kind, smoothed; without labels every score is 0.5.
Repeated rows get equal scores, an empty table gives no rows, other columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from dataclasses import dataclass, field
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratingloom.llm.common import held_out, pieces

#: Bound on the labelled documents of one fit.
SAMPLE = 20_000
#: Bins of a feature on its own, and in a pair.
BINS, PAIR_BINS = 32, 8
#: Tables of pairs; rounds over the features and over the pairs; shrinkage of a tree; least documents of a leaf.
PAIRS, ROUNDS, PAIR_ROUNDS, RATE, LEAF = 10, 150, 60, 0.1, 5
#: Weight of the prior that pulls leaves to zero.
RIDGE = 1.0

FEATURES = (
    "bytes", "words", "word_length", "longest_word", "capitals", "digits", "symbols", "stops", "calls", "spaces",
    "line_ends", "beyond_ascii", "distinct_words", "most_frequent", "repeated_next", "distinct_lines", "letter_ends",
    "letterless", "sentence_ends", "short_words", "entropy", "squeezed",
)
_CLASSES = {
    "capitals": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "letters": b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz" + bytes(range(128, 256)),
    "digits": b"0123456789",
    "symbols": b"#$%&*+/<=>@[\\]^_`{|}~",
    "stops": b".,;:",
    "calls": b"!?",
    "spaces": b" \t\r\v\f",
    "beyond_ascii": bytes(range(128, 256)),
}
_MEMBERS = {name: np.frombuffer(members, np.uint8) for name, members in _CLASSES.items()}
_LETTER = frozenset(_CLASSES["letters"])
_LETTERS_GONE = _CLASSES["letters"]


def features(text: str | None) -> list[float]:
    """The numbers by which a text is judged, in the order of ``FEATURES``."""
    used, words, lines = np.zeros(256, np.int64), Counter(), Counter()
    repeated = letter_ends = letterless = sentence_ends = short = squeezed = 0
    last_word, open_line = None, b""
    squeeze = zlib.compressobj(1)
    for piece in pieces(text or ""):
        data = piece.encode("utf-8", "surrogatepass")
        used += np.bincount(np.frombuffer(data, np.uint8), minlength=256)
        squeezed += len(squeeze.compress(data))
        found = data.split()
        words.update(found)
        repeated += sum(map(eq, found, [last_word, *found[:-1]]))
        last_word = found[-1] if found else last_word
        *whole, open_line = (open_line + data).split(b"\n")
        lines.update(line for line in whole if line)
        if len(open_line) > 1 << 20:  # a line that never ends is told apart by its beginning and length
            open_line = open_line[: 1 << 16] + b"%d" % len(open_line)
    squeezed += len(squeeze.flush())
    if open_line:
        lines[open_line] += 1
    n, longest, length = sum(words.values()), 0, 0
    for word, times in words.items():
        length += times * len(word)
        longest = max(longest, len(word))
        letter_ends += times * (word[-1] in _LETTER)
        letterless += times * (len(word.translate(None, _LETTERS_GONE)) == len(word))
        sentence_ends += times * (word[-1] in b".!?")
        short += times * (len(word) <= 3)
    size, count = int(used.sum()), {name: int(used[members].sum()) for name, members in _MEMBERS.items()}
    per_byte, per_word = 1 / max(1, size), 1 / max(1, n)
    shares = used[used > 0] * per_byte
    return [
        math.log1p(size),
        math.log1p(n),
        length * per_word,
        math.log1p(longest),
        count["capitals"] / max(1, count["letters"]),
        count["digits"] * per_byte,
        count["symbols"] * per_byte,
        count["stops"] * per_byte,
        count["calls"] * per_byte,
        count["spaces"] * per_byte,
        int(used[10]) * per_byte,
        count["beyond_ascii"] * per_byte,
        len(words) * per_word,
        max(words.values(), default=0) * per_word,
        repeated * per_word,
        len(lines) / max(1, sum(lines.values())),
        letter_ends * per_word,
        letterless * per_word,
        sentence_ends * per_word,
        short * per_word,
        float(-(shares * np.log2(shares)).sum()) if size else 0.0,
        squeezed * per_byte if size else 0.0,
    ]


def described(texts: DataFrame) -> DataFrame:
    """``texts`` with ``features ARRAY<DOUBLE>`` in place of ``text``."""
    others = [name for name in texts.columns if name != "text"]
    schema = texts.select(*others, F.array().cast("array<double>").alias("features")).schema

    def describe(batches):
        for batch in batches:
            numbers = pa.array([features(text) for text in batch.column("text").to_pylist()], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*(batch.column(name) for name in others), numbers], [*others, "features"])

    return texts.mapInArrow(describe, schema)


def sample(docs: DataFrame, labels: DataFrame, size: int = SAMPLE) -> DataFrame:
    """``(doc_id, quality, features)`` of the labelled documents to learn from: ``size`` rows at most."""
    chosen = (
        labels.filter("quality IS NOT NULL AND doc_id IS NOT NULL")
        .filter(~held_out(5, 0))
        .groupBy("doc_id")
        .agg(F.max("quality").cast("int").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(size)
    )
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    return described(texts).groupBy("doc_id", "quality").agg(F.min("features").alias("features"))


@dataclass
class Model:
    """A bias, a lookup table per feature and one per chosen pair."""

    bias: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pair_edges: list[np.ndarray] = field(default_factory=list)
    pairs: dict[tuple[int, int], np.ndarray] = field(default_factory=dict)

    def scores(self, rows: np.ndarray) -> np.ndarray:
        """Scores of feature rows: one entry of every table, added."""
        logit = np.full(len(rows), self.bias)
        for column, (edges, table) in enumerate(zip(self.edges, self.tables, strict=True)):
            logit += table[np.searchsorted(edges, rows[:, column], "right")]
        coarse = {i: np.searchsorted(self.pair_edges[i], rows[:, i], "right") for pair in self.pairs for i in pair}
        for (a, b), table in self.pairs.items():
            logit += table[coarse[a], coarse[b]]
        return 1 / (1 + np.exp(-np.clip(logit, -500, 500)))


def _edges(column: np.ndarray, bins: int) -> np.ndarray:
    """Cut points that give at most ``bins`` bins of about equal weight."""
    inner = np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1], method="higher")
    return np.unique(inner[inner > column.min()])


def _gain(slope: np.ndarray, weight: np.ndarray) -> np.ndarray:
    return slope * slope / (weight + RIDGE)


def _best_cut(slope: np.ndarray, weight: np.ndarray, held: np.ndarray, low: int, high: int) -> tuple[float, int]:
    """(gain, place) of the best cut of the bins ``low`` to ``high`` in two; ``held`` are the documents of a bin."""
    left_s, left_w, left_n = (np.cumsum(x[low:high])[:-1] for x in (slope, weight, held))
    all_s, all_w, all_n = (x[low:high].sum() for x in (slope, weight, held))
    gain = _gain(left_s, left_w) + _gain(all_s - left_s, all_w - left_w) - _gain(all_s, all_w)
    gain[(left_n < LEAF) | (all_n - left_n < LEAF)] = 0
    place = int(gain.argmax()) if len(gain) else 0
    return (float(gain[place]), low + place + 1) if len(gain) and gain[place] > 0 else (0.0, low)


def _tree(slope: np.ndarray, weight: np.ndarray, held: np.ndarray) -> np.ndarray:
    """Steps per bin of a tree of up to three leaves."""
    cuts, bins = [0, len(slope)], len(slope)
    for _ in range(2):
        found = max((_best_cut(slope, weight, held, low, high) for low, high in zip(cuts, cuts[1:])), default=(0.0, 0))
        if found[0] <= 0:
            break
        cuts = sorted([*cuts, found[1]])
    steps = np.zeros(bins)
    for low, high in zip(cuts, cuts[1:]):
        steps[low:high] = slope[low:high].sum() / (weight[low:high].sum() + RIDGE)
    return steps


def _corner_sums(cells: np.ndarray) -> list[np.ndarray]:
    """Sums of the four quadrants at every inner crossing of a grid."""
    total = cells.cumsum(0).cumsum(1)
    upper, left, both = total[:-1, -1:], total[-1:, :-1], total[:-1, :-1]
    return [both, upper - both, left - both, total[-1, -1] - upper - left + both]


def _crossing(slope: np.ndarray, weight: np.ndarray, held: np.ndarray) -> tuple[float, int, int]:
    """(gain, row, column) of the crossing at which four leaves gain most."""
    if min(slope.shape) < 2:
        return 0.0, 0, 0
    slopes, weights, counts = _corner_sums(slope), _corner_sums(weight), _corner_sums(held)
    gain = sum(_gain(s, w) for s, w in zip(slopes, weights, strict=True)) - _gain(slope.sum(), weight.sum())
    gain = np.where(np.min(counts, axis=0) < LEAF, 0.0, gain)
    row, column = np.unravel_index(gain.argmax(), gain.shape)
    return float(gain[row, column]), int(row) + 1, int(column) + 1


def _pair_tree(slope: np.ndarray, weight: np.ndarray, held: np.ndarray) -> np.ndarray:
    gain, row, column = _crossing(slope, weight, held)
    steps = np.zeros(slope.shape)
    if gain > 0:
        for rows in (slice(0, row), slice(row, None)):
            for columns in (slice(0, column), slice(column, None)):
                steps[rows, columns] = slope[rows, columns].sum() / (weight[rows, columns].sum() + RIDGE)
    return steps


def fit(rows: np.ndarray, quality: np.ndarray, n_pairs: int = PAIRS, rounds: int = ROUNDS) -> Model:
    """A model of feature rows and their labels (0 or 1)."""
    good = float(quality.sum())
    if not len(rows):
        return Model()
    model = Model(bias=math.log((good + 0.5) / (len(rows) - good + 0.5)))
    if good in (0, len(rows)):
        return model
    wide = rows.shape[1]
    model.edges = [_edges(rows[:, i], BINS) for i in range(wide)]
    model.pair_edges = [_edges(rows[:, i], PAIR_BINS) for i in range(wide)]
    model.tables = [np.zeros(len(edges) + 1) for edges in model.edges]
    at = [np.searchsorted(edges, rows[:, i], "right") for i, edges in enumerate(model.edges)]
    coarse = [np.searchsorted(edges, rows[:, i], "right") for i, edges in enumerate(model.pair_edges)]
    held = [np.bincount(place, minlength=len(table)) for place, table in zip(at, model.tables, strict=True)]
    logit = np.full(len(rows), model.bias)

    def pull() -> tuple[np.ndarray, np.ndarray]:
        share = 1 / (1 + np.exp(-logit))
        return quality - share, np.maximum(share * (1 - share), 1e-6)

    for _ in range(rounds):
        for i, table in enumerate(model.tables):
            error, weight = pull()
            sums = (np.bincount(at[i], values, len(table)) for values in (error, weight))
            steps = RATE * _tree(*sums, held[i])
            table += steps
            logit += steps[at[i]]

    def grid(a: int, b: int, values: np.ndarray | None = None) -> np.ndarray:
        shape = len(model.pair_edges[a]) + 1, len(model.pair_edges[b]) + 1
        return np.bincount(coarse[a] * shape[1] + coarse[b], values, shape[0] * shape[1]).reshape(shape)

    error, weight = pull()
    gains = [
        (_crossing(grid(a, b, error), grid(a, b, weight), grid(a, b))[0], -a, -b)
        for a in range(wide)
        for b in range(a + 1, wide)
    ]
    chosen = [(-a, -b) for gain, a, b in sorted(gains, reverse=True)[:n_pairs] if gain > 0]
    model.pairs = {(a, b): np.zeros((len(model.pair_edges[a]) + 1, len(model.pair_edges[b]) + 1)) for a, b in chosen}
    for _ in range(PAIR_ROUNDS):
        for (a, b), table in model.pairs.items():
            error, weight = pull()
            steps = RATE * _pair_tree(grid(a, b, error), grid(a, b, weight), grid(a, b))
            table += steps
            logit += steps[coarse[a], coarse[b]]
    return model


def train(docs: DataFrame, labels: DataFrame, size: int = SAMPLE, **options) -> Model:
    """A model of a bounded sample; rows are taken in the order of their ids, so that reruns agree."""
    table = sample(docs, labels, size).toArrow().sort_by("doc_id")
    rows = table.column("features").combine_chunks().flatten().to_numpy().reshape(-1, len(FEATURES))
    return fit(rows, table.column("quality").to_numpy().astype(float), **options)


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted of every document; a score is a function of the text alone."""
    schema = docs.select("doc_id", F.lit(0.0).alias("score")).schema

    def judge(batches):
        for batch in batches:
            rows = np.array([features(text) for text in batch.column("text").to_pylist()], float)
            scores = model.scores(rows.reshape(-1, len(FEATURES)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores)], ["doc_id", "score"])

    return (
        docs.select("doc_id", "text")
        .mapInArrow(judge, schema)
        .select("doc_id", held_out(5, 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))
    )

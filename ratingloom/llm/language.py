"""Language identification by rank-order profiles of n-grams.

A language's profile is the list of its most frequent letter n-grams (n = 1, 2, 3; words
padded by a space), counted over all its texts. A document's own list is compared to
each profile: an n-gram costs the difference of its two places, or the length of the
profile if it is not there. The language with the smallest sum wins, ties going to the
first by name.

Defined results: null texts and texts without a letter are ``und`` with score 0, and so
is every text if no language was learned. A null doc_id counts as empty text for the
split. Repeated rows get equal results; other columns are ignored. Texts of any length
are read whole, in pieces of a million characters cut at spaces.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ratingloom.llm.common import held_out, pieces

PROFILE_LENGTH = 400
#: A profile list larger than this is refused: it is shipped to every task.
MOST_LANGUAGES = 5_000
#: Arrays over a slice take some 150 bytes a character.
SLICE_CHARS, SLICE_TEXTS = 300_000, 300
UNKNOWN = "und"
CODE_BITS = 21


@cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def slices(texts: list[str | None], groups: list[int]):
    """(pieces, their groups) of bounded total length."""
    held, of, chars = [], [], 0
    for text, group in zip(texts, groups, strict=True):
        for piece in pieces(text or ""):
            held.append(piece)
            of.append(group)
            chars += len(piece)
            if chars >= SLICE_CHARS or len(held) >= SLICE_TEXTS:
                yield held, of
                held, of, chars = [], [], 0
    if held:
        yield held, of


def gram_counts(texts: list[str], groups: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(group, n-gram, count), sorted by group and n-gram; an n-gram is its code points in 63 bits."""
    lowered = [text.lower() + " " for text in texts]
    points = np.frombuffer((" " + "".join(lowered)).encode("utf-32-le", "surrogatepass"), np.uint32)
    group = np.repeat(np.asarray([groups[0], *groups]), [1, *map(len, lowered)])
    space = ~_letters()[points]
    keep = np.ones(len(points), bool)
    keep[1:] = ~(space[1:] & space[:-1])
    points, group, space = points[keep], group[keep], space[keep]
    seen = np.zeros(0x110000, bool)
    seen[points] = True
    seen[32] = True
    seen[points[space]] = False
    seen[32] = True
    alphabet = np.flatnonzero(seen)
    number = np.cumsum(seen).astype(np.int64)
    symbol = np.where(space, number[32], number[points])
    base = np.int64(len(alphabet) + 1)
    first = int(group.min())
    owner = (group - first).astype(np.int64) * base**3
    one = (owner + symbol)[~space]
    two = (owner[1:] + symbol[:-1] * base + symbol[1:])[~(space[1:] & space[:-1])]
    three = owner[1:-1] + (symbol[:-2] * base + symbol[1:-1]) * base + symbol[2:]
    three = three[~space[1:-1]]
    keys = np.sort(np.concatenate([one, two, three]))
    if not len(keys):
        return keys, keys, keys
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    counts = np.diff(np.append(starts, len(keys)))
    keys = keys[starts]
    owner, code = keys // base**3 + first, keys % base**3
    point = np.concatenate([[0], alphabet]).astype(np.int64)
    grams = (point[code // base**2] << 2 * CODE_BITS) | (point[code // base % base] << CODE_BITS) | point[code % base]
    return owner, grams, counts


def _summed(held: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    owner, gram, count = (np.concatenate(x) for x in zip(*held, strict=True))
    order = np.lexsort((gram, owner))
    owner, gram, count = owner[order], gram[order], count[order]
    starts = np.flatnonzero(
        np.concatenate([[True], (owner[1:] != owner[:-1]) | (gram[1:] != gram[:-1])])
    )
    return owner[starts], gram[starts], np.add.reduceat(count, starts)


def _count_by_language(batches):
    names: dict[str, int] = {}
    held: list[tuple] = []
    for batch in batches:
        texts, langs = batch.column("text").to_pylist(), batch.column("lang").to_pylist()
        for part, groups in slices(texts, [names.setdefault(lang, len(names)) for lang in langs]):
            held.append(gram_counts(part, groups))
            if len(held) >= 64:
                held = [_summed(held)] if any(len(x[0]) for x in held) else []
    held = [x for x in held if len(x[0])]
    if held:
        owner, gram, count = _summed(held)
        known = pa.array(list(names))
        for start in range(0, len(gram), 100_000):
            part = slice(start, start + 100_000)
            yield pa.RecordBatch.from_arrays(
                [known.take(pa.array(owner[part])), pa.array(gram[part]), pa.array(count[part])], ["lang", "gram", "n"]
            )


def profiles(labelled: DataFrame, length: int = PROFILE_LENGTH) -> DataFrame:
    """lang, gram, place (from 0) of the most frequent n-grams of each language in ``labelled`` (text, lang)."""
    counts = (
        labelled.filter("lang IS NOT NULL AND text IS NOT NULL")
        .select("text", "lang")
        .mapInArrow(_count_by_language, "lang string, gram bigint, n bigint")
    )
    most = W.partitionBy("lang").orderBy(F.col("n").desc(), "gram")
    return (
        counts.groupBy("lang", "gram")
        .agg(F.sum("n").alias("n"))
        .withColumn("place", F.row_number().over(most))
        .filter(F.col("place") <= length)
        .select("lang", "gram", (F.col("place") - 1).alias("place"))
    )


class Profiles:
    """Profiles as one sorted list of n-grams with a place for each language."""

    def __init__(self, table: pa.Table, length: int):
        langs = table.column("lang").to_pylist()
        self.length = length
        self.names = sorted(set(langs))
        if len(self.names) > MOST_LANGUAGES:
            raise ValueError(f"more than {MOST_LANGUAGES} languages")
        of = {name: i for i, name in enumerate(self.names)}
        grams = table.column("gram").to_numpy()
        self.grams = np.unique(grams)
        self.places = np.full((len(self.names), len(self.grams) + 1), length, np.int64)
        rows = np.fromiter((of[x] for x in langs), np.int64, len(langs))
        self.places[rows, np.searchsorted(self.grams, grams)] = table.column("place").to_numpy()

    def best(self, owner: np.ndarray, gram: np.ndarray, count: np.ndarray) -> dict[int, tuple[str, float]]:
        """The language and score of each owner, given its counts sorted by owner and n-gram."""
        order = np.argsort((owner << 32) - count, kind="stable")
        owner, gram = owner[order], gram[order]
        starts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
        sizes = np.diff(np.append(starts, len(owner)))
        place = np.arange(len(owner)) - np.repeat(starts, sizes)
        keep = place < self.length
        owners, place, gram = owner[starts], place[keep], gram[keep]
        index = np.repeat(np.arange(len(starts)), np.minimum(sizes, self.length))
        at = np.searchsorted(self.grams, gram)
        at[self.grams[np.minimum(at, len(self.grams) - 1)] != gram] = len(self.grams)
        cost = np.empty((len(self.names), len(starts)))
        for i, places in enumerate(self.places):
            theirs = places[at]
            away = np.where(theirs == self.length, self.length, np.abs(theirs - place))
            cost[i] = np.bincount(index, away, len(starts))
        winner = np.argmin(cost, axis=0)
        worst = np.minimum(sizes, self.length) * self.length
        score = 1 - cost[winner, np.arange(len(starts))] / worst
        return {int(o): (self.names[w], float(s)) for o, w, s in zip(owners, winner, score, strict=True)}


def _judged(texts: list[str | None], known: Profiles) -> list[tuple[str, float]]:
    found: dict[int, tuple[str, float]] = {}
    if known.names:
        long = [i for i, text in enumerate(texts) if text and len(text) > SLICE_CHARS // 2]
        for i in long:  # counts of its pieces are added up before they are ranked
            parts = [gram_counts(part, of) for part, of in slices([texts[i]], [i])]
            parts = [part for part in parts if len(part[0])]
            if parts:
                found |= known.best(*_summed(parts))
        short = sorted(set(range(len(texts))) - set(long))
        for part, of in slices([texts[i] for i in short], short):
            counts = gram_counts(part, of)
            if len(counts[0]):
                found |= known.best(*counts)
    return [found.get(i, (UNKNOWN, 0.0)) for i in range(len(texts))]


def predicted(docs: DataFrame, known: Profiles) -> DataFrame:
    """``docs`` with the columns lang_pred and score at the end; learned profiles are all it looks at but the text."""
    schema = docs.select("*", F.lit("").alias("lang_pred"), F.lit(0.0).alias("score")).schema

    def judge(batches):
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
            judged = _judged(texts, known)
            columns = [pa.array([x[0] for x in judged], pa.string()), pa.array([x[1] for x in judged], pa.float64())]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *columns], names=[*batch.schema.names, "lang_pred", "score"]
            )

    return docs.mapInArrow(judge, schema)


def learn(docs: DataFrame, length: int = PROFILE_LENGTH) -> Profiles:
    """Profiles from every row with a language that is not held out."""
    return Profiles(profiles(docs.filter(~held_out(3, 1)), length).toArrow(), length)


def identify(docs: DataFrame, length: int = PROFILE_LENGTH) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document."""
    known = learn(docs, length)
    judged = predicted(docs.select("doc_id", "text"), known)
    return judged.select("doc_id", held_out(3, 1).alias("held_out"), "lang_pred", "score")

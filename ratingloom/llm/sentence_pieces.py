"""SentencePiece encoding and decoding over a relational lattice.

A text becomes units: a run of spaces with what follows it up to the next space. No piece
goes across units, so a unit is encoded once however often it occurs. Its substrings of
bounded length are exploded and joined to the piece table; the matches are the edges of
its lattice, which are grouped by unit and folded with a higher-order aggregate into
the one segmentation that the model's kind asks for:

* ``unigram``: Viterbi, the path with the largest sum of scores (ties: the longer last piece);
* ``bpe``: from single characters, the edge over two neighbouring parts with the best
  score (ties: leftmost) is merged again and again. Viterbi over the scores of a BPE
  model is another segmentation, so it can't give that model's ids.

The lattice encodes the ``DICTIONARY`` most frequent units of the corpus, which are
shipped to all tasks. Rarer ones, and those longer than ``LONGEST_UNIT``, are solved by
the same rule where they stand, as joining them back would move every text.

Defined results: null and empty texts have no ids. Characters without a piece become
their UTF-8 bytes' pieces, or the unknown piece in a model without these. A literal
U+2581 is a space to the model and decodes as one; every other text survives the round
trip through a model with byte pieces. Repeated rows are encoded alike; other columns are
ignored. An empty table gives an empty result. Long texts are encoded whole: a task holds a
few times the longest text, or some ``SLICE`` bytes. Units that are equally frequent at the end of
the dictionary may fall on either side of it, which changes no ids.
"""

from __future__ import annotations

import heapq
import itertools
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratingloom.llm.common import let, most_frequent, small, staged, text_of

SPACE = "▁"
UNIT = rf"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n"
#: Frequent units known to all tasks, at most, and the longest of them.
DICTIONARY = 400_000
LONGEST_UNIT = 48
#: Bytes of text that are coded together, unless one text is longer.
SLICE = 4 << 20
#: Rarer units that a task remembers at once.
REMEMBERED = 100_000
#: A unigram model charges this much more than its worst piece for a character without one.
UNKNOWN_PENALTY = 10.0


@dataclass
class Pieces:
    """The piece table of a model. It has as many rows as the vocabulary, so it fits anywhere."""

    scores: dict[str, tuple[int, float]]
    byte_ids: list[int]
    unknown: int
    kind: str = "bpe"
    spelled: dict[int, bytes] = field(init=False)

    def __post_init__(self):
        self.spelled = {i: piece.encode() for piece, (i, _) in self.scores.items()}
        self.spelled |= {i: bytes([b]) for b, i in enumerate(self.byte_ids)}
        self.cost = {piece: -score for piece, (_, score) in self.scores.items()}
        self.longest = max(map(len, self.scores), default=1)
        self.worst = min((s for _, s in self.scores.values()), default=0.0)

    @classmethod
    def load(cls, path: str, kind: str = "bpe") -> Pieces:
        """The pieces of a SentencePiece model file, read on the driver only."""
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        scores, byte_ids = {}, {}
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                byte_ids[int(piece[3:5], 16)] = i
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                scores[piece] = (i, model.get_score(i))
        return cls(scores, [byte_ids[b] for b in range(256)] if byte_ids else [], model.unk_id(), kind)

    def table(self, spark: SparkSession) -> DataFrame:
        rows = [(piece, i, float(score)) for piece, (i, score) in self.scores.items()]
        return staged(spark.createDataFrame(rows, "piece string, id int, score double"), "pieces")

    def other(self, char: str) -> list[int]:
        """The ids of a character without a piece."""
        return [self.byte_ids[b] for b in char.encode("utf-8", "surrogatepass")] if self.byte_ids else [self.unknown]


def units_of(text: Column) -> Column:
    marked = F.concat(F.lit(SPACE), F.replace(text, F.lit(" "), F.lit(SPACE)))
    return F.regexp_extract_all(F.when(text == "", "").otherwise(marked), F.lit(UNIT), F.lit(0))


# The lattice in Spark.


def edges(units: DataFrame, pieces: Pieces) -> DataFrame:
    """unit and its edges (at, to, id, score): every substring that is a piece."""
    n = F.char_length("unit")
    spans = F.flatten(
        F.transform(
            F.sequence(F.lit(0), n - 1),
            lambda at: F.transform(
                F.sequence(F.lit(1), F.least(F.lit(pieces.longest), n - at)),
                lambda size: F.struct(
                    at.alias("at"), (at + size).alias("to"), F.substring("unit", at + 1, size).alias("piece")
                ),
            ),
        )
    )
    found = (
        units.select("unit", F.explode(spans).alias("span"))
        .select("unit", "span.*")
        .join(small(pieces.table(units.sparkSession)), "piece")
        .groupBy("unit")
        .agg(F.collect_list(F.struct("at", "to", "id", "score")).alias("edges"))
    )
    none = F.array().cast("array<struct<at:int,to:int,id:int,score:double>>")
    return units.select("unit").join(found, "unit", "left").withColumn("edges", F.coalesce("edges", none))


def merge_fold(edges: Column, n: Column) -> Column:
    """The positions between the pieces of a BPE segmentation, as bits 0 to n of a number."""
    one = F.lit(1).cast("long")
    shift = lambda by: F.call_function("shiftleft", one, by)

    def marked(e: Column) -> Column:
        inner = shift(e["to"]) - shift(e["at"] + 1)
        ends = shift(e["to"]).bitwiseOR(shift(e["at"]))
        return F.struct(
            (-e["score"]).alias("cost"), e["at"].alias("at"), inner.alias("inner"), ends.alias("ends")
        )

    longer = F.array_sort(F.transform(F.filter(edges, lambda e: e["to"] - e["at"] > 1), marked))

    def step(ordered: Column) -> Callable[[Column, Column], Column]:
        def merged(bits: Column, _: Column) -> Column:
            fits = F.filter(
                ordered,
                lambda e: (bits.bitwiseAND(e["ends"]) == e["ends"])
                & (F.bit_count(bits.bitwiseAND(e["inner"])) == 1),
            )
            return let(
                F.get(fits, F.lit(0)),
                lambda e: F.when(e.isNull(), bits).otherwise(bits - bits.bitwiseAND(e["inner"])),
            )

        return merged

    return let(
        longer,
        lambda ordered: F.aggregate(F.sequence(F.lit(1), n), shift(n + 1) - 1, step(ordered)),
    )


def viterbi_fold(edges: Column, n: Column, unknown: float) -> Column:
    """The positions between the pieces of the best path, as bits 0 to n of a number."""
    one = F.lit(1).cast("long")
    shift = lambda by: F.call_function("shiftleft", one, by)

    def forward(best: Column, to: Column) -> Column:
        def candidate(at: Column, score: Column) -> Column:
            before = F.get(best, at)
            return F.struct(
                (before["score"] + score).alias("score"),
                (-at).alias("longest"),
                before["bits"].bitwiseOR(shift(to)).alias("bits"),
            )

        ways = F.transform(F.filter(edges, lambda e: e["to"] == to), lambda e: candidate(e["at"], e["score"]))
        alone = F.exists(edges, lambda e: (e["to"] == to) & (e["at"] == to - 1))
        ways = F.when(alone, ways).otherwise(F.array_append(ways, candidate(to - 1, F.lit(unknown))))
        return F.array_append(best, F.array_max(ways))

    start = F.array(F.struct(F.lit(0.0).alias("score"), F.lit(0).alias("longest"), one.alias("bits")))
    return F.aggregate(
        F.sequence(F.lit(1), n), start, forward, lambda best: F.element_at(best, -1)["bits"]
    )


def segmented(units: DataFrame, pieces: Pieces) -> DataFrame:
    """unit, cuts (positions from 0 to its length) and ids of the pieces between; null for what has no piece."""
    n = F.char_length("unit")
    bits = (
        merge_fold(F.col("edges"), n)
        if pieces.kind == "bpe"
        else viterbi_fold(F.col("edges"), n, pieces.worst - UNKNOWN_PENALTY)
    )
    at = F.filter(
        F.sequence(F.lit(0), n), lambda i: F.call_function("getbit", F.col("bits"), i) == 1
    )

    def piece(i: Column, k: Column) -> Column:
        to = F.get("cuts", k + 1)
        return F.get(F.filter("edges", lambda e: (e["at"] == i) & (e["to"] == to)), F.lit(0))["id"]

    return (
        edges(units, pieces)
        .withColumn("bits", bits)
        .withColumn("cuts", at)
        .select(
            "unit",
            "cuts",
            F.slice(F.transform("cuts", piece), F.lit(1), F.size("cuts") - 1).alias("ids"),
        )
    )


def frequent_units(docs: DataFrame, size: int = DICTIONARY) -> DataFrame:
    """unit: the most frequent short units of all texts, at most ``size``."""
    counts = (
        docs.select(F.explode(units_of(text_of())).alias("unit"))
        .filter(F.char_length("unit") <= LONGEST_UNIT)
        .groupBy("unit")
        .agg(F.count("*").alias("n"))
        .filter("n > 1")
    )
    return most_frequent(staged(counts, "unit-counts"), size).select("unit")


# The same rules for one unit, where it stands.


def _merged(unit: str, pieces: Pieces) -> list[str]:
    return _merged_short(unit, pieces.cost) if len(unit) <= 64 else _merged_long(unit, pieces)


def _merged_short(unit: str, cost: dict[str, float]) -> list[str]:
    parts = list(unit)
    never = float("inf")
    joints = [cost.get(a + b, never) for a, b in itertools.pairwise(parts)]
    while joints and (least := min(joints)) < never:
        i = joints.index(least)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
        del joints[i]
        if i < len(joints):
            joints[i] = cost.get(parts[i] + parts[i + 1], never)
        if i:
            joints[i - 1] = cost.get(parts[i - 1] + parts[i], never)
    return parts


def _merged_long(unit: str, pieces: Pieces) -> list[str]:
    """The same with a heap, for units in which looking at every joint again costs too much."""
    parts: list[str | None] = list(unit)
    n = len(parts)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = []

    def offer(i: int) -> None:
        if 0 <= i and after[i] < n:
            joint = parts[i] + parts[after[i]]
            if joint in pieces.cost:
                heapq.heappush(heap, (pieces.cost[joint], i, joint))

    for i in range(n - 1):
        offer(i)
    while heap:
        _, i, joint = heapq.heappop(heap)
        if parts[i] is None or after[i] >= n or parts[i] + parts[after[i]] != joint:
            continue
        gone = after[i]
        parts[i], parts[gone] = joint, None
        after[i] = after[gone]
        if after[i] < n:
            before[after[i]] = i
        offer(before[i])
        offer(i)
    return [part for part in parts if part is not None]


def _best_path(unit: str, pieces: Pieces) -> list[str]:
    best: list[tuple[float, int]] = [(0.0, 0)]
    for to in range(1, len(unit) + 1):
        ways = []
        for at in range(max(0, to - pieces.longest), to):
            known = pieces.scores.get(unit[at:to])
            if known or to - at == 1:
                ways.append((best[at][0] + (known[1] if known else pieces.worst - UNKNOWN_PENALTY), -at))
        score, at = max(ways)
        best.append((score, -at))
    parts, to = [], len(unit)
    while to:
        at = best[to][1]
        parts.append(unit[at:to])
        to = at
    return parts[::-1]


def unit_ids(unit: str, pieces: Pieces) -> list[int]:
    parts = _merged(unit, pieces) if pieces.kind == "bpe" else _best_path(unit, pieces)
    ids: list[int] = []
    for part in parts:
        known = pieces.scores.get(part)
        ids += [known[0]] if known else pieces.other(part)
    return ids


# Coding by batch: units and ids as Arrow arrays, Python for units outside the dictionary only.


def _offsets(array: pa.Array) -> np.ndarray:
    return np.frombuffer(array.buffers()[1], np.int32)[array.offset : array.offset + len(array) + 1]


def cut(texts: pa.StringArray) -> tuple[pa.StringArray, np.ndarray]:
    """The units of all texts, and for each text (and the end) the number of its first unit.

    A unit starts with a text, at and behind a line feed, and at a mark that follows
    another character.
    """
    prefix = pc.if_else(pc.equal(texts, ""), "", SPACE)
    marked = pc.binary_join_element_wise(prefix, pc.replace_substring(texts, " ", SPACE), "")
    ends = _offsets(marked)
    data = np.frombuffer(marked.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
    ends = ends - ends[0]
    starts = np.zeros(len(data) + 3, bool)
    line = np.flatnonzero(data == ord("\n"))
    starts[line], starts[line + 1] = True, True
    first, second, third = SPACE.encode()
    mark = np.flatnonzero(data == first)
    mark = mark[(data[mark + 1] == second) & (data[mark + 2] == third)]
    starts[mark[np.diff(mark, prepend=-4) != 3]] = True
    starts[ends] = True
    at = np.flatnonzero(starts[: len(data)])
    edges = np.append(at, len(data)).astype(np.int32)
    units = pa.StringArray.from_buffers(len(at), pa.py_buffer(edges), pa.py_buffer(data))
    return units, np.searchsorted(at, ends)


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """``batch`` in runs of rows with at most ``SLICE`` bytes of text, or of one row."""
    ends, at = _offsets(batch.column("text")), 0
    while at < len(batch):
        to = max(at + 1, int(np.searchsorted(ends, int(ends[at]) + SLICE, "right")) - 1)
        yield batch.slice(at, to - at)
        at = to


def spellings(pieces: Pieces) -> pa.BinaryArray:
    """The bytes of every id up to the highest that has any, and of an unknown one."""
    unknown = " ⁇ ".encode()
    return pa.array([pieces.spelled.get(i, unknown) for i in range(max(pieces.spelled, default=0) + 2)], pa.binary())


def spelled(ids: pa.ListArray, table: pa.BinaryArray) -> pa.BinaryArray:
    """The bytes of each list of ids, put together. Ids without bytes are unknown ones."""
    flat = ids.flatten().fill_null(-1).to_numpy(zero_copy_only=False)
    last = len(table) - 1
    parts = table.take(pa.array(np.where((flat < 0) | (flat > last), last, flat)))
    bounds = np.concatenate(([0], np.cumsum(pc.list_value_length(ids).fill_null(0)))).astype(np.int64)
    ends = _offsets(parts)
    buffers = [None, pa.py_buffer(np.ascontiguousarray(ends[bounds])), parts.buffers()[2] or pa.py_buffer(b"")]
    return pa.Array.from_buffers(pa.binary(), len(ids), buffers)


def plain(data: bytes) -> str:
    """The text of spelled ids: marks as spaces, without the space in front."""
    return data.decode("utf-8", "replace").replace(SPACE, " ")[1:]


@dataclass
class Dictionary:
    """Units whose ids are known, each once. ``DICTIONARY`` bounds it."""

    units: pa.StringArray
    ids: pa.ListArray

    @classmethod
    def of(cls, solved: DataFrame, pieces: Pieces) -> Dictionary:
        """From unit, cuts and ids as ``segmented`` gives them."""
        found = solved.withColumn("open", F.exists("ids", F.isnull)).toArrow().combine_chunks()
        whole, open_ = found.filter(pc.invert(found["open"])), found.filter(found["open"])
        columns = (open_.column(c).to_pylist() for c in ("unit", "cuts", "ids"))
        mended = [
            [i for known, at in zip(ids, cuts, strict=False) for i in (pieces.other(unit[at]) if known is None else [known])]
            for unit, cuts, ids in zip(*columns, strict=True)
        ]
        kind = pa.list_(pa.int32())
        return cls(
            pa.concat_arrays([*whole["unit"].chunks, *open_["unit"].chunks, pa.array([], pa.string())]),
            pa.concat_arrays([*(c.cast(kind) for c in whole["ids"].chunks), pa.array(mended, kind)]),
        )

    def look_up(self, units: pa.StringArray, missing: Callable[[str], list[int]]) -> pa.ListArray:
        """The ids of each unit; ``missing`` gives those of a unit that is not here."""
        at = pc.index_in(units, value_set=self.units)
        known = self.ids.take(at.drop_null())
        others = pa.array(map(missing, units.filter(at.is_null()).to_pylist()), known.type)
        is_known = at.is_valid().to_numpy(zero_copy_only=False)
        place = np.empty(len(units), np.int64)
        place[is_known] = np.arange(len(known))
        place[~is_known] = len(known) + np.arange(len(others))
        return pa.concat_arrays([known, others]).take(pa.array(place))


def _coder(pieces, dictionary):
    def code(batches):
        table, known = pieces.value, dictionary.value
        spelling = spellings(table)
        rare: dict[str, list[int]] = {}

        def solved(unit: str) -> list[int]:
            if unit not in rare:
                if len(rare) >= REMEMBERED:
                    rare.clear()
                rare[unit] = unit_ids(unit, table)
            return rare[unit]

        for batch in itertools.chain.from_iterable(map(_slices, batches)):
            texts = pc.fill_null(batch.column("text"), "")
            units, first = cut(texts)
            coded = units.dictionary_encode()
            lists = known.look_up(coded.dictionary, solved)
            wrong = pc.not_equal(spelled(lists, spelling), coded.dictionary.cast(pa.binary()))
            wrong = wrong.to_numpy(zero_copy_only=False)[coded.indices.to_numpy()]
            by_unit = lists.take(coded.indices)
            offsets = np.concatenate(([0], np.cumsum(pc.list_value_length(by_unit))))[first].astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(offsets), by_unit.flatten())
            same = ~pc.match_substring(texts, SPACE).to_numpy(zero_copy_only=False)
            # Units that are not spelled as they were leave the answer to the whole text.
            until = np.concatenate(([0], np.cumsum(wrong)))[first]
            for i in np.flatnonzero(same & (np.diff(until) > 0)):
                same[i] = plain(spelled(ids.slice(i, 1), spelling)[0].as_py()) == texts[i].as_py()
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), ids, pa.array(np.diff(offsets).astype(np.int64)), pa.array(same)],
                ["doc_id", "ids", "n_ids", "round_trip"],
            )

    return code


def encoded(docs: DataFrame, pieces: Pieces, dictionary: int = DICTIONARY) -> DataFrame:
    """doc_id, ids, n_ids and round_trip (whether the ids decode to the very text) of every document."""
    context = docs.sparkSession.sparkContext
    known = Dictionary.of(segmented(staged(frequent_units(docs, dictionary), "units"), pieces), pieces)
    coder = _coder(context.broadcast(pieces), context.broadcast(known))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        coder, f"doc_id {kind}, ids array<int>, n_ids bigint, round_trip boolean"
    )


def decoded(coded: DataFrame, pieces: Pieces) -> DataFrame:
    """doc_id and text of the ids of every row.

    Null or no ids are an empty text, ids without a piece read " ⁇ ", and bytes that are no
    UTF-8 become U+FFFD.
    """
    table = coded.sparkSession.sparkContext.broadcast(pieces)
    kind = coded.schema["doc_id"].dataType.simpleString()

    def decode(batches):
        spelling = spellings(table.value)
        for batch in batches:
            data = spelled(batch.column("ids"), spelling)
            try:
                marked = pc.replace_substring(data.cast(pa.string()), SPACE, " ")
                texts = pc.utf8_slice_codeunits(marked, 1)
            except pa.ArrowInvalid:
                texts = pa.array(map(plain, data.to_pylist()), pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), texts], ["doc_id", "text"])

    return coded.select("doc_id", "ids").mapInArrow(decode, f"doc_id {kind}, text string")

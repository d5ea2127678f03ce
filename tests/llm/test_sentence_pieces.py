import itertools
import re

import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F

from ratingloom.llm import sentence_pieces as sp

PATH = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [
    "Hello  world",
    " hi\nyou ",
    "",
    "  a   b\n\n c\r\n",
    "日本語のテキスト x",
    "a\tb ﬁ ① é x",
    "123 4567 </s> <s> <0x0A>",
    "Eauouon. Enpaeux leaux le ouè eauenaux. unbelievable internationalization",
    "x" * 300,
    "ab" * 40 + " " * 40 + "end",
    "der die das und " * 50,
]


@pytest.fixture(scope="module")
def pieces():
    return sp.Pieces.load(PATH)


def documents(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")


@pytest.mark.parametrize("dictionary", [200_000, 1])
def test_ids_are_those_of_the_library(spark, pieces, dictionary):
    model = sentencepiece.SentencePieceProcessor(model_file=PATH)
    texts = [*TEXTS, *TEXTS]
    found = sp.encoded(documents(spark, texts), pieces, dictionary).orderBy("doc_id").collect()
    assert [r.ids for r in found] == [model.encode(text) for text in texts]
    assert all(r.round_trip and r.n_ids == len(r.ids) for r in found)


def test_cuts_are_those_of_the_pattern():
    texts = [*TEXTS, "", "▁", "▁▁ \n", "\n", " ", "a▁b", "\n\n ", ""]
    units, first = sp.cut(pa.array(["skipped", *texts]).slice(1))
    units = units.to_pylist()
    for k, text in enumerate(texts):
        marked = sp.SPACE + text.replace(" ", sp.SPACE) if text else ""
        assert units[first[k] : first[k + 1]] == re.findall(sp.UNIT, marked)
    assert sp.cut(pa.array([], pa.string()))[0].to_pylist() == []


def test_slices_cover_a_batch_in_order(monkeypatch):
    monkeypatch.setattr(sp, "SLICE", 10)
    texts = pa.array(["abc", None, "x" * 30, "", "äö", "1234567", "z"])
    batch = pa.RecordBatch.from_arrays([texts], ["text"]).slice(1)
    parts = [part.column("text").to_pylist() for part in sp._slices(batch)]
    assert sum(parts, []) == texts.to_pylist()[1:]
    assert all(len(part) == 1 or sum(len((t or "").encode()) for t in part) <= 10 for part in parts)


def test_decoding_gives_the_texts_back(spark, pieces):
    coded = sp.encoded(documents(spark, TEXTS), pieces)
    found = {r.doc_id: r.text for r in sp.decoded(coded, pieces).collect()}
    assert found == dict(enumerate(TEXTS))


def test_decoding_of_odd_ids(spark, pieces):
    mark, broken = pieces.scores[sp.SPACE][0], pieces.byte_ids[0xE2]
    rows = [(1, None), (2, []), (3, [mark, broken]), (4, [mark, 10**6, -1]), (None, [mark, mark])]
    found = sp.decoded(spark.createDataFrame(rows, "doc_id bigint, ids array<int>"), pieces)
    assert {r.doc_id: r.text for r in found.collect()} == {1: "", 2: "", 3: "\ufffd", 4: " ⁇  ⁇ ", None: " "}


def test_a_model_without_bytes_tells_what_it_loses(spark):
    pieces = sp.Pieces({sp.SPACE: (1, -1.0), "a": (2, -2.0), f"{sp.SPACE}a": (3, -3.0)}, [], 0)
    found = sp.encoded(documents(spark, ["a a", "a b", "", "aa"]), pieces)
    assert {r.doc_id: (r.ids, r.round_trip) for r in found.collect()} == {
        0: ([3, 3], True), 1: ([3, 1, 0], False), 2: ([], True), 3: ([3, 2], True),
    }


def test_lattice_gives_what_one_unit_gives(spark, pieces):
    units = sorted({u for text in TEXTS for u in re.findall(sp.UNIT, sp.SPACE + text.replace(" ", sp.SPACE))})
    units = [u for u in units if len(u) <= sp.LONGEST_UNIT]
    rows = sp.segmented(spark.createDataFrame([(u,) for u in units], "unit string"), pieces).collect()
    assert len(rows) == len(units)
    for row in rows:
        parts = [row.unit[a:b] for a, b in itertools.pairwise(row.cuts)]
        assert parts == sp._merged(row.unit, pieces) == sp._merged_long(row.unit, pieces)
        assert row.ids == [pieces.scores.get(p, (None,))[0] for p in parts]


def test_viterbi_finds_the_best_of_all_segmentations(spark):
    scores = {"a": -2.0, "b": -3.0, "ab": -2.5, "ba": -3.5, "aba": -6.0, "bb": -9.0, "abab": -4.0}
    pieces = sp.Pieces({p: (i + 1, s) for i, (p, s) in enumerate(scores.items())}, [], 0, "unigram")
    units = ["".join(u) for n in range(1, 7) for u in itertools.product("ab", repeat=n)] + ["c", "acb", "abcab"]
    rows = sp.segmented(spark.createDataFrame([(u,) for u in units], "unit string"), pieces).collect()

    def worth(parts):
        return sum(scores.get(p, min(scores.values()) - sp.UNKNOWN_PENALTY) for p in parts)

    for row in rows:
        n = len(row.unit)
        ways = []
        for size in range(n):
            for inner in itertools.combinations(range(1, n), size):
                parts = [row.unit[a:b] for a, b in itertools.pairwise([0, *inner, n])]
                if all(p in scores or len(p) == 1 for p in parts):
                    ways.append(worth(parts))
        parts = [row.unit[a:b] for a, b in itertools.pairwise(row.cuts)]
        assert worth(parts) == pytest.approx(max(ways))
        assert parts == sp._best_path(row.unit, pieces)


def test_odd_rows(spark, pieces):
    docs = spark.createDataFrame(
        [(1, None), (None, "a b"), (2, "a b"), (2, "a b"), (3, "y" * 200_000), (4, "▁x")],
        "doc_id bigint, text string",
    ).withColumn("ids", F.lit("mine")).withColumn("unit", F.lit(0))
    found = {(r.doc_id, r.n_ids > 0): r for r in sp.encoded(docs, pieces).collect()}
    assert found[1, False].ids == [] and found[1, False].round_trip
    assert found[None, True].ids == found[2, True].ids
    assert found[3, True].round_trip and not found[4, True].round_trip
    assert sp.encoded(docs.limit(0), pieces).count() == 0

import os
import random

from pyspark.sql import functions as F

from ratingloom.llm import substrings

SCHEMA = "doc_id bigint, text string"


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyzäß") for _ in range(rng.randint(2, 9))) for _ in range(n))


def test_chunks_cover_the_text_within_bounds_and_keep_characters_whole():
    for text in [prose(1, 4000), "", "ä" * 9000, "\x00" * 5000, "x", "日本語" * 2000]:
        data = text.encode()
        spans = substrings.chunk_spans(data)
        assert b"".join(data[a:b] for a, b in spans) == data
        assert "".join(data[a:b].decode() for a, b in spans) == text
        assert all(b - a <= substrings.LONGEST + 3 for a, b in spans)
        assert all(b - a >= substrings.SHORTEST for a, b in spans[:-1])


def test_cuts_fall_in_step_after_an_insertion_and_across_windows(monkeypatch):
    text = prose(2, 3000).encode()
    own = {text[a:b] for a, b in substrings.chunk_spans(text)}
    other = b"something else in front " + text
    moved = {other[a:b] for a, b in substrings.chunk_spans(other)}
    assert len(own & moved) > 0.99 * len(own)
    spans = substrings.chunk_spans(text)
    monkeypatch.setattr(substrings, "WINDOW", 1000)
    assert substrings.chunk_spans(text) == spans


def test_shared_passages_are_found_and_clean_documents_left_alone(spark):
    passages = [prose(1000 + i, 55) for i in range(40)]
    data = [(i, prose(i, 200)) for i in range(200)]
    for i in range(40):
        for doc in (i, 40 + i, 80 + i):
            words = data[doc][1].split(" ")
            data[doc] = (doc, " ".join([*words[: 50 + i], passages[i], *words[50 + i :]]))
    result = substrings.repeated_passages(spark.createDataFrame(data, SCHEMA)).collect()
    assert {r.doc_id for r in result} == set(range(120))
    texts = {i: t.encode() for i, t in data}
    for r in result:
        own, passage = texts[r.doc_id], passages[r.doc_id % 40].encode()
        at = own.index(passage)
        before, after = own[:at], own[at + len(passage) :]
        # What the documents have in common may go on beyond the passage, by the same letters on either side.
        cut = [texts[d].partition(passage) for d in range(r.doc_id % 40, 120, 40) if d != r.doc_id]
        left = max(len(os.path.commonprefix([before[::-1], other[0][::-1]])) for other in cut)
        right = max(len(os.path.commonprefix([after, other[2]])) for other in cut)
        assert at - left <= r.start < r.start + r.length <= at + len(passage) + right
        assert (r.first_doc_id, r.kept, r.copies) == (r.doc_id % 40, r.doc_id < 40, 3)


def test_cut_texts_keep_one_copy(spark):
    passage = prose(7, 80)
    data = [(1, "alpha " + passage + " omega"), (2, prose(8, 30) + " " + passage), (3, prose(9, 50)), (4, None)]
    docs = spark.createDataFrame(data, SCHEMA).withColumn("cuts", F.lit("mine")).withColumn("row", F.lit(1))
    result = substrings.without_repeats(docs)
    assert result.columns == docs.columns
    found = {r.doc_id: r.text for r in result.collect()}
    assert (found[1], found[3], found[4]) == (data[0][1], data[2][1], None)
    assert len(found[2]) < len(data[1][1]) - 300 and found[2].startswith(prose(8, 25))


def test_odd_rows(spark):
    text = prose(3, 60)
    data = [(1, text), (1, text), (2, None), (3, ""), (None, prose(4, 60)), (None, prose(4, 60))]
    assert substrings.repeated_passages(spark.createDataFrame(data, SCHEMA)).count() == 0
    data += [(5, text), (None, text)]
    found = substrings.repeated_passages(spark.createDataFrame(data, SCHEMA)).collect()
    assert {(r.doc_id, r.first_doc_id, r.kept) for r in found} == {(1, 1, True), (5, 1, False), (None, 1, False)}
    assert substrings.repeated_passages(spark.createDataFrame(data, SCHEMA).limit(0)).count() == 0


def test_texts_of_one_id_are_apart(spark):
    one, two, clean = prose(21, 80), prose(22, 80), prose(23, 160)
    data = [(1, one), (2, two), (None, "first " + one), (None, "other " + two), (None, clean), (5, "x " + one), (5, clean + " end")]
    data += [(3, "y " + one), (4, "z " + two)] + [(None, "first " + one)] * 20
    docs = spark.createDataFrame(data, SCHEMA)
    result = substrings.repeated_passages(docs.filter("doc_id IS NULL OR doc_id < 5").filter(~F.col("text").contains(clean)))
    found = [(r.first_doc_id, r.length > 400) for r in result.collect() if r.doc_id is None]
    assert sorted(found) == [(1, True), (2, True)]
    cut = [(r.doc_id, r.text) for r in substrings.without_repeats(docs.filter(F.coalesce("doc_id", F.lit(0)) > 0)).collect()]
    assert (5, clean + " end") in cut and (1, one) in cut
    assert len(cut) == 6 and all(len(t) < 200 for i, t in cut if i == 5 and t.startswith("x "))

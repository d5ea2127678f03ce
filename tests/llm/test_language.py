import random
import tracemalloc
from collections import Counter

import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

from ratingloom.llm import language

WORDS = {
    "en": "the of and that with this from have which their would there about",
    "de": "der und die nicht ein mit sich auch auf werden haben einer für",
    "fr": "les des une que dans pour qui par avec sont cette mais été",
}


def corpus():
    rows = []
    for i in range(90):
        lang = ("en", "de", "fr")[i % 3]
        words = WORDS[lang].split()
        rows.append((i, " ".join(words[(i * j + j) % len(words)] for j in range(1, 30)).title() + f" {i}!", lang))
    return rows


def grams(text):
    counts = Counter()
    for word in "".join(c if c.isalpha() else " " for c in text.lower()).split():
        padded = f" {word} "
        counts.update(word)
        counts.update(padded[i : i + 2] for i in range(len(padded) - 1))
        counts.update(padded[i : i + 3] for i in range(len(padded) - 2))
    return counts


def ranked(counts, length):
    # Shorter n-grams first among equals, then by code points.
    order = sorted(counts, key=lambda g: (-counts[g], len(g), g))
    return {g: i for i, g in enumerate(order[:length])}


def brute(learn, texts, length):
    by = {}
    for _, text, lang in learn:
        by.setdefault(lang, Counter()).update(grams(text))
    profiles = {lang: ranked(c, length) for lang, c in sorted(by.items())}
    found = []
    for text in texts:
        own = ranked(grams(text or ""), length)
        if not own:
            found.append(("und", 0.0))
            continue
        cost = {
            lang: sum(abs(i - p[g]) if g in p else length for g, i in own.items()) for lang, p in profiles.items()
        }
        lang = min(cost, key=cost.get)
        found.append((lang, 1 - cost[lang] / (len(own) * length)))
    return found


@pytest.mark.parametrize("length", [40, 400])
def test_equals_brute_force(spark, length):
    docs = spark.createDataFrame(corpus(), "doc_id bigint, text string, lang string").withColumn("score", F.lit("mine"))
    result = {r.doc_id: r for r in language.identify(docs, length).collect()}
    assert len(result) == 90
    learn = [row for row in corpus() if not result[row[0]].held_out]
    assert 0 < len(learn) < 90
    for (doc_id, _, _), (lang, score) in zip(corpus(), brute(learn, [r[1] for r in corpus()], length)):
        assert result[doc_id].lang_pred == lang
        assert result[doc_id].score == pytest.approx(score)
    assert all(result[i].lang_pred == lang for i, _, lang in corpus())


def test_labels_of_held_out_rows_and_ids_change_nothing(spark):
    docs = spark.createDataFrame(corpus(), "doc_id bigint, text string, lang string")
    before = {r.doc_id: r for r in language.identify(docs).collect()}
    swapped = [(i, t, "xx" if before[i].held_out else lang) for i, t, lang in corpus()]
    after = language.identify(spark.createDataFrame(swapped, "doc_id bigint, text string, lang string"))
    assert {r.doc_id: r for r in after.collect()} == before


def test_odd_rows(spark):
    data = [
        *corpus(), (100, None, "en"), (101, "", None), (102, "123 !?\n", "de"), (None, "the and", None),
        (103, "the of and that " * 200_000, None), (104, "q" * 1_700_000, None), (105, "\U0001F600 \x00 日本", None),
    ]
    docs = spark.createDataFrame(data, "doc_id bigint, text string, lang string")
    found = {r.doc_id: r for r in language.identify(docs).collect()}
    assert [(found[i].lang_pred, found[i].score) for i in (100, 101, 102)] == [("und", 0.0)] * 3
    assert found[None].lang_pred == "en" and found[103].lang_pred == "en"
    assert all(0 <= r.score <= 1 for r in found.values())
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in language.identify(unlabelled).collect()} == {"und"}
    assert language.identify(docs.limit(0)).count() == 0


def test_pieces_of_a_long_text_count_as_one(spark):
    text = " ".join(WORDS["de"].split() * 40_000)
    parts = [language.gram_counts(p, of) for p, of in language.slices([text], [0])]
    assert len(parts) > 1
    _, codes, counts = language._summed(parts)
    expected = grams(text)
    spelled = {"".join(chr(c >> s & 0x1FFFFF) for s in (42, 21, 0)).lstrip("\x00"): n for c, n in zip(codes.tolist(), counts.tolist())}
    assert spelled == expected


def test_memory_of_a_task_does_not_follow_its_texts():
    rng = random.Random(9)
    texts = ["".join(rng.choice("abcdefghij klmnop") for _ in range(900)) for _ in range(2_000)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array(["xx", "yy"] * 1_000)], ["text", "lang"])
    counted = pa.Table.from_batches(list(language._count_by_language([batch])))
    most = pc.sort_indices(counted["n"], [("", "descending")])[:400]
    learned = counted.take(most).append_column("place", pa.array(range(400)))
    known = language.Profiles(learned.select(["lang", "gram", "place"]), 400)
    peaks = []
    for work in (lambda: list(language._count_by_language([batch])), lambda: language._judged(texts, known)):
        tracemalloc.start()
        work()
        peaks.append(tracemalloc.get_traced_memory()[1] >> 20)
        tracemalloc.stop()
    assert max(peaks) < 100, peaks

import hashlib
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from ratingloom.llm import exact_dedup
from ratingloom.llm.oracle import ORACLES
from tests.conftest import rows
from tools.check_oracles import compare

SCHEMA = "doc_id bigint, text string"


def folded(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def brute(data):
    groups = {}
    for doc_id, text in data:
        groups.setdefault(folded(text), []).append(doc_id)
    found = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = max(known) if known else None
        left = 1
        for i in ids:
            kept = i == keep and left > 0
            left -= kept
            found.append((i, keep, len(ids), kept, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(found, key=repr)


LONG = "Straße und Wort, " * 5000
DATA = [
    (1, "Hello World"), (2, "hello world"), (3, "hello  world"), (4, "ÀB"), (5, "àb"), (6, "Àb"), (7, None), (8, ""),
    (9, LONG), (10, LONG.upper().replace("SS", "ß")), (11, LONG), (12, LONG + "x"), (13, "x" * 30000), (13, "x" * 30000),
    (None, "n"), (None, "N"), (14, "same"), (14, "SAME"), (15, "\n \n"),
]


@pytest.mark.parametrize("bits", [64, 3])
def test_equals_brute_force(spark, bits):
    docs = spark.createDataFrame(DATA, SCHEMA).withColumn("recipe", F.lit("mine")).withColumn("times", F.lit(1))
    result = exact_dedup.exact_duplicates(docs, bits=bits)
    assert sorted(map(tuple, result.collect()), key=repr) == brute(DATA)
    assert exact_dedup.exact_duplicates(docs.limit(0)).count() == 0


def test_equals_its_sql(spark):
    data = [(i, f"text {i % 7} " * (i % 5 * 300)) for i in range(60)]
    base = duckdb.connect()
    docs = spark.createDataFrame(data, SCHEMA)
    base.register("documents", docs.toArrow())
    theirs = base.sql(ORACLES["op1_exact_dedup"]).to_arrow_table()
    assert compare(exact_dedup.exact_duplicates(docs).toArrow(), theirs) == "equal, 60 rows"


def test_few_hash_bits_widen_the_identifier(spark):
    chunks = spark.createDataFrame([(f"chunk {i}",) for i in range(100)], "chunk string")
    assert exact_dedup.identifier_width(chunks) == 1
    assert exact_dedup.identifier_width(chunks, bits=4) > 2


def test_chunks_make_up_the_text_and_survive_an_insertion(spark):
    words = "and by my to of be had a the from word stone river among we he every green house in".split()
    rng = random.Random(3)
    text = "".join(rng.choice(words) + " " for _ in range(9000))
    docs = spark.createDataFrame([(1, text), (2, "inserted here " + text), (3, "y" * 20000)], SCHEMA)
    cut = {r[0]: r[1] for r in rows(docs.select("doc_id", exact_dedup.chunks_of(F.col("text"))))}
    assert "".join(cut[1]) == text and "".join(cut[3]) == "y" * 20000
    assert max(map(len, cut[3])) <= exact_dedup.LONGEST
    assert len(set(cut[1]) & set(cut[2])) > len(cut[1]) * 0.8


def test_a_hot_text_is_split_by_the_join(spark):
    plan = exact_dedup.exact_duplicates(spark.createDataFrame(DATA, SCHEMA))._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoop" not in plan and "Python" not in plan


def test_a_third_of_all_rows_is_one_row_repeated(spark):
    """Rows of a null id without text, and of an id with a text, come back one by one, and one of each stays."""
    data = [(None, None)] * 300 + [(7, "the same text")] * 300 + [(i, f"text {i}") for i in range(100, 400)]
    result = exact_dedup.exact_duplicates(spark.createDataFrame(data, SCHEMA).repartition(6))
    found = {(r.doc_id, r.keep_id, r.group_size): r["count"] for r in result.groupBy("doc_id", "keep_id", "group_size").count().collect()}
    assert found[None, None, 300] == found[7, 7, 300] == 300 and len(found) == 302
    assert result.filter("kept").count() == 302
    plan = result._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and "collect_list" not in plan

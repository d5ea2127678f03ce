import math

import duckdb
import pytest
from pyspark.sql import functions as F

from ratingloom.llm import mixing
from ratingloom.llm.oracle import ORACLES
from tests.conftest import rows
from tools.check_oracles import compare


def documents(spark, data):
    return spark.createDataFrame(data, "doc_id bigint, text string, source string")


def test_tree_keeps_quotas_and_evens_shards(spark):
    quotas = spark.createDataFrame([([10, 0, 333, 57],)], "quotas array<bigint>")
    shards = [list(row[0]) for row in mixing.splitting_tree(quotas, 7).select("quotas").collect()]
    assert len(shards) == 7
    assert [sum(column) for column in zip(*shards)] == [10, 0, 333, 57]
    totals = [sum(shard) for shard in shards]
    assert max(totals) - min(totals) <= 3
    again = [list(row[0]) for row in mixing.splitting_tree(quotas, 7).select("quotas").collect()]
    assert shards == again


def test_tree_of_one_shard(spark):
    quotas = spark.createDataFrame([([4],)], "quotas array<bigint>")
    assert rows(mixing.splitting_tree(quotas, 1)) == [(0, [4])]


@pytest.mark.parametrize("total, marked, drawn", [(20, 8, 5), (1000, 300, 500), (7, 7, 3), (5, 0, 5), (0, 0, 0)])
def test_hypergeometric_follows_its_distribution(spark, total, marked, drawn):
    from math import comb

    n = 4000
    u = (F.col("id") + 0.5) / n
    draws = spark.range(n).select(mixing.hypergeometric(u, F.lit(total), F.lit(marked), F.lit(drawn)).alias("k"))
    counts = dict(draws.groupBy("k").count().collect())
    for k in range(drawn + 1):
        if k <= marked and drawn - k <= total - marked:
            chance = comb(marked, k) * comb(total - marked, drawn - k) / comb(total, drawn)
            assert abs(counts.get(k, 0) / n - chance) < 1e-3
        else:
            assert k not in counts


def test_targets_share_the_excess(spark):
    # 150 % of 100 words is 150; the small sources stop at twice their size.
    data = [(1, "w " * 10, "a"), (2, "w " * 60, "b"), (3, "w " * 30, None)]
    found = {r.doc_id: (r.target, r.taken) for r in mixing.mix_counts(documents(spark, data)).collect()}
    assert {k: round(v[0], 6) for k, v in found.items()} == {1: 20.0, 2: pytest.approx(86.666667), 3: pytest.approx(43.333333)}
    assert found[1][1] == 20


def test_mix_comes_near_targets_with_many_shards(spark):
    data = [(i, "w " * (1 + i * 7919 % 50), f"s{i % 4}") for i in range(2000)]
    docs = documents(spark, data)
    counts = mixing.mix_counts(docs, words_per_shard=5000)
    for row in counts.groupBy(F.col("doc_id") % 4).agg(F.first("target").alias("t"), F.sum("taken").alias("n")).collect():
        assert abs(row.n - row.t) <= 50
    assert counts.filter("taken > 2 * size").isEmpty()
    copies = mixing.mixed(docs, words_per_shard=5000)
    taken = {r.doc_id: r.n for r in copies.groupBy("doc_id").agg(F.count("*").alias("n")).collect()}
    assert taken == {r.doc_id: r.taken // r.size for r in counts.collect() if r.taken}
    assert copies.select("shard").distinct().count() > 1
    assert rows(mixing.mix_counts(docs, words_per_shard=5000)) == rows(counts)


@pytest.mark.parametrize("hot_id", [7, None])
@pytest.mark.parametrize("same_text", [True, False])
def test_a_third_of_all_rows_under_one_id(spark, hot_id, same_text):
    sizes = [1 + i * 7919 % 50 for i in range(3000)]
    data = [
        (hot_id if i % 3 == 0 else i, "w " * (23 if same_text and i % 3 == 0 else n), "c" if i % 3 == 0 else f"s{i % 4}")
        for i, n in enumerate(sizes)
    ]
    docs = documents(spark, data)
    counts = mixing.mix_counts(docs, words_per_shard=5000)
    by_target = counts.groupBy("target", "source_size").agg(F.sum("taken").alias("n"), F.max("size").alias("most"))
    assert all(abs(r.n - r.target) <= r.most for r in by_target.collect())
    base = duckdb.connect()
    base.register("documents", docs.toArrow())
    theirs = base.sql(ORACLES["op5_mixing"]).to_arrow_table()
    assert compare(counts.toArrow(), theirs) == "equal, 3000 rows"
    copies = mixing.mixed(docs, words_per_shard=5000)
    words = copies.groupBy("source").agg(F.sum(F.regexp_count("text", F.lit("w"))).alias("n"))
    assert sum(r.n for r in words.collect()) == sum(r.n for r in by_target.collect())


def test_shards_hold_their_quotas(spark):
    data = [(i, "w " * (1 + i % 9), f"s{i % 3}") for i in range(3000)]
    docs = documents(spark, data)
    _, sources, draws = mixing._plan(docs, 1500)
    quotas = sources.agg(F.array_sort(F.collect_list(F.struct("ordinal", "quota"))).alias("q")).select("q.quota")
    shards = math.ceil(sources.agg(F.sum("target")).first()[0] / 1500)
    tree = mixing.splitting_tree(quotas.withColumnRenamed("quota", "quotas"), shards).collect()
    due = {(r.shard, k): n for r in tree for k, n in enumerate(r.quotas) if n}
    drawn = draws.select("ordinal", F.explode("draws.shard").alias("shard")).groupBy("shard", "ordinal").count()
    assert shards > 4 and {(r["shard"], r["ordinal"]): r["count"] for r in drawn.collect()} == due


def test_odd_rows_and_clashing_columns(spark):
    data = [(1, None, "a"), (2, "", "a"), (None, "x y", "a"), (None, "x y", "a"), (3, "z", None)]
    docs = documents(spark, data).withColumn("size", F.lit("mine")).withColumn("key", F.lit(0))
    counts = mixing.mix_counts(docs)
    assert counts.count() == 5
    assert {(r.doc_id, r.size) for r in counts.collect()} == {(1, 0), (2, 0), (None, 2), (3, 1)}
    assert mixing.mixed(docs).columns == ["doc_id", "text", "source", "size", "key", "shard"]
    assert set(mixing.mixed(docs).select("size").distinct().collect()) <= {("mine",)}
    assert mixing.mix_counts(docs.limit(0)).count() == 0
    assert mixing.mixed(docs.limit(0)).count() == 0

"""A keyed table by merged runs."""

import pytest
from pyspark.sql import functions as F

from ratingloom.sources.files import folder_names
from ratingloom.sources.serving import lookup, lookup_key, lookup_many, serving_table, tiered_serving_table
from ratingloom.sources.tiered import Run
from tests.conftest import rows
from tests.test_buckets import files_read

LISTS = "user_id STRING, top_10 ARRAY<STRING>, source STRING"


def lists(spark, users, mark):
    return spark.createDataFrame([(str(u), [f"{mark}", str(u)], "batch") for u in users], LISTS)


def test_same_answers_as_one_version_after_the_other(spark, scratch):
    plain, tiered = serving_table(spark, scratch("plain")), tiered_serving_table(spark, scratch("tiered"), 4, 3)
    for v in range(14):
        some = lists(spark, range(v, 40, 1 + v % 5), v) if v != 6 else lists(spark, [], 6)
        for table in (plain, tiered):
            table.append(some, v)
        if v % 2:
            tiered.merge()
    assert rows(plain.latest()) == rows(tiered.latest())
    before = rows(tiered.latest())
    tiered.expire()
    assert rows(tiered.latest()) == before
    assert tiered.newest_version() == 13
    for user in ("0", "7", "39", "nobody"):
        assert lookup_key(tiered, user) == lookup(plain.latest(), user)
    keys = spark.createDataFrame([("1",), ("77",)], "user_id STRING")
    assert rows(lookup_many(tiered.latest(only=keys), keys)) == rows(lookup_many(plain.latest(), keys))


def test_merged_versions_cannot_be_changed_unseen(spark, scratch):
    table = tiered_serving_table(spark, scratch("t"), 2, 2)
    table.append(lists(spark, [1], "old"), 10)
    table.append(lists(spark, [2], "old"), 20)
    assert table.merge() == 1 and table.runs() == [Run(1, 10, 20)]
    table.append(lists(spark, [1], "new"), 10)  # a batch that runs again
    assert lookup_key(table, 1) == ["old", "1"]
    with pytest.raises(ValueError):
        table.append(lists(spark, [1], "late"), 15)
    table.append(lists(spark, [1], "next"), 21)
    assert lookup_key(table, 1) == ["next", "1"]


def test_an_unfinished_merge_is_not_seen(spark, scratch):
    root = scratch("t")
    table = tiered_serving_table(spark, root, 2, 2)
    assert table.latest().count() == 0 and table.newest_version() == -1
    for v in (1, 2):
        table.append(lists(spark, [1, 2], v), v)
    # What a merge that died leaves behind: files, but no mark of completion.
    lists(spark, [1, 2], "half").selectExpr("*", "CAST(2 AS BIGINT) AS version", "0 AS key_bucket").write.option(
        "mapreduce.fileoutputcommitter.marksuccessfuljobs", "false"
    ).partitionBy("key_bucket").parquet(f"{root}/runs/run=1-1-2")
    assert [r.level for r in table.runs()] == [0, 0]
    assert lookup_key(table, 2) == ["2", "2"]
    assert table.merge() == 1 and lookup_key(table, 2) == ["2", "2"]


def test_a_lookup_after_200_versions_opens_few_files(spark, scratch, conf):
    conf(spark__sql__shuffle__partitions="1")
    table = tiered_serving_table(spark, scratch("t"), 4, 8)
    for v in range(200):
        table.append(lists(spark, [v % 50, 1000 + v], v).coalesce(1), v)
        if v % 8 == 7:
            table.merge()
            table.expire()
    # 200 = 3 runs of 64 versions and one of 8.
    assert [run.level for run in table.runs()] == [2, 2, 2, 1]
    assert lookup_key(table, 7) == ["157", "7"]
    assert files_read(table.latest_of("7"), "top_10") <= 4
    assert len(folder_names(spark, f"{table.root}/runs")) <= 8


def test_files_carry_a_bloom_filter(spark, scratch):
    table = tiered_serving_table(spark, scratch("t"), 1, 2)
    table.append(spark.range(5000).select(F.col("id").cast("string").alias("user_id"), F.array().cast("array<string>").alias("top_10"), F.lit("b").alias("source")), 1)
    plan = table.latest_of("77")
    assert lookup_key(table, "77") == [] and plan.count() == 1
    (path,) = [r[0] for r in table._read(table.runs()).select(F.input_file_name()).distinct().collect()]
    footer = spark._jvm.org.apache.parquet.hadoop.ParquetFileReader.open(
        spark._jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(
            spark._jvm.org.apache.hadoop.fs.Path(path), spark._jsc.hadoopConfiguration()
        )
    )
    column = footer.getFooter().getBlocks().get(0).getColumns().get(0)
    assert column.getPath().toDotString() == "user_id" and column.getBloomFilterOffset() > 0
    footer.close()

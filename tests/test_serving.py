import pytest
from pyspark.sql import functions as F

from ratingloom.plans.serve import movie_details, movie_map, shown_page, with_titles
from ratingloom.sources.serving import lookup, lookup_many, serving_rows, serving_table
from ratingloom.sources.versioned import version_of
from tests.conftest import rows


def lists(spark, data, source="batch"):
    return serving_rows(spark.createDataFrame(data, "userId INT, movies ARRAY<INT>"), source)


def state(table):
    return rows(table.latest(), "user_id", "top_10", "version")


def test_write_and_read_back(spark, scratch):
    table = serving_table(spark, scratch())
    listed = ["movie_1", "movie_5", "movie_99"]
    row = spark.createDataFrame([("user_under_test", listed)], "userId STRING, movies ARRAY<STRING>")
    table.append(serving_rows(row, "batch"), version_of(1))
    assert lookup(table.latest(), "user_under_test") == listed
    assert lookup(table.latest(), "somebody else") == []


def test_newest_version_wins_and_replays_change_nothing(spark, scratch):
    table = serving_table(spark, scratch())
    table.append(lists(spark, [(1, [10]), (2, [20])]), 1)
    table.append(lists(spark, [(1, [11, 12])], "online"), 2)
    expected = [("1", ["11", "12"], 2), ("2", ["20"], 1)]
    assert state(table) == expected
    table.append(lists(spark, [(1, [11, 12])], "online"), 2)
    table.append(lists(spark, [(1, [10]), (2, [20])]), 1)
    assert state(table) == expected


def test_an_empty_table_and_an_existing_one(spark, scratch):
    root = scratch()
    table = serving_table(spark, root)
    assert state(table) == [] and lookup(table.latest(), 1) == []
    table.append(lists(spark, [(1, [])]), 1)
    assert state(serving_table(spark, root)) == [("1", [], 1)]
    assert lookup(table.latest(), 1) == []


def test_compaction_keeps_the_view_and_later_writes_win(spark, scratch):
    table = serving_table(spark, scratch())
    for version in (1, 2, 3):
        table.append(lists(spark, [(u, [version * 10 + u]) for u in range(version)]), version)
    before = state(table)
    table.compact(2)
    assert table.as_of() == 2 and state(table) == before
    table.compact(1)  # older than the snapshot: nothing to do
    table.append(lists(spark, [(0, [99])]), 4)
    table.compact(4)
    assert state(table) == sorted([("0", ["99"], 4), *before[1:]])
    assert table.versions().count() == 3
    view = state(table)
    table.expire()  # versions 1 to 4 are in the snapshot
    table.append(lists(spark, [(2, [7])]), 5)
    assert state(table) == [*view[:2], ("2", ["7"], 5)]


def test_a_new_generation_outranks_every_batch_of_the_old(spark, scratch):
    assert version_of(1) < version_of(1, 0) < version_of(1, 10**6) < version_of(2)
    table = serving_table(spark, scratch())
    table.append(lists(spark, [(1, [1])], "online"), version_of(1, 500))
    table.append(lists(spark, [(1, [2])]), version_of(2))
    assert lookup(table.latest(), 1) == ["2"]


def test_a_key_filter_reaches_the_scan(spark, scratch):
    table = serving_table(spark, scratch())
    table.append(lists(spark, [(u, [u]) for u in range(50)]), 1)
    table.compact(1)
    plan = table.latest().filter("user_id = '7'")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("EqualTo(user_id,7)") == 2  # snapshot and log
    assert lookup(table.latest(), 7) == ["7"]


def test_one_user_with_most_versions_is_combined_before_the_shuffle(spark, scratch):
    table = serving_table(spark, scratch())
    table.append(lists(spark, [(1, [1])]), 1)
    plan = table.latest()._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan


def test_bulk_lookup_reports_missing_keys(spark, scratch):
    table = serving_table(spark, scratch())
    table.append(lists(spark, [(1, [5]), (2, [])]), 1)
    keys = spark.createDataFrame([("1",), ("1",), ("2",), ("3",)], "user_id STRING")
    assert rows(lookup_many(table.latest(), keys)) == [("1", ["5"], True), ("2", [], False), ("3", [], False)]


@pytest.fixture(scope="module")
def catalogue(spark):
    data = [(1, "A", "x", "7"), (2, "", "x", "8"), (3, "Không rõ tên 3", "x", "9"), (4, "D", "x", None)]
    return spark.createDataFrame(data, "movieId INT, title STRING, genres STRING, tmdbId STRING")


def test_titles_come_in_list_order_without_unusable_entries(spark, catalogue):
    served = spark.createDataFrame(
        [("u", ["4", "2", "x", "1", "3", "77"]), ("v", ["2"]), ("w", [])], "user_id STRING, top_10 ARRAY<STRING>"
    )
    titled = with_titles(served, catalogue)
    got = {r.user_id: [tuple(e) for e in r.recs] for r in titled.collect()}
    assert got == {"u": [(4, "D"), (1, "A")], "v": [], "w": []}
    last = {r.user_id: [e.movieId for e in r.recs] for r in shown_page(titled, 1, from_end=True).collect()}
    first = {r.user_id: [e.movieId for e in r.recs] for r in shown_page(titled, 1).collect()}
    assert last["u"] == [1] and first["u"] == [4] and last["v"] == []


def test_movie_map_keeps_the_last_row_of_an_id(spark):
    movies = spark.createDataFrame([(1, "old", "g", 0), (1, "new", "g", 1), (2, "B", "g", 2)], "movieId INT, title STRING, genres STRING, line INT")
    links = spark.createDataFrame([(1, "007")], "movieId INT, tmdbId STRING")
    assert rows(movie_map(movies, links, F.col("line"))) == [(1, "new", "g", "007")]


def test_details_of_unknown_movies_are_marked(spark, catalogue):
    asked = spark.createDataFrame([(1,), (55,)], "movieId INT")
    assert rows(movie_details(asked, catalogue), "movieId", "found") == [(1, True), (55, False)]

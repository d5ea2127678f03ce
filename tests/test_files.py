import pytest

from ratingloom.operators import als
from ratingloom.sources import files, schemas
from tests.conftest import rows


def write(folder, name, text):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text)
    return str(folder)


def test_csv_scans_use_declared_schemas(spark, tmp_path):
    ratings = write(tmp_path / "r", "ratings.csv", "userId,movieId,rating,timestamp\n1,10,4.5,100\n2,11,x,101\n")
    assert rows(files.read_ratings(spark, ratings).na.fill(-1)) == [(1, 10, 4.5, 100), (2, 11, -1.0, 101)]
    movies = write(tmp_path / "m", "movies.csv", 'movieId,title,genres\n1,"Good, Bad (1966)",A|B\n')
    assert rows(files.read_movies(spark, movies)) == [(1, "Good, Bad (1966)", "A|B")]
    links = write(tmp_path / "l", "links.csv", "movieId,imdbId,tmdbId\n1,0114709,0862\n")
    assert rows(files.read_links(spark, links)) == [(1, "0862")]


def test_csv_scans_read_only_the_asked_columns(spark, tmp_path):
    path = write(tmp_path / "r", "ratings.csv", "userId,movieId,rating,timestamp\n1,10,4.5,100\n")
    plan = files.read_ratings(spark, path).groupBy("movieId").count()._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<movieId:int>" in plan


def test_columns_are_found_by_their_names(spark, tmp_path):
    path = write(tmp_path / "r", "ratings.csv", "movieId,userId,note,rating,timestamp\n7,1,n,4.0,9\n")
    assert rows(files.read_ratings(spark, path)) == [(1, 7, 4.0, 9)]
    short = write(tmp_path / "s", "ratings.csv", "userId,movieId,rating\n1,7,4.0\n")
    with pytest.raises(ValueError, match="timestamp"):
        files.read_ratings(spark, short)


def test_lines_with_too_many_fields_are_rejected_whole(spark, tmp_path, scratch):
    path = write(tmp_path / "d", "ratings.dat", "1::2::5::100::junk\n3::4::2.5::101\n5::6::1\n")
    target, rejects = scratch("target"), scratch("rejects")
    files.land_raw(spark, path, schemas.RATINGS, target, rejects, sep="::", header=False)
    assert rows(spark.read.parquet(target)) == [(3, 4, 2.5, 101)]
    assert rows(spark.read.parquet(rejects), "line") == [("1::2::5::100::junk",), ("5::6::1",)]


def test_landing_splits_good_rows_from_bad(spark, tmp_path, scratch):
    path = write(tmp_path / "d", "ratings.dat", "1::10::4.5::100\n2::x::3::101\n3::11::2\n4::12::1.0::102\n")
    target, rejects = scratch("target"), scratch("rejects")
    for _ in range(2):  # a repeated run changes nothing
        files.land_raw(spark, path, schemas.RATINGS, target, rejects, sep="::", header=False)
    assert rows(spark.read.parquet(target)) == [(1, 10, 4.5, 100), (4, 12, 1.0, 102)]
    assert rows(spark.read.parquet(rejects), "userId") == [("2",), ("3",)]


def test_factors_survive_a_round_trip(spark, scratch):
    path = scratch("factors")
    factors = spark.createDataFrame([(3, [1.5, 2.0]), (1, [0.0, -1.0])], "movieId INT, features ARRAY<FLOAT>")
    files.write_factors(factors, path)
    assert rows(files.read_factors(spark, path)) == [(1, [0.0, -1.0]), (3, [1.5, 2.0])]
    assert files.read_factors(spark, path, "userId").columns == ["userId", "features"]


def test_staged_tables_keep_schema_and_rows_even_when_empty(spark):
    df = spark.createDataFrame([(1, "a")], "x INT, y STRING")
    assert rows(files.staged(df)) == [(1, "a")]
    empty = files.staged(df.filter("x > 1"))
    assert empty.isEmpty() and empty.schema == df.schema


@pytest.mark.parametrize(
    "strategy,order", [("local-first", "LH"), ("hdfs-first", "HL"), ("HDFS-only", "H"), ("whatever", "LH")]
)
def test_load_orders(strategy, order):
    assert "".join(als.load_order("L", "H", strategy)) == order

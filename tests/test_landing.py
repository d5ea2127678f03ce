"""Landing of new files, maintained summaries, and generations of a model."""

import pytest
from pyspark.sql import functions as F

from ratingloom.operators import als
from ratingloom.operators.preparation import split_point
from ratingloom.plans import explore
from ratingloom.sources import schemas
from ratingloom.sources.landing import RatingSummaries, land_new, landed_table
from ratingloom.sources.models import ModelStore
from tests.conftest import rows


class Landing:
    def __init__(self, spark, scratch):
        self.spark, self.raw = spark, scratch("raw")
        self.target, self.rejects, self.ledger = scratch("target"), scratch("rejects"), scratch("ledger")
        self.summaries, self.calls = RatingSummaries(spark, scratch("summaries")), []

    def send(self, *lines):
        frame = self.spark.createDataFrame([(line,) for line in lines], "value STRING")
        frame.coalesce(1).write.mode("append").text(self.raw)

    def run(self, fail=False):
        def landed(part, rows_of_part):
            self.calls.append(part)
            if fail:
                raise RuntimeError("the run dies")
            self.summaries.add(part, rows_of_part)

        land_new(self.spark, self.raw, schemas.RATINGS, self.target, self.rejects, self.ledger, "::", False, landed)

    def table(self):
        return rows(landed_table(self.spark, self.target, schemas.RATINGS))


def test_only_new_files_are_landed(spark, scratch):
    landing = Landing(spark, scratch)
    landing.send("1::10::4.5::100", "2::10::x::100", "3::11::1::200::junk")
    landing.run()
    first = landing.table()
    assert first == [(1, 10, 4.5, 100, 0)]
    files = set(spark.read.parquet(landing.target).inputFiles())
    landing.run()  # nothing came
    assert landing.table() == first and landing.calls == [0]
    landing.send("5::12::2::300")
    landing.run()
    assert landing.table() == [*first, (5, 12, 2.0, 300, 1)]
    assert files < set(spark.read.parquet(landing.target).inputFiles())  # the first part was not written again
    rejected = spark.read.parquet(landing.rejects)
    assert rejected.count() == 2 and rejected.filter("line IS NOT NULL").count() == 1


def test_a_run_that_died_repeats_its_part(spark, scratch):
    landing = Landing(spark, scratch)
    landing.send("1::10::4.5::100")
    with pytest.raises(Exception, match="the run dies"):
        landing.run(fail=True)
    assert landing.summaries.parts() == []
    landing.send("2::10::3::100")
    landing.run()
    assert [(r[0], r[4]) for r in landing.table()] == [(1, 0), (2, 1)]
    assert landing.calls == [0, 0, 1] and landing.summaries.parts() == [0, 1]


def test_summaries_equal_a_recount(spark, scratch):
    landing = Landing(spark, scratch)
    for part in range(3):
        landing.send(*[f"{i * i % 17}::{i % (5 + part)}::{1 + i % 9 / 2}::{1_000_000_000 + i * 5_000_000}" for i in range(80)])
        landing.run()
    summaries = landing.summaries
    summaries.add(1, landed_table(spark, landing.target, schemas.RATINGS).filter("part = 1"))  # once more
    ratings = landed_table(spark, landing.target, schemas.RATINGS)
    movies = spark.createDataFrame([(i, f"m{i} ({1990 + i})", "x") for i in range(7)], "movieId INT, title STRING, genres STRING")
    for table in (
        explore.rating_distribution, explore.ratings_per_year, explore.matrix_sparsity, explore.top_users,
        explore.long_tail, explore.head_share, lambda r: explore.count_histogram(r, "movieId", 10),
        lambda r: explore.dataset_totals(r, movies), lambda r: explore.top_movies(r, movies),
        lambda r: explore.release_year_summary(r, movies),
    ):
        assert rows(table(summaries)) == rows(table(ratings))
    assert "rating" not in summaries.counts("userId").columns
    plan = explore.rating_distribution(summaries)._jdf.queryExecution().executedPlan().toString()
    assert landing.target not in plan  # the ratings are not read


def test_split_point_of_sketches(spark, scratch):
    summaries = RatingSummaries(spark, scratch("s"))
    assert split_point(summaries).first().quantile is None
    stamps = spark.range(100_000).select(F.pmod(F.xxhash64("id"), F.lit(1_000_000)).alias("timestamp"), "id")
    ratings = stamps.select(F.lit(1).alias("userId"), F.lit(1).alias("movieId"), F.lit(3.0).alias("rating"), "timestamp", "id")
    for part in range(5):
        summaries.add(part, ratings.filter(f"id % 5 = {part}"))
    point = split_point(summaries).first().quantile
    share = ratings.agg(F.avg((F.col("timestamp") <= point).cast("int"))).first()[0]
    assert share == pytest.approx(0.8, abs=0.002)


@pytest.fixture(scope="module")
def models(spark):
    data = [(u, m, float((u + m) % 5 + 1)) for u in range(6) for m in range(6) if (u * m) % 4 != 3]
    ratings = spark.createDataFrame(data, "userId INT, movieId INT, rating FLOAT")
    return [als.fit(ratings, rank=rank, iterations=1) for rank in (2, 3)]


def test_generations(spark, scratch, models):
    store = ModelStore(spark, scratch("models"))
    with pytest.raises(RuntimeError):
        store.load()
    with pytest.raises(RuntimeError):
        store.roll_back()
    assert store.save(models[0]) == 0
    models[1].itemFactors.write.parquet(f"{store.folder(1)}/itemFactors")  # a save that died
    generation, model = store.load()
    assert (generation, model.rank) == (0, 2)
    with pytest.raises(RuntimeError):
        store.load(1)
    assert store.save(models[1]) == 2 and store.load()[1].rank == 3
    assert store.roll_back() == 0 and store.load()[1].rank == 2
    assert store.roll_back(2) == 2 and store.current() == 2
    store.drop_unfinished()
    assert store.generations() == [0, 2] and store.next_generation() == 3
    store.keep(1)
    assert store.generations() == [2] and store.load(2)[1].rank == 3

"""Every operator as a query over the order database, by name.

A query is a function of the session and a folder of parquet tables. Each one
reads whole tables; sizes follow the tables.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ratingloom import fixed_values as fixed
from ratingloom.functions import dot, guarded_ratio, ideal_dcg, is_good, last_n, release_year
from ratingloom.operators import als
from ratingloom.operators.alternating import weighted_sums
from ratingloom.operators.fold_in import fold_in, fold_in_split, fold_in_two, gram_sums, probe
from ratingloom.operators.positions import dense_ids
from ratingloom.operators.preparation import IdMappings, active_only, clean, counts, split_at, split_point, time_split
from ratingloom.operators.pruned import pruned_top_items
from ratingloom.operators.ranking import (
    good_items,
    hit_rate,
    item_mean_predictions,
    ndcg,
    ranked_groups,
    ranked_labels,
    rmse,
    top_k_per_user,
    user_hits,
    user_ndcg,
)
from ratingloom.operators.scoring import as_lists, top_items
from ratingloom.operators.vectors import ItemFactors
from ratingloom.plans import explore
from ratingloom.plans.publish import publish
from ratingloom.plans.serve import movie_details, movie_map, shown_page, with_titles
from ratingloom.plans.train import (
    Prepared,
    evaluate,
    predictions_in_original_ids,
    prepare,
    stored_predictions,
)
from ratingloom.session import scratch_path
from ratingloom.sources import files, schemas, tables
from ratingloom.sources import messages as msg
from ratingloom.sources.landing import SKETCH_K, RatingSummaries, land_new, landed_table
from ratingloom.sources.models import ModelStore
from ratingloom.sources.serving import lookup_many, serving_rows, serving_table, tiered_serving_table
from ratingloom.sources.tiered import TieredTable
from ratingloom.sources.topic import NumberedTopic, publish_numbered
from ratingloom.sources.versioned import GENERATION, version_of
from ratingloom.streaming.histories import histories
from ratingloom.streaming.refresh import (
    LiveRefresh,
    fallback_causes,
    fallback_lists,
    online_lists,
    rating_log,
    start,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# The item threshold that removes movies in the test tables; the library default is in fixed_values.
MOVIE_THRESHOLD = 30
# Models have the library's rank and iterations; the seed makes their random start repeatable.
SEED = 7
# Fitted models of this process by application and folder: where they are saved, what they were fitted on.
_MODELS: dict[tuple[str, str], tuple[str, Prepared]] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _active(spark: SparkSession, folder: str) -> DataFrame:
    return active_only(tables.ratings(spark, folder), fixed.MIN_USER_RATINGS, MOVIE_THRESHOLD)


def _split(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    active = files.staged(_active(spark, folder))
    return split_at(active, F.lit(split_point(active, exact=True).first().quantile))


def _predictions(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """(item-mean predictions of the test ratings, test ratings)."""
    train, test = _split(spark, folder)
    return files.staged(item_mean_predictions(train, test)), test


def _parsed(spark: SparkSession, folder: str) -> DataFrame:
    return msg.parse(tables.messages(spark, folder), "event_id")


def _fresh(spark: SparkSession, folder: str) -> DataFrame:
    return msg.well_formed(_parsed(spark, folder)).select("userId", "movieId", "rating")


def _items(spark: SparkSession, folder: str) -> ItemFactors:
    return ItemFactors.of(tables.item_factors(spark, folder))


def _vectors_as_users(spark: SparkSession, folder: str) -> DataFrame:
    return tables.item_factors(spark, folder).withColumnRenamed("movieId", "userId")


def _mean_ratings(ratings: DataFrame) -> DataFrame:
    return ratings.groupBy("userId", "movieId").agg(F.avg("rating").alias("prediction"))


def _favourites(ratings: DataFrame) -> DataFrame:
    """``(userId, movies)``: the ten best rated movies of every user, best first."""
    best = top_k_per_user(_mean_ratings(ratings), fixed.SHOWN_LENGTH, ties=False)
    return als.movie_ids(as_lists(best, "prediction"))


def _joined(lists: DataFrame, column: str) -> DataFrame:
    return lists.withColumn(column, F.array_join(column, "|"))


# --- exploration -----------------------------------------------------------


@query
def rating_distribution(spark, folder):
    return explore.rating_distribution(tables.ratings(spark, folder))


@query
def ratings_per_year(spark, folder):
    return explore.ratings_per_year(tables.ratings(spark, folder))


@query
def movies_per_release_year(spark, folder):
    return explore.movies_per_release_year(tables.movies(spark, folder))


@query
def release_years(spark, folder):
    titles = tables.movies(spark, folder)
    return titles.select("movieId", release_year(F.col("title")).alias("ReleaseYear"))


@query
def dataset_totals(spark, folder):
    return explore.dataset_totals(tables.ratings(spark, folder), tables.movies(spark, folder))


@query
def matrix_sparsity(spark, folder):
    sparsity = explore.matrix_sparsity(tables.ratings(spark, folder))
    return sparsity.withColumn("sparsity_percent", F.round("sparsity_percent", 6))


def _rounded_histogram(spark: SparkSession, folder: str, key: str) -> DataFrame:
    histogram = explore.count_histogram(tables.ratings(spark, folder), key)
    return histogram.withColumns({name: F.round(name, 6) for name in ("lower", "upper")})


@query
def movie_count_histogram(spark, folder):
    return _rounded_histogram(spark, folder, "movieId")


@query
def user_count_histogram(spark, folder):
    return _rounded_histogram(spark, folder, "userId")


@query
def top_movies(spark, folder):
    return explore.top_movies(tables.ratings(spark, folder), tables.movies(spark, folder))


@query
def top_users(spark, folder):
    return explore.top_users(tables.ratings(spark, folder))


@query
def ratings_by_release_year(spark, folder):
    return explore.ratings_by_release_year(tables.ratings(spark, folder), tables.movies(spark, folder))


@query
def avg_ratings_by_release_year(spark, folder):
    yearly = explore.avg_ratings_by_release_year(tables.ratings(spark, folder), tables.movies(spark, folder))
    return yearly.withColumn("avg_ratings_per_movie", F.round("avg_ratings_per_movie", 6))


@query
def release_year_summary(spark, folder):
    summary = explore.release_year_summary(tables.ratings(spark, folder), tables.movies(spark, folder))
    return summary.withColumns({name: F.round(name, 6) for name in ("mean_of_years", "peak_value")})


@query
def long_tail_rank(spark, folder):
    return explore.long_tail(tables.ratings(spark, folder))


@query
def head_share(spark, folder):
    share = explore.head_share(tables.ratings(spark, folder))
    return share.withColumn("head_percent", F.round("head_percent", 6))


@query
def ratings_per_user(spark, folder):
    return counts(tables.ratings(spark, folder), "userId")


# --- files -----------------------------------------------------------------


def _csv_copy(table: DataFrame, name: str) -> str:
    path = scratch_path(table.sparkSession, name)
    table.write.option("header", True).csv(path)
    return path


@query
def csv_ratings(spark, folder):
    return files.read_ratings(spark, _csv_copy(tables.ratings(spark, folder), "ratings-csv"))


@query
def csv_movies(spark, folder):
    return files.read_movies(spark, _csv_copy(tables.movies(spark, folder), "movies-csv"))


@query
def csv_links(spark, folder):
    links = tables.links(spark, folder)
    with_imdb = links.select("movieId", F.lpad("tmdbId", 7, "0").alias("imdbId"), "tmdbId")
    return files.read_links(spark, _csv_copy(with_imdb, "links-csv"))


def _land_dat(spark: SparkSession, folder: str) -> tuple[str, str]:
    """Ratings as ``::`` lines, those of one line number broken, landed as parquet."""
    lines = tables.table(spark, folder, "lineitem").join(
        tables.table(spark, folder, "orders"), F.col("l_orderkey") == F.col("o_orderkey")
    )
    stamp = F.when(F.col("l_linenumber") == 7, "soon").otherwise(F.date_format("l_shipdate", "yyyyMMdd"))
    text = F.concat_ws("::", "o_custkey", "l_partkey", F.col("l_quantity").cast("int").cast("string"), stamp)
    raw, target, rejects = (scratch_path(spark, name) for name in ("dat", "landed", "rejects"))
    lines.select(text.alias("value")).write.text(raw)
    files.land_raw(spark, raw, schemas.RATINGS, target, rejects, sep="::", header=False)
    return target, rejects


@query
def landed_ratings(spark, folder):
    return spark.read.parquet(_land_dat(spark, folder)[0])


@query
def rejected_ratings(spark, folder):
    return spark.read.parquet(_land_dat(spark, folder)[1]).drop("line")


def _land_ragged(spark: SparkSession, folder: str) -> tuple[str, str]:
    """Ratings as ``::`` lines; those of line number 3 have a field too many, those of 5 one too few."""
    lines = tables.table(spark, folder, "lineitem").join(
        tables.table(spark, folder, "orders"), F.col("l_orderkey") == F.col("o_orderkey")
    )
    fields = ["o_custkey", "l_partkey", F.col("l_quantity").cast("int").cast("string"), F.date_format("l_shipdate", "yyyyMMdd")]
    text = (
        F.when(F.col("l_linenumber") == 3, F.concat_ws("::", *fields, F.lit("junk")))
        .when(F.col("l_linenumber") == 5, F.concat_ws("::", *fields[:3]))
        .otherwise(F.concat_ws("::", *fields))
    )
    raw, target, rejects = (scratch_path(spark, name) for name in ("dat", "landed", "rejects"))
    lines.select(text.alias("value")).write.text(raw)
    files.land_raw(spark, raw, schemas.RATINGS, target, rejects, sep="::", header=False)
    return target, rejects


@query
def landed_extra_fields(spark, folder):
    return spark.read.parquet(_land_ragged(spark, folder)[0])


@query
def rejected_extra_fields(spark, folder):
    return spark.read.parquet(_land_ragged(spark, folder)[1]).select("line")


@query
def csv_reordered_header(spark, folder):
    """A ratings file whose columns stand in another order, with one more."""
    shuffled = tables.ratings(spark, folder).select("movieId", F.lit("x").alias("note"), "timestamp", "userId", "rating")
    return files.read_ratings(spark, _csv_copy(shuffled, "reordered-csv"))


def _landed_in_two(spark: SparkSession, folder: str) -> tuple[str, RatingSummaries]:
    """Ratings whose files arrive in two lots, each landed and summarised when it is there, then once more for nothing."""
    raw, target, rejects, ledger, root = (
        scratch_path(spark, name) for name in ("dat", "landed", "rejects", "ledger", "summaries")
    )
    summaries = RatingSummaries(spark, root)
    ratings = tables.ratings(spark, folder)
    lines = ratings.select("movieId", F.concat_ws("::", "userId", "movieId", "rating", "timestamp").alias("value"))
    for late in (False, True, None):
        if late is not None:
            lines.filter((F.col("movieId") % 3 == 0) == late).select("value").write.mode("append").text(raw)
        land_new(spark, raw, schemas.RATINGS, target, rejects, ledger, "::", False, summaries.add)
    return target, summaries


@query
def landed_incrementally(spark, folder):
    """Ratings with the number of the landing run that took their file."""
    return landed_table(spark, _landed_in_two(spark, folder)[0], schemas.RATINGS)


@query
def maintained_exploration(spark, folder):
    """Exploration tables from summaries that were refreshed by merging, one below the other."""
    _, ratings = _landed_in_two(spark, folder)
    movies = tables.movies(spark, folder)

    def measured(table: DataFrame, name: str, key: str, value: str) -> DataFrame:
        number = F.round(F.col(value).cast("double"), 6).alias("value")
        return table.select(F.lit(name).alias("measure"), F.col(key).cast("double").alias("key"), number)

    found = [
        measured(explore.rating_distribution(ratings), "rating", "rating", "count"),
        measured(explore.ratings_per_year(ratings), "year", "year", "count"),
        measured(explore.long_tail(ratings), "tail", "movieId", "position"),
        measured(explore.count_histogram(ratings, "userId"), "histogram", "bin", "rows"),
        measured(explore.ratings_by_release_year(ratings, movies), "release", "ReleaseYear", "total_ratings"),
        measured(explore.top_users(ratings), "top", "userId", "count"),
        measured(explore.head_share(ratings), "head", "head_size", "head_percent"),
        measured(explore.dataset_totals(ratings, movies), "totals", "ratings", "users"),
        measured(explore.matrix_sparsity(ratings), "sparsity", "movies", "sparsity_percent"),
    ]
    return reduce(DataFrame.unionByName, found)


@query
def stored_split_point(spark, folder):
    """Whether the split point of the stored sketches has its share of the whole table on either side."""
    _, summaries = _landed_in_two(spark, folder)
    point = split_point(summaries).scalar()
    moment, allowed = F.col("timestamp"), 3 / SKETCH_K**0.9
    return tables.ratings(spark, folder).agg(
        (F.avg((moment <= point).cast("int")) >= fixed.SPLIT_QUANTILE - allowed).alias("enough_before"),
        (F.avg((moment < point).cast("int")) <= fixed.SPLIT_QUANTILE + allowed).alias("enough_after"),
        F.count("*").alias("ratings"),
    )


@query
def stored_factors(spark, folder):
    """Item factors written and read back: first component and length per movie."""
    path = scratch_path(spark, "factors")
    files.write_factors(tables.item_factors(spark, folder), path)
    first = F.round(F.get("features", F.lit(0)).cast("double"), 6).alias("first")
    return files.read_factors(spark, path).select("movieId", F.size("features").alias("width"), first)


# --- preparation -----------------------------------------------------------


@query
def clean_ratings(spark, folder):
    """Ratings as text, with unreadable, empty and missing values, cleaned."""
    lines = tables.table(spark, folder, "lineitem").join(
        tables.table(spark, folder, "orders"), F.col("l_orderkey") == F.col("o_orderkey")
    )
    number = F.col("l_linenumber")
    raw = lines.select(
        F.when(number == 7, "x").otherwise(F.col("o_custkey").cast("string")).alias("userId"),
        F.when(number == 6, "").otherwise(F.col("l_partkey").cast("string")).alias("movieId"),
        F.when(number != 5, (F.col("l_quantity") / 10).cast("string")).alias("rating"),
        F.date_format("l_shipdate", "yyyyMMdd").alias("timestamp"),
    )
    return clean(raw)


@query
def activity_filter(spark, folder):
    return _active(spark, folder)


@query
def dense_user_ids(spark, folder):
    return dense_ids(_active(spark, folder), "userId", "new_userId")


@query
def dense_movie_ids(spark, folder):
    return dense_ids(_active(spark, folder), "movieId", "new_movieId")


@query
def rekeyed_ratings(spark, folder):
    active = files.staged(_active(spark, folder))
    return IdMappings.of(active).rekey(active)


@query
def restored_ids(spark, folder):
    active = files.staged(_active(spark, folder))
    mappings = IdMappings.of(active)
    return mappings.restore(mappings.rekey(active))


@query
def stored_mappings(spark, folder):
    """Both id mappings as the training job stores them, in one table."""
    prepared = _prepared(spark, folder)
    users = prepared.mappings.users.select(F.lit("user").alias("kind"), "userId", "new_userId")
    return users.toDF("kind", "id", "new_id").unionByName(
        prepared.mappings.movies.select(F.lit("movie").alias("kind"), "movieId", "new_movieId").toDF(
            "kind", "id", "new_id"
        )
    )


@query
def time_split_counts(spark, folder):
    train, test = time_split(files.staged(_active(spark, folder)), exact=True)
    return train.agg(F.max("timestamp").alias("split_point"), F.count("*").alias("train_rows")).select(
        "split_point", "train_rows", test.agg(F.count("*")).scalar().alias("test_rows")
    )


@query
def approximate_split(spark, folder):
    """Whether the sketched split point lies within the error it promises."""
    ratings = _active(spark, folder)
    point = split_point(ratings).scalar()
    placed = ratings.select((F.col("timestamp") < point).alias("below"), (F.col("timestamp") <= point).alias("up_to"))
    shares = placed.agg(*[F.avg(F.col(name).cast("double")).alias(name) for name in placed.columns])
    error, wanted = 1.0 / fixed.SPLIT_ACCURACY, fixed.SPLIT_QUANTILE
    within = (F.col("below") - error <= wanted) & (F.col("up_to") + error >= wanted)
    return shares.select(within.alias("within_error"))


# --- evaluation --------------------------------------------------------------


@query
def relevance_labels(spark, folder):
    _, test = _split(spark, folder)
    return test.select("userId", "movieId", "rating", is_good(F.col("rating")).alias("is_good_item"))


@query
def topk_per_user(spark, folder):
    predictions, _ = _predictions(spark, folder)
    ranked = ranked_labels(predictions)
    return ranked.withColumn("prediction", F.round("prediction", 6))


@query
def topk_without_ties(spark, folder):
    best = top_k_per_user(_mean_ratings(tables.ratings(spark, folder)), ties=False)
    return best.withColumn("prediction", F.round("prediction", 6))


@query
def user_hits_and_dcg(spark, folder):
    predictions, _ = _predictions(spark, folder)
    return user_hits(ranked_groups(predictions)).withColumn("dcg", F.round("dcg", 6))


@query
def good_items_per_user(spark, folder):
    return good_items(_split(spark, folder)[1])


@query
def ideal_dcg_per_user(spark, folder):
    """Ideal DCG over all users, those without a good rating included."""
    good = F.sum(is_good(F.col("rating")))
    users = tables.ratings(spark, folder).groupBy("userId").agg(good.alias("num_good_items"))
    return users.withColumn("ideal_dcg", F.round(ideal_dcg(F.col("num_good_items")), 6))


@query
def guarded_good_share(spark, folder):
    """Share of good ratings per user, the ratio guarded against no ratings at all."""
    good = F.sum(is_good(F.col("rating")))
    late = tables.ratings(spark, folder).groupBy("userId").agg(good.alias("good"), F.count("*").alias("n"))
    people = tables.table(spark, folder, "customer").select((F.col("c_custkey") * 2).cast("int").alias("userId"))
    share = guarded_ratio(F.coalesce("good", F.lit(0)), F.coalesce("n", F.lit(0)))
    return people.join(late, "userId", "left").select("userId", F.round(share, 6).alias("share"))


@query
def baseline_rmse(spark, folder):
    return rmse(_predictions(spark, folder)[0]).withColumn("rmse", F.round("rmse", 6))


@query
def hit_rate_at_10(spark, folder):
    predictions, test = _predictions(spark, folder)
    rates = hit_rate(ranked_groups(predictions), test)
    return rates.withColumns({name: F.round(name, 6) for name in ("hit_rate", "hit_rate_all_users")})


@query
def ndcg_at_10(spark, folder):
    predictions, test = _predictions(spark, folder)
    return ndcg(ranked_groups(predictions), test).withColumn("ndcg", F.round("ndcg", 6))


@query
def ndcg_per_user(spark, folder):
    predictions, test = _predictions(spark, folder)
    scores = user_ndcg(ranked_groups(predictions), test)
    return scores.select("userId", *[F.round(name, 6).alias(name) for name in ("dcg", "ideal_dcg", "ndcg")])


@query
def evaluation_summary(spark, folder):
    predictions, test = _predictions(spark, folder)
    summary = evaluate(predictions, test)
    return summary.withColumns({name: F.round(name, 6) for name in ("rmse", "hit_rate", "ndcg")})


# --- messages ----------------------------------------------------------------


@query
def encode_messages(spark, folder):
    return msg.encode(tables.ratings(spark, folder))


@query
def published_messages(spark, folder):
    """Messages written to a folder topic and read back."""
    topic = scratch_path(spark, "topic")
    msg.publish(msg.encode(tables.ratings(spark, folder)), "text", path=topic)
    return spark.read.text(topic)


@query
def replay_messages(spark, folder):
    return msg.replay_lines(tables.messages(spark, folder))


@query
def replay_ratings_file(spark, folder):
    return msg.replay_file(spark, _csv_copy(tables.ratings(spark, folder), "replay-csv"))


@query
def parse_messages(spark, folder):
    return msg.well_formed(_parsed(spark, folder)).drop("value")


@query
def malformed_messages(spark, folder):
    return msg.malformed(_parsed(spark, folder)).select("event_id", "value")


@query
def factor_probe(spark, folder):
    """Per user: messages whose movie has a vector, and the others."""
    probed = probe(_fresh(spark, folder), _items(spark, folder))
    return probed.groupBy("userId").agg(
        F.count_if("known").alias("matched"), F.count_if(~F.col("known")).alias("unmatched")
    )


@query
def events_per_user(spark, folder):
    """Combined message ratings per user and movie."""
    fresh = _fresh(spark, folder).groupBy("userId", "movieId")
    return fresh.agg(F.count("*").alias("n"), F.sum(F.col("rating").cast("double")).alias("total"))


# --- fold-in and scoring -----------------------------------------------------


@query
def gram_and_moments(spark, folder):
    sums = gram_sums(_fresh(spark, folder), tables.item_factors(spark, folder), 3)
    return sums.select("userId", *[F.round(name, 6).alias(name) for name in sums.columns if name != "userId"])


@query
def fold_in_rank2(spark, folder):
    vectors = fold_in_two(_fresh(spark, folder), tables.item_factors(spark, folder))
    return vectors.select("userId", F.round("u0", 6).alias("u0"), F.round("u1", 6).alias("u1"))


@query
def fold_in_full(spark, folder):
    """Every component of every folded-in user vector."""
    vectors = fold_in(_fresh(spark, folder), _items(spark, folder))
    return vectors.select("userId", "n_items", F.posexplode("features").alias("place", "component")).withColumn(
        "component", F.round("component", 6)
    )


@query
def fold_in_split_user(spark, folder):
    """The same with one more user, who rated every movie that has a vector, solved in parts of 32 movies."""
    movies = tables.item_factors(spark, folder).select("movieId")
    collector = movies.select(
        F.lit(-1).alias("userId"), "movieId", ((F.lit(1) + F.col("movieId") % 9) / 2).cast("float").alias("rating")
    )
    rated = _fresh(spark, folder).unionByName(collector)
    vectors = fold_in_split(rated, _items(spark, folder), pairs_per_part=32)
    return vectors.select("userId", "n_items", F.posexplode("features").alias("place", "component")).withColumn(
        "component", F.round("component", 6)
    )


def _rewritten_items(spark: SparkSession, folder: str) -> DataFrame:
    """Item factors in which every third movie has two rows, the later one back to front."""
    items = tables.item_factors(spark, folder).withColumn("written", F.lit(1))
    again = items.filter("movieId % 3 = 0").withColumns({"features": F.reverse("features"), "written": F.lit(2)})
    return items.unionByName(again)


def _by_either_path(spark: SparkSession, folder: str, compute: Callable[[ItemFactors], DataFrame]) -> DataFrame:
    """The same with a broadcast catalogue and with a joined one."""
    rewritten = _rewritten_items(spark, folder)
    packed = compute(ItemFactors.of(rewritten, order="written")).withColumn("path", F.lit("packed"))
    joined = compute(ItemFactors.of(rewritten, limit_bytes=0, order="written")).withColumn("path", F.lit("joined"))
    return packed.unionByName(joined)


@query
def fold_in_duplicate_factors(spark, folder):
    """Movies with two vectors count once, by the last one, whatever the size of the catalogue."""
    fresh = files.staged(_fresh(spark, folder))
    vectors = _by_either_path(spark, folder, lambda items: fold_in(fresh, items))
    return vectors.select(
        "path", "userId", "n_items", F.posexplode("features").alias("place", "component")
    ).withColumn("component", F.round("component", 6))


@query
def score_duplicate_factors(spark, folder):
    """Top ten of every vector over the same catalogue."""
    users = _vectors_as_users(spark, folder)
    return _rounded_scores(_by_either_path(spark, folder, lambda items: top_items(users, items, fixed.SHOWN_LENGTH)))


@query
def vector_products(spark, folder):
    """Inner product of every message's movie vector with the vector of its user's id."""
    items = tables.item_factors(spark, folder)
    users = _vectors_as_users(spark, folder).withColumnRenamed("features", "user_features")
    pairs = _fresh(spark, folder).select("userId", "movieId").distinct()
    product = dot(F.col("features"), F.col("user_features"))
    return pairs.join(items, "movieId").join(users, "userId").select(
        "userId", "movieId", F.round(product, 6).alias("product")
    )


def _rounded_scores(ranked: DataFrame) -> DataFrame:
    return ranked.withColumn("score", F.round("score", 6))


@query
def score_topk_from_vectors(spark, folder):
    return _rounded_scores(top_items(_vectors_as_users(spark, folder), _items(spark, folder), fixed.SHOWN_LENGTH))


@query
def score_topk_excluding(spark, folder):
    rated = tables.ratings(spark, folder)
    users = _vectors_as_users(spark, folder)
    return _rounded_scores(top_items(users, _items(spark, folder), fixed.SHOWN_LENGTH, rated))


@query
def score_topk_in_blocks(spark, folder):
    """The excluding query with a catalogue treated as too large to broadcast."""
    rated = tables.ratings(spark, folder)
    items = ItemFactors.of(tables.item_factors(spark, folder), limit_bytes=0)
    users = _vectors_as_users(spark, folder)
    return _rounded_scores(top_items(users, items, fixed.SHOWN_LENGTH, rated, user_block=256, item_block=256))


def _skewed_items(spark: SparkSession, folder: str) -> DataFrame:
    """Item vectors whose lengths fall from 1 to 1/50, as those of popular and rare items do."""
    scale = 1 / (1 + F.col("movieId") % 50)
    return tables.item_factors(spark, folder).withColumn(
        "features", F.transform("features", lambda x: x.cast("double") * scale)
    )


def _pruned(spark: SparkSession, folder: str, items: ItemFactors, rated: DataFrame | None, **sizes: int) -> DataFrame:
    """Lists next to whether the search worked out fewer scores than there are pairs."""
    users = _vectors_as_users(spark, folder)
    best = files.staged(pruned_top_items(users, items, fixed.SHOWN_LENGTH, rated, **sizes))
    scored = best.select("userId", "scored").distinct().agg(F.sum("scored").alias("scored"))
    every_pair = users.agg((F.count("*") * items.count).alias("pairs"))
    return _rounded_scores(best.withColumn("spared", scored.scalar() < every_pair.scalar()).drop("scored"))


@query
def score_topk_pruned(spark, folder):
    """The best items over vectors of skewed lengths, found without scoring them all."""
    return _pruned(spark, folder, ItemFactors.of(_skewed_items(spark, folder)), None, block=16)


@query
def score_topk_pruned_excluding(spark, folder):
    """The same without rated items, with a catalogue treated as too large to broadcast."""
    items = ItemFactors.of(_skewed_items(spark, folder), limit_bytes=0)
    return _pruned(spark, folder, items, tables.ratings(spark, folder), first_tier=64)


@query
def score_topk_pruned_even(spark, folder):
    """Over the vectors as they are: the lists of scoring everything, whatever can be skipped."""
    best = pruned_top_items(_vectors_as_users(spark, folder), _items(spark, folder), fixed.SHOWN_LENGTH)
    return _rounded_scores(best.drop("scored"))


@query
def fold_in_recommend(spark, folder):
    """Online lists of all users who sent messages."""
    return _joined(online_lists(files.staged(_fresh(spark, folder)), _items(spark, folder)), "movies")


@query
def fallback_users(spark, folder):
    fresh, items = files.staged(_fresh(spark, folder)), _items(spark, folder)
    return fallback_causes(fresh, items, online_lists(fresh, items))


@query
def fallback_recommend(spark, folder):
    """Lists from stored vectors for the users with an unknown movie."""
    fresh, items = _fresh(spark, folder), _items(spark, folder)
    unsure = probe(fresh, items).filter("NOT known")
    return _joined(fallback_lists(unsure, _vectors_as_users(spark, folder), items), "movies")


def _spread_items(spark: SparkSession, folder: str) -> ItemFactors:
    """All vectors, under ids 150 apart, so that some users rate only movies without one."""
    return ItemFactors.of(tables.item_factors(spark, folder).withColumn("movieId", F.col("movieId") * 150))


@query
def fallback_causes_mixed(spark, folder):
    """Both causes of a fallback, over a catalogue that lacks most movies."""
    fresh, items = files.staged(_fresh(spark, folder)), _spread_items(spark, folder)
    return fallback_causes(fresh, items, online_lists(fresh, items))


# --- model -------------------------------------------------------------------


def _prepared(spark: SparkSession, folder: str) -> Prepared:
    ratings = tables.ratings(spark, folder)
    return prepare(ratings, min_movie=MOVIE_THRESHOLD, exact_split=True)


def _fitted(spark: SparkSession, folder: str):
    """The model of a folder, fitted once and read back by the queries that look at it."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _MODELS:
        prepared, path = _prepared(spark, folder), scratch_path(spark, "fitted")
        als.save(als.fit(prepared.train, seed=SEED), path)
        _MODELS[key] = path, prepared
    path, prepared = _MODELS[key]
    return als.load_first(spark, [path]), prepared


def _products(model, pairs: DataFrame) -> DataFrame:
    """``pairs`` (userId, movieId, ...) with the inner product of their stored factors in double precision."""
    users, items = als.factor_tables(model)
    joined = pairs.join(users.withColumnRenamed("features", "u"), "userId")
    joined = joined.join(items.withColumnRenamed("features", "v"), "movieId")
    return joined.withColumn("product", dot(F.col("u"), F.col("v"))).drop("u", "v")


@query
def als_recommend(spark, folder):
    """Whether every user's top 30 fall by the products of the stored factors and are those of the grid path."""
    model, prepared = _fitted(spark, folder)
    return _checked_lists(model, prepared, als.recommend_all(model), model.userFactors.select(F.col("id").alias("userId")))


def _checked_lists(model, prepared: Prepared, lists: DataFrame, asked: DataFrame) -> DataFrame:
    """userId, length, ordered, complete: lists over dense ids against the products and the other scoring path."""
    entries = lists.select("userId", F.posexplode("recommendations").alias("place", "entry"))
    entries = _products(model, entries.select("userId", "place", F.col("entry.movieId").alias("movieId")))
    own = Window.partitionBy("userId").orderBy("place")
    falls = F.coalesce(F.lag("product").over(own) >= F.col("product") - 1e-9, F.lit(True))
    listed = (
        entries.withColumn("falls", falls)
        .groupBy("userId")
        .agg(F.count("*").alias("length"), F.min("falls").alias("ordered"))
    )
    users, items = als.factor_tables(model)
    users = users.join(asked, "userId", "left_semi")
    gridded = top_items(users, ItemFactors.of(items, limit_bytes=0), fixed.LIST_LENGTH)
    both = entries.join(gridded, ["userId", "movieId"]).groupBy("userId").agg(F.count("*").alias("same"))
    checked = listed.join(both, "userId", "left").select(
        "userId", "length", "ordered", F.col("same").eqNullSafe(F.col("length")).alias("complete")
    )
    back = prepared.mappings.users.withColumnRenamed("userId", "original")
    return checked.join(back, checked.userId == back.new_userId).select(
        F.col("original").alias("userId"), "length", "ordered", "complete"
    )


@query
def als_recommend_subset(spark, folder):
    """The same check for the users who sent messages; strangers to the model have no list."""
    model, prepared = _fitted(spark, folder)
    asked = _fresh(spark, folder).join(prepared.mappings.users, "userId").select(F.col("new_userId").alias("userId"))
    asked = files.staged(asked.distinct())
    return _checked_lists(model, prepared, als.recommend_for(model, asked), asked)


@query
def als_normal_equations(spark, folder):
    """Whether every user vector solves its ridge system over the item vectors of its train ratings."""
    model, prepared = _fitted(spark, folder)
    users, items = als.factor_tables(model)
    rated = _products(model, prepared.train.select("userId", "movieId", "rating"))
    errors = rated.select("userId", "movieId", (F.col("product") - F.col("rating")).alias("rating"))
    tasks = spark.sparkContext.defaultParallelism
    blocks = als.block_count(prepared.train.count(), items.count(), model.rank, tasks)
    slopes = weighted_sums(errors, items, blocks)
    gradient = F.zip_with("sums", "features", lambda slope, u: F.abs(slope + fixed.ALS_REG * F.col("n") * u))
    left = F.array_max(gradient) / F.col("n")
    solved = slopes.join(users, "userId").select("userId", (left < 1e-3).alias("solved"))
    return prepared.mappings.restore(solved)


@query
def als_subset_lengths(spark, folder):
    """Who of the message senders gets a list from the model, and its length."""
    model, prepared = _fitted(spark, folder)
    users, items = als.factor_tables(model, prepared.mappings)
    lists = fallback_lists(_fresh(spark, folder), users, ItemFactors.of(items))
    return lists.select("userId", F.size("movies").alias("length"))


@query
def als_list_lengths(spark, folder):
    """Length of every user's list, and how many different movies it names."""
    model, prepared = _fitted(spark, folder)
    lists = als.movie_ids(als.restore_lists(als.recommend_all(model), prepared.mappings))
    distinct = F.size(F.array_distinct("movies")).alias("distinct_movies")
    return lists.select("userId", F.size("movies").alias("length"), distinct)


@query
def als_predict(spark, folder):
    """Whether every test prediction is the product of the stored factors."""
    model, prepared = _fitted(spark, folder)
    scored = _products(model, als.predict(model, prepared.test.select("userId", "movieId", "rating")))
    same = F.abs(F.col("prediction") - F.col("product")) < 1e-4
    return prepared.mappings.restore(scored.select("userId", "movieId", "rating", same.alias("is_product")))


@query
def als_prediction_pairs(spark, folder):
    """The test ratings the model can predict: both ids occur in the train part."""
    model, prepared = _fitted(spark, folder)
    return predictions_in_original_ids(model, prepared).select("userId", "movieId", "rating")


@query
def als_rmse(spark, folder):
    """Whether the RMSE operator gives the error of the products, and over how many test ratings."""
    model, prepared = _fitted(spark, folder)
    tested = rmse(als.predict(model, prepared.test))
    error = F.col("product") - F.col("rating")
    wanted = _products(model, prepared.test.select("userId", "movieId", "rating")).agg(F.sqrt(F.avg(error * error)))
    return tested.select((F.abs(F.col("rmse") - wanted.scalar()) < 1e-4).alias("right"), "scored")


@query
def als_rmse_agreement(spark, folder):
    """Whether MLlib's evaluator and the RMSE operator agree on the test predictions."""
    model, prepared = _fitted(spark, folder)
    predictions = stored_predictions(model, prepared)
    theirs = als.evaluate_rmse(predictions)
    return rmse(predictions).select((F.abs(F.col("rmse") - F.lit(theirs)) < 1e-9).alias("agree"), "scored")


@query
def als_evaluation(spark, folder):
    """Whether the one-pass evaluation gives what the single metrics give, and over how many ratings."""
    model, prepared = _fitted(spark, folder)
    predictions = stored_predictions(model, prepared)
    ranked = ranked_groups(predictions)
    same = lambda column, other: (F.abs(F.col(column) - other.scalar()) < 1e-9).alias(column)
    return evaluate(predictions, prepared.test).select(
        same("rmse", rmse(predictions).select("rmse")),
        same("hit_rate", hit_rate(ranked, prepared.test).select("hit_rate")),
        same("ndcg", ndcg(ranked, prepared.test).select("ndcg")),
        "scored",
    )


@query
def als_factor_ids(spark, folder):
    """Users and items that have a factor, under original ids, with its length."""
    model, prepared = _fitted(spark, folder)
    users, items = als.factor_tables(model, prepared.mappings)
    width = F.size("features").alias("width")
    return users.select(F.lit("user").alias("kind"), F.col("userId").alias("id"), width).unionByName(
        items.select(F.lit("item").alias("kind"), F.col("movieId").alias("id"), width)
    )


@query
def als_stored_model(spark, folder):
    """A model saved to two places and loaded past a missing one: it predicts the same."""
    model, prepared = _fitted(spark, folder)
    missing, first, mirror = (scratch_path(spark, name) for name in ("missing", "model", "mirror"))
    als.save(model, first, mirror)
    loaded = als.load_first(spark, als.load_order(missing, mirror))
    pairs = prepared.test.select("userId", "movieId").distinct()
    again = als.predict(loaded, pairs).withColumnRenamed("prediction", "loaded")
    both = als.predict(model, pairs).join(again, ["userId", "movieId"], "full")
    return both.groupBy(F.col("prediction").eqNullSafe(F.col("loaded")).alias("same")).agg(F.count("*").alias("pairs"))


@query
def als_model_generations(spark, folder):
    """Which generation a reader gets between saves, and on how many test pairs it predicts what that model predicts."""
    model, prepared = _fitted(spark, folder)
    small = als.fit(prepared.train, rank=4, iterations=1, seed=SEED)
    store = ModelStore(spark, scratch_path(spark, "models"))
    pairs = files.staged(prepared.test.select("userId", "movieId").distinct())

    def seen(step: str, expected) -> DataFrame:
        generation, read = store.load()
        wanted = als.predict(expected, pairs).withColumnRenamed("prediction", "wanted")
        both = als.predict(read, pairs).join(wanted, ["userId", "movieId"])
        same = F.col("prediction").eqNullSafe(F.col("wanted")).cast("bigint")
        found = both.agg(F.count("*").alias("pairs"), F.sum(same).alias("same_pairs"))
        return files.staged(found.select(F.lit(step).alias("step"), F.lit(generation).alias("generation"), "pairs", "same_pairs"))

    store.save(model)
    found = [seen("saved", model)]
    # A save that dies between its writes: the user factors are there, nothing else is.
    small.userFactors.write.parquet(f"{store.folder(store.next_generation())}/userFactors")
    found.append(seen("half written", model))
    store.drop_unfinished()
    store.save(small)
    found.append(seen("saved again", small))
    store.roll_back()
    found.append(seen("rolled back", model))
    return reduce(DataFrame.unionByName, found)


# --- serving -----------------------------------------------------------------


def _served(spark: SparkSession, folder: str, table=None):
    """A table with every user's favourites and, newer, those of message senders, one write repeated."""
    table = table or serving_table(spark, scratch_path(spark, "serving"))
    table.append(serving_rows(_favourites(tables.ratings(spark, folder)), "batch"), version_of(1))
    online = files.staged(serving_rows(_favourites(_fresh(spark, folder)), "online"))
    for _ in range(2):
        table.append(online, version_of(1, 0))
    return table


@query
def serving_upsert_latest(spark, folder):
    return _joined(_served(spark, folder).latest(), "top_10")


@query
def serving_compacted(spark, folder):
    """The same after the versions were folded into a snapshot and one more was written."""
    table = _served(spark, folder)
    table.compact(version_of(1, 0))
    late = _favourites(tables.ratings(spark, folder).filter("rating < 3"))
    table.append(serving_rows(late, "online"), version_of(1, 1))
    return _joined(table.latest(), "top_10")


@query
def serving_lookup(spark, folder):
    """Lists of even customer numbers up to twice the number of customers."""
    keys = tables.table(spark, folder, "customer").select((F.col("c_custkey") * 2).alias("user_id"))
    return _joined(lookup_many(_served(spark, folder).latest(), keys), "top_10")


def _tiered(spark: SparkSession, folder: str) -> TieredTable:
    return _served(spark, folder, tiered_serving_table(spark, scratch_path(spark, "tiered"), buckets=8, fan=2))


@query
def serving_tiered(spark, folder):
    """The compacted query over merged runs, with a merged version written once more."""
    table = _tiered(spark, folder)
    table.merge()
    table.append(serving_rows(_favourites(_fresh(spark, folder)), "online"), version_of(1, 0))
    late = _favourites(tables.ratings(spark, folder).filter("rating < 3"))
    table.append(serving_rows(late, "online"), version_of(1, 1))
    table.expire()
    return _joined(table.latest(), "top_10")


@query
def serving_tiered_lookup(spark, folder):
    """Lookups of many keys in merged runs: buckets without a key are not opened."""
    table = _tiered(spark, folder)
    table.merge()
    keys = tables.table(spark, folder, "customer").select((F.col("c_custkey") * 2).cast("string").alias("user_id"))
    keys = files.staged(keys.distinct())
    return _joined(lookup_many(table.latest(only=keys), keys), "top_10")


def _catalogue(spark: SparkSession, folder: str) -> DataFrame:
    return movie_map(tables.movies(spark, folder), tables.links(spark, folder))


def _titled(spark: SparkSession, folder: str) -> DataFrame:
    """Titled lists, over a catalogue in which some titles are empty or placeholders."""
    number = F.col("movieId")
    title = F.when(number % 17 == 0, F.concat(F.lit(fixed.UNKNOWN_TITLE_PREFIX + " "), number.cast("string")))
    title = title.when(number % 19 == 0, "").otherwise(F.col("title"))
    return with_titles(_served(spark, folder).latest(), _catalogue(spark, folder).withColumn("title", title))


def _entries(titled: DataFrame) -> DataFrame:
    return titled.select("user_id", F.posexplode("recs").alias("place", "entry")).select(
        "user_id", "place", "entry.movieId", "entry.title"
    )


@query
def recs_with_titles(spark, folder):
    return _entries(_titled(spark, folder))


@query
def recs_first_page(spark, folder):
    return _entries(shown_page(_titled(spark, folder), 5))


@query
def recs_last_page(spark, folder):
    return _entries(shown_page(_titled(spark, folder), 5, from_end=True))


@query
def recs_last_n(spark, folder):
    """The last five of every user's favourites; shorter lists stay whole."""
    lists = _favourites(tables.ratings(spark, folder))
    return _joined(lists.select("userId", last_n(F.col("movies"), 5).alias("movies")), "movies")


@query
def movie_catalogue(spark, folder):
    return _catalogue(spark, folder)


@query
def movie_lookup(spark, folder):
    """Details of every movie named in a message, known or not."""
    asked = _parsed(spark, folder).filter("movieId IS NOT NULL").select("movieId").distinct()
    return movie_details(asked, _catalogue(spark, folder))


@query
def batch_publish(spark, folder):
    """A model published and looked up: every user's list length and source."""
    model, prepared = _fitted(spark, folder)
    table = serving_table(spark, scratch_path(spark, "publish"))
    publish(model, prepared.mappings, table, 1, scratch_path(spark, "export"))
    return table.latest().select("user_id", F.size("top_10").alias("length"), "source")


@query
def batch_publish_unseen(spark, folder):
    """Published without the movies a user has rated: no list names a rated movie."""
    model, prepared = _fitted(spark, folder)
    table = serving_table(spark, scratch_path(spark, "publish"))
    rated = tables.ratings(spark, folder)
    publish(model, prepared.mappings, table, 1, scratch_path(spark, "export"), exclude_seen=rated)
    named = table.latest().select(
        F.col("user_id").cast("int").alias("userId"), F.explode("top_10").alias("id")
    ).select("userId", F.col("id").cast("int").alias("movieId"))
    seen = named.join(rated.select("userId", "movieId").distinct(), ["userId", "movieId"], "left_semi")
    repeats = seen.groupBy("userId").agg(F.count("*").alias("seen_movies"))
    lengths = named.groupBy("userId").agg(F.count("*").alias("length"))
    return lengths.join(repeats, "userId", "left").select(
        "userId", "length", F.coalesce("seen_movies", F.lit(0)).alias("seen_movies")
    )


# --- streams -----------------------------------------------------------------


@query
def stream_parse(spark, folder):
    """The event stream parsed into a parquet sink."""
    sink, checkpoint = scratch_path(spark, "parsed"), scratch_path(spark, "checkpoint")
    parsed = msg.parse(tables.message_stream(spark, folder), "event_id")
    writer = msg.well_formed(parsed).drop("value").writeStream.format("parquet")
    writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start(sink).awaitTermination()
    return spark.read.schema("event_id BIGINT, userId INT, movieId INT, rating FLOAT").parquet(sink)


def _topic_parts(spark: SparkSession, folder: str, parts: int) -> list[DataFrame]:
    """The messages by event number, cut into consecutive parts."""
    sent = tables.messages(spark, folder)
    last = sent.agg(F.max("event_id")).first()[0] or 0
    part = F.expr(f"event_id * {parts} div {last + 1}")
    return [sent.filter(part == i).select("value") for i in range(parts)]


def _run_stream(
    spark: SparkSession,
    folder: str,
    scope: str,
    parts: int = 1,
    items: ItemFactors | None = None,
    fallback: str = "no_list",
    between: Callable[[LiveRefresh, int], None] | None = None,
    buckets: int = 0,
) -> LiveRefresh:
    """Messages published to a topic part by part, and refreshed by a subscriber, one micro-batch a part."""
    refresh = LiveRefresh(
        items=items or _items(spark, folder),
        serving=serving_table(spark, scratch_path(spark, "serving")),
        dead_letters=scratch_path(spark, "dead-letters"),
        generation=1,
        user_factors=_vectors_as_users(spark, folder),
        log=rating_log(spark, scratch_path(spark, "rating-log"), buckets),
        scope=scope,
        fallback=fallback,
    )
    topic, checkpoint = scratch_path(spark, "topic"), scratch_path(spark, "checkpoint")
    for number, part in enumerate(_topic_parts(spark, folder, parts)):
        if between is not None:
            between(refresh, number)
        msg.publish(part, "text", path=topic)
        stream = msg.subscribe(spark, "text", path=topic)
        start(stream, refresh, checkpoint, available_now=True).awaitTermination()
    return refresh


@query
def stream_from_latest(spark, folder):
    """What a subscriber parses who comes after the first third of the messages, and is away between the others."""
    spark.dataSource.register(NumberedTopic)
    topic, sink, checkpoint = (scratch_path(spark, name) for name in ("numbered", "parsed", "checkpoint"))
    for part in _topic_parts(spark, folder, 3):
        publish_numbered(part, topic)
        stream = msg.subscribe(spark, NumberedTopic.name(), path=topic, startingOffsets="latest", group="parser")
        parsed = msg.well_formed(msg.parse(stream)).drop("value").writeStream.format("parquet")
        parsed.option("checkpointLocation", checkpoint).trigger(availableNow=True).start(sink).awaitTermination()
    return spark.read.schema("userId INT, movieId INT, rating FLOAT").parquet(sink)


@query
def stream_refresh_batch(spark, folder):
    """Lists served by the live refresh that looks at the micro-batch only."""
    latest = _run_stream(spark, folder, "batch").serving.latest()
    return _joined(latest.select("user_id", "top_10", "source"), "top_10")


@query
def stream_refresh_history(spark, folder):
    """Lists served by the live refresh over rating histories, latest rating per movie."""
    latest = _run_stream(spark, folder, "history", parts=3).serving.latest()
    return _joined(latest.select("user_id", "top_10", "source"), "top_10")


@query
def stream_refresh_state(spark, folder):
    """The same with the histories in the state store."""
    latest = _run_stream(spark, folder, "state", parts=3).serving.latest()
    return _joined(latest.select("user_id", "top_10", "source"), "top_10")


@query
def stream_state_map(spark, folder):
    """The same with one state entry per movie: a micro-batch writes the entries it changes."""
    latest = _run_stream(spark, folder, "map", parts=3).serving.latest()
    return _joined(latest.select("user_id", "top_10", "source"), "top_10")


@query
def stream_log_bucketed(spark, folder):
    """The log by buckets of users, after a compaction between the second and the third micro-batch."""

    def compact(refresh: LiveRefresh, number: int) -> None:
        if number == 2:
            refresh.log.compact(refresh.log.newest_version())

    refresh = _run_stream(spark, folder, "history", parts=3, between=compact, buckets=16)
    return _joined(refresh.serving.latest().select("user_id", "top_10", "source"), "top_10")


@query
def stream_refresh_fallback(spark, folder):
    """Lists over a catalogue that lacks most movies: users without an online list get the stored model's."""
    latest = _run_stream(spark, folder, "batch", items=_spread_items(spark, folder)).serving.latest()
    return _joined(latest.select("user_id", "top_10", "source"), "top_10")


@query
def stream_refresh_model_first(spark, folder):
    """The other order: the stored model serves everybody who rated a movie without a vector."""
    refresh = _run_stream(spark, folder, "batch", items=_spread_items(spark, folder), fallback="unknown_movie")
    return _joined(refresh.serving.latest().select("user_id", "top_10", "source"), "top_10")


@query
def serving_publish_while_streaming(spark, folder):
    """Who wrote each user's list last, when a batch of generation 2 is published between two micro-batches."""
    ratings = tables.ratings(spark, folder)

    def publish_batch(refresh: LiveRefresh, number: int) -> None:
        rated = ratings if number == 0 else ratings.filter("rating < 3")
        refresh.serving.append(serving_rows(_favourites(rated), "batch"), version_of(number + 1))

    latest = _run_stream(spark, folder, "batch", parts=2, between=publish_batch).serving.latest()
    return latest.select("user_id", "source", F.expr(f"version div {GENERATION}").alias("generation"))


@query
def stream_histories(spark, folder):
    """Histories as the state store emits them for the users of a micro-batch."""
    sink, checkpoint = scratch_path(spark, "histories"), scratch_path(spark, "checkpoint")
    stream = histories(msg.well_formed(msg.parse(tables.message_stream(spark, folder))))
    writer = stream.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
    writer = writer.foreachBatch(lambda batch, n: batch.write.mode("overwrite").parquet(f"{sink}/batch_id={n}"))
    writer.trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(sink).select("userId", "movieId", "rating")


@query
def stream_dead_letters(spark, folder):
    return spark.read.parquet(_run_stream(spark, folder, "batch").dead_letters).select("value")


@query
def stream_rating_log(spark, folder):
    latest = _run_stream(spark, folder, "history", parts=3).log.latest()
    return latest.select("userId", "movieId", "rating")


def flagship(spark: SparkSession, folder: str) -> DataFrame:
    """Raw ratings to titled top-10 lists: filter, ids, split, model, score, restore, enrich."""
    prepared = prepare(tables.ratings(spark, folder))
    model = als.fit(prepared.train, seed=SEED)
    users, items = als.factor_tables(model, prepared.mappings)
    best = top_items(users, ItemFactors.of(items), fixed.SHOWN_LENGTH)
    titles = tables.movies(spark, folder).select("movieId", "title")
    return best.join(titles, "movieId").select("userId", "rank", "movieId", "title", F.round("score", 6).alias("score"))

"""Rating histories of users as keyed streaming state.

:func:`histories` keeps a user's history as one value, :func:`map_histories` as one entry
per movie, so that a micro-batch writes the entries it changes and nothing else.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

_RATING = "userId INT, movieId INT, rating FLOAT"
_STATE = "movies ARRAY<INT>, ratings ARRAY<FLOAT>"


def histories(ratings: DataFrame) -> DataFrame:
    """For every user of a micro-batch, all their ratings so far, the latest per movie.

    A streaming operator: the state of a user is one value, read and written once
    per micro-batch. Messages carry no time, so of one micro-batch's ratings of a
    movie the highest counts; that also lets copies be dropped before the shuffle,
    and a user's share of a micro-batch shrinks to the movies they rated.
    """
    combined = ratings.select("userId", "movieId", "rating").mapInPandas(_combine, _RATING)
    return combined.groupBy("userId").applyInPandasWithState(
        _remember, _RATING, _STATE, "update", GroupStateTimeout.NoTimeout
    )


def _highest(frame: pd.DataFrame) -> pd.DataFrame:
    return frame.groupby(["userId", "movieId"], as_index=False, sort=False)["rating"].max()


def _combine(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        yield _highest(frame)


def _remember(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    history = fresh = _highest_by_movie(frames)
    if state.exists:
        before = zip(*state.get, strict=True)
        history = {movie: rating for movie, rating in before if movie not in fresh} | fresh
    movies, ratings = list(history), list(history.values())
    state.update((movies, ratings))
    yield _frame(key[0], movies, ratings)


def _highest_by_movie(frames: Iterator[pd.DataFrame]) -> dict[int, float]:
    # Called once per user: for a few rows a dict is many times cheaper than a grouped frame.
    fresh: dict[int, float] = {}
    for frame in frames:
        for movie, rating in zip(frame["movieId"].tolist(), frame["rating"].tolist(), strict=True):
            fresh[movie] = max(rating, fresh.get(movie, rating))
    return fresh


def _frame(user: int, movies: list[int], ratings: list[float]) -> pd.DataFrame:
    columns = {"userId": np.full(len(movies), user, "int32"), "movieId": np.array(movies, "int32")}
    return pd.DataFrame(columns | {"rating": np.array(ratings, "float32")})


# State by entry needs a provider that reads and writes single keys.
_PROVIDER_CONF = "spark.sql.streaming.stateStore.providerClass"
_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# Rows of a history that are handed on at once.
_EMITTED = 10_000


@contextmanager
def entry_state(spark: SparkSession):
    """Streams started inside keep their state by entry; the session's own setting comes back afterwards."""
    before = spark.conf.get(_PROVIDER_CONF, None)
    spark.conf.set(_PROVIDER_CONF, _PROVIDER)
    try:
        yield
    finally:
        spark.conf.unset(_PROVIDER_CONF) if before is None else spark.conf.set(_PROVIDER_CONF, before)


def map_histories(ratings: DataFrame) -> DataFrame:
    """What :func:`histories` gives, from a map state keyed by movie.

    A micro-batch writes one entry per rating that is new or changed, however long the
    history; the history itself is read entry by entry and handed on in bounded frames, so
    no task holds it. Start the stream inside :func:`entry_state`.
    """
    combined = ratings.select("userId", "movieId", "rating").mapInPandas(_combine, _RATING)
    return combined.groupBy("userId").transformWithStateInPandas(MovieRatings(), _RATING, "update", "none")


class MovieRatings(StatefulProcessor):
    """The latest rating of each movie a user rated."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.ratings = handle.getMapState("ratings", "movieId INT", "rating FLOAT")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        fresh = _highest_by_movie(rows)
        same = set()  # what needs no write: the history is read anyway, and one call hands over many entries
        movies, ratings = [], []
        for (movie,), (rating,) in self.ratings.iterator():
            if movie not in fresh:
                movies.append(movie)
                ratings.append(rating)
            elif rating == fresh[movie]:
                same.add(movie)
            if len(movies) == _EMITTED:
                yield _frame(key[0], movies, ratings)
                movies, ratings = [], []
        for movie, rating in fresh.items():
            if movie not in same:
                self.ratings.updateValue((movie,), (rating,))
        yield _frame(key[0], movies + list(fresh), ratings + list(fresh.values()))

    def close(self) -> None:
        pass

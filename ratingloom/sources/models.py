"""Generations of a stored model: readers load a whole one, whatever is being written.

Layout below the root::

    generation=<n>/   a saved model, never written again once it is pointed to
    current/          one row (change, generation) per change; the last change counts

A save writes a folder of its own and then one row to ``current``. The row's file appears
at once or not at all, so between two saves, and after one that died half-way, readers go
on with the generation before. Rolling back is one more change.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.recommendation import ALSModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratingloom.sources.files import delete_path, folder_names, path_exists

_CURRENT = "change BIGINT, generation INT"


@dataclass(frozen=True)
class ModelStore:
    spark: SparkSession
    root: str

    def folder(self, generation: int) -> str:
        return f"{self.root}/generation={generation}"

    def _changes(self) -> DataFrame:
        if not path_exists(self.spark, f"{self.root}/current"):
            return self.spark.createDataFrame([], _CURRENT)
        return self.spark.read.schema(_CURRENT).parquet(f"{self.root}/current")

    def _written(self) -> list[int]:
        names = folder_names(self.spark, self.root) if path_exists(self.spark, self.root) else []
        return sorted(int(name.removeprefix("generation=")) for name in names if name.startswith("generation="))

    def generations(self) -> list[int]:
        """The finished generations that are still there."""
        pointed = {row.generation for row in self._changes().select("generation").distinct().collect()}
        return [generation for generation in self._written() if generation in pointed]

    def current(self) -> int | None:
        """The generation that readers get; None before the first save."""
        return self._changes().agg(F.max_by("generation", "change")).first()[0]

    def next_generation(self) -> int:
        """The number of the next save; folders of saves that died keep theirs."""
        return max(self._written(), default=-1) + 1

    def save(self, model: ALSModel) -> int:
        """Store ``model`` as a new generation and make it the current one."""
        generation = self.next_generation()
        model.write().save(self.folder(generation))
        self._point_to(generation)
        return generation

    def load(self, generation: int | None = None) -> tuple[int, ALSModel]:
        """(generation, model): the current one, or a given finished one."""
        wanted = self.current() if generation is None else generation
        if wanted is None or wanted not in self.generations():
            raise RuntimeError(f"no finished model {'' if wanted is None else wanted} below {self.root}")
        return wanted, ALSModel.load(self.folder(wanted))

    def roll_back(self, generation: int | None = None) -> int:
        """Make an earlier finished generation current: the one before, or a given one."""
        now, finished = self.current(), self.generations()
        earlier = [g for g in finished if now is not None and g < now]
        wanted = generation if generation is not None else earlier[-1] if earlier else None
        if wanted is None or wanted not in finished:
            raise RuntimeError(f"no finished generation to go back to below {self.root}")
        self._point_to(wanted)
        return wanted

    def drop_unfinished(self) -> None:
        """Delete what saves that died left behind; call it when no save is running."""
        finished = set(self.generations())
        for generation in self._written():
            if generation not in finished:
                delete_path(self.spark, self.folder(generation))

    def keep(self, newest: int) -> None:
        """Delete all but the ``newest`` finished generations and the current one; for when no reader loads an old one."""
        finished, now = self.generations(), self.current()
        for generation in finished[: max(0, len(finished) - newest)]:
            if generation != now:
                delete_path(self.spark, self.folder(generation))

    def _point_to(self, generation: int) -> None:
        change = self._changes().agg(F.coalesce(F.max("change"), F.lit(-1))).first()[0] + 1
        row = self.spark.range(1).select(F.lit(change).cast("bigint").alias("change"), F.lit(generation).alias("generation"))
        row.write.mode("append").parquet(f"{self.root}/current")

"""Batch publish: a stored model becomes served lists under original ids."""

from __future__ import annotations

from pyspark.ml.recommendation import ALSModel
from pyspark.sql import DataFrame

from ratingloom import fixed_values as fixed
from ratingloom.operators import als
from ratingloom.operators.preparation import IdMappings
from ratingloom.operators.scoring import as_lists, top_items
from ratingloom.operators.vectors import ItemFactors
from ratingloom.sources.files import write_factors
from ratingloom.sources.serving import serving_rows
from ratingloom.sources.versioned import VersionedTable, version_of


def batch_lists(
    users: DataFrame, items: DataFrame, n: int = fixed.LIST_LENGTH, exclude_seen: DataFrame | None = None
) -> DataFrame:
    """``(userId, recommendations)`` for every user vector, seen items optionally left out."""
    return as_lists(top_items(users, ItemFactors.of(items), n, exclude_seen))


def publish(
    model: ALSModel,
    mappings: IdMappings,
    serving: VersionedTable,
    generation: int,
    factors_path: str,
    n: int = fixed.LIST_LENGTH,
    exclude_seen: DataFrame | None = None,
) -> None:
    """Export both factor tables under original ids and serve every user's list.

    All writes are distributed; nothing is iterated on the driver. Repeating a
    generation replaces exactly what it wrote before.
    """
    users, items = als.factor_tables(model, mappings)
    write_factors(users, f"{factors_path}/users")
    write_factors(items, f"{factors_path}/items")
    lists = als.movie_ids(batch_lists(users, items, n, exclude_seen))
    serving.append(serving_rows(lists, "batch"), version_of(generation))

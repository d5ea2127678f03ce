from ratingloom.functions.expressions import (
    dot,
    epoch_seconds,
    guarded_ratio,
    ideal_dcg,
    is_good,
    last_n,
    message_fields,
    rating_year,
    release_year,
    strings,
    to_message,
)

__all__ = [
    "dot",
    "epoch_seconds",
    "guarded_ratio",
    "ideal_dcg",
    "is_good",
    "last_n",
    "message_fields",
    "rating_year",
    "release_year",
    "strings",
    "to_message",
]

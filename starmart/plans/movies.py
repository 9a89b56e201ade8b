from __future__ import annotations

from pyspark.sql import DataFrame

from starmart.functions.nulls import drop_nulls
from starmart.operators.merge import upsert
from starmart.operators.project import project

KEYS = ["movie_id"]

# Fixed value: the clean output's columns in order (source names).
_COLUMNS = [
    "id", "adult", "budget", "original_language", "title",
    "popularity", "release_date", "vote_count", "vote_average",
]


def clean_movies(source: DataFrame) -> DataFrame:
    """The movie attributes, for movies that have all of them."""
    return drop_nulls(project(source, _COLUMNS, {"id": "movie_id", "adult": "is_adult"}))


def merge_movies(target: DataFrame, stage: DataFrame, **options) -> DataFrame:
    return upsert(target, stage, KEYS, **options)

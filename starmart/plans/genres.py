from __future__ import annotations

from pyspark.sql import DataFrame

from starmart.functions.records import explode_records
from starmart.operators.distinct import distinct_rows
from starmart.operators.merge import insert_new, insert_only_new, upsert
from starmart.operators.project import project

GENRE_KEYS = ["genre_id"]
BRIDGE_KEYS = ["movie_id", "genre_id"]


def movie_genre_records(source: DataFrame) -> DataFrame:
    """One row per movie and listed genre: the shared input of both genre tables."""
    listed = project(source, ["id", "genres"], {"id": "movie_id"})
    return explode_records(listed, "genres", {"genre_id": "id", "genre_name": "name"}).drop("genres")


def clean_genres(records: DataFrame) -> DataFrame:
    """Distinct genres that have both an id and a name."""
    names = ["genre_id", "genre_name"]
    return distinct_rows(records, names, require=names)


def clean_movie_genres(records: DataFrame) -> DataFrame:
    """Distinct movie-genre pairs; a genre without an id stays, the merge decides on it."""
    return distinct_rows(records, BRIDGE_KEYS)


def merge_genres(target: DataFrame, stage: DataFrame, **options) -> DataFrame:
    return upsert(target, stage, GENRE_KEYS, **options)


def new_movie_genres(target: DataFrame, stage: DataFrame, **options) -> DataFrame:
    """The pairs the bridge lacks: all a publish has to write."""
    return insert_new(target, stage, BRIDGE_KEYS, **options)


def merge_movie_genres(target: DataFrame, stage: DataFrame, **options) -> DataFrame:
    return insert_only_new(target, stage, BRIDGE_KEYS, **options)

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.operators.keys import assign_surrogate_key, next_key
from starmart.operators.layout import exceeds_broadcast
from starmart.operators.merge import insert_new, matched_once, settle_source, update_from
from starmart.operators.project import align_to_schema, project
from starmart.scratch import materialize

KEYS = ["user_id", "movie_id"]
SURROGATE = "user_movie_id"


def clean_ratings(source: DataFrame) -> DataFrame:
    columns = ["userId", "movieId", "rating"]
    return project(source, columns, {"userId": "user_id", "movieId": "movie_id"})


def merge_ratings(
    target: DataFrame,
    stage: DataFrame,
    dedupe_by: list[str] | None = None,
    null_keys: bool = True,
    unique: bool = False,
    reserve: Callable[[int], int] | None = None,
) -> DataFrame:
    """Ratings of known pairs change and keep their key; new pairs get the next keys.

    ``reserve`` is given the number of new pairs and returns their first key; without it the
    target's highest key is looked up.  A stage too large to broadcast meets the target in one
    full outer join, written once: the target is read once, and shuffled unless it is bucketed.
    """
    if dedupe_by is not None or not unique:
        stage = settle_source(stage, KEYS, dedupe_by, null_keys)
    if exceeds_broadcast(stage):
        joined = materialize(matched_once(target, stage, KEYS, null_keys), "ratings-joined")
        known, fresh = joined.where("__have"), joined.where("__have IS NULL")
        types = dict(target.dtypes)
        rating = F.when(F.col("__hit"), F.col("__s_rating").cast(types["rating"]))
        updated = known.withColumn("rating", rating.otherwise(F.col("rating")))
        keyed = assign_surrogate_key(
            fresh.select(*[F.col(f"__s_{c}").alias(c) for c in stage.columns]),
            KEYS,
            SURROGATE,
            start=reserve or next_key(known, SURROGATE),
        )
        return updated.select(*target.columns).unionByName(align_to_schema(keyed, target.schema))
    options = {"unique": True, "null_keys": null_keys}
    updated = update_from(target, stage, KEYS, ["rating"], **options)
    fresh = insert_new(target, stage, KEYS, **options)
    keyed = assign_surrogate_key(fresh, KEYS, SURROGATE, start=reserve or next_key(target, SURROGATE))
    return updated.unionByName(align_to_schema(keyed, target.schema))

from __future__ import annotations

from pyspark.sql import DataFrame

from starmart.functions.calendar import calendar_dim
from starmart.functions.nulls import drop_nulls
from starmart.operators.merge import upsert

KEYS = ["release_date"]


def clean_dates(source: DataFrame, required: str = "output") -> DataFrame:
    """The calendar of the release dates.

    ``required="output"`` skips movies without a release date, ``"all"`` movies with
    a NULL in any source column.
    """
    return calendar_dim(drop_nulls(source, KEYS if required == "output" else None), KEYS[0])


def merge_dates(target: DataFrame, stage: DataFrame, **options) -> DataFrame:
    return upsert(target, stage, KEYS, **options)

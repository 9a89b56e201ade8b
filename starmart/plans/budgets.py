from __future__ import annotations

from pyspark.sql import DataFrame

from starmart.functions.nulls import drop_nulls
from starmart.operators.merge import append_all
from starmart.operators.project import project


def clean_budgets(source: DataFrame, required: str = "output") -> DataFrame:
    """Budget and revenue per movie.

    ``required="output"`` skips movies lacking one of the three output columns,
    ``"all"`` movies with a NULL in any source column.
    """
    columns = ["id", "budget", "revenue"]
    kept = drop_nulls(source, columns if required == "output" else None)
    return project(kept, columns, {"id": "movie_id"})


def merge_budgets(target: DataFrame, stage: DataFrame) -> DataFrame:
    return append_all(target, stage)

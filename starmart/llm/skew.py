"""Joins of many rows to one row per key, where one key may hold a third of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def attach(rows: DataFrame, table: DataFrame, key: str, weight: str, total: int) -> DataFrame:
    """Each row with the columns of its key's row in ``table``; NULL ones where there is none.

    ``weight`` counts, in ``table``, the rows of each key, ``total`` all of them.  Keys of over
    a quarter of a mean shuffle partition are at most four times as many as there are
    partitions, whatever the data: these are broadcast.  The rest, none of them large, meet in
    a shuffle.  Both sides are read twice, so hand in stored tables.
    """
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    limit = max(total // (4 * parts), 1)
    hot = table.where(F.col(weight) > limit).drop(weight)
    cold = table.where(F.col(weight) <= limit).drop(weight)
    names = F.broadcast(hot.select(key))
    return rows.join(F.broadcast(hot), key).unionByName(
        rows.join(names, key, "left_anti").join(cold, key, "left"), allowMissingColumns=False
    )

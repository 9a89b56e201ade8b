from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from starmart.functions.nulls import drop_nulls


def distinct_rows(
    df: DataFrame, columns: Sequence[str] | None = None, require: Sequence[str] = ()
) -> DataFrame:
    """Distinct rows over ``columns``; rows with no value in ``require`` go first.

    Each task removes its own duplicates before the shuffle, so a value that fills
    a third of the table reaches the shuffle once per task.
    """
    out = df if columns is None else df.select(*columns)
    if require:
        out = drop_nulls(out, require)
    return out.distinct()

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def calendar_parts(date: Column) -> dict[str, Column]:
    """Day, ISO week, month, quarter and calendar year of a date.

    ``week`` is the ISO week while ``year`` is the calendar year: 1996-12-30 gives
    week 1 of year 1996.  The two are no ISO year-week pair.
    """
    return {
        "day": F.dayofmonth(date),
        "week": F.weekofyear(date),
        "month": F.month(date),
        "quarter": F.quarter(date),
        "year": F.year(date),
    }


def calendar_dim(df: DataFrame, date_col: str) -> DataFrame:
    """One row per distinct date with its calendar parts.

    Duplicates go before the parts are derived: the parts follow from the date, so
    the shuffle carries one column instead of six.
    """
    return df.select(date_col).dropDuplicates().withColumns(calendar_parts(F.col(date_col)))

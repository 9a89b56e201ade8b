from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.schemas import RATING_TYPE

_INTEGRAL = {"tinyint", "byte", "smallint", "short", "int", "integer", "bigint", "long"}


def try_cast(text: Column, type_name: str) -> Column:
    """Parse a text column; what does not parse becomes NULL (a plain cast raises).

    Inside Spark every failed integer cast raises and catches an exception, some
    thirty times the cost of a good one.  Text with anything but digits, signs and
    blanks cannot be an integer, so it is turned away before the cast.
    """
    parsed = text.try_cast(type_name)
    if type_name.lower() not in _INTEGRAL:
        return parsed
    return F.when(text.rlike(r"^[0-9+\-\s\p{Cntrl}]*[0-9][0-9+\-\s\p{Cntrl}]*$"), parsed)


def try_cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    return df.withColumns({n: try_cast(F.col(n), t) for n, t in types.items()})


def rating_value(column: Column, rating_type: T.DecimalType = RATING_TYPE) -> Column:
    """A rating in the warehouse's decimal type; extra digits round half up."""
    return column.cast(rating_type)

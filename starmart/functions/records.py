from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.schemas import GENRE_JSON


def parse_records(column: Column, schema: T.ArrayType = GENRE_JSON) -> Column:
    """JSON array text as an array of structs; malformed text becomes NULL."""
    return F.from_json(column, schema)


def explode_records(
    df: DataFrame,
    column: str,
    fields: Mapping[str, str],
    schema: T.ArrayType = GENRE_JSON,
) -> DataFrame:
    """One row per array element, with ``fields`` (new name -> struct field) added.

    Rows whose text is NULL, malformed or an empty array disappear.  ``column``
    itself is replaced by the element.
    """
    return df.withColumn(column, F.explode(parse_records(F.col(column), schema))).withColumns(
        {new: F.col(f"{column}.{old}") for new, old in fields.items()}
    )

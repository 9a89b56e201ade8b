from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def project(df: DataFrame, columns: Sequence[str], rename: Mapping[str, str] | None = None) -> DataFrame:
    """Keep ``columns`` in that order, renaming those listed in ``rename`` (old -> new)."""
    rename = rename or {}
    return df.select(*[F.col(c).alias(rename.get(c, c)) for c in columns])


def derive(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Add columns, or replace those that exist; all see the incoming values."""
    return df.withColumns(dict(columns))


def align_to_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of ``schema`` by name, in its order and types; others are dropped.

    A column the frame lacks is an error rather than a column of NULLs: a merge
    would overwrite good values with them.
    """
    missing = [n for n in schema.names if n not in df.columns]
    if missing:
        raise ValueError(f"columns missing from the source: {missing}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])

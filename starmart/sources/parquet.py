from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def write_parquet(df: DataFrame, path: str) -> None:
    """Write a new dataset; an existing path is an error."""
    df.write.mode("errorifexists").parquet(path)


def append_parquet(df: DataFrame, path: str) -> None:
    """Add the rows to a dataset; the same rows twice are there twice."""
    df.write.mode("append").parquet(path)


def read_parquet(spark: SparkSession, *paths: str, schema: T.StructType | None = None) -> DataFrame:
    """A stored dataset; with ``schema`` no file is opened to infer one."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(*paths)

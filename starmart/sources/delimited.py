from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.sources.split_csv import read_csv_split

# "rfc4180" reads doubled quotes and line breaks inside quotes, "rfc4180_split" the same
# with many tasks per file, "lines" doubled quotes with one record per line, "plain"
# sets nothing but the header.
DIALECTS = {
    "rfc4180": {"multiLine": "true", "escape": '"'},
    "rfc4180_split": {"multiLine": "true", "escape": '"'},
    "lines": {"escape": '"'},
    "plain": {},
}

#: The record's text beside its typed cells, where one of them did not parse.
RECORD = "__record"
#: And the cells that did not.
LOST = "__lost"


def read_csv_typed(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    dialect: str = "rfc4180",
) -> DataFrame:
    """Header CSV under a fixed schema.

    Columns bind by position, the header line is skipped and not compared; a cell
    that does not parse becomes NULL.  The dialect alone decides how a file is read,
    never its size: ``"rfc4180"`` gives a file to one task, ``"rfc4180_split"`` reads it
    by many and raises on any record that is not strict RFC 4180.
    """
    options = {"mode": "PERMISSIVE", **DIALECTS[dialect]}
    if dialect == "rfc4180_split":
        return read_csv_split(spark, path, schema, options)
    return spark.read.schema(schema).option("header", True).options(**options).csv(path)


def read_csv_checked(
    spark: SparkSession, path: str, schema: T.StructType, dialect: str = "rfc4180"
) -> DataFrame:
    """As ``read_csv_typed``, with the text of every record that did not fit the schema.

    ``__record`` is NULL where all cells parsed and the record had as many as the schema.  Spark
    does not answer a query of that column alone: use others with it, or write the rows first.
    """
    if dialect == "rfc4180_split":
        raise ValueError("records are kept by Spark's own reader only; choose another dialect")
    wide = T.StructType([*schema.fields, T.StructField(RECORD, T.StringType())])
    # Without pruning, so that a bad cell counts whichever columns are used.
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": RECORD, "columnPruning": "false", **DIALECTS[dialect]}
    return spark.read.schema(wide).option("header", True).options(**options).csv(path)


def rejected_cells(
    checked: DataFrame, schema: T.StructType, dialect: str = "rfc4180", keep: Sequence[str] = ()
) -> DataFrame:
    """The cells of ``read_csv_checked`` that did not parse: ``keep`` columns, ``column, value, record``.

    A record that has too few or too many cells, and no bad one, is one row with a NULL column.
    """
    marked = checked.withColumn(LOST, lost_cells(schema, dialect))
    return rejected_rows(marked, keep)


def lost_cells(schema: T.StructType, dialect: str = "rfc4180") -> Column:
    """Of a row of ``read_csv_checked`` the array of (column, value) of the cells that did not parse.

    NULL for a record that fits.  Rows can be stored with it, so that no file is parsed twice.
    """
    text = ", ".join(f"`c{i}` STRING" for i in range(len(schema.fields)))
    cells = F.from_csv(F.col(RECORD), text, {"mode": "PERMISSIVE", "columnPruning": "false", **DIALECTS[dialect]})
    lost = F.array(
        *[
            F.when(F.col(f"`{f.name}`").isNull(), F.struct(F.lit(f.name).alias("column"), cells.getField(f"c{i}").alias("value")))
            for i, f in enumerate(schema.fields)
        ]
    )
    return F.when(F.col(RECORD).isNotNull(), F.filter(lost, lambda x: x["value"].isNotNull()))


def rejected_rows(marked: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """``rejected_cells`` of rows that carry ``__record`` and, as ``__lost``, their ``lost_cells``."""
    names = [f"`{c}`" for c in keep]
    bad = marked.where(F.col(LOST).isNotNull())
    each = bad.select(*names, F.explode_outer(LOST).alias("__cell"), F.col(RECORD).alias("record"))
    return each.select(*names, "__cell.column", "__cell.value", "record")


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Header CSV with doubled quotes and untrimmed text, readable by ``read_csv_typed``."""
    (
        df.write.mode(mode)
        .option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )

"""Quoted CSV whose records span lines, read by many tasks per file.

Spark's ``multiLine`` reader gives a file to one task.  Here the file is read as
plain lines, which does split, and the lines are put together again.  In RFC 4180
text a line break ends a record exactly if the quotes before it are even in number.
Counting inside each split and then over the splits' totals (one row per split)
tells that for every line, without any task seeing the whole file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.scratch import materialize


def _strict(value: Column) -> Column:
    """Whether a record is strict RFC 4180: quotes only round whole cells, doubled inside.

    Every pair of quotes with what it holds becomes one control character, two if quotes
    are doubled.  Then none may stand next to anything but a comma or its like, and no
    quote or line break may be left.
    """
    bare = F.regexp_replace(value, '"[^"]*+"', "\x01")
    return ~bare.rlike("\x01[^,\x01]|[^,\x01]\x01|[\"\r\n]") & (F.trim(value) != "")


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """All lines: ``file``, ``block`` (offset of the split), ``at`` (order inside the split),
    ``value``, ``quotes``, and ``crlf`` if the line break had two characters."""
    value = F.col("value")
    return (
        spark.read.option("lineSep", "\n")
        .text(path)
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("at"),
            value,
            (F.length(value) - F.length(F.replace(value, F.lit('"'), F.lit("")))).alias("quotes"),
            F.endswith(value, F.lit("\r")).alias("crlf"),
        )
    )


def _with_split_state(lines: DataFrame) -> DataFrame:
    """Add what a split knows alone: ``odd`` (quotes before the line, modulo 2) and the
    last line so far that starts a record if the split begins outside (``start0``) or
    inside (``start1``) quotes."""
    split = Window.partitionBy("file", "block").orderBy("at")
    so_far = split.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = F.sum("quotes").over(split.rowsBetween(Window.unboundedPreceding, -1))
    odd = (F.coalesce(before, F.lit(0)) % 2).cast("int")
    return lines.withColumn("odd", odd).withColumns(
        {
            f"start{i}": F.last(F.when(F.col("odd") == i, F.col("at")), ignorenulls=True).over(so_far)
            for i in (0, 1)
        }
    )


def _splits(lines: DataFrame) -> DataFrame:
    """One row per split: ``inside`` (1 if it begins inside quotes), ``open`` (the line
    that starts the record it begins in), ``header`` (the line that starts the file) and
    ``file_crlf`` (``crlf`` of that line)."""
    totals = lines.groupBy("file", "block").agg(
        (F.sum("quotes") % 2).alias("odd"),
        F.max("start0").alias("last0"),
        F.max("start1").alias("last1"),
        F.min("at").alias("first"),
        F.min_by("crlf", "at").alias("crlf"),
    )
    order = Window.partitionBy("file").orderBy("block")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    inside = (F.coalesce(F.sum("odd").over(earlier), F.lit(0)) % 2).cast("int")
    last = F.when(F.col("inside") == 0, F.col("last0")).otherwise(F.col("last1"))
    return (
        totals.withColumn("inside", inside)
        .withColumn("last", last)
        .select(
            "file",
            "block",
            "inside",
            "odd",
            F.last("last", ignorenulls=True).over(earlier).alias("open"),
            F.first("first").over(order).alias("header"),
            F.first("crlf").over(order).alias("file_crlf"),
        )
    )


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """The text (``value``) of every record but the header of each file."""
    lines = materialize(_with_split_state(_lines(spark, path)), "csv-lines")
    start = F.when(F.col("inside") == 0, F.col("start0")).otherwise(F.col("start1"))
    # Stored, the table of splits has a known size: Spark broadcasts it if it is small.
    splits = materialize(_splits(lines), "csv-splits")
    broken = splits.groupBy("file").agg((F.sum("odd") % 2).alias("odd")).where("odd = 1").head(3)
    if broken:
        raise ValueError(f"quote without end in {[r['file'] for r in broken]}")
    placed = (
        lines.drop("odd")
        .join(splits.drop("odd"), ["file", "block"])
        .withColumn("record", F.coalesce(start, F.col("open")))
        .where(F.col("record") != F.col("header"))
    )
    # Most records are one line; only the lines of longer ones are shuffled together.
    alone = (F.col("record") == F.col("at")) & (F.col("quotes") % 2 == 0)
    pieces = F.array_sort(F.collect_list(F.struct("block", "at", "value")))
    joined = (
        placed.where(~alone)
        .groupBy("record")
        .agg(
            F.array_join(F.transform(pieces, lambda p: p["value"]), "\n").alias("value"),
            F.first("file_crlf").alias("file_crlf"),
            F.first("file").alias("file"),
        )
    )
    text = placed.where(alone).select("value", "file_crlf", "file").unionByName(joined.drop("record"))
    # Where lines end with two characters, the reader makes them one, inside quotes too.
    plain = F.regexp_replace("value", "\r(\n|\\z)", "$1")
    value = F.when(F.col("file_crlf"), plain).otherwise(F.col("value"))
    bad = F.raise_error(F.concat(F.lit("a record outside strict RFC 4180 in "), F.col("file")))
    checked = F.when(_strict(value), value).otherwise(bad.cast("string"))
    # An empty line is no record; one of blanks is none that RFC 4180 knows.
    return text.where(F.rtrim("value", F.lit("\r")) != "").select(checked.alias("value"))


def read_csv_split(
    spark: SparkSession, path: str, schema: T.StructType, options: dict[str, str]
) -> DataFrame:
    """Same rows as the ``multiLine`` reader on strict RFC 4180 text, in any order; else an error."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    row = F.from_csv("value", columns, options)
    return csv_records(spark, path).select(row.alias("row")).select("row.*")

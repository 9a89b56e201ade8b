from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.scratch import materialize

# monotonically_increasing_id() holds the partition number above bit 33 and the
# row's position in its partition below.
_POSITION_BITS = 33


def assign_surrogate_key(
    df: DataFrame, order_keys: Sequence[str], name: str, start: int | Callable[[int], int] = 0
) -> DataFrame:
    """Number the rows ``start``, ``start + 1``, ... in the order of ``order_keys``.

    The rows are range-partitioned, sorted inside their partitions and written once
    with their position; a row's number is that position plus the row count of the
    partitions before.  There is no single-partition window over the data: only the
    counts, one row per partition, meet in one place.  Equal order keys are told
    apart by the other columns and finally by the reading task, so a key that fills
    a third of the table still spreads over several partitions.

    ``start`` may be a function that is given the number of rows and returns the first key, such
    as one that reserves a range (``Warehouse.reserve``).
    """
    sortable = [
        f.name
        for f in df.schema.fields
        if f.name not in order_keys and not isinstance(f.dataType, (T.MapType, T.VariantType))
    ]
    order = [*order_keys, *sortable, "__task"]
    placed = materialize(
        df.withColumn("__task", F.spark_partition_id())
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .drop("__task")
        .withColumn("__at", F.monotonically_increasing_id()),
        "surrogate",
    )
    if callable(start):
        start = start(placed.count())
    run = F.shiftright("__at", _POSITION_BITS)
    position = F.col("__at").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    counts = placed.groupBy(run.alias("__run")).agg((F.max(position) + 1).alias("__n"))
    before = Window.orderBy("__run").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "__run", (F.coalesce(F.sum("__n").over(before), F.lit(0)) + start).alias("__offset")
    )
    # One row per shuffle partition, whatever the size of the data: safe to broadcast.
    numbered = placed.withColumn("__run", run).join(F.broadcast(offsets), "__run")
    return numbered.select((F.col("__offset") + position).alias(name), *df.columns)


def next_key(df: DataFrame, name: str) -> int:
    """The first unused surrogate key."""
    top = df.agg(F.max(name)).first()[0]
    return 0 if top is None else top + 1

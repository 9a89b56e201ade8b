"""Physical placement: clustered by key, replicated, sorted."""

from __future__ import annotations

import re
import threading
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Largest share of a table, relative to an even spread, that one bucket may hold by default.
MAX_SKEW = 4.0


class SkewedBucketError(ValueError):
    """One bucket would hold far more than its share."""


def table_bytes(df: DataFrame) -> int:
    """Upper estimate of the frame's size as a broadcast table, counted in one pass.

    Eight bytes per column and row plus the text itself; nested columns are sized by
    their JSON text.
    """
    parts = [F.lit(8)]
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        parts.append(F.lit(16))
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            parts.append(F.coalesce(F.octet_length(c), F.lit(0)))
        elif isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType)):
            parts.append(F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0)))
    row = sum(parts[1:], parts[0]).cast("long")
    return df.agg(F.coalesce(F.sum(row), F.lit(0))).first()[0]


def broadcast_threshold(spark: SparkSession) -> int:
    """``spark.sql.autoBroadcastJoinThreshold`` in bytes; -1 if broadcasting is off."""
    text = spark.conf.get("spark.sql.autoBroadcastJoinThreshold").strip().lower()
    number, unit = re.fullmatch(r"(-?\d+)\s*([kmgt]?)i?b?", text).groups()
    return int(number) * 1024 ** " kmgt".index(unit or " ")


def planned_bytes(df: DataFrame) -> int:
    """The size Spark itself plans with, from the statistics of the stored files; runs no job."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def exceeds_broadcast(df: DataFrame) -> bool:
    """Whether Spark would plan with more than the session's broadcast threshold."""
    return planned_bytes(df) > broadcast_threshold(df.sparkSession)


def replicated(dim: DataFrame, max_bytes: int = 64 << 20) -> DataFrame:
    """``dim`` marked for broadcast if it measures at most ``max_bytes``.

    A larger one is returned unmarked, so a join with it falls back to a shuffle.
    """
    return F.broadcast(dim) if table_bytes(dim) <= max_bytes else dim


def write_sorted(df: DataFrame, path: str, column: str, mode: str = "errorifexists") -> None:
    """Parquet sorted by ``column`` across files, so that readers can skip by min/max.

    The task number is a second range key: a value that fills a third of the table
    is cut over several files instead of landing in one.
    """
    (
        df.withColumn("__task", F.spark_partition_id())
        .repartitionByRange(column, "__task")
        .drop("__task")
        .sortWithinPartitions(column)
        .write.mode(mode)
        .parquet(path)
    )


def bucket_skew(df: DataFrame, buckets: int, *keys: str) -> float:
    """Rows of the fullest bucket relative to an even spread (1.0 = even)."""
    sizes = df.groupBy(F.pmod(F.hash(*keys), F.lit(buckets)).alias("b")).count()
    top, total = sizes.agg(F.max("count"), F.sum("count")).first()
    return 1.0 if not total else top * buckets / total


def by_bucket(df: DataFrame, buckets: int, keys: Sequence[str], *first: str) -> DataFrame:
    """The rows dealt to tasks by their bucket, and before it by the columns ``first``.

    A bucket above Spark's advisory partition size is cut over several tasks, each with a file
    of its own, and small ones share a task: what a task sorts does not grow with the table.
    """
    bucket = F.pmod(F.hash(*[F.col(f"`{k.replace('`', '``')}`") for k in keys]), F.lit(buckets))
    return df.withColumn("__bucket", bucket).hint("rebalance", *first, "__bucket").drop("__bucket")


def write_bucketed(
    df: DataFrame,
    table: str,
    path: str,
    buckets: int,
    *keys: str,
    mode: str = "errorifexists",
    max_skew: float | None = MAX_SKEW,
) -> None:
    """Catalog table hash-clustered by ``keys``; equally bucketed tables join in place.

    One bucket is one task of every later join, so the spread is counted first: a bucket of
    over ``max_skew`` times an even share raises ``SkewedBucketError``.  None takes any spread.
    """
    if max_skew is not None and (skew := bucket_skew(df, buckets, *keys)) > max_skew:
        raise SkewedBucketError(f"the fullest bucket by {keys} holds {skew:.1f} times an even share; max_skew allows {max_skew}")
    # One file per bucket, or one per task that a large bucket is cut into.
    writer = by_bucket(df, buckets, keys).write.bucketBy(buckets, *keys).sortBy(*keys)
    writer.mode(mode).option("path", path).saveAsTable(table)


def require_even_files(sizes: Mapping[str, int], buckets: int, max_skew: float | None, least: int) -> None:
    """Raise ``SkewedBucketError`` if one bucket's files hold over ``max_skew`` times an even share.

    ``sizes`` are the bytes of the bucketed files by name, which ends in the bucket.  A bucket of
    under ``least`` bytes is no burden for its task, however empty the others are.
    """
    if max_skew is None or not sizes:
        return
    held = [0] * buckets
    for name, size in sizes.items():
        held[int(re.search(r"_(\d{5,})(?:\.c\d+)?\.[^/]*$", name).group(1))] += size
    if max(held) >= least and max(held) * buckets > max_skew * sum(held):
        raise SkewedBucketError(
            f"bucket {held.index(max(held))} of {buckets} holds {max(held)} of {sum(held)} bytes; choose another key, or allow it by max_skew"
        )


def part_of(column: Column, kind: T.DataType, bounds: Sequence[int | str]) -> Column:
    """The number of bounds at or below the value, by bisection; 0 for NULL."""

    def cut(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        mid = (low + high + 1) // 2
        bound = F.lit(bounds[mid - 1]).cast(kind)
        return F.when(column < bound, cut(low, mid - 1)).otherwise(cut(mid, high))

    return F.when(column.isNull(), F.lit(0)).otherwise(cut(0, len(bounds)))


def quantiles(df: DataFrame, column: str, n: int) -> list[int | str]:
    """Bounds that cut the rows into about ``n`` equal runs of the column, the least value left out."""
    if n < 2:
        return []
    shares = [i / n for i in range(1, n)]
    row = df.agg(F.percentile_approx(column, shares, 20 * n).alias("cuts"), F.min(column).alias("least")).first()
    found = sorted({v for v in row["cuts"] or [] if v > row["least"]})
    return [v if isinstance(v, int) else v.isoformat() for v in found]


_IN_PLACE = "spark.sql.requireAllClusterKeysForCoPartition"
_lock = threading.Lock()
_holding: dict[int, tuple[int, str]] = {}


@contextmanager
def join_in_place(spark: SparkSession) -> Iterator[None]:
    """Let joins on several keys use a side that is bucketed by some of them as it lies.

    Spark by default shuffles both sides by all keys then.  The session's setting is put back
    when the last block that runs at the same time has ended.
    """
    me = id(spark)
    with _lock:
        n, old = _holding.get(me, (0, ""))
        if not n:
            old = spark.conf.get(_IN_PLACE)
            spark.conf.set(_IN_PLACE, "false")
        _holding[me] = (n + 1, old)
    try:
        yield
    finally:
        with _lock:
            n, old = _holding.pop(me)
            if n > 1:
                _holding[me] = (n - 1, old)
            else:
                spark.conf.set(_IN_PLACE, old)

"""Whitening of embeddings on their leading principal components.

The covariance is summed by tasks, over centred values; its eigenpairs are found on the
driver (``eigen``), which holds one matrix of dimension by dimension; the projection, dimension
by components, is broadcast.
"""

from __future__ import annotations

import decimal
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.llm.eigen import leading
from starmart.llm.exprs import col
from starmart.scratch import Scratch

SCALE, OFFSET = 64, 1_000_000
#: Entries from here on count as not finite: their whole number would not be exact.
_LARGEST = float(2**52 // SCALE)
_LIMB = 24


def scaled(vector: Column) -> Column:
    """floor(64 c) + 1000000 of every entry as longs; NULL for a vector that does not count.

    It counts if it is neither NULL nor empty and has no entry that is NULL, NaN, infinite or
    of 2^46 or more.
    """
    double = vector.cast("array<double>")
    good = F.forall(double, lambda c: c.isNotNull() & (F.abs(c) < _LARGEST)) & (F.size(vector) > 0)
    return F.when(good, F.transform(double, lambda c: F.floor(c * SCALE) + OFFSET))


def _matrix(column: pa.ListArray, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


@dataclass(frozen=True)
class Mean:
    """The mean S / n of whole vectors, exact: ``base`` + ``rest`` / n, 0 <= ``rest`` < n."""

    n: int
    base: np.ndarray
    rest: list[int]

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.base).astype(float) - np.array([r / self.n for r in self.rest])

    def deviations(self, x: np.ndarray) -> list[int]:
        """Per row the sum of (n x - S)^2, exact."""
        near = x - self.base
        if not len(x):
            return []
        if (int(np.abs(near).max()) + 1) * self.n >= 2**62:
            far = near.astype(object) * self.n - np.array(self.rest, object)
            return (far * far).sum(axis=1).tolist()
        y = near * self.n - np.array(self.rest, np.int64)
        # In limbs of 24 bits no sum of products of two overflows (up to 32,768 dimensions).
        low = y & ((1 << _LIMB) - 1)
        mid = (y >> _LIMB) & ((1 << _LIMB) - 1)
        high = y >> 2 * _LIMB
        out = [0] * len(y)
        for a, b, twice, shift in ((low, low, 1, 0), (low, mid, 2, 1), (mid, mid, 1, 2), (low, high, 2, 2), (mid, high, 2, 3), (high, high, 1, 4)):
            sums = np.einsum("ij,ij->i", a, b)
            if sums.any():
                out = [o + (twice * s << _LIMB * shift) for o, s in zip(out, sums.tolist(), strict=True)]
        return out


def _mean(fit: DataFrame, d: int) -> Mean:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, high, low = 0, np.zeros(d, np.int64), np.zeros(d, np.int64)
        for batch in batches:
            x = _matrix(batch.column(0), d)
            n, high, low = n + len(x), high + (x >> 26).sum(axis=0), low + (x & (1 << 26) - 1).sum(axis=0)
        if n:
            yield pa.record_batch([pa.array(np.arange(d)), pa.array(np.full(d, n)), pa.array(high), pa.array(low)], names=["i", "n", "high", "low"])

    parts = fit.select("x").mapInArrow(run, "i long, n long, high long, low long")
    # One row per dimension.
    rows = parts.groupBy("i").agg(F.sum("n").alias("n"), F.sum("high").alias("high"), F.sum("low").alias("low")).orderBy("i").collect()
    n, sums = rows[0]["n"], [(r["high"] << 26) + r["low"] for r in rows]
    return Mean(n, np.array([s // n for s in sums], np.int64), [s % n for s in sums])


def _products(fit: DataFrame, d: int, k: int, values: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum over all rows of v v', v = ``values`` of the row, of ``k`` entries: k * k numbers reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, any_rows = np.zeros((k, k)), False
        for batch in batches:
            v = values(_matrix(batch.column(0), d))
            total, any_rows = total + v.T @ v, any_rows or len(v) > 0
        if any_rows:
            i, j = np.triu_indices(k)
            yield pa.record_batch([pa.array(i), pa.array(j), pa.array(total[i, j])], names=["i", "j", "v"])

    parts = fit.select("x").mapInArrow(run, "i long, j long, v double")
    out = np.zeros((k, k))
    for r in parts.groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        out[r["i"], r["j"]] = out[r["j"], r["i"]] = r["v"]
    return out


def whiten(embeddings: DataFrame, components: int = 16, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Every vector on the leading components: ``id, component, n, deviation, whitened, explained, identity_error``.

    The fit takes each distinct scaled vector (``scaled``) once; ``n`` is their number,
    ``deviation`` the sum over dimensions of (n x - S)^2 as decimal(38,0), NULL beyond 38
    digits.  A direction whose variance is nothing but rounding, at most 1e-13 of the trace per
    dimension, cannot be whitened and is no component, so one distinct vector gives no rows.
    Vectors that do not count have no rows.  Of vectors of different lengths those of the
    commonest length (of distinct ones; the smallest of several) are fitted and returned.
    Repeated ids and rows each have their own rows; other columns are ignored; an empty table
    gives no rows.
    """
    spark = embeddings.sparkSession
    kind = dict(embeddings.dtypes)[id]
    schema = f"id {kind}, component int, deviation decimal(38,0), whitened double, explained double"
    x = scaled(col(embeddings, vector)).alias("x")
    rows = embeddings.select(col(embeddings, id).alias("id"), x).where("x IS NOT NULL")
    with Scratch(spark) as scratch:
        fit = scratch.table(rows.select("x").distinct(), "distinct-vectors")
        common = fit.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), "d").first()
        if common is None:
            d, n, mean, trace, error = 0, 0, Mean(1, np.zeros(0, np.int64), []), 0.0, 0.0
            values, axes = np.zeros(0), np.zeros((0, 0))
        else:
            d = common["d"]
            fit = fit.where(F.size("x") == d)
            mean = _mean(fit, d)
            n = mean.n
            covariance = _products(fit, d, d, mean.centred) / n
            trace = float(np.trace(covariance))
            values, axes = leading(covariance, components)
            real = values > 1e-13 * d * trace
            values, axes = values[real], axes[:, real] / np.sqrt(values[real])
            k = len(values)
            error = float(np.abs(_products(fit, d, k, lambda m: mean.centred(m) @ axes) / n - np.eye(k)).max()) if k else 0.0
    shared = spark.sparkContext.broadcast((mean, axes, values / trace if trace else values))

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mean, axes, explained = shared.value
        k = axes.shape[1]
        digits = decimal.Context(prec=38)
        for batch in batches:
            if not k or not len(batch):
                continue
            m = _matrix(batch.column(1), d)
            far = [digits.create_decimal(v) if v < 10**38 else None for v in mean.deviations(m)]
            each = np.repeat(np.arange(len(m)), k)
            yield pa.record_batch([
                batch.column(0).take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(m))),
                pa.array(far, pa.decimal128(38, 0)).take(pa.array(each)), pa.array((mean.centred(m) @ axes).ravel()), pa.array(np.tile(explained, len(m))),
            ], names=["id", "component", "deviation", "whitened", "explained"])

    out = rows.where(F.size("x") == d).mapInArrow(project, schema)
    return out.select(
        F.col("id").alias(id), "component", F.lit(n).cast("long").alias("n"), "deviation", "whitened", "explained", F.lit(error).alias("identity_error")
    )

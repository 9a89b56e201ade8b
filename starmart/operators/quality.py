"""Constraints that plain Parquet does not enforce: NOT NULL, text length, unique key."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from starmart.operators.merge import duplicate_keys
from starmart.operators.metrics import collected
from starmart.operators.project import align_to_schema
from starmart.schemas import TableSpec

__all__ = ["ConstraintError", "breaking_rows", "conform", "duplicate_keys", "enforce", "observed", "violations"]


class ConstraintError(ValueError):
    """Rows break a declared constraint."""


def _broken(spec: TableSpec) -> list[tuple[str, str, Column]]:
    """(column, rule, condition that is true on a breaking row)."""
    return [(c, "not_null", F.col(c).isNull()) for c in spec.not_null] + [
        (c, f"length<={n}", F.coalesce(F.char_length(c) > n, F.lit(False)))
        for c, n in spec.lengths.items()
    ]


def violations(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Breaking rows per constraint: ``column``, ``rule``, ``n_rows`` (0 if it holds).

    All constraints are counted in one pass without shuffling rows.
    """
    rules = _broken(spec)
    counted = df.agg(*[F.count_if(bad).alias(f"n{i}") for i, (_, _, bad) in enumerate(rules)])
    lines = [
        F.struct(F.lit(c).alias("column"), F.lit(r).alias("rule"), F.col(f"n{i}").alias("n_rows"))
        for i, (c, r, _) in enumerate(rules)
    ]
    return counted.select(F.inline(F.array(*lines)))


def breaking_rows(df: DataFrame, spec: TableSpec) -> DataFrame:
    """The rows that break a constraint, as they are."""
    return df.where(reduce(lambda a, b: a | b, [bad for _, _, bad in _broken(spec)], F.lit(False)))


def observed(df: DataFrame, spec: TableSpec) -> tuple[DataFrame, Callable[[], None]]:
    """The rows, counted against the constraints by whatever job writes them; no scan of its own.

    Call the second result once that job has run: it raises ``ConstraintError`` if a row broke
    the spec.
    """
    rules = _broken(spec)
    if not rules:
        return df, lambda: None
    seen = Observation()
    rows = df.observe(seen, *[F.count_if(bad).alias(f"n{i}") for i, (_, _, bad) in enumerate(rules)])

    def check() -> None:
        counts = collected(seen)
        found = [(c, r, n) for i, (c, r, _) in enumerate(rules) if (n := counts.get(f"n{i}", 0))]
        if found:
            raise ConstraintError(f"{spec.name}: {found}")

    return rows, check


def enforce(df: DataFrame, spec: TableSpec, on_violation: str = "fail") -> DataFrame:
    """The rows that satisfy the spec; ``"fail"`` raises if any does not, ``"drop"`` filters."""
    rules = _broken(spec)
    if not rules:
        return df
    if on_violation == "drop":
        return df.where(~reduce(lambda a, b: a | b, [bad for _, _, bad in rules]))
    if on_violation != "fail":
        raise ValueError(f"on_violation must be 'fail' or 'drop', not {on_violation!r}")
    found = violations(df, spec).where("n_rows > 0").collect()  # at most one row per rule
    if found:
        raise ConstraintError(f"{spec.name}: {[tuple(r) for r in found]}")
    return df


def conform(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Source columns in the spec's order and types; fixed-width text padded with blanks."""
    out = align_to_schema(df, spec.stage_schema)
    padded = {
        c: F.when(F.char_length(c) < spec.lengths[c], F.rpad(c, spec.lengths[c], " ")).otherwise(
            F.col(c)
        )
        for c in spec.pad
    }
    return out.withColumns(padded) if padded else out

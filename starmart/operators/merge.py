"""Keyed merges of a source into a target, as DataFrame expressions.

For target T, source S, keys K and set columns C a merge yields

    {t : t.K not in S.K}  +  {t with C := s.C : t.K = s.K}  +  {s : s.K not in T.K}

Whether a row matched is carried as a flag, so a NULL in the source overwrites.
A NULL in any key never matches: such source rows are always inserted.

No join here carries a hint.  The plan follows the statistics Spark plans with
(``exceeds_broadcast``), which cost no job; both ways give the same rows.

- Source at most ``spark.sql.autoBroadcastJoinThreshold``: it is broadcast and no read
  of the target is shuffled.  The update is a left join from the target, the insert
  looks only at target keys already reduced by a semi-join.  The source is read three
  times and the target twice (once for its keys), so hand in stored tables.
- Above it: an upsert is one full outer join, an insert one anti-join.  Each side is
  read once and hash-partitioned once by the keys.

``update_from`` and ``insert_new`` join complete keys only and add the rows with a NULL
key afterwards (a second, filtered read), so that tables bucketed alike join in place.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from starmart.operators.layout import exceeds_broadcast
from starmart.operators.metrics import collected
from starmart.operators.project import align_to_schema
from starmart.scratch import materialize

_SPREAD = "__spread"
_HIT = "__hit"


class DuplicateKeyError(ValueError):
    """The merge source holds several rows for one key."""


def keys_present(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row count ``n_rows``."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")


def _spread(keys: Sequence[str]) -> Column:
    """0 for rows whose keys are all present, else the number of the reading task.

    As an extra join column it changes no match (NULL keys match nothing) but keeps
    the NULL-key rows from meeting in one shuffle partition.
    """
    return F.when(keys_present(keys), F.lit(0)).otherwise(F.spark_partition_id())


def one_row_per_key(
    source: DataFrame, keys: Sequence[str], dedupe_by: Sequence[str], count: str | None = None
) -> DataFrame:
    """The row with the smallest ``dedupe_by`` (NULL first) for every key.

    ``count`` names a further column with the number of the key's rows.

    Remaining ties go to the smallest row over all columns.  It is a plain minimum,
    so copies of a hot key shrink to one row per task before the shuffle.
    """
    order = [c for c in dedupe_by if c not in keys]
    order += [c for c in source.columns if c not in keys and c not in order]
    if not order and count is None:
        return source.distinct()
    row = [F.min(F.struct(*order)).alias("__row")] if order else []
    picked = source.groupBy(*keys).agg(*row, F.count(F.lit(1)).alias(count or "__count"))
    columns = [F.col(c) if c in keys else F.col(f"__row.{c}").alias(c) for c in source.columns]
    return picked.select(*columns, *([count] if count else []))


def unique_observed(
    source: DataFrame, keys: Sequence[str], order: Sequence[str] = ()
) -> tuple[DataFrame, Callable[[], None]]:
    """One row per key, and a check that there was no other, made by whatever job writes the rows.

    Call the second result once that job has run: it raises ``DuplicateKeyError`` if a key had
    several rows.  The rows are shuffled once by the keys and not read for the check.
    """
    seen = Observation()
    many = F.col("__count") > 1
    counted = one_row_per_key(source, keys, order, "__count").observe(
        seen,
        F.count_if(many).alias("n"),
        *[F.min_by(k, F.when(many, F.lit(1))).cast("string").alias(f"k{i}") for i, k in enumerate(keys)],
    )

    def check() -> None:
        found = collected(seen)
        if found.get("n"):
            first = tuple(found[f"k{i}"] for i in range(len(keys)))
            raise DuplicateKeyError(
                f"{found['n']} source keys {tuple(keys)} have several rows, such as {first}; pass dedupe_by to keep one of them"
            )

    return counted.drop("__count"), check


def require_unique(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The source itself, after a check that no complete key occurs twice."""
    found = duplicate_keys(source.where(keys_present(keys)).select(*keys), keys).head(3)
    if found:
        raise DuplicateKeyError(
            f"source rows share a key {tuple(keys)}: {[tuple(r) for r in found]}; "
            "pass dedupe_by to keep one of them"
        )
    return source


def settle_source(
    source: DataFrame,
    keys: Sequence[str],
    dedupe_by: Sequence[str] | None = None,
    null_keys: bool = True,
) -> DataFrame:
    """The source with each complete key once, for use in several joins.

    Checks, or with ``dedupe_by`` picks the rows and writes them: later reads then do
    not group again, and Spark plans with the true size of what was kept.
    """
    if dedupe_by is None:
        return require_unique(source, keys)
    if not null_keys:
        return materialize(one_row_per_key(source, keys, dedupe_by), "merge-source")
    # A row with a NULL key is a key of its own, so one scan settles both kinds.
    own = F.when(keys_present(keys), F.lit(0)).otherwise(F.monotonically_increasing_id() + 1)
    kept = one_row_per_key(source.withColumn(_SPREAD, own), [*keys, _SPREAD], dedupe_by)
    return materialize(kept.drop(_SPREAD), "merge-source")


def _complete(
    source: DataFrame,
    keys: Sequence[str],
    dedupe_by: Sequence[str] | None,
    unique: bool,
    null_keys: bool,
) -> DataFrame:
    """The source rows that can match: complete keys, each once."""
    keyed = source.where(keys_present(keys)) if null_keys else source
    if dedupe_by is not None:
        return one_row_per_key(keyed, keys, dedupe_by)
    return keyed if unique else require_unique(keyed, keys)


def update_from(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    set_cols: Sequence[str] | None = None,
    dedupe_by: Sequence[str] | None = None,
    unique: bool = False,
    null_keys: bool = True,
) -> DataFrame:
    """Every target row; where the source has its key, ``set_cols`` come from the source.

    ``set_cols`` defaults to the non-key columns both sides have.  Duplicate source
    keys raise ``DuplicateKeyError`` unless ``dedupe_by`` picks a row; ``unique=True``
    skips that check, ``null_keys=False`` tells that no key column holds NULL.
    """
    if set_cols is None:
        set_cols = [c for c in target.columns if c in source.columns and c not in keys]
    right = _complete(source, keys, dedupe_by, unique, null_keys)
    left = target.where(keys_present(keys)) if null_keys else target
    right = right.select(
        *[F.col(k).alias(f"__s_{k}") for k in keys],
        *[F.col(c).alias(f"__s_{c}") for c in set_cols],
        F.lit(True).alias(_HIT),
    )
    match = [F.col(k) == F.col(f"__s_{k}") for k in keys]
    types = {f.name: f.dataType for f in target.schema.fields}
    updated = left.join(right, match, "left").select(
        *[
            F.when(F.col(_HIT), F.col(f"__s_{c}").cast(types[c])).otherwise(F.col(c)).alias(c)
            if c in set_cols
            else F.col(c)
            for c in target.columns
        ]
    )
    return updated.unionByName(target.where(~keys_present(keys))) if null_keys else updated


def insert_new(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    dedupe_by: Sequence[str] | None = None,
    unique: bool = False,
    null_keys: bool = True,
) -> DataFrame:
    """The source rows whose key the target lacks.

    An anti-join has the target on its build side and so would shuffle it whole for a
    small source too; a source that is broadcast anyway first reduces the target's keys
    by a semi-join.
    """
    wanted = source.where(keys_present(keys)).select(*keys)
    known = target.where(keys_present(keys)).select(*keys)
    if not exceeds_broadcast(wanted):
        if dedupe_by is not None:
            wanted = wanted.distinct()
        known = known.join(wanted, list(keys), "left_semi").distinct()
    complete = _complete(source, keys, dedupe_by, unique, null_keys)
    fresh = complete.join(known, list(keys), "left_anti").select(*source.columns)
    return fresh.unionByName(source.where(~keys_present(keys))) if null_keys else fresh


def insert_only_new(
    target: DataFrame, source: DataFrame, keys: Sequence[str], **options
) -> DataFrame:
    """The target unchanged plus the source rows with new keys."""
    fresh = insert_new(target, source, keys, **options)
    return target.unionByName(align_to_schema(fresh, target.schema))


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    set_cols: Sequence[str] | None = None,
    dedupe_by: Sequence[str] | None = None,
    unique: bool = False,
    null_keys: bool = True,
    one_pass: bool | None = None,
) -> DataFrame:
    """Update the target rows whose key the source has, insert the rest of the source.

    ``one_pass`` does both in one full outer join: either side is read and shuffled
    once.  By default it is chosen for a source too large to broadcast.  A full outer
    join cannot split a hot key: for a target whose keys are far from unique pass False.
    """
    if dedupe_by is not None or not unique:
        source = settle_source(source, keys, dedupe_by, null_keys)
    if exceeds_broadcast(source) if one_pass is None else one_pass:
        return _upsert_in_one_pass(target, source, keys, set_cols, null_keys)
    options = {"unique": True, "null_keys": null_keys}
    updated = update_from(target, source, keys, set_cols, **options)
    fresh = insert_new(target, source, keys, **options)
    return updated.unionByName(align_to_schema(fresh, target.schema))


def matched_once(
    target: DataFrame, source: DataFrame, keys: Sequence[str], null_keys: bool = True
) -> DataFrame:
    """The full outer join of both: target columns, source columns as ``__s_<name>``, and
    the flags ``__have`` and ``__hit`` (true where the target, the source has the row).

    Rows with a NULL key match nothing; ``null_keys`` spreads them over the partitions.
    """
    right = source.select(
        *[F.col(c).alias(f"__s_{c}") for c in source.columns], F.lit(True).alias(_HIT)
    )
    left = target.withColumn("__have", F.lit(True))
    match = [F.col(k) == F.col(f"__s_{k}") for k in keys]
    if null_keys:
        left = left.withColumn(_SPREAD, _spread(keys))
        right = right.withColumn(f"__s{_SPREAD}", _spread([f"__s_{k}" for k in keys]))
        match.append(F.col(_SPREAD) == F.col(f"__s{_SPREAD}"))
    return left.join(right, match, "full").drop(_SPREAD, f"__s{_SPREAD}")


def _upsert_in_one_pass(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    set_cols: Sequence[str] | None,
    null_keys: bool,
) -> DataFrame:
    if set_cols is None:
        set_cols = [c for c in target.columns if c in source.columns and c not in keys]
    joined = matched_once(target, align_to_schema(source, target.schema), keys, null_keys)
    return joined.select(
        *[
            F.when(F.col(_HIT) if c in set_cols else F.col("__have").isNull(), F.col(f"__s_{c}"))
            .otherwise(F.col(c))
            .alias(c)
            for c in target.columns
        ]
    )


def append_all(target: DataFrame, source: DataFrame) -> DataFrame:
    """All rows of both; running it twice doubles the source rows."""
    return target.unionByName(align_to_schema(source, target.schema))

"""Merges against the set definition, on hand-made and random rows."""

import random

import pytest
from pyspark.sql import functions as F

from starmart.operators.merge import (
    DuplicateKeyError,
    append_all,
    duplicate_keys,
    insert_new,
    insert_only_new,
    one_row_per_key,
    update_from,
    upsert,
)

KV = "k int, v string"
ABV = "a int, b string, v int, w int"


def bag(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def srt(rows):
    return sorted(rows, key=repr)


@pytest.fixture(params=["10485760", "-1"], ids=["broadcast", "shuffle"])
def joins(request, spark):
    """Both physical plans: the source below and above the broadcast threshold."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", request.param)
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.mark.parametrize(
    ("target", "source", "expected"),
    [
        ([(1, "a"), (2, "b")], [(2, "B"), (3, "c")], [(1, "a"), (2, "B"), (3, "c")]),
        ([(1, "a")], [(1, None)], [(1, None)]),
        ([(1, "a")], [(None, "n")], [(1, "a"), (None, "n")]),
        ([(None, "t")], [(None, "n"), (None, "m")], [(None, "t"), (None, "n"), (None, "m")]),
        ([], [(1, "a")], [(1, "a")]),
        ([(1, "a")], [], [(1, "a")]),
        ([(1, "a"), (1, "z")], [(1, "x")], [(1, "x"), (1, "x")]),
    ],
)
def test_upsert_cases(spark, joins, target, source, expected):
    t, s = spark.createDataFrame(target, KV), spark.createDataFrame(source, KV)
    assert bag(upsert(t, s, ["k"])) == srt(expected)
    assert bag(upsert(t, s, ["k"], one_pass=True)) == srt(expected)


def test_duplicate_source_key(spark):
    t = spark.createDataFrame([(1, "a")], KV)
    s = spark.createDataFrame([(2, "y"), (2, "x")], KV)
    for merge in (upsert, update_from, insert_new, insert_only_new):
        with pytest.raises(DuplicateKeyError, match="dedupe_by"):
            merge(t, s, ["k"])
    assert bag(upsert(t, s, ["k"], dedupe_by=["v"])) == [(1, "a"), (2, "x")]
    assert bag(duplicate_keys(s, ["k"])) == [(2, 2)]


def test_one_row_per_key(spark):
    s = spark.createDataFrame([(1, "b", 1), (1, None, 9), (2, "c", 5), (2, "c", 4)], "k int, v string, n int")
    assert bag(one_row_per_key(s, ["k"], ["v"])) == srt([(1, None, 9), (2, "c", 4)])
    assert bag(one_row_per_key(s, ["k"], ["n"])) == srt([(1, "b", 1), (2, "c", 4)])
    assert bag(one_row_per_key(s.select("k"), ["k"], [])) == [(1,), (2,)]


def _random_pair(seed):
    rng = random.Random(seed)

    def key():
        return (rng.choice([None, *range(8)]), rng.choice([None, "x", "y"]))

    target = [(*key(), rng.choice([None, 1, 2]), rng.randrange(9)) for _ in range(40)]
    keyed, loose = {}, []
    for _ in range(30):
        k = key()
        row = (*k, rng.choice([None, 10, 20]), rng.randrange(90, 99))
        if None in k:
            loose.append(row)
        else:
            keyed[k] = row
    source = [*keyed.values(), *loose]
    rng.shuffle(source)
    return target, source


def _model(target, source, update=True, insert=True):
    by_key = {r[:2]: r for r in source if None not in r[:2]}
    have = {r[:2] for r in target if None not in r[:2]}
    out = [(*r[:2], by_key[r[:2]][2], r[3]) if update and r[:2] in by_key else r for r in target]
    if insert:
        out += [r for r in source if None in r[:2] or r[:2] not in have]
    return srt(out)


@pytest.mark.parametrize("seed", range(3))
def test_random_merges(spark, joins, seed):
    target, source = _random_pair(seed)
    t, s = spark.createDataFrame(target, ABV), spark.createDataFrame(source, ABV)
    keys = ["a", "b"]
    assert bag(update_from(t, s, keys, ["v"])) == _model(target, source, insert=False)
    assert bag(insert_new(t, s, keys)) == _model([], [r for r in _model(target, source) if r in source and (
        None in r[:2] or r[:2] not in {x[:2] for x in target})])
    merged = upsert(t, s, keys, ["v"])
    assert bag(merged) == _model(target, source)
    assert bag(upsert(t, s, keys, ["v"], one_pass=True)) == _model(target, source)
    assert bag(insert_only_new(t, s, keys)) == _model(target, source, update=False)

    # The same source again changes nothing (rows with a NULL key have no identity).
    keyed = s.where("a IS NOT NULL AND b IS NOT NULL")
    once = upsert(t, keyed, keys, ["v"])
    assert bag(upsert(once, keyed, keys, ["v"], null_keys=True)) == bag(once)
    complete = t.where("a IS NOT NULL AND b IS NOT NULL")
    assert bag(upsert(complete, keyed, keys, ["v"], null_keys=False)) == bag(
        upsert(complete, keyed, keys, ["v"])
    )
    assert bag(upsert(complete, keyed, keys, ["v"], null_keys=False, one_pass=True)) == bag(
        upsert(complete, keyed, keys, ["v"])
    )


def test_dedupe_with_null_keys(spark, joins):
    t = spark.createDataFrame([(1, "a")], KV)
    s = spark.createDataFrame([(None, "n"), (None, "n"), (1, "c"), (1, "b"), (3, "q"), (3, "p")], KV)
    for one_pass in (False, True):
        assert bag(upsert(t, s, ["k"], dedupe_by=["v"], one_pass=one_pass)) == srt(
            [(1, "b"), (3, "p"), (None, "n"), (None, "n")]
        )


def test_update_keeps_types_and_columns(spark):
    t = spark.createDataFrame([(1, 5, "keep")], "k long, n long, extra string")
    s = spark.createDataFrame([("7", 1)], "n string, k int")
    out = update_from(t, s, ["k"])
    assert out.schema == t.schema and tuple(out.first()) == (1, 7, "keep")


def test_append_doubles(spark):
    t = spark.createDataFrame([], KV)
    s = spark.createDataFrame([(1, "a"), (2, None)], KV)
    assert append_all(append_all(t, s), s.select("v", "k")).count() == 4


def test_small_source_does_not_shuffle_the_target(spark, tmp_path):
    spark.range(50_000).select(F.col("id").alias("k"), F.col("id").cast("string").alias("v")).write.parquet(
        str(tmp_path / "t")
    )
    spark.range(10).select(F.col("id").alias("k"), F.lit("s").alias("v")).write.parquet(str(tmp_path / "s"))
    t, s = (spark.read.parquet(str(tmp_path / x)) for x in "ts")
    plan = upsert(t, s, ["k"], unique=True, null_keys=False)._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line or "Exchange hash" in line or "Semi" in line]
    # The only hash exchange is above the semi-join, over the surviving keys.
    exchange = next(i for i, line in enumerate(scans) if "Exchange hash" in line)
    semi = next(i for i, line in enumerate(scans) if "BroadcastHashJoin" in line and "LeftSemi" in line)
    assert plan.count("Exchange hashpartitioning") == 1 and exchange < semi
    assert "SortMergeJoin" not in plan


def test_one_pass_shuffles_each_side_once(spark, tmp_path):
    spark.range(1_000).select(F.col("id").alias("k"), F.lit("t").alias("v")).write.parquet(str(tmp_path / "t"))
    t = spark.read.parquet(str(tmp_path / "t"))
    merged = upsert(t, t, ["k"], unique=True, null_keys=False, one_pass=True)
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2 and plan.count("FileScan") == 2


def test_null_key_rows_spread_over_partitions(spark, joins):
    t = spark.range(4_000).repartition(4).select(F.lit(None).cast("int").alias("k"), F.col("id").alias("v"))
    s = spark.createDataFrame([(1, 5)], "k int, v long")
    out = update_from(t, s, ["k"])
    assert out.count() == 4_000


def _shape(df):
    """File scans, hash exchanges and sort-merge joins of the plan without adaptive execution."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return tuple(plan.count(x) for x in ("FileScan", "Exchange hashpartitioning", "SortMergeJoin"))


def test_large_source_plans(spark, tmp_path):
    """Above the threshold every merge reads and shuffles either side once."""
    for name in "ts":
        spark.range(1_000).select(F.col("id").alias("k"), F.lit(name).alias("v")).write.parquet(str(tmp_path / name))
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    old = {c: spark.conf.get(c) for c in conf}
    try:
        for c, v in conf.items():
            spark.conf.set(c, v)
        t, s = (spark.read.parquet(str(tmp_path / x)) for x in "ts")
        for null_keys in (True, False):
            options = {"unique": True, "null_keys": null_keys}
            assert _shape(upsert(t, s, ["k"], **options)) == (2, 2, 1)
            more = 1 if null_keys else 0  # the filtered read of rows without a key
            assert _shape(insert_new(t, s, ["k"], **options)) == (2 + more, 2, 1)
            assert _shape(update_from(t, s, ["k"], **options)) == (2 + more, 2, 1)
    finally:
        for c, v in old.items():
            spark.conf.set(c, v)


def test_tables_bucketed_alike_merge_in_place(spark, tmp_path):
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    old = {c: spark.conf.get(c) for c in conf}
    names = ["merge_in_place_t", "merge_in_place_s"]
    try:
        for c, v in conf.items():
            spark.conf.set(c, v)
        for n in names:
            df = spark.range(100).select(F.col("id").alias("k"), F.lit(n).alias("v"))
            df.write.bucketBy(4, "k").sortBy("k").option("path", str(tmp_path / n)).saveAsTable(n)
        t, s = map(spark.table, names)
        assert _shape(update_from(t, s, ["k"], unique=True))[1] == 0
        assert _shape(insert_new(t, s, ["k"], unique=True))[1] == 0
        assert _shape(upsert(t, s, ["k"], unique=True, null_keys=False))[1] == 0
    finally:
        for c, v in old.items():
            spark.conf.set(c, v)
        for n in names:
            spark.sql(f"DROP TABLE IF EXISTS {n}")

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.operators.keys import assign_surrogate_key, next_key
from starmart.operators.layout import (
    SkewedBucketError,
    broadcast_threshold,
    bucket_skew,
    replicated,
    table_bytes,
    write_bucketed,
    write_sorted,
)
from starmart.operators.quality import ConstraintError, conform, enforce, violations
from starmart.plans.ratings import merge_ratings
from starmart.scratch import materialize
from starmart.schemas import INT, STRING, TableSpec, struct


def bag(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture
def many_partitions(spark):
    """Keep small shuffle partitions apart, as large ones are."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_surrogate_keys_follow_the_order(spark):
    df = spark.range(1_000).select((F.col("id") * 7919 % 1_000).alias("k"), F.col("id").alias("v")).repartition(7)
    out = assign_surrogate_key(df, ["k"], "key", start=5)
    assert out.columns == ["key", "k", "v"]
    assert [r.key - r.k for r in out.collect()] == [5] * 1_000


def test_surrogate_keys_with_a_hot_key(spark, many_partitions, monkeypatch):
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id")).alias("k"), F.lit("x").alias("v")
    ).repartition(8)
    placed = []

    def spy(rows, label):
        placed.append(materialize(rows, label))
        return placed[0]

    monkeypatch.setattr("starmart.operators.keys.materialize", spy)
    out = assign_surrogate_key(df, ["k"], "key")
    found = out.orderBy("key").collect()
    assert [r.key for r in found] == list(range(30_000))
    assert [r.k for r in found] == sorted(r.k for r in found)
    # The hot key's rows were spread over several output files.
    assert placed[0].where("k = 1").select(F.input_file_name()).distinct().count() > 1


def test_surrogate_keys_of_nothing(spark):
    df = spark.createDataFrame([], "k int")
    assert assign_surrogate_key(df, ["k"], "key").count() == 0
    assert next_key(spark.createDataFrame([], "key long"), "key") == 0
    assert next_key(spark.createDataFrame([(4,), (9,)], "key long"), "key") == 10


def test_ratings_keep_their_key(spark):
    t = spark.createDataFrame(
        [(0, 1, 10, 1.0), (1, 2, 10, 2.0)], "user_movie_id long, user_id int, movie_id int, rating double"
    )
    s = spark.createDataFrame(
        [(2, 10, None), (1, 5, 3.0), (0, 9, 4.0)], "user_id int, movie_id int, rating double"
    )
    once = merge_ratings(t, s)
    expected = [(0, 1, 10, 1.0), (1, 2, 10, None), (2, 0, 9, 4.0), (3, 1, 5, 3.0)]
    assert bag(once) == expected
    assert bag(merge_ratings(once, s)) == expected


SPEC = TableSpec(
    "t",
    struct(a=INT, b=STRING, c=STRING),
    keys=("a",),
    not_null=("a",),
    lengths={"b": 3, "c": 2},
    pad=("c",),
)


def test_violations_and_enforce(spark):
    df = spark.createDataFrame([(1, "abc", "xx"), (None, "abcd", None), (2, None, "xxx")], "a int, b string, c string")
    assert bag(violations(df, SPEC)) == [("a", "not_null", 1), ("b", "length<=3", 1), ("c", "length<=2", 1)]
    assert bag(enforce(df, SPEC, "drop")) == [(1, "abc", "xx")]
    with pytest.raises(ConstraintError, match="length<=3"):
        enforce(df, SPEC)
    good = df.where("a = 1")
    assert bag(enforce(good, SPEC)) == bag(good)
    with pytest.raises(ValueError, match="on_violation"):
        enforce(df, SPEC, "ignore")
    assert enforce(df, TableSpec("free", struct(a=INT))) is df


def test_length_counts_characters(spark):
    df = spark.createDataFrame([(1, "äöü", "éé")], "a int, b string, c string")
    assert bag(enforce(df, SPEC)) == [(1, "äöü", "éé")]


def test_conform_pads_and_casts(spark):
    df = spark.createDataFrame([("x", 7, "b", 1), (None, 8, "b", 1)], "c string, a long, b string, more int")
    out = conform(df, SPEC)
    assert out.schema.names == ["a", "b", "c"] and out.schema["a"].dataType == T.IntegerType()
    assert bag(out) == [(7, "b", "x "), (8, "b", None)]


def test_sorted_layout_splits_a_hot_value(spark, many_partitions, tmp_path):
    df = spark.range(20_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("d"), "id"
    ).repartition(8)
    write_sorted(df, str(tmp_path / "s"), "d")
    back = spark.read.parquet(str(tmp_path / "s"))
    assert bag(back) == bag(df)
    per_file = back.groupBy(F.input_file_name().alias("f")).agg(F.min("d"), F.max("d"), F.count("*")).collect()
    spans = sorted((r[1], r[2]) for r in per_file)
    assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:], strict=False))
    assert back.where("d = 7").select(F.input_file_name()).distinct().count() > 1


def test_bucketed_tables_join_in_place(spark, tmp_path):
    frames = {
        "bucket_a": spark.range(2_000).select(F.col("id").alias("k")),
        "bucket_b": spark.range(0, 2_000, 2).select(F.col("id").alias("k"), F.lit(1).alias("v")),
    }
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name, df in frames.items():
            write_bucketed(df, name, str(tmp_path / name), 4, "k")
        out = spark.table("bucket_a").join(spark.table("bucket_b"), "k", "left_anti")
        assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
        assert out.count() == 1_000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        for name in frames:
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_hot_key_is_an_error_unless_allowed(spark, tmp_path):
    hot = spark.range(1_000).select(F.when(F.col("id") < 900, F.lit(1)).otherwise(F.col("id")).alias("k"))
    assert bucket_skew(hot, 16, "k") > 4
    try:
        with pytest.raises(SkewedBucketError, match="times an even share"):
            write_bucketed(hot, "bucket_hot", str(tmp_path / "hot"), 16, "k")
        assert not spark.catalog.tableExists("bucket_hot")
        write_bucketed(hot, "bucket_hot", str(tmp_path / "hot"), 16, "k", max_skew=None)
        assert spark.sql("DESCRIBE EXTENDED bucket_hot").where("col_name = 'Num Buckets'").first()[1] == "16"
        assert bag(spark.table("bucket_hot")) == bag(hot)
    finally:
        spark.sql("DROP TABLE IF EXISTS bucket_hot")
    assert bucket_skew(spark.createDataFrame([], "k int"), 16, "k") == 1.0


def test_broadcast_threshold_units(spark):
    name = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(name)
    try:
        for text, size in [("-1", -1), ("10485760", 10 << 20), ("2MB", 2 << 20), ("3g", 3 << 30), ("5b", 5)]:
            spark.conf.set(name, text)
            assert broadcast_threshold(spark) == size
    finally:
        spark.conf.set(name, old)


def test_replicated_only_when_small(spark):
    dim = spark.range(1_000).select("id", F.repeat(F.lit("x"), 100).alias("t"), F.array("id").alias("a"))
    size = table_bytes(dim)
    assert 100_000 < size < 400_000
    fact = spark.range(10)
    plan = lambda d: fact.join(d, "id", "left")._jdf.queryExecution().logical().toString()
    assert "strategy=broadcast" in plan(replicated(dim, size))
    assert "strategy=broadcast" not in plan(replicated(dim, size - 1))

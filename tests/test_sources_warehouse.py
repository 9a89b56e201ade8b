import pytest
from pyspark.sql import functions as F

from starmart.operators.merge import upsert
from starmart.schemas import DATE, DOUBLE, INT, LONG, STRING, TIMESTAMP, TableSpec, struct
from starmart.scratch import materialize, scratch_path, scratch_root
from starmart.sources.delimited import read_csv_typed, write_csv
from starmart.sources.jdbc import append_jdbc, read_jdbc
from starmart.sources.parquet import append_parquet, read_parquet, write_parquet
from starmart.warehouse import PublishConflict, Warehouse


def bag(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_csv_binds_by_position_and_nulls_bad_cells(spark, tmp_path):
    (tmp_path / "f.csv").write_text("any,header,at all\n1,2.5,1995-10-30\nx,y,z\n3,,\n")
    schema = struct(k=INT, v=DOUBLE, d=DATE)
    out = read_csv_typed(spark, str(tmp_path / "f.csv"), schema, "plain")
    assert out.schema == schema
    found = [tuple(r) for r in out.collect()]
    assert found[0][:2] == (1, 2.5) and found[1:] == [(None, None, None), (3, None, None)]


def test_csv_unused_bad_column_costs_no_row(spark, tmp_path):
    (tmp_path / "r.csv").write_text("userId,movieId,rating,timestamp\n1,110,1.0,1425941529\n")
    schema = struct(userId=INT, movieId=INT, rating=DOUBLE, timestamp=TIMESTAMP)
    out = read_csv_typed(spark, str(tmp_path / "r.csv"), schema, "lines")
    assert bag(out.select("userId", "movieId", "rating")) == [(1, 110, 1.0)]


NASTY = [
    (1, 'He said "go", then left'),
    (2, "line one\nline two"),
    (3, "comma, comma"),
    (4, '"'),
    (5, 'ends with quote"'),
    (6, "tab\tand \\ backslash"),
    (7, "\n\nblank lines\n"),
    (8, '","'),
]


def test_csv_roundtrip_of_quotes_and_breaks(spark, tmp_path):
    schema = struct(k=INT, t=STRING)
    df = spark.createDataFrame(NASTY, schema)
    write_csv(df, str(tmp_path / "c"))
    assert bag(read_csv_typed(spark, str(tmp_path / "c"), schema)) == bag(df)


def test_parquet_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "a")], "k int, v string")
    write_parquet(df, str(tmp_path / "p"))
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        write_parquet(df, str(tmp_path / "p"))
    append_parquet(df, str(tmp_path / "p"))
    assert bag(read_parquet(spark, str(tmp_path / "p"), schema=df.schema)) == [(1, "a"), (1, "a")]


def test_jdbc_append_and_partitioned_read(spark):
    url = "jdbc:derby:memory:sources;create=true"
    df = spark.range(100).select(F.col("id").alias("k"), F.concat(F.lit("n"), "id").alias("v"))
    append_jdbc(df, url, "stage_t", connections=2)
    append_jdbc(df, url, "stage_t", connections=2)
    whole = read_jdbc(spark, url, "stage_t")
    split = read_jdbc(spark, url, "stage_t", partition_column="k", partitions=4)
    assert bag(whole) == bag(split) == bag(df.union(df))
    assert split.rdd.getNumPartitions() == 4
    append_jdbc(df.where("k = 3"), url, "one")
    assert bag(read_jdbc(spark, url, "one", partition_column="k")) == [(3, "n3")]


def test_scratch_uses_the_session_setting(spark):
    assert scratch_root(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")
    df = spark.range(5)
    assert bag(materialize(df, "five")) == bag(df)


@pytest.fixture
def wh(spark, tmp_path):
    specs = {
        "t": TableSpec("t", struct(k=LONG, v=STRING), keys=("k",), dist_key="k"),
        "u": TableSpec("u", struct(k=LONG), keys=("k",), sort_by="k"),
    }
    return Warehouse(spark, str(tmp_path / "wh"), specs)


def test_create_read_publish(spark, wh):
    with pytest.raises(KeyError):
        wh.read("t")
    assert sorted(wh.create_if_absent()) == ["t", "u"]
    assert wh.create_if_absent() == []
    assert wh.read("t").schema == wh.specs["t"].schema and wh.read("t").isEmpty()
    df = spark.createDataFrame([(1, "a"), (2, "b")], wh.specs["t"].schema)
    wh.publish({"t": df, "u": df.select("k")})
    assert bag(wh.read("t")) == bag(df) and bag(wh.read("u")) == [(1,), (2,)]
    before = wh.snapshot()
    source = spark.createDataFrame([(2, "B"), (3, "c")], df.schema)
    wh.publish({"t": upsert(wh.read("t"), source, ["k"])})
    assert bag(wh.read("t")) == [(1, "a"), (2, "B"), (3, "c")]
    assert bag(wh.read("t", before)) == bag(df)
    assert bag(wh.stale_paths()) == [(before["t"].paths[0],)]


def test_append_leaves_stored_files(spark, wh):
    wh.publish({"t": spark.createDataFrame([(1, "a")], "k long, v string")})
    first = wh.snapshot()["t"].paths
    wh.publish(append={"t": spark.createDataFrame([("b", 2)], "v string, k int")})
    assert wh.snapshot()["t"].paths[:1] == first
    assert bag(wh.read("t")) == [(1, "a"), (2, "b")]


def test_stage_append_and_consume(spark, wh):
    batch = spark.createDataFrame([(1, "a")], "k long, v string")
    wh.stage("stage_t", batch)
    wh.stage("stage_t", batch)
    assert wh.read("stage_t").count() == 2
    wh.drop("stage_t")
    assert not wh.exists("stage_t")
    with pytest.raises(KeyError):
        wh.drop("stage_t")
    wh.drop("stage_t", if_exists=True)
    with pytest.raises(KeyError):
        wh.publish({"t": batch}, consume=["stage_t"])
    assert not wh.exists("t")
    wh.stage("stage_t", batch)  # a new stage starts empty
    assert wh.read("stage_t").count() == 1


def test_staged_files_are_not_copied(spark, wh, tmp_path):
    df = spark.createDataFrame([(1, "a")], "k long, v string")
    write_parquet(df, str(tmp_path / "clean"))
    wh.stage_files({"stage_t": (str(tmp_path / "clean"), df.schema)})
    assert wh.snapshot()["stage_t"].paths == (str(tmp_path / "clean"),)
    assert bag(wh.read("stage_t")) == [(1, "a")]


@pytest.mark.parametrize("how", ["replace", "append"])
def test_the_later_of_two_publishes_changes_nothing(spark, wh, how):
    first, won, lost = (spark.createDataFrame([(i, x)], "k long, v string") for i, x in enumerate("abc"))
    wh.publish({"t": first, "u": first})
    stale = wh.snapshot()
    wh.publish(**{how: {"t": won}})
    before = wh.snapshot()
    with pytest.raises(PublishConflict, match="'t'"):  # told before anything counts
        wh.publish(**{how: {"t": lost}}, state=stale)
    assert wh.snapshot() == before
    assert bag(wh.read("t")) == (bag(won) if how == "replace" else [(0, "a"), (1, "b")])
    wh.publish(append={"u": won}, state=stale)  # another table is not concerned
    assert bag(wh.read("u")) == [(0, "a"), (1, "b")]
    assert wh.stale_paths().count() == (how == "replace")  # the loser's folder is gone


def test_tables_for_joining(spark, wh):
    df = spark.range(50).select(F.col("id").alias("k"), F.lit("x").alias("v"))
    wh.publish({"t": df, "u": df.select("k")})
    joined = spark.range(5).toDF("k").join(wh.dimension("u"), "k")
    assert "strategy=broadcast" in joined._jdf.queryExecution().logical().toString()
    assert "strategy=broadcast" not in wh.dimension("t")._jdf.queryExecution().logical().toString()
    try:
        wh.export_bucketed("t", "wh_t", 2)
        assert bag(spark.table("wh_t")) == bag(df)
    finally:
        spark.sql("DROP TABLE IF EXISTS wh_t")

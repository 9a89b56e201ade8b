"""Loads that fail half-way and are called again; batches that arrive once; cells that do not parse."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from starmart.plans import load
from starmart.plans.load import CLEAN_NAMES, STAGES, UnfinishedLoad, clean_path, run_all, run_cleaning
from starmart.schemas import DATE, INT, STRING, struct
from starmart.scratch import scratch_root
from starmart.sources.delimited import RECORD, read_csv_checked, rejected_cells
from starmart.sources.jdbc import append_jdbc_once, read_jdbc

DATA = Path(__file__).parent / "data"


def bag(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def kill(monkeypatch, job, tables=0):
    """Let one job die, after it has written some of its tables."""
    real = load.run_job

    def run(spark, name, *args, **options):
        if name == job:
            for table in load.JOBS[name].tables[:tables]:
                spark.range(3).write.parquet(clean_path(args[1], table))
            raise RuntimeError("lost the driver")
        done.append(name)
        return real(spark, name, *args, **options)

    done = []
    monkeypatch.setattr(load, "run_job", run)
    return done


@pytest.mark.parametrize("tables", [0, 1, 2])
def test_a_failed_load_goes_on_where_it_stopped(spark, tmp_path, monkeypatch, tables):
    expected = run_all(spark, str(DATA), str(tmp_path / "o1"), str(tmp_path / "w1"), on_violation="drop")
    out, root = str(tmp_path / "o2"), str(tmp_path / "w2")
    with monkeypatch.context() as m:
        kill(m, "genre", tables)
        with pytest.raises(RuntimeError, match="lost"):
            run_all(spark, str(DATA), out, root, on_violation="drop")
    with pytest.raises(UnfinishedLoad, match="other arguments"):
        run_all(spark, str(DATA), out, root, required="all")
    with monkeypatch.context() as m:
        again = kill(m, None)
        warehouse = run_all(spark, str(DATA), out, root, on_violation="drop")
        assert again == ["genre"]  # the others had finished
    for table in CLEAN_NAMES:
        assert bag(warehouse.read(table)) == bag(expected.read(table))
    assert not any(warehouse.exists(s) for s in STAGES.values())
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):  # a finished one is not loaded twice
        run_all(spark, str(DATA), out, root, on_violation="drop")


def test_outputs_of_others_are_not_touched(spark, tmp_path):
    path = clean_path(str(tmp_path), "date")
    spark.range(3).write.parquet(path)
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        run_cleaning(spark, str(DATA), str(tmp_path))
    assert spark.read.parquet(path).count() == 3


def test_a_load_leaves_no_scratch(spark, tmp_path):
    top = Path(scratch_root(spark).removeprefix("file://"))
    before = {p for p in top.glob("starmart/*/*")}
    run_all(spark, str(DATA), str(tmp_path / "o"), str(tmp_path / "w"), on_violation="drop")
    run_all(spark, str(DATA), str(tmp_path / "o2"), str(tmp_path / "w"), on_violation="drop")
    assert {p for p in top.glob("starmart/*/*")} == before


def test_a_load_reads_each_stage_once(spark, tmp_path, monkeypatch):
    reads = []
    real = load.Warehouse.read

    def read(self, name, *args, **options):
        reads.append(name)
        return real(self, name, *args, **options)

    monkeypatch.setattr(load.Warehouse, "read", read)
    warehouse = run_all(spark, str(DATA), str(tmp_path / "o"), str(tmp_path / "w"), on_violation="drop", database="load_test")
    assert sorted(r for r in reads if r.startswith("stage_")) == sorted(STAGES.values())
    assert bag(spark.table("load_test.ratings")) == bag(warehouse.read("ratings"))
    spark.sql("DROP DATABASE load_test CASCADE")


def test_a_load_keeps_what_did_not_parse(spark, tmp_path):
    from starmart.__main__ import main

    plain = run_all(spark, str(DATA), str(tmp_path / "o1"), str(tmp_path / "w1"), on_violation="drop")
    main(["all", "--input", str(DATA), "--output", str(tmp_path / "o2"), "--warehouse", str(tmp_path / "w2"), "--on-violation", "drop", "--rejects"])
    for table in CLEAN_NAMES:
        assert bag(load.Warehouse(spark, str(tmp_path / "w2")).read(table)) == bag(plain.read(table))
    cells = spark.read.parquet(str(tmp_path / "o2" / "_rejected" / "movies.parquet"))
    assert cells.columns == ["id", "column", "value", "record"] and cells.where("column = 'id'").count() > 0
    assert cells.where("value IS NULL AND column IS NOT NULL").isEmpty()
    spark.read.parquet(str(tmp_path / "o2" / "_rejected" / "ratings.parquet")).count()
    main(["vacuum", "--warehouse", str(tmp_path / "w2"), "--hours", "100"])


def test_a_batch_arrives_once(spark):
    url = "jdbc:derby:memory:once;create=true"
    df = spark.range(50).select(F.col("id").alias("K"), F.concat(F.lit("n"), "id").alias("V"))
    assert append_jdbc_once(df, url, "stage_t", "monday", connections=3)
    assert not append_jdbc_once(df, url, "stage_t", "monday", connections=3)  # the retry
    assert bag(read_jdbc(spark, url, "stage_t")) == bag(df)
    assert append_jdbc_once(df, url, "stage_t", "tuesday", connections=3)
    assert bag(read_jdbc(spark, url, "stage_t")) == bag(df.union(df))
    assert append_jdbc_once(df.limit(0), url, "stage_t", "wednesday")
    assert read_jdbc(spark, url, "stage_t").count() == 100


def test_a_batch_whose_move_fails_leaves_nothing(spark):
    url = "jdbc:derby:memory:undone;create=true"
    df = spark.range(5).select(F.col("id").alias("K"))
    append_jdbc_once(df, url, "t", "first")
    wrong = df.withColumn("MORE", F.lit(1))
    with pytest.raises(Exception, match="MORE"):
        append_jdbc_once(wrong, url, "t", "second")
    assert append_jdbc_once(df, url, "t", "second")  # it was not entered
    assert read_jdbc(spark, url, "t").count() == 10


def test_rejected_cells(spark, tmp_path):
    (tmp_path / "f.csv").write_text('k,d,t\n1,1995-10-30,a\nx,1996-01-01,"b, ""c"""\n3,never,\n,,\ny,z,"two\nlines"\n4,1997-01-01\n')
    schema = struct(k=INT, d=DATE, t=STRING)
    checked = read_csv_checked(spark, str(tmp_path / "f.csv"), schema)
    assert checked.columns == ["k", "d", "t", RECORD]
    assert sum(r[RECORD] is None for r in checked.collect()) == 2
    found = bag(rejected_cells(checked, schema, keep=["t"]).drop("record"))
    assert found == sorted([('b, "c"', "k", "x"), (None, "d", "never"), ("two\nlines", "k", "y"), ("two\nlines", "d", "z"), (None, None, None)], key=repr)
    assert rejected_cells(checked, schema).columns == ["column", "value", "record"]
    with pytest.raises(ValueError, match="dialect"):
        read_csv_checked(spark, str(tmp_path / "f.csv"), schema, "rfc4180_split")

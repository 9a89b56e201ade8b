import datetime as dt
import math
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.functions.calendar import calendar_dim
from starmart.functions.casts import rating_value, try_cast, try_cast_columns
from starmart.functions.nulls import drop_nulls
from starmart.functions.records import explode_records, parse_records
from starmart.operators.distinct import distinct_rows
from starmart.operators.project import align_to_schema, derive, project
from starmart.schemas import GENRE_JSON, MOVIES_CSV, RATINGS_CSV, warehouse_specs


def bag(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_source_schemas():
    assert len(MOVIES_CSV) == 24
    assert RATINGS_CSV.names == ["userId", "movieId", "rating", "timestamp"]
    assert MOVIES_CSV["belongs_to_collection"].dataType == T.LongType()
    specs = warehouse_specs(T.DecimalType(18, 0))
    assert specs["ratings"].schema["rating"].dataType == T.DecimalType(18, 0)
    assert specs["ratings"].stage_schema.names == ["user_id", "movie_id", "rating"]
    assert specs["movies"].set_cols == specs["movies"].schema.names[1:]
    assert specs["budgetrevenue"].keys == ()


@pytest.mark.parametrize("subset", [None, ["a"], ["a", "c"], ["b"]])
def test_drop_nulls_equals_na_drop(spark, subset):
    rng = random.Random(7)
    values = [
        (
            rng.choice([None, "x", ""]),
            rng.choice([None, 1, 2]),
            rng.choice([None, math.nan, 0.5]),
            rng.choice([None, math.nan, -1.0]),
        )
        for _ in range(60)
    ]
    df = spark.createDataFrame(values, "a string, b int, c double, d float")
    # NaN differs from itself, so compare the printed rows.
    assert repr(bag(drop_nulls(df, subset))) == repr(bag(df.na.drop(subset=subset)))


def test_drop_nulls_reaches_the_scan(spark, tmp_path, capsys):
    spark.createDataFrame([("x", 1)], "a string, b int").write.parquet(str(tmp_path / "p"))
    drop_nulls(spark.read.parquet(str(tmp_path / "p")), ["a"]).select("b").explain()
    plan = capsys.readouterr().out
    assert "PushedFilters: [IsNotNull(a)]" in plan


def test_casts(spark):
    df = spark.createDataFrame([("7", "2020-02-30"), ("x", "2020-02-29"), (None, None)], "a string, b string")
    out = try_cast_columns(df, {"a": "int"}).withColumn("b", try_cast(F.col("b"), "date"))
    assert bag(out) == bag(
        spark.createDataFrame([(7, None), (None, dt.date(2020, 2, 29)), (None, None)], "a int, b date")
    )


def test_integer_text_equals_plain_try_cast(spark):
    texts = ["1", " 7 ", "+3", "-4", "--1", "1-2", "", " ", "99999999999", "1.0", "1e3", "\t5\n", "٣", "x", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for kind in ("tinyint", "smallint", "int", "bigint"):
        ours = df.select(try_cast(F.col("t"), kind)).collect()
        assert ours == df.select(F.col("t").try_cast(kind)).collect()


def test_rating_value(spark):
    df = spark.createDataFrame([(3.5,), (4.5,), (0.5,), (None,)], "r double")
    assert [r[0] for r in df.select(rating_value(F.col("r"))).collect()] == [
        Decimal("3.5"), Decimal("4.5"), Decimal("0.5"), None,
    ]
    whole = df.select(rating_value(F.col("r"), T.DecimalType(18, 0))).collect()
    assert [r[0] for r in whole] == [4, 5, 1, None]


def test_json_records(spark):
    df = spark.createDataFrame(
        [
            (1, "[{'id': 16, 'name': 'A'}, {'id': 35, 'name': 'B'}]"),
            (2, '[{"id": 12, "name": "C"}]'),
            (3, "[]"),
            (4, "not json"),
            (5, None),
            (6, "[{'id': 'x', 'name': 'Bad'}, {'name': 'NoId'}]"),
        ],
        "k int, j string",
    )
    out = explode_records(df, "j", {"gid": "id", "gname": "name"}).drop("j")
    assert bag(out) == sorted(
        [(1, 16, "A"), (1, 35, "B"), (2, 12, "C"), (6, None, "Bad"), (6, None, "NoId")], key=repr
    )
    parsed = {r.k: r.p for r in df.select("k", parse_records(F.col("j"), GENRE_JSON).alias("p")).collect()}
    assert parsed[4] is None and parsed[5] is None and parsed[3] == []


def test_calendar(spark):
    days = [(dt.date(1996, 12, 30),), (dt.date(1995, 1, 1),), (dt.date(1995, 1, 1),), (None,)]
    df = spark.createDataFrame(days, "d date")
    assert bag(calendar_dim(df, "d")) == sorted(
        [
            (dt.date(1995, 1, 1), 1, 52, 1, 1, 1995),
            (dt.date(1996, 12, 30), 30, 1, 12, 4, 1996),
            (None,) * 6,
        ],
        key=repr,
    )


def test_projection(spark):
    df = spark.createDataFrame([(1, "a", 2.0)], "id int, name string, x double")
    assert project(df, ["name", "id"], {"id": "movie_id"}).columns == ["name", "movie_id"]
    out = derive(df, {"id": F.col("id") + 1, "old": F.col("id")})
    assert out.columns == ["id", "name", "x", "old"] and tuple(out.first()) == (2, "a", 2.0, 1)


def test_align_to_schema(spark):
    df = spark.createDataFrame([("5", 1, 9)], "b string, a int, extra int")
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.IntegerType())])
    out = align_to_schema(df, schema)
    assert out.schema == schema and tuple(out.first()) == (1, 5)
    with pytest.raises(ValueError, match="missing"):
        align_to_schema(df.drop("a"), schema)


def test_distinct_rows(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, None), (None, None), (None, None)], "x int, y string")
    assert bag(distinct_rows(df)) == sorted([(1, "a"), (1, None), (None, None)], key=repr)
    assert bag(distinct_rows(df, ["x", "y"], require=["y"])) == [(1, "a")]
    assert bag(distinct_rows(df, ["x"], require=["x"])) == [(1,)]

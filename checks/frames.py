"""Shared inputs of the queries, each as a Spark frame and as SQL over the same tables.

The merge pairs are whole tables against each other: the order lines of ``lineitem``
as target and the header line (line 1) of every order in ``orders`` as source.  Some
header lines exist as order lines, some do not, and most order lines are no header
lines, so every branch of a merge has rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# -- one key: k = ten times the order number plus the line number ---------------------

LINES_SQL = """
    SELECT l_orderkey * 10 + l_linenumber AS k, max(l_extendedprice) AS v, min(l_returnflag) AS p
    FROM lineitem GROUP BY 1"""

HEADERS_SQL = """
    SELECT o_orderkey * 10 + 1 AS k,
           CASE WHEN o_orderstatus <> 'P' THEN o_totalprice + 1 END AS v,
           o_orderpriority AS p
    FROM orders"""


def lines(spark: SparkSession, sf: str) -> DataFrame:
    return (
        table(spark, sf, "lineitem")
        .groupBy((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("k"))
        .agg(F.max("l_extendedprice").alias("v"), F.min("l_returnflag").alias("p"))
    )


def headers(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(
        (F.col("o_orderkey") * 10 + 1).alias("k"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice") + 1).alias("v"),
        F.col("o_orderpriority").alias("p"),
    )


# -- two keys, one of them NULL for orders that are still pending ---------------------

LINES2_SQL = """
    SELECT l_orderkey AS a, l_linenumber AS b, max(l_extendedprice) AS v
    FROM lineitem GROUP BY 1, 2"""

HEADERS2_SQL = """
    SELECT o_orderkey AS a, CAST(CASE WHEN o_orderstatus <> 'P' THEN 1 END AS INTEGER) AS b,
           o_totalprice AS v
    FROM orders"""


def lines2(spark: SparkSession, sf: str) -> DataFrame:
    return (
        table(spark, sf, "lineitem")
        .groupBy(F.col("l_orderkey").alias("a"), F.col("l_linenumber").alias("b"))
        .agg(F.max("l_extendedprice").alias("v"))
    )


def headers2(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("a"),
        F.when(F.col("o_orderstatus") != "P", F.lit(1)).alias("b"),
        F.col("o_totalprice").alias("v"),
    )


# -- one row per user and event type: the value of the earliest event ------------------

FIRST_EVENTS_SQL = """
    SELECT user_id, event_type, arg_min(value, event_id) AS v
    FROM events GROUP BY 1, 2"""


def first_events(spark: SparkSession, sf: str) -> DataFrame:
    return (
        table(spark, sf, "events")
        .groupBy("user_id", "event_type")
        .agg(F.min_by("value", "event_id").alias("v"))
    )


# -- JSON text -------------------------------------------------------------------------

RECORDS_SQL = """
    SELECT p_partkey,
           '[{"id": ' || p_size || ', "name": "' || p_type || '"}, {"id": ' || (p_size + 1)
           || ', "name": "' || p_brand || '"}]' AS j
    FROM part"""

RECORD_TYPE = '[{"id":"INTEGER","name":"VARCHAR"}]'


def records(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select(
        "p_partkey",
        F.concat(
            F.lit('[{"id": '),
            F.col("p_size"),
            F.lit(', "name": "'),
            F.col("p_type"),
            F.lit('"}, {"id": '),
            F.col("p_size") + 1,
            F.lit(', "name": "'),
            F.col("p_brand"),
            F.lit('"}]'),
        ).alias("j"),
    )


# Genre lists in which an id always has the same name.
GENRES_SQL = """
    SELECT p_partkey AS id,
           '[{"id": ' || p_size || ', "name": "size ' || p_size || '"}, {"id": '
           || CASE p_type WHEN 'ECONOMY' THEN 1001 WHEN 'MEDIUM' THEN 1002
                          WHEN 'PROMO' THEN 1003 WHEN 'LARGE' THEN 1004
                          WHEN 'STANDARD' THEN 1005 ELSE 1006 END
           || ', "name": "' || CASE WHEN p_type IN ('ECONOMY', 'MEDIUM', 'PROMO', 'LARGE', 'STANDARD')
                               THEN p_type ELSE 'OTHER' END || '"}]' AS genres
    FROM part"""

_TYPES = {"ECONOMY": 1001, "MEDIUM": 1002, "PROMO": 1003, "LARGE": 1004, "STANDARD": 1005}


def genre_source(spark: SparkSession, sf: str) -> DataFrame:
    kind, number = F.lit("OTHER"), F.lit(1006)
    for name, value in _TYPES.items():
        number = F.when(F.col("p_type") == name, F.lit(value)).otherwise(number)
        kind = F.when(F.col("p_type") == name, F.lit(name)).otherwise(kind)
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("id"),
        F.concat(
            F.lit('[{"id": '),
            F.col("p_size"),
            F.lit(', "name": "size '),
            F.col("p_size"),
            F.lit('"}, {"id": '),
            number,
            F.lit(', "name": "'),
            kind,
            F.lit('"}]'),
        ).alias("genres"),
    )


# -- orders with gaps: NULL status and priority, NaN price -----------------------------

GAPS_SQL = """
    SELECT o_orderkey, nullif(o_orderstatus, 'P') AS status,
           CASE WHEN o_orderpriority = '5-LOW' THEN CAST('NaN' AS DOUBLE) ELSE o_totalprice END
             AS price,
           nullif(o_orderpriority, '1-URGENT') AS priority
    FROM orders"""


def gaps(spark: SparkSession, sf: str) -> DataFrame:
    low = F.col("o_orderpriority") == "5-LOW"
    return table(spark, sf, "orders").select(
        "o_orderkey",
        F.nullif("o_orderstatus", F.lit("P")).alias("status"),
        F.when(low, F.lit(float("nan"))).otherwise(F.col("o_totalprice")).alias("price"),
        F.nullif("o_orderpriority", F.lit("1-URGENT")).alias("priority"),
    )


# -- orders in the shape of the movie source -------------------------------------------

MOVIES_SQL = """
    SELECT o_orderkey AS id,
           CASE WHEN o_orderstatus = 'F' THEN 'True' ELSE 'False' END AS adult,
           CAST(round(o_totalprice * 100) AS BIGINT) AS budget,
           CASE WHEN o_orderstatus = 'O' THEN 'en' ELSE 'fr' END AS original_language,
           nullif(o_orderpriority, '3-MEDIUM') AS title,
           o_totalprice AS popularity,
           CAST(o_orderdate AS DATE) AS release_date,
           CAST(round(o_totalprice * 100) * 2 AS BIGINT) AS revenue,
           o_custkey AS vote_count,
           CASE WHEN o_orderpriority = '5-LOW' THEN CAST('NaN' AS DOUBLE)
                ELSE CAST(length(o_orderpriority) AS DOUBLE) END AS vote_average
    FROM orders"""


def movie_source(spark: SparkSession, sf: str, *more: Column) -> DataFrame:
    cents = F.round(F.col("o_totalprice") * 100)
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.when(F.col("o_orderstatus") == "F", F.lit("True")).otherwise(F.lit("False")).alias("adult"),
        cents.cast("long").alias("budget"),
        F.when(F.col("o_orderstatus") == "O", F.lit("en")).otherwise(F.lit("fr")).alias("original_language"),
        F.nullif("o_orderpriority", F.lit("3-MEDIUM")).alias("title"),
        F.col("o_totalprice").alias("popularity"),
        F.to_date("o_orderdate").alias("release_date"),
        (cents * 2).cast("long").alias("revenue"),
        F.col("o_custkey").alias("vote_count"),
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit(float("nan")))
        .otherwise(F.char_length("o_orderpriority").cast("double"))
        .alias("vote_average"),
        *more,
    )

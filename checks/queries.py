"""One query per operator and job, registered with its SQL twin."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.frames import (
    FIRST_EVENTS_SQL,
    GAPS_SQL,
    GENRES_SQL,
    HEADERS2_SQL,
    HEADERS_SQL,
    LINES2_SQL,
    LINES_SQL,
    MOVIES_SQL,
    RECORD_TYPE,
    RECORDS_SQL,
    first_events,
    gaps,
    genre_source,
    headers,
    headers2,
    lines,
    lines2,
    movie_source,
    records,
    table,
)
from starmart.functions.calendar import calendar_dim
from starmart.functions.casts import rating_value, try_cast, try_cast_columns
from starmart.functions.nulls import drop_nulls
from starmart.functions.records import explode_records, parse_records
from starmart.operators.distinct import distinct_rows
from starmart.operators.keys import assign_surrogate_key, next_key
from starmart.operators.layout import replicated, write_bucketed, write_sorted
from starmart.operators.merge import (
    append_all,
    duplicate_keys,
    insert_new,
    insert_only_new,
    update_from,
    upsert,
)
from starmart.operators.project import align_to_schema, derive, project
from starmart.operators.quality import breaking_rows, violations
from starmart.plans import budgets, dates, genres, movies, ratings
from starmart.plans.load import run_all
from starmart.schemas import (
    DATE,
    DOUBLE,
    INT,
    LONG,
    MOVIES_CSV,
    RATINGS_CSV,
    STRING,
    TableSpec,
    struct,
)
from starmart.scratch import is_local, scratch_path
from starmart.sources.delimited import read_csv_checked, read_csv_typed, rejected_cells, write_csv
from starmart.sources.jdbc import append_jdbc, append_jdbc_once, read_jdbc
from starmart.sources.parquet import append_parquet, read_parquet, write_parquet
from starmart.warehouse import Warehouse

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        ORACLES[name] = sql
        return fn

    return register


# -- scans and sinks ------------------------------------------------------------------

_ORDERS_CSV = struct(
    order_key=LONG, cust_key=LONG, status=STRING, price=DOUBLE, order_date=DATE, priority=STRING
)


def _orders_file(spark: SparkSession, sf: str) -> str:
    path = scratch_path(spark, "orders-csv")
    orders = table(spark, sf, "orders").withColumn("o_orderdate", F.to_date("o_orderdate"))
    write_csv(orders, path)
    return path


@query(
    "csv_scan_typed",
    """SELECT o_orderkey AS order_key, o_custkey AS cust_key, o_orderstatus AS status,
              o_totalprice AS price, CAST(o_orderdate AS DATE) AS order_date,
              o_orderpriority AS priority FROM orders""",
)
def csv_scan_typed(spark, sf):
    return read_csv_typed(spark, _orders_file(spark, sf), _ORDERS_CSV, "lines")


@query(
    "csv_scan_permissive",
    """SELECT o_orderkey AS order_key, TRY_CAST(o_orderstatus AS INTEGER) AS status,
              o_totalprice AS price, TRY_CAST(o_orderpriority AS INTEGER) AS priority FROM orders""",
)
def csv_scan_permissive(spark, sf):
    fields = [
        T.StructField(f.name, INT) if f.name in ("status", "priority") else f
        for f in _ORDERS_CSV.fields
    ]
    scan = read_csv_typed(spark, _orders_file(spark, sf), T.StructType(fields), "lines")
    return scan.select("order_key", "status", "price", "priority")


@query(
    "csv_rejected_cells",
    """SELECT o_orderkey AS order_key, 'status' AS "column", o_orderstatus AS value FROM orders
       WHERE TRY_CAST(o_orderstatus AS INTEGER) IS NULL
       UNION ALL SELECT o_orderkey, 'priority', o_orderpriority FROM orders
       WHERE TRY_CAST(o_orderpriority AS DATE) IS NULL""",
)
def csv_rejected_cells(spark, sf):
    """The cells that the typed scan turned to NULL, with their text."""
    kinds = {"status": INT, "priority": DATE}
    schema = T.StructType([T.StructField(f.name, kinds.get(f.name, f.dataType)) for f in _ORDERS_CSV.fields])
    checked = read_csv_checked(spark, _orders_file(spark, sf), schema, "lines")
    return rejected_cells(checked, schema, "lines", keep=["order_key"]).drop("record")


@query("csv_scan_multiline", "SELECT doc_id, text, source, n_chars FROM documents")
def csv_scan_multiline(spark, sf):
    # Prose with commas, quotes and line breaks, one file per writing task.
    path = scratch_path(spark, "documents-csv")
    docs = table(spark, sf, "documents").select("doc_id", "text", "source", "n_chars")
    write_csv(docs, path)
    return read_csv_typed(spark, path, docs.schema, "rfc4180")


@query("csv_scan_split", "SELECT doc_id, text, source, n_chars FROM documents")
def csv_scan_split(spark, sf):
    # The same scan by many tasks per file.
    path = scratch_path(spark, "documents-csv")
    docs = table(spark, sf, "documents").select("doc_id", "text", "source", "n_chars")
    write_csv(docs, path)
    return read_csv_typed(spark, path, docs.schema, "rfc4180_split")


@query(
    "try_cast_null",
    """SELECT o_orderkey, TRY_CAST(o_orderpriority AS INTEGER) AS as_int,
              TRY_CAST(CAST(o_custkey AS VARCHAR) AS INTEGER) AS cust,
              TRY_CAST(o_orderstatus AS DATE) AS as_date FROM orders""",
)
def try_cast_null(spark, sf):
    text = table(spark, sf, "orders").select(
        "o_orderkey",
        F.col("o_orderpriority").alias("as_int"),
        F.col("o_custkey").cast("string").alias("cust"),
        try_cast(F.col("o_orderstatus"), "date").alias("as_date"),
    )
    return try_cast_columns(text, {"as_int": "int", "cust": "int"})


@query("stage_scan", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def stage_scan(spark, sf):
    warehouse = Warehouse(spark, scratch_path(spark, "stage"), {})
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    warehouse.stage("stage_orders", orders)
    return warehouse.read("stage_orders")


@query(
    "parquet_roundtrip",
    "SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag FROM lineitem",
)
def parquet_roundtrip(spark, sf):
    path = scratch_path(spark, "lineitem")
    write_parquet(table(spark, sf, "lineitem"), path)
    return read_parquet(spark, path).select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag")


def _test_database(spark: SparkSession) -> str:
    """JDBC URL from ``spark.starmart.test.jdbcUrl``; a local session may use the
    database library embedded in its own process."""
    url = spark.conf.get("spark.starmart.test.jdbcUrl", None)
    if url is None:
        if not is_local(spark):
            raise ValueError("spark.starmart.test.jdbcUrl must name a database all executors reach")
        name = scratch_path(spark, "db").rsplit("/", 1)[1].replace("-", "")
        url = f"jdbc:derby:memory:{name};create=true"
    return url


@query(
    "jdbc_append_roundtrip",
    "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer",
)
def jdbc_append_roundtrip(spark, sf):
    url, name = _test_database(spark), "stage_" + scratch_path(spark, "c").rsplit("-", 1)[1]
    customer = table(spark, sf, "customer")
    append_jdbc(customer, url, name, connections=8)
    back = read_jdbc(spark, url, name, partition_column="c_custkey", partitions=8)
    return align_to_schema(back, customer.schema)


@query(
    "jdbc_append_once",
    """SELECT s_suppkey, s_name, s_nationkey FROM supplier
       UNION ALL SELECT s_suppkey, s_name, s_nationkey FROM supplier WHERE s_nationkey < 10""",
)
def jdbc_append_once(spark, sf):
    """Two batches, the first of them tried twice."""
    url, name = _test_database(spark), "stage_" + scratch_path(spark, "s").rsplit("-", 1)[1]
    supplier = table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    for batch, rows in (("one", supplier), ("one", supplier), ("two", supplier.where("s_nationkey < 10"))):
        append_jdbc_once(rows, url, name, batch, connections=4)
    return align_to_schema(read_jdbc(spark, url, name), supplier.schema)


@query("append_twice", f"SELECT * FROM ({HEADERS_SQL}) UNION ALL SELECT * FROM ({HEADERS_SQL})")
def append_twice(spark, sf):
    path = scratch_path(spark, "append")
    source = headers(spark, sf)
    append_parquet(source, path)
    append_parquet(source, path)
    return read_parquet(spark, path, schema=source.schema)


# -- projections, predicates, scalars -------------------------------------------------


@query("project_rename", "SELECT p_partkey AS movie_id, p_name AS title, p_size FROM part")
def project_rename(spark, sf):
    names = {"p_partkey": "movie_id", "p_name": "title"}
    return project(table(spark, sf, "part"), ["p_partkey", "p_name", "p_size"], names)


@query(
    "derive_columns",
    """SELECT p_partkey, p_name, p_brand, upper(p_type) AS p_type, p_size, p_retailprice,
              p_size + 1 AS next_size FROM part""",
)
def derive_columns(spark, sf):
    return derive(
        table(spark, sf, "part"),
        {"p_type": F.upper("p_type"), "next_size": F.col("p_size") + 1},
    )


@query(
    "null_drop_all",
    f"""SELECT * FROM ({GAPS_SQL}) WHERE o_orderkey IS NOT NULL AND status IS NOT NULL
        AND priority IS NOT NULL AND price IS NOT NULL AND NOT isnan(price)""",
)
def null_drop_all(spark, sf):
    return drop_nulls(gaps(spark, sf))


@query(
    "null_drop_subset",
    f"""SELECT o_orderkey, status, priority FROM ({GAPS_SQL})
        WHERE status IS NOT NULL AND price IS NOT NULL AND NOT isnan(price)""",
)
def null_drop_subset(spark, sf):
    return drop_nulls(gaps(spark, sf), ["status", "price"]).drop("price")


@query(
    "json_parse_array",
    f"""SELECT p_partkey, CAST(len(r) AS INTEGER) AS n, r[1].id AS first_id, r[1].name AS first_name
        FROM (SELECT p_partkey, from_json(j, '{RECORD_TYPE}') AS r FROM ({RECORDS_SQL}))""",
)
def json_parse_array(spark, sf):
    parsed = records(spark, sf).select("p_partkey", parse_records(F.col("j")).alias("r"))
    first = F.get("r", F.lit(0))
    return parsed.select(
        "p_partkey",
        F.size("r").alias("n"),
        first["id"].alias("first_id"),
        first["name"].alias("first_name"),
    )


_EXPLODED_SQL = f"""
    SELECT p_partkey, r.id AS id, r.name AS name
    FROM (SELECT p_partkey, unnest(from_json(j, '{RECORD_TYPE}')) AS r FROM ({RECORDS_SQL}))"""


@query("json_explode", _EXPLODED_SQL)
def json_explode(spark, sf):
    return explode_records(records(spark, sf), "j", {"id": "id", "name": "name"}).drop("j")


@query(
    "json_dim",
    f"SELECT DISTINCT id, name FROM ({_EXPLODED_SQL}) WHERE id IS NOT NULL AND name IS NOT NULL",
)
def json_dim(spark, sf):
    return distinct_rows(json_explode(spark, sf), ["id", "name"], require=["id", "name"])


@query("distinct_pairs", "SELECT DISTINCT user_id, event_type FROM events")
def distinct_pairs(spark, sf):
    return distinct_rows(table(spark, sf, "events"), ["user_id", "event_type"])


def _calendar_sql(date: str, source: str) -> str:
    return f"""
    SELECT DISTINCT d AS {date}, CAST(day(d) AS INTEGER) AS day, CAST(week(d) AS INTEGER) AS week,
           CAST(month(d) AS INTEGER) AS month, CAST(quarter(d) AS INTEGER) AS quarter,
           CAST(year(d) AS INTEGER) AS year
    FROM ({source})"""


@query("calendar_parts", _calendar_sql("d", "SELECT CAST(l_shipdate AS DATE) AS d FROM lineitem"))
def calendar_parts(spark, sf):
    return calendar_dim(table(spark, sf, "lineitem").select(F.to_date("l_shipdate").alias("d")), "d")


@query(
    "rating_numeric_cast",
    """SELECT o_orderkey, CAST(CAST(o_custkey AS DOUBLE) / 2 AS DECIMAL(18,0)) AS whole,
              CAST(CAST(o_custkey AS DOUBLE) / 2 AS DECIMAL(18,1)) AS tenths FROM orders""",
)
def rating_numeric_cast(spark, sf):
    half = F.col("o_custkey").cast("double") / 2
    return table(spark, sf, "orders").select(
        "o_orderkey",
        rating_value(half, T.DecimalType(18, 0)).alias("whole"),
        rating_value(half, T.DecimalType(18, 1)).alias("tenths"),
    )


# -- joins and merges -----------------------------------------------------------------

_T, _S = f"({LINES_SQL}) t", f"({HEADERS_SQL}) s"
_T2, _S2 = f"({LINES2_SQL}) t", f"({HEADERS2_SQL}) s"
_ON2 = "t.a = s.a AND t.b = s.b"

_UPDATE = f"""
    SELECT t.k, CASE WHEN s.k IS NOT NULL THEN s.v ELSE t.v END AS v,
           CASE WHEN s.k IS NOT NULL THEN s.p ELSE t.p END AS p
    FROM {_T} LEFT JOIN {_S} ON t.k = s.k"""
_INSERT = f"SELECT s.* FROM {_S} LEFT JOIN {_T} ON t.k = s.k WHERE t.k IS NULL"
_UPDATE2 = f"""
    SELECT t.a, t.b, CASE WHEN s.a IS NOT NULL THEN s.v ELSE t.v END AS v
    FROM {_T2} LEFT JOIN {_S2} ON {_ON2}"""
_INSERT2 = f"SELECT s.* FROM {_S2} LEFT JOIN {_T2} ON {_ON2} WHERE t.a IS NULL"
_UPSERT = f"{_UPDATE} UNION ALL {_INSERT}"


@query(
    "left_outer_join",
    f"SELECT s.k, s.v, t.v AS line_price, t.p AS flag FROM {_S} LEFT JOIN {_T} ON t.k = s.k",
)
def left_outer_join(spark, sf):
    right = lines(spark, sf).select("k", F.col("v").alias("line_price"), F.col("p").alias("flag"))
    return headers(spark, sf).drop("p").join(right, "k", "left")


@query(
    "anti_join_single",
    """SELECT o.o_orderkey, o.o_custkey FROM orders o LEFT JOIN lineitem l
       ON o.o_orderkey = l.l_orderkey WHERE l.l_orderkey IS NULL""",
)
def anti_join_single(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    seen = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return insert_new(seen, orders, ["o_orderkey"], unique=True)


@query("anti_join_composite", _INSERT2)
def anti_join_composite(spark, sf):
    return insert_new(lines2(spark, sf), headers2(spark, sf), ["a", "b"], unique=True)


@query("update_from_single", _UPDATE)
def update_from_single(spark, sf):
    return update_from(lines(spark, sf), headers(spark, sf), ["k"])


@query("update_from_composite", _UPDATE2)
def update_from_composite(spark, sf):
    return update_from(lines2(spark, sf), headers2(spark, sf), ["a", "b"])


@query(
    "update_partial",
    f"""SELECT t.k, CASE WHEN s.k IS NOT NULL THEN s.v ELSE t.v END AS v, t.p
        FROM {_T} LEFT JOIN {_S} ON t.k = s.k""",
)
def update_partial(spark, sf):
    return update_from(lines(spark, sf), headers(spark, sf), ["k"], ["v"])


@query("insert_new_single", _INSERT)
def insert_new_single(spark, sf):
    return insert_new(lines(spark, sf), headers(spark, sf), ["k"])


@query("insert_new_composite", _INSERT2)
def insert_new_composite(spark, sf):
    return insert_new(lines2(spark, sf), headers2(spark, sf), ["a", "b"])


@query("insert_new_only", f"{LINES2_SQL} UNION ALL {_INSERT2}")
def insert_new_only(spark, sf):
    return insert_only_new(lines2(spark, sf), headers2(spark, sf), ["a", "b"])


@query("upsert_single", _UPSERT)
def upsert_single(spark, sf):
    return upsert(lines(spark, sf), headers(spark, sf), ["k"])


@query("upsert_one_pass", _UPSERT)
def upsert_one_pass(spark, sf):
    return upsert(lines(spark, sf), headers(spark, sf), ["k"], one_pass=True)


@query("upsert_composite", f"{_UPDATE2} UNION ALL {_INSERT2}")
def upsert_composite(spark, sf):
    return upsert(lines2(spark, sf), headers2(spark, sf), ["a", "b"])


_PICKED = """(
    SELECT user_id, event_type, v FROM (
        SELECT l_suppkey AS user_id, l_returnflag AS event_type, l_extendedprice AS v,
               row_number() OVER (PARTITION BY l_suppkey, l_returnflag ORDER BY l_extendedprice) AS n
        FROM lineitem) WHERE n = 1) s"""


@query(
    "upsert_deduped",
    f"""SELECT t.user_id, t.event_type, CASE WHEN s.user_id IS NOT NULL THEN s.v ELSE t.v END AS v
        FROM ({FIRST_EVENTS_SQL}) t LEFT JOIN {_PICKED}
        ON t.user_id = s.user_id AND t.event_type = s.event_type
        UNION ALL
        SELECT s.* FROM {_PICKED} LEFT JOIN ({FIRST_EVENTS_SQL}) t
        ON t.user_id = s.user_id AND t.event_type = s.event_type WHERE t.user_id IS NULL""",
)
def upsert_deduped(spark, sf):
    # Few keys, many rows each: the smallest price per key is the source row.
    source = table(spark, sf, "lineitem").select(
        F.col("l_suppkey").alias("user_id"),
        F.col("l_returnflag").alias("event_type"),
        F.col("l_extendedprice").alias("v"),
    )
    return upsert(first_events(spark, sf), source, ["user_id", "event_type"], dedupe_by=["v"])


@query("append_all", f"{LINES_SQL} UNION ALL {HEADERS_SQL}")
def append_all_query(spark, sf):
    return append_all(lines(spark, sf), headers(spark, sf))


@query("align_to_schema", HEADERS_SQL)
def align(spark, sf):
    source = headers(spark, sf).select("p", F.lit(1).alias("extra"), "v", "k")
    return align_to_schema(source, lines(spark, sf).schema)


# -- publishing -----------------------------------------------------------------------


def _line_warehouse(spark: SparkSession, label: str) -> Warehouse:
    spec = TableSpec("lines", struct(k=LONG, v=DOUBLE, p=STRING), keys=("k",))
    return Warehouse(spark, scratch_path(spark, label), {"lines": spec})


@query("create_if_absent", HEADERS_SQL)
def create_if_absent(spark, sf):
    warehouse = _line_warehouse(spark, "create")
    warehouse.create_if_absent()
    warehouse.create_if_absent()
    return upsert(warehouse.read("lines"), headers(spark, sf), ["k"])


@query("stage_consume", f"SELECT *, FALSE AS stage_left FROM ({_UPSERT})")
def stage_consume(spark, sf):
    warehouse = _line_warehouse(spark, "consume")
    warehouse.publish({"lines": lines(spark, sf)})
    warehouse.stage("stage_lines", headers(spark, sf))
    merged = upsert(warehouse.read("lines"), warehouse.read("stage_lines"), ["k"])
    warehouse.publish({"lines": merged}, consume=["stage_lines"])
    warehouse.drop("stage_lines", if_exists=True)
    left = F.lit(warehouse.exists("stage_lines"))
    return warehouse.read("lines").withColumn("stage_left", left)


@query(
    "publish_roundtrip",
    f"SELECT *, 'upsert' AS part FROM ({_UPSERT}) UNION ALL SELECT *, 'source' AS part FROM ({HEADERS_SQL})",
)
def publish_roundtrip(spark, sf):
    # Two tables in one commit.
    warehouse = _line_warehouse(spark, "publish")
    warehouse.publish({"lines": lines(spark, sf)})
    merged = upsert(warehouse.read("lines"), headers(spark, sf), ["k"])
    warehouse.publish({"lines": merged, "headers": headers(spark, sf)})
    return (
        warehouse.read("lines")
        .withColumn("part", F.lit("upsert"))
        .unionByName(warehouse.read("headers").withColumn("part", F.lit("source")))
    )


@query("upsert_parts", _UPSERT)
def upsert_parts(spark, sf):
    """Stored in folders by ranges of the key and files by its hash: a merge replaces the touched
    folders and lists the others unchanged; the result is read by its name in the catalog."""
    spec = TableSpec(
        "lines", struct(k=LONG, v=DOUBLE, p=STRING), keys=("k",), part_key="k", part_bytes=1 << 18, dist_key="k", buckets=4
    )
    label = "parts_" + uuid.uuid4().hex[:12]
    warehouse = Warehouse(spark, scratch_path(spark, "parts"), {"lines": spec}, database=label)
    warehouse.publish({"lines": lines(spark, sf)})
    warehouse.relayout("lines")
    for half in ("k % 20 = 1", "k % 20 <> 1"):  # two batches, each in the parts it touches
        state, batch = warehouse.snapshot(), headers(spark, sf).where(half)
        parts = warehouse.touched("lines", batch, state)
        merged = upsert(warehouse.read("lines", state, parts), batch, ["k"])
        warehouse.publish({"lines": merged}, state=state, parts={"lines": parts} if parts else None)
    return spark.table(f"{label}.lines")


# -- surrogate keys -------------------------------------------------------------------


@query(
    "surrogate_key",
    f"""SELECT row_number() OVER (ORDER BY a, b) - 1 AS key, a, b, v FROM ({LINES2_SQL})""",
)
def surrogate_key(spark, sf):
    return assign_surrogate_key(lines2(spark, sf), ["a", "b"], "key")


_KEYED2_SQL = f"SELECT row_number() OVER (ORDER BY a, b) - 1 AS key, a, b, v FROM ({LINES2_SQL})"
# The keys of new rows continue after the last one, NULL keys first.
_NEW_KEYED2_SQL = f"""
    SELECT row_number() OVER (ORDER BY a NULLS FIRST, b NULLS FIRST) - 1
             + (SELECT count(*) FROM ({LINES2_SQL})) AS key, a, b, v
    FROM ({_INSERT2})"""


@query("surrogate_key_upsert", f"{_KEYED2_SQL} UNION ALL {_NEW_KEYED2_SQL}")
def surrogate_key_upsert(spark, sf):
    target = assign_surrogate_key(lines2(spark, sf), ["a", "b"], "key")
    fresh = insert_new(target, headers2(spark, sf), ["a", "b"])
    keyed = assign_surrogate_key(fresh, ["a", "b"], "key", start=next_key(target, "key"))
    return target.unionByName(keyed)


# -- constraints and layout -----------------------------------------------------------


@query(
    "check_not_null",
    f"""SELECT c AS "column", 'not_null' AS rule, n AS n_rows FROM (
          SELECT 'status' AS c, count(*) FILTER (status IS NULL) AS n FROM ({GAPS_SQL})
          UNION ALL SELECT 'price', count(*) FILTER (price IS NULL) FROM ({GAPS_SQL})
          UNION ALL SELECT 'priority', count(*) FILTER (priority IS NULL) FROM ({GAPS_SQL}))""",
)
def check_not_null(spark, sf):
    spec = TableSpec("gaps", T.StructType([]), not_null=("status", "price", "priority"))
    return violations(gaps(spark, sf), spec)


@query("check_length", "SELECT p_partkey, p_name FROM part WHERE length(p_name) > 8")
def check_length(spark, sf):
    spec = TableSpec("part", T.StructType([]), lengths={"p_name": 8})
    return breaking_rows(table(spark, sf, "part").select("p_partkey", "p_name"), spec)


@query(
    "check_constraints",
    """SELECT 'p_name' AS "column", 'length<=8' AS rule,
              count(*) FILTER (length(p_name) > 8) AS n_rows FROM part
       UNION ALL
       SELECT 'p_type', 'length<=5', count(*) FILTER (length(p_type) > 5) FROM part""",
)
def check_constraints(spark, sf):
    spec = TableSpec("part", T.StructType([]), lengths={"p_name": 8, "p_type": 5})
    return violations(table(spark, sf, "part"), spec)


@query(
    "check_unique_key",
    """SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem
       GROUP BY 1, 2 HAVING count(*) > 1""",
)
def check_unique_key(spark, sf):
    return duplicate_keys(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "layout_bucketed",
    f"SELECT s.k, s.v FROM {_S} LEFT JOIN {_T} ON t.k = s.k WHERE t.k IS NULL",
)
def layout_bucketed(spark, sf):
    frames = {"t": lines(spark, sf).select("k", "v"), "s": headers(spark, sf).select("k", "v")}
    names = {}
    for label, df in frames.items():
        path = scratch_path(spark, f"bucketed-{label}")
        names[label] = "starmart_" + path.rsplit("/", 1)[1].replace("-", "_")
        write_bucketed(df, names[label], path, 8, "k")
        found = {r[0]: r[1] for r in spark.sql(f"DESCRIBE EXTENDED {names[label]}").collect()}
        if found.get("Num Buckets") != "8" or found.get("Bucket Columns") != "[`k`]":
            raise ValueError(f"{names[label]} is not bucketed by k: {found}")
    return spark.table(names["s"]).join(spark.table(names["t"]), "k", "left_anti")


@query("layout_sorted", "SELECT l_shipdate, l_orderkey, l_quantity FROM lineitem")
def layout_sorted(spark, sf):
    path = scratch_path(spark, "sorted")
    rows = table(spark, sf, "lineitem").select("l_shipdate", "l_orderkey", "l_quantity")
    write_sorted(rows, path, "l_shipdate")
    return read_parquet(spark, path, schema=rows.schema)


@query(
    "layout_broadcast",
    """SELECT c_custkey, c_name, n_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""",
)
def layout_broadcast(spark, sf):
    nation = table(spark, sf, "nation").select("n_nationkey", "n_name")
    customer = table(spark, sf, "customer")
    joined = customer.join(
        replicated(nation), customer.c_nationkey == nation.n_nationkey, "left"
    )
    return joined.select("c_custkey", "c_name", "n_name")


# -- jobs -----------------------------------------------------------------------------

_CLEAN_MOVIES_SQL = f"""
    SELECT id AS movie_id, adult AS is_adult, budget, original_language, title, popularity,
           release_date, vote_count, vote_average
    FROM ({MOVIES_SQL}) WHERE title IS NOT NULL AND NOT isnan(vote_average)"""
_OLD_MOVIES_SQL = """
    SELECT l_orderkey AS movie_id, 'False' AS is_adult, 'xx' AS original_language,
           min(l_returnflag) AS title, max(l_extendedprice) AS popularity,
           CAST(min(l_shipdate) AS DATE) AS release_date, count(*) AS vote_count,
           max(l_quantity) AS vote_average
    FROM lineitem GROUP BY 1"""
_MOVIE_COLUMNS = [
    "movie_id", "is_adult", "original_language", "title",
    "popularity", "release_date", "vote_count", "vote_average",
]


def _old_movies(spark: SparkSession, sf: str) -> DataFrame:
    return (
        table(spark, sf, "lineitem")
        .groupBy(F.col("l_orderkey").alias("movie_id"))
        .agg(
            F.lit("False").alias("is_adult"),
            F.lit("xx").alias("original_language"),
            F.min("l_returnflag").alias("title"),
            F.max("l_extendedprice").alias("popularity"),
            F.to_date(F.min("l_shipdate")).alias("release_date"),
            F.count(F.lit(1)).alias("vote_count"),
            F.max("l_quantity").alias("vote_average"),
        )
    )


@query(
    "job_movies",
    "SELECT t.movie_id, "
    + ", ".join(
        f"CASE WHEN s.movie_id IS NOT NULL THEN s.{c} ELSE t.{c} END AS {c}"
        for c in _MOVIE_COLUMNS[1:]
    )
    + f""" FROM ({_OLD_MOVIES_SQL}) t LEFT JOIN ({_CLEAN_MOVIES_SQL}) s ON t.movie_id = s.movie_id
        UNION ALL
        SELECT {", ".join("s." + c for c in _MOVIE_COLUMNS)}
        FROM ({_CLEAN_MOVIES_SQL}) s LEFT JOIN ({_OLD_MOVIES_SQL}) t ON t.movie_id = s.movie_id
        WHERE t.movie_id IS NULL""",
)
def job_movies(spark, sf):
    stage = movies.clean_movies(movie_source(spark, sf))
    return movies.merge_movies(_old_movies(spark, sf), stage)


_PAIRS_SQL = f"""
    SELECT id, r.id AS genre_id, r.name AS genre_name
    FROM (SELECT id, unnest(from_json(genres, '{RECORD_TYPE}')) AS r FROM ({GENRES_SQL}))"""
_CLEAN_GENRES_SQL = f"SELECT DISTINCT genre_id, genre_name FROM ({_PAIRS_SQL})"
_OLD_GENRES_SQL = """
    SELECT DISTINCT CAST(l_quantity * 2 AS INTEGER) AS genre_id, 'unnamed' AS genre_name
    FROM lineitem"""


def _old_genres(spark: SparkSession, sf: str) -> DataFrame:
    number = (F.col("l_quantity") * 2).cast("int")
    old = table(spark, sf, "lineitem").select(number.alias("genre_id"))
    return old.distinct().withColumn("genre_name", F.lit("unnamed"))


@query(
    "job_genre",
    f"""SELECT t.genre_id, CASE WHEN s.genre_id IS NOT NULL THEN s.genre_name ELSE t.genre_name END
               AS genre_name
        FROM ({_OLD_GENRES_SQL}) t LEFT JOIN ({_CLEAN_GENRES_SQL}) s ON t.genre_id = s.genre_id
        UNION ALL
        SELECT s.* FROM ({_CLEAN_GENRES_SQL}) s LEFT JOIN ({_OLD_GENRES_SQL}) t
        ON t.genre_id = s.genre_id WHERE t.genre_id IS NULL""",
)
def job_genre(spark, sf):
    listed = genres.movie_genre_records(genre_source(spark, sf))
    return genres.merge_genres(_old_genres(spark, sf), genres.clean_genres(listed))


_OLD_PAIRS_SQL = """
    SELECT DISTINCT l_partkey AS movie_id, CAST(l_quantity AS INTEGER) AS genre_id FROM lineitem"""


@query(
    "job_movie_genre",
    f"""{_OLD_PAIRS_SQL} UNION ALL
        SELECT s.movie_id, s.genre_id
        FROM (SELECT DISTINCT id AS movie_id, genre_id FROM ({_PAIRS_SQL})) s
        LEFT JOIN ({_OLD_PAIRS_SQL}) t ON t.movie_id = s.movie_id AND t.genre_id = s.genre_id
        WHERE t.movie_id IS NULL""",
)
def job_movie_genre(spark, sf):
    old = table(spark, sf, "lineitem").select(
        F.col("l_partkey").alias("movie_id"), F.col("l_quantity").cast("int").alias("genre_id")
    )
    listed = genres.movie_genre_records(genre_source(spark, sf))
    # Both sides are distinct pairs by construction.
    return genres.merge_movie_genres(
        old.distinct(), genres.clean_movie_genres(listed), unique=True
    )


_OLD_DATES_SQL = """
    SELECT DISTINCT CAST(l_shipdate AS DATE) AS release_date, -1 AS day, -1 AS week, -1 AS month,
           -1 AS quarter, -1 AS year FROM lineitem"""
_NEW_DATES_SQL = _calendar_sql("release_date", "SELECT CAST(o_orderdate AS DATE) AS d FROM orders")
_DATE_PARTS = ["day", "week", "month", "quarter", "year"]


@query(
    "job_date",
    "SELECT t.release_date, "
    + ", ".join(
        f"CASE WHEN s.release_date IS NOT NULL THEN s.{c} ELSE t.{c} END AS {c}" for c in _DATE_PARTS
    )
    + f""" FROM ({_OLD_DATES_SQL}) t LEFT JOIN ({_NEW_DATES_SQL}) s
        ON t.release_date = s.release_date
        UNION ALL
        SELECT s.* FROM ({_NEW_DATES_SQL}) s LEFT JOIN ({_OLD_DATES_SQL}) t
        ON t.release_date = s.release_date WHERE t.release_date IS NULL""",
)
def job_date(spark, sf):
    """Clean, stage, merge and publish the calendar; read it back from the warehouse."""
    old = table(spark, sf, "lineitem").select(F.to_date("l_shipdate").alias("release_date"))
    old = old.distinct().withColumns({c: F.lit(-1) for c in _DATE_PARTS})
    warehouse = Warehouse(spark, scratch_path(spark, "dates"))
    warehouse.publish({"date": old})
    warehouse.stage("stage_date", dates.clean_dates(movie_source(spark, sf)))
    merged = dates.merge_dates(warehouse.read("date"), warehouse.read("stage_date"))
    warehouse.publish({"date": merged}, consume=["stage_date"])
    return warehouse.read("date")


_RATING = """CAST(CASE o_orderpriority WHEN '1-URGENT' THEN 4.5 WHEN '2-HIGH' THEN 4.0
             WHEN '3-MEDIUM' THEN 3.5 WHEN '4-NOT SPECIFIED' THEN 1.0 ELSE 0.5 END AS DOUBLE)"""
_STAGE_RATINGS_SQL = f"""
    SELECT o_orderkey AS user_id, 1 AS movie_id, CAST({_RATING} AS DECIMAL(3,1)) AS rating FROM orders"""
_OLD_RATINGS_SQL = """
    SELECT row_number() OVER (ORDER BY user_id, movie_id) - 1 AS user_movie_id, *
    FROM (SELECT l_orderkey AS user_id, l_linenumber AS movie_id,
                 CAST(max(l_quantity) AS DECIMAL(3,1)) AS rating FROM lineitem GROUP BY 1, 2)"""


def _rating_source(spark: SparkSession, sf: str) -> DataFrame:
    stars = F.lit(0.5)
    for code, value in {
        "1-URGENT": 4.5,
        "2-HIGH": 4.0,
        "3-MEDIUM": 3.5,
        "4-NOT SPECIFIED": 1.0,
    }.items():
        stars = F.when(F.col("o_orderpriority") == code, F.lit(value)).otherwise(stars)
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("userId"), F.lit(1).alias("movieId"), stars.alias("rating")
    )


@query(
    "job_ratings",
    f"""SELECT t.user_movie_id, t.user_id, t.movie_id,
               CASE WHEN s.user_id IS NOT NULL THEN s.rating ELSE t.rating END AS rating
        FROM ({_OLD_RATINGS_SQL}) t LEFT JOIN ({_STAGE_RATINGS_SQL}) s
        ON t.user_id = s.user_id AND t.movie_id = s.movie_id
        UNION ALL
        SELECT row_number() OVER (ORDER BY s.user_id, s.movie_id) - 1
                 + (SELECT count(*) FROM ({_OLD_RATINGS_SQL})) AS user_movie_id,
               s.user_id, s.movie_id, s.rating
        FROM ({_STAGE_RATINGS_SQL}) s LEFT JOIN ({_OLD_RATINGS_SQL}) t
        ON t.user_id = s.user_id AND t.movie_id = s.movie_id WHERE t.user_id IS NULL""",
)
def job_ratings(spark, sf):
    old = (
        table(spark, sf, "lineitem")
        .groupBy(F.col("l_orderkey").alias("user_id"), F.col("l_linenumber").alias("movie_id"))
        .agg(rating_value(F.max("l_quantity")).alias("rating"))
    )
    target = assign_surrogate_key(old, ratings.KEYS, ratings.SURROGATE)
    return ratings.merge_ratings(target, ratings.clean_ratings(_rating_source(spark, sf)))


@query(
    "job_budget",
    f"""SELECT l_orderkey AS movie_id, CAST(round(l_extendedprice * 100) AS BIGINT) AS budget,
               CAST(round(l_extendedprice * 200) AS BIGINT) AS revenue FROM lineitem
        UNION ALL
        SELECT id AS movie_id, budget, revenue FROM ({MOVIES_SQL})""",
)
def job_budget(spark, sf):
    target = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("movie_id"),
        F.round(F.col("l_extendedprice") * 100).cast("long").alias("budget"),
        F.round(F.col("l_extendedprice") * 200).cast("long").alias("revenue"),
    )
    return budgets.merge_budgets(target, budgets.clean_budgets(movie_source(spark, sf)))


@query(
    "job_date_all_required",
    _calendar_sql(
        "release_date",
        f"SELECT release_date AS d FROM ({MOVIES_SQL}) "
        "WHERE title IS NOT NULL AND NOT isnan(vote_average)",
    ),
)
def job_date_all_required(spark, sf):
    return dates.clean_dates(movie_source(spark, sf), required="all")


@query(
    "job_budget_all_required",
    f"""SELECT id AS movie_id, budget, revenue FROM ({MOVIES_SQL})
        WHERE title IS NOT NULL AND NOT isnan(vote_average)""",
)
def job_budget_all_required(spark, sf):
    return budgets.clean_budgets(movie_source(spark, sf), required="all")


#: The columns that all six tables' rows are laid into.
_COMMON = {"id": "BIGINT", "other": "BIGINT", "label": "VARCHAR", "day": "DATE", "a": "BIGINT", "b": "BIGINT", "x": "DOUBLE", "y": "DOUBLE"}
_CELLS = {
    "movies": {"id": "movie_id", "label": "concat_ws('|', is_adult, original_language, title)", "day": "release_date", "a": "vote_count", "x": "popularity", "y": "vote_average"},
    "genre": {"id": "genre_id", "label": "genre_name"},
    "movie_genre": {"id": "movie_id", "other": "genre_id"},
    "date": {"id": "year", "other": "quarter * 100 + month", "day": "release_date", "a": "week", "b": "day"},
    "ratings": {"id": "user_id", "other": "movie_id", "a": "user_movie_id", "x": "rating"},
    "budgetrevenue": {"id": "movie_id", "a": "budget", "b": "revenue"},
}
_NUMBERED_SQL = "SELECT o_orderkey AS movie_id, CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END AS genre_id, o_orderstatus AS genre_name FROM orders"
_LOADED = {
    "movies": _CLEAN_MOVIES_SQL,
    "genre": f"SELECT DISTINCT genre_id, genre_name FROM ({_NUMBERED_SQL})",
    "movie_genre": _NUMBERED_SQL,
    "date": _NEW_DATES_SQL,
    "ratings": _OLD_RATINGS_SQL,
    "budgetrevenue": f"SELECT id AS movie_id, budget, revenue FROM ({MOVIES_SQL})",
}


def _laid(cells: dict[str, str]) -> str:
    return ", ".join(f"CAST({cells.get(c, 'NULL')} AS {kind}) AS {c}" for c, kind in _COMMON.items())


@query("job_load_all", " UNION ALL ".join(f"SELECT '{n}' AS name, {_laid(c)} FROM ({_LOADED[n]}) t" for n, c in _CELLS.items()))
def job_load_all(spark, sf):
    """CSV files in the shape of the movie and rating sources, loaded end to end; the rows of all six tables."""
    prefix = scratch_path(spark, "load")
    status = F.col("o_orderstatus")
    number = F.when(status == "F", 1).when(status == "O", 2).otherwise(3)
    listed = F.concat(F.lit("[{'id': "), number, F.lit(", 'name': '"), status, F.lit("'}]"))
    known = movie_source(spark, sf, listed.alias("genres"))
    cells = [
        (F.col(f.name) if f.name in known.columns else F.lit("x")).cast("string").alias(f.name)
        for f in MOVIES_CSV.fields
    ]
    write_csv(known.select(*cells), f"{prefix}/in/movies_metadata.csv")
    rated = (
        table(spark, sf, "lineitem")
        .groupBy(F.col("l_orderkey").alias("userId"), F.col("l_linenumber").alias("movieId"))
        .agg(F.max("l_quantity").alias("rating"))
        .withColumn("timestamp", F.lit("0"))
    )
    write_csv(rated.select(*RATINGS_CSV.names), f"{prefix}/in/ratings.csv")
    warehouse = run_all(spark, f"{prefix}/in", f"{prefix}/out", f"{prefix}/warehouse")
    state = warehouse.snapshot()
    out = None
    for name, cells in _CELLS.items():
        laid = [F.expr(cells.get(c, "NULL")).cast(kind.replace("VARCHAR", "STRING")).alias(c) for c, kind in _COMMON.items()]
        rows = warehouse.read(name, state).select(F.lit(name).alias("name"), *laid)
        out = rows if out is None else out.unionByName(rows)
    return out

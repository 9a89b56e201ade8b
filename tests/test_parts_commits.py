"""Folders by key ranges, buckets in force, commits that exclude each other, lifetimes."""

import threading
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from starmart import commits
from starmart.operators.layout import SkewedBucketError, join_in_place
from starmart.operators.merge import upsert
from starmart.plans.ratings import KEYS, merge_ratings
from starmart.schemas import DATE, INT, LONG, STRING, TableSpec, struct, warehouse_specs
from starmart.scratch import Scratch, materialize, remove_old, scratch_path, scratch_root
from starmart.sources.files import create_new, file_sizes, folder_bytes, list_paths, read_bytes
from starmart.warehouse import PublishConflict, Warehouse


def bag(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def spec(**more):
    return TableSpec("t", struct(k=LONG, v=STRING), keys=("k",), part_key="k", **{"part_bytes": 20_000, **more})


def rows(spark, start, end, v="x"):
    return spark.range(start, end).select(F.col("id").alias("k"), F.concat(F.lit(v), F.sha2(F.col("id").cast("string"), 256)).alias("v"))


@pytest.fixture(params=["plain", "bucketed", "sorted"])
def parted(spark, tmp_path, request):
    """A table of 30,000 keys in many folders."""
    more = {"bucketed": {"dist_key": "k", "buckets": 2}, "sorted": {"sort_by": "k"}, "plain": {}}[request.param]
    wh = Warehouse(spark, str(tmp_path / "wh"), {"t": spec(**more)})
    wh.create_if_absent()
    wh.publish({"t": rows(spark, 0, 30_000)})
    wh.relayout("t")
    return wh


def test_a_merge_rewrites_the_touched_parts_only(spark, parted):
    state = parted.snapshot()
    assert len(state["t"].bounds) > 25
    whole = sum(folder_bytes(spark, p) for p in state["t"].paths)
    source = rows(spark, 12_000, 12_030, "new")  # a thousandth of the keys
    parts = parted.touched("t", source, state)
    merged = upsert(parted.read("t", state, parts), source, ["k"])
    parted.publish({"t": merged}, state=state, parts={"t": parts})
    after = parted.snapshot()["t"]
    fresh = [p for p in after.paths if p not in state["t"].paths]
    assert 0 < sum(folder_bytes(spark, p) for p in fresh) < 0.05 * whole
    assert set(state["t"].paths) - set(after.paths) == {p for q, p in state["t"].folders if q in parts}
    expected = bag(rows(spark, 0, 12_000).union(source).union(rows(spark, 12_030, 30_000)))
    assert bag(parted.read("t")) == expected
    # NULL keys and keys beyond all bounds are in parts too.
    more = rows(spark, 50_000, 50_010).union(spark.createDataFrame([(None, "none")], "k long, v string"))
    parts = parted.touched("t", more)
    assert parts == [0, len(after.bounds)]
    parted.publish({"t": upsert(parted.read("t", parts=parts), more, ["k"])}, parts={"t": parts})
    assert bag(parted.read("t")) == sorted(expected + bag(more), key=repr)


def test_parts_that_have_grown_are_cut_when_rewritten(spark, parted):
    before = parted.snapshot()["t"]
    source = rows(spark, 30_000, 45_000)
    for _ in range(2):  # the first merge fills the last part, the second finds it too large
        parts = parted.touched("t", source)
        assert parts == [len(before.bounds)] or len(parts) > 1
        parted.publish({"t": upsert(parted.read("t", parts=parts), source, ["k"])}, parts={"t": parts})
    after = parted.snapshot()["t"]
    assert len(after.bounds) > len(before.bounds) + 5 and list(after.bounds) == sorted(set(after.bounds))
    assert bag(parted.read("t")) == bag(rows(spark, 0, 45_000))
    for part in (0, 7, len(after.bounds)):  # every folder holds the keys of its range
        low = after.bounds[part - 1] if part else None
        high = after.bounds[part] if part < len(after.bounds) else None
        ends = parted.read("t", parts=[part]).agg(F.min("k"), F.max("k")).first()
        assert (low is None or ends[0] >= low) and (high is None or ends[1] < high)


def test_a_table_gets_its_parts_by_being_merged(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"), {"t": spec()})
    wh.create_if_absent()
    for start in (0, 100, 20_000):
        state, source = wh.snapshot(), rows(spark, start, start + 20_000)
        parts = wh.touched("t", source, state)
        wh.publish({"t": upsert(wh.read("t", state, parts), source, ["k"])}, state=state, parts={"t": parts})
    assert len(wh.snapshot()["t"].bounds) > 10 and wh.read("t").count() == 40_000


def test_appends_go_to_their_parts(spark, parted):
    parted.publish(append={"t": rows(spark, -5, 0)})
    assert parted.read("t", parts=[0]).where("k < 0").count() == 5
    assert parted.read("t").count() == 30_005


def test_parts_by_date(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"), {"d": TableSpec("d", struct(d=DATE, n=INT), keys=("d",), part_key="d", part_bytes=2_000, sort_by="d")})
    days = spark.range(5_000).select(F.date_add(F.lit("1999-12-01").cast("date"), F.col("id").cast("int")).alias("d"), F.col("id").cast("int").alias("n"))
    wh.publish({"d": days})
    wh.relayout("d")
    assert len(wh.snapshot()["d"].bounds) > 3
    new = days.where("n between 40 and 45").withColumn("n", -F.col("n"))
    parts = wh.touched("d", new)
    assert len(parts) == 1
    wh.publish({"d": upsert(wh.read("d", parts=parts), new, ["d"])}, parts={"d": parts})
    assert bag(wh.read("d")) == bag(days.where("n not between 40 and 45").union(new))


def test_the_number_of_parts_does_not_grow_with_the_table(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"), {"t": spec(part_bytes=2_000)})
    wh.publish({"t": rows(spark, 0, 30_000)})
    whole = sum(folder_bytes(spark, p) for p in wh.snapshot()["t"].paths)
    wh.relayout("t")
    after = wh.snapshot()["t"]
    assert whole > 500 * 2_000 and 64 < len(after.bounds) < wh.specs["t"].max_parts
    wh.relayout("t")  # nothing has outgrown its share
    assert wh.snapshot()["t"] == after and bag(wh.read("t")) == bag(rows(spark, 0, 30_000))


# -- buckets ---------------------------------------------------------------------


@pytest.mark.parametrize("most", [64 << 20, 1_000])
def test_crowded_buckets_are_not_joined_as_they_lie(spark, tmp_path, most):
    wh = Warehouse(spark, str(tmp_path / "wh"), {"t": spec(dist_key="k", buckets=2, part_bytes=200_000, join_bytes=most)})
    wh.publish({"t": rows(spark, 0, 30_000)})
    wh.relayout("t")
    bounds = wh.snapshot()["t"].bounds
    whole, part = wh.read("t"), wh.read("t", parts=[1])
    assert ("spark_catalog" in whole._jdf.queryExecution().optimizedPlan().toString()) == (most > 1_000)
    assert bag(whole) == bag(rows(spark, 0, 30_000))
    assert bag(part) == bag(rows(spark, bounds[0], bounds[1] if len(bounds) > 1 else 30_000))


def test_a_large_bucket_is_written_by_several_tasks(spark, tmp_path):
    """Also if its rows have one key: what a task sorts is bounded."""
    more = {"dist_key": "b", "buckets": 2, "max_skew": None}
    wh = Warehouse(spark, str(tmp_path / "wh"), {"t": TableSpec("t", struct(b=INT, k=LONG, v=STRING), **more)})
    hot = rows(spark, 0, 30_000).repartition(6).select(F.lit(1).alias("b"), "k", "v")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "200k")
    try:
        wh.publish({"t": hot})
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    (path,) = wh.snapshot()["t"].paths
    assert len(file_sizes(spark, path)) >= 4 and bag(wh.read("t")) == bag(hot)


def exchanges(plan: str) -> int:
    return plan.count("Exchange hashpartitioning")


def test_merge_ratings_reads_buckets_in_place(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"), warehouse_specs(buckets=4))
    wh.create_if_absent()
    old = spark.range(2_000).selectExpr("id AS user_movie_id", "cast(id as int) AS user_id", "cast(id % 50 as int) AS movie_id", "cast(1 as decimal(3,1)) AS rating")
    wh.publish({"ratings": old})
    stage = spark.range(1_500, 2_500).selectExpr("cast(id as int) AS user_id", "cast(id % 50 as int) AS movie_id", "cast(2 as decimal(3,1)) AS rating")
    name = "spark.sql.autoBroadcastJoinThreshold"
    threshold = spark.conf.get(name)
    spark.conf.set(name, "-1")
    try:
        from starmart.operators.merge import matched_once

        with join_in_place(spark):
            plan = matched_once(wh.read("ratings"), stage, KEYS, null_keys=False)._jdf.queryExecution().executedPlan().toString()
        assert "Bucketed: true" in plan and exchanges(plan) == 1  # the stage alone is shuffled
        merged = merge_ratings(wh.read("ratings"), stage, unique=True, null_keys=False, reserve=lambda n: wh.reserve("ratings", n))
        wh.publish({"ratings": merged})
    finally:
        spark.conf.set(name, threshold)
    assert spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition") == "true"
    out = bag(wh.read("ratings").selectExpr("user_movie_id", "user_id", "cast(rating as int)"))
    assert out == sorted([(i, i, 2 if i >= 1_500 else 1) for i in range(2_500)], key=repr)


def test_a_skewed_bucket_is_an_error_or_allowed(spark, tmp_path):
    hot = spark.range(5_000).select(F.lit(7).cast("long").alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    strict = {"dist_key": "k", "buckets": 8, "skew_bytes": 1000}
    wh = Warehouse(spark, str(tmp_path / "wh"), {"t": spec(**strict)})
    with pytest.raises(SkewedBucketError, match="of 8 holds"):
        wh.publish({"t": hot})
    assert not wh.exists("t") and wh.stale_paths().isEmpty()
    wh.specs["t"] = spec(**strict, max_skew=None)
    wh.publish({"t": hot})
    assert wh.read("t").count() == 5_000


# -- commits ---------------------------------------------------------------------


def at_once(n, call):
    barrier, done, errors = threading.Barrier(n), [], []

    def run(i):
        barrier.wait()
        try:
            done.append(call(i))
        except PublishConflict as e:
            errors.append(e)

    threads = [threading.Thread(target=run, args=(i,)) for i in range(n)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    return done, errors


def test_a_new_file_has_one_writer(spark, tmp_path):
    for turn in range(5):
        path = f"{tmp_path}/log/{turn}.json"
        done, _ = at_once(8, lambda i, path=path: create_new(spark, path, b"%d" % i))
        assert sorted(done) == [False] * 7 + [True]
        assert read_bytes(spark, path) in [b"%d" % i for i in range(8)]
    assert [p for p, _ in list_paths(spark, f"{tmp_path}/log")] == [f"{tmp_path}/log/{i}.json" for i in range(5)]


def test_of_writers_at_one_moment_exactly_one_wins(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"), {"t": spec()})
    wh.create_if_absent()
    for _ in range(3):
        state = wh.snapshot()
        made = [wh.prepare({"t": rows(spark, i, i + 1)}, state=state) for i in range(4)]
        done, errors = at_once(4, lambda i, made=made: wh.commit(made[i]))
        assert len(done) == 1 and len(errors) == 3
        assert wh.snapshot()["t"].version == state["t"].version + 1 and wh.read("t").count() == 1
    # Writers of different tables do not hinder each other.
    done, errors = at_once(4, lambda i: wh.publish({f"u{i}": rows(spark, 0, i)}))
    assert len(done) == 4 and [wh.read(f"u{i}").count() for i in range(4)] == [0, 1, 2, 3]


def test_a_commit_reads_few_files_however_many_there_are(spark, tmp_path, monkeypatch):
    wh = Warehouse(spark, str(tmp_path / "wh"), {})
    read = []
    monkeypatch.setattr(commits, "read_bytes", lambda s, p: read.append(p) or read_bytes(s, p))
    schema = struct(k=LONG)
    most = 0
    for i in range(300):
        read.clear()
        wh.stage_files({"stage_t": (f"/batch/{i}", schema)})
        most = max(most, len(read))
    assert most <= 2 * (commits.SUMMARY + 4)
    assert wh.snapshot()["stage_t"].paths == tuple(f"/batch/{i}" for i in range(300))
    assert len(wh.vacuum(-1)) > 290  # the summary covers them
    assert len(wh.snapshot()["stage_t"].paths) == 300
    wh.stage_files({"stage_t": ("/batch/last", schema)})
    assert len(wh.snapshot()["stage_t"].paths) == 301


def test_reserved_keys_never_overlap(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"), warehouse_specs())
    wh.create_if_absent()
    kind = wh.specs["ratings"].schema
    wh.publish({"ratings": spark.createDataFrame([], kind)})
    done, _ = at_once(6, lambda i: (wh.reserve("ratings", 10 + i), 10 + i))
    taken = [k for start, n in done for k in range(start, start + n)]
    assert sorted(taken) == list(range(sum(10 + i for i in range(6))))
    # A publish raises the mark to its highest key.
    wh.publish({"ratings": spark.sql("SELECT 500L AS user_movie_id, 1 AS user_id, 2 AS movie_id, cast(1 as decimal(3,1)) AS rating")})
    assert wh.reserve("ratings", 1) == 501


# -- catalog and lifetime --------------------------------------------------------


def test_tables_by_name(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"), warehouse_specs(buckets=2), database="movies_test")
    try:
        assert len(wh.create_if_absent()) == 12
        assert spark.table("movies_test.stage_ratings").columns == ["user_id", "movie_id", "rating"]
        assert spark.catalog.tableExists("movies_test.date") and spark.table("movies_test.date").isEmpty()
        pairs = spark.createDataFrame([(1, 2), (3, 4)], "movie_id int, genre_id int")
        wh.publish({"movie_genre": pairs})
        assert bag(spark.table("movies_test.movie_genre")) == bag(pairs)
        wh.publish(append={"movie_genre": pairs.where("movie_id = 1").withColumn("genre_id", F.lit(9))})
        assert bag(spark.sql("SELECT genre_id FROM movies_test.movie_genre WHERE movie_id = 1")) == [(2,), (9,)]
        wh.drop("stage_date")
        assert not spark.catalog.tableExists("movies_test.stage_date")
        again = Warehouse(spark, wh.root, wh.specs)  # another session reads the log and names them anew
        again.register("movies_again")
        assert bag(spark.table("movies_again.movie_genre")) == bag(wh.read("movie_genre"))
    finally:
        for base in ("movies_test", "movies_again", wh._catalog):
            spark.sql(f"DROP DATABASE IF EXISTS {base} CASCADE")
    assert wh.read("movie_genre").count() == 3  # dropping the names drops no data


def test_vacuum_removes_what_nothing_refers_to(spark, parted):
    old = parted.snapshot()["t"]
    source = rows(spark, 0, 3, "new")
    parts = parted.touched("t", source)
    parted.publish({"t": upsert(parted.read("t", parts=parts), source, ["k"])}, parts={"t": parts})
    parted.prepare({"t": source})  # a publish that never comes to its commit
    expected = bag(parted.read("t"))
    assert parted.vacuum(1) == []  # too young
    gone = parted.vacuum(-1)
    assert len([p for p in gone if "/_log/" not in p]) >= 3
    assert bag(parted.read("t")) == expected
    assert parted.stale_paths().isEmpty() and set(parted.snapshot()["t"].paths) & set(old.paths)


def test_scratch_tables_end_with_their_block(spark):
    root = Path(scratch_root(spark).removeprefix("file://")) / "starmart" / spark.sparkContext.applicationId
    before = set(root.glob("*")) if root.exists() else set()
    with Scratch(spark) as outer:
        with Scratch(spark) as inner:
            a = inner.table(spark.range(3), "a")
            materialize(spark.range(4), "b")  # also of a library function that knows no block
            inner.drop(a)
            with pytest.raises(Exception, match="DIVIDE"):
                materialize(spark.range(3).selectExpr("id / (id - id)"), "failing")
            with Scratch(spark) as innermost:  # a result of a block within can be handed on
                kept = inner.result(innermost.result(spark.range(5), "c"), "d")
        assert kept.count() == 5
        assert len(set(root.glob("*")) - before) == 1
        assert outer.spark is spark
    assert set(root.glob("*")) - before == set()


def test_old_scratch_of_other_applications_goes(spark, tmp_path):
    name = scratch_root(spark)
    other = f"{name}/starmart/app-lost/table-1"
    spark.range(2).write.parquet(other)
    mine = scratch_path(spark, "mine")
    spark.range(2).write.parquet(mine)
    assert remove_old(spark, 1) == []
    assert remove_old(spark, -1) == [f"{name}/starmart/app-lost"]
    assert spark.read.parquet(mine).count() == 2

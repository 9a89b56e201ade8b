"""Whole jobs on a small golden input."""

import datetime as dt
import shutil
from decimal import Decimal
from pathlib import Path

import pytest

from starmart.__main__ import main
from starmart.operators.merge import DuplicateKeyError
from starmart.operators.quality import ConstraintError
from starmart.plans.load import (
    CLEAN_NAMES,
    STAGES,
    UnfinishedLoad,
    clean_path,
    merge_all,
    merge_table,
    run_all,
    run_cleaning,
    run_job,
    stage_clean,
)
from starmart.warehouse import Warehouse

DATA = Path(__file__).parent / "data"
D = dt.date

MOVIES = {
    (1, "False", 30000000, "en", "Alpha", 21.5, D(1995, 10, 30), 5415, 7.5),
    (2, "False", 65000000, "en", "Beta, Part 2", 17.0, D(1996, 12, 30), 2413, 6.5),
    (3, "False", 0, "fr", "Gamma", 11.25, D(1995, 10, 30), 92, 6.0),
    (7, "False", 900, "en", "Eta", 4.5, D(2004, 12, 31), 70, 8.0),
}
BRIDGE = {(1, 16), (1, 35), (2, 12), (4, 35), (6, 18), (6, None), (7, 18)}
GENRES = {(12, "Adventure"), (16, "Animation"), (18, "Drama"), (35, "Comedy")}
DATES = {
    (D(1995, 10, 30), 30, 44, 10, 4, 1995),
    (D(1996, 12, 30), 30, 1, 12, 4, 1996),
    (D(2000, 2, 29), 29, 9, 2, 1, 2000),
    (D(2001, 1, 1), 1, 1, 1, 1, 2001),
    (D(2004, 12, 31), 31, 53, 12, 4, 2004),
}
BUDGETS = {
    (1, 30000000, 373554033),
    (2, 65000000, 262797249),
    (3, 0, 0),
    (4, 16000000, 81452156),
    (6, 700, 9),
    (7, 900, 11),
}
# Movie 5 has no readable id, so its budget row is dropped; its date stays.


def rows(df):
    found = [tuple(r) for r in df.collect()]
    assert len(found) == len(set(found)), "unexpected duplicates"
    return set(found)


def bag(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def read(spark, output, table):
    return spark.read.parquet(clean_path(str(output), table))


def test_clean_outputs(spark, tmp_path):
    run_cleaning(spark, str(DATA), str(tmp_path))
    assert rows(read(spark, tmp_path, "movies")) == MOVIES
    assert rows(read(spark, tmp_path, "movie_genre")) == BRIDGE
    assert rows(read(spark, tmp_path, "genre")) == GENRES
    assert rows(read(spark, tmp_path, "date")) == DATES
    assert rows(read(spark, tmp_path, "budgetrevenue")) == BUDGETS
    assert rows(read(spark, tmp_path, "ratings")) == {(1, 110, 1.0), (1, 147, 4.5)}
    assert read(spark, tmp_path, "movies").columns == [
        "movie_id", "is_adult", "budget", "original_language", "title", "popularity",
        "release_date", "vote_count", "vote_average",
    ]
    assert dict(read(spark, tmp_path, "movies").dtypes)["vote_average"] == "float"


def test_wide_null_drop(spark, tmp_path):
    run_cleaning(spark, str(DATA), str(tmp_path), required="all")
    assert rows(read(spark, tmp_path, "date")) == {(D(1995, 10, 30), 30, 44, 10, 4, 1995)}
    assert rows(read(spark, tmp_path, "budgetrevenue")) == {(1, 30000000, 373554033), (3, 0, 0)}
    assert rows(read(spark, tmp_path, "movies")) == MOVIES


@pytest.mark.parametrize("job", ["genre", "date", "rating", "movies", "budgetrevenue"])
def test_single_job_equals_whole_run(spark, tmp_path, job):
    run_cleaning(spark, str(DATA), str(tmp_path / "whole"))
    for table, clean in run_job(spark, job, str(DATA), str(tmp_path / "one")).items():
        stored = spark.read.parquet(clean.path)
        assert stored.schema == clean.schema
        assert bag(stored) == bag(read(spark, tmp_path / "whole", table))


def test_job_refuses_existing_output(spark, tmp_path):
    run_job(spark, "date", str(DATA), str(tmp_path))
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        run_job(spark, "date", str(DATA), str(tmp_path))


def test_run_all_and_rerun(spark, tmp_path):
    root = str(tmp_path / "wh")
    with pytest.raises(ConstraintError, match="genre_id"):
        run_all(spark, str(DATA), str(tmp_path / "o0"), root)
    failed = Warehouse(spark, root)
    assert all(failed.read(t).isEmpty() for t in CLEAN_NAMES)  # checked before any publish
    with pytest.raises(UnfinishedLoad, match="stage_genre"):
        run_all(spark, str(DATA), str(tmp_path / "o3"), root, on_violation="drop")
    main(["merge", "budgetrevenue", "genre", "--warehouse", root, "--on-violation", "drop"])
    assert set(bag(failed.read("budgetrevenue"))) == BUDGETS and failed.read("movies").isEmpty()
    main(["merge", "--warehouse", root, "--on-violation", "drop"])
    main(["merge", "--warehouse", root])  # nothing is left
    with pytest.raises(SystemExit):
        main(["merge", "nothing", "--warehouse", root])

    wh = failed
    first = {t: bag(wh.read(t)) for t in CLEAN_NAMES}
    assert set(first["movies"]) == {r[:2] + r[3:] for r in MOVIES}
    assert set(first["movie_genre"]) == BRIDGE - {(6, None)}
    assert set(first["genre"]) == GENRES
    assert set(first["date"]) == DATES
    assert set(first["budgetrevenue"]) == BUDGETS
    assert first["ratings"] == [(0, 1, 110, Decimal("1.0")), (1, 1, 147, Decimal("4.5"))]
    assert not any(wh.exists(s) for s in STAGES.values())

    run_all(spark, str(DATA), str(tmp_path / "o2"), root, on_violation="drop")
    again = {t: bag(wh.read(t)) for t in CLEAN_NAMES}
    doubled = sorted(first.pop("budgetrevenue") * 2, key=repr)
    assert again.pop("budgetrevenue") == doubled
    assert again == first


def test_run_with_changed_rows(spark, tmp_path):
    root = str(tmp_path / "wh")
    wh = run_all(spark, str(DATA), str(tmp_path / "o1"), root, on_violation="drop")
    changed = tmp_path / "in"
    shutil.copytree(DATA, changed)
    text = (changed / "movies_metadata.csv").read_text()
    (changed / "movies_metadata.csv").write_text(
        text.replace("{'id': 16, 'name': 'Animation'}", "{'id': 16, 'name': 'Cartoon'}").replace(
            "Released,T,Alpha,", "Released,T,Alpha II,"
        )
    )
    (changed / "ratings.csv").write_text(
        "userId,movieId,rating,timestamp\n1,147,2.0,1\n0,5,3.5,1\n2,5,0.5,1\n"
    )
    run_all(spark, str(changed), str(tmp_path / "o2"), root, on_violation="drop")
    assert (16, "Cartoon") in rows(wh.read("genre"))
    assert rows(wh.read("movies").where("movie_id = 1").select("title")) == {("Alpha II",)}
    assert bag(wh.read("ratings")) == [
        (0, 1, 110, Decimal("1.0")),
        (1, 1, 147, Decimal("2.0")),
        (2, 0, 5, Decimal("3.5")),
        (3, 2, 5, Decimal("0.5")),
    ]


def test_large_source_gives_the_same_tables(spark, tmp_path, monkeypatch):
    small = run_all(spark, str(DATA), str(tmp_path / "o1"), str(tmp_path / "w1"), on_violation="drop")
    monkeypatch.setattr("starmart.operators.merge.exceeds_broadcast", lambda df: True)
    monkeypatch.setattr("starmart.plans.ratings.exceeds_broadcast", lambda df: True)
    for output in ("o2", "o3"):
        large = run_all(spark, str(DATA), str(tmp_path / output), str(tmp_path / "w2"), on_violation="drop")
    for table in ("movies", "genre", "date", "ratings", "movie_genre"):
        assert bag(large.read(table)) == bag(small.read(table))


def test_duplicate_source_keys(spark, tmp_path):
    source = tmp_path / "in"
    shutil.copytree(DATA, source)
    with open(source / "ratings.csv", "a") as f:
        f.write("1,110,5.0,9\n")
    wh = Warehouse(spark, str(tmp_path / "wh"))
    wh.create_if_absent()
    stage_clean(wh, run_job(spark, "rating", str(source), str(tmp_path / "o")))
    with pytest.raises(DuplicateKeyError):
        merge_table(wh, "ratings")
    assert wh.exists("stage_ratings") and wh.read("ratings").isEmpty()
    merge_table(wh, "ratings", dedupe={"ratings": ["rating"]})
    assert bag(wh.read("ratings"))[0] == (0, 1, 110, Decimal("1.0"))


def test_staged_movie_needs_a_release_date(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    wh.create_if_absent()
    row = spark.sql("""SELECT 1 AS movie_id, 'False' AS is_adult, 'en' AS original_language, 'x' AS title,
        1.0D AS popularity, CAST(NULL AS DATE) AS release_date, 1 AS vote_count, 1.0D AS vote_average""")
    wh.stage("stage_movies", row)
    with pytest.raises(ConstraintError, match="release_date"):
        merge_table(wh, "movies")
    merge_table(wh, "movies", on_violation="drop")
    assert wh.read("movies").isEmpty() and not wh.exists("stage_movies")


def test_failure_before_commit_keeps_everything(spark, tmp_path, monkeypatch):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    wh.create_if_absent()
    stage_clean(wh, run_job(spark, "genre", str(DATA), str(tmp_path / "o")))

    def broken(self, made):
        raise RuntimeError("lost the driver")

    with monkeypatch.context() as m:
        m.setattr(Warehouse, "commit", broken)
        with pytest.raises(RuntimeError, match="lost"):
            merge_table(wh, "genre", on_violation="drop")
    assert wh.read("genre").isEmpty() and wh.read("movie_genre").isEmpty()
    assert wh.exists("stage_genre") and wh.exists("stage_movie_genre")
    merge_all(wh, ["genre"], on_violation="drop")
    assert rows(wh.read("genre")) == GENRES


def test_command_line(spark, tmp_path):
    main(["date", "--input", str(DATA), "--output", str(tmp_path / "o")])
    assert rows(read(spark, tmp_path / "o", "date")) == DATES
    main(
        ["all", "--input", str(DATA), "--output", str(tmp_path / "p"),
         "--warehouse", str(tmp_path / "wh"), "--on-violation", "drop", "--dedupe"]
    )
    assert rows(Warehouse(spark, str(tmp_path / "wh")).read("date")) == DATES


def test_clean_data_reaches_the_database(spark, tmp_path):
    url = "jdbc:derby:memory:load;create=true"
    main(
        ["genre", "--input", str(DATA), "--output", str(tmp_path), "--jdbc-url", url,
         "--jdbc-schema", "app", "--jdbc-property", "batchsize=100"]
    )
    assert rows(spark.read.jdbc(url, "app.stage_genre")) == GENRES
    assert rows(spark.read.jdbc(url, "app.stage_movie_genre")) == BRIDGE


def test_plain_dialect_is_the_bare_header_reader(spark, tmp_path):
    stored = run_job(
        spark, "budgetrevenue", str(DATA), str(tmp_path), dialects={"movies": "plain"}
    )
    # Doubled quotes and line breaks shred rows 2 and 3; the others survive.
    assert (1, 30000000, 373554033) in rows(spark.read.parquet(stored["budgetrevenue"].path))

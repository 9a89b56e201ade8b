"""The jobs as a user runs them: clean files into Parquet, then merge into the warehouse."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import partial

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from starmart.operators.merge import one_row_per_key, unique_observed
from starmart.operators.quality import ConstraintError, conform, enforce, observed
from starmart.plans import budgets, dates, genres, movies, ratings
from starmart.schemas import MOVIES_CSV, RATING_TYPE, RATINGS_CSV, warehouse_specs
from starmart.scratch import Scratch
from starmart.sources.delimited import LOST, RECORD, lost_cells, read_csv_checked, read_csv_typed, rejected_rows
from starmart.sources.files import create_new, delete, read_bytes
from starmart.sources.jdbc import append_jdbc, append_jdbc_once
from starmart.sources.parquet import read_parquet, write_parquet
from starmart.warehouse import Entry, Prepared, Warehouse

# Input file names and schemas.
SOURCES: dict[str, tuple[str, T.StructType, str]] = {
    "movies": ("movies_metadata.csv", MOVIES_CSV, "rfc4180"),
    "ratings": ("ratings.csv", RATINGS_CSV, "lines"),
}

# Warehouse table -> name of its clean dataset and of its staging table.
CLEAN_NAMES = {
    "movies": "movies",
    "genre": "genre",
    "movie_genre": "movie_genre",
    "date": "date",
    "ratings": "rating",
    "budgetrevenue": "budgetrevenue",
}
STAGES = {table: f"stage_{table}" for table in CLEAN_NAMES}


@dataclass(frozen=True)
class Job:
    """One clean-up job: the source it reads and the warehouse tables it feeds."""

    source: str
    tables: tuple[str, ...]
    clean: Callable[[DataFrame, str], Mapping[str, DataFrame]]
    shared: Callable[[DataFrame], DataFrame] | None = None  # computed once for all tables


JOBS: dict[str, Job] = {
    "genre": Job(
        "movies",
        ("genre", "movie_genre"),
        lambda records, required: {
            "genre": genres.clean_genres(records),
            "movie_genre": genres.clean_movie_genres(records),
        },
        shared=genres.movie_genre_records,
    ),
    "date": Job("movies", ("date",), lambda df, required: {"date": dates.clean_dates(df, required)}),
    "rating": Job("ratings", ("ratings",), lambda df, required: {"ratings": ratings.clean_ratings(df)}),
    "movies": Job("movies", ("movies",), lambda df, required: {"movies": movies.clean_movies(df)}),
    "budgetrevenue": Job(
        "movies",
        ("budgetrevenue",),
        lambda df, required: {"budgetrevenue": budgets.clean_budgets(df, required)},
    ),
}


class UnfinishedLoad(RuntimeError):
    """An earlier load left staged batches that were not merged."""


@dataclass(frozen=True)
class Clean:
    """A stored clean dataset."""

    path: str
    schema: T.StructType


def _side_by_side(spark: SparkSession, calls: Iterable[Callable]) -> list:
    """Run independent jobs at the same time, so that small ones do not idle the cluster.

    All of them finish; the first failure is then raised.
    """
    calls = [inheritable_thread_target(spark)(c) for c in calls]
    with ThreadPoolExecutor(len(calls)) as pool:
        return [f.result() for f in [pool.submit(c) for c in calls]]


def clean_path(output: str, table: str) -> str:
    return f"{output.rstrip('/')}/{CLEAN_NAMES[table]}.parquet"


def read_source(
    spark: SparkSession, input: str, source: str, dialects: Mapping[str, str] | None = None
) -> DataFrame:
    file, schema, dialect = SOURCES[source]
    dialect = (dialects or {}).get(source, dialect)
    return read_csv_typed(spark, f"{input.rstrip('/')}/{file}", schema, dialect)


def run_job(
    spark: SparkSession,
    name: str,
    input: str = "/source",
    output: str = "/output",
    required: str = "output",
    dialects: Mapping[str, str] | None = None,
    jdbc: Mapping[str, object] | None = None,
    source: DataFrame | None = None,
    batch: str | None = None,
) -> dict[str, Clean]:
    """Clean one source into its Parquet datasets, one per warehouse table it feeds.

    ``jdbc`` (``url``, optionally ``properties`` and ``schema``) also appends every
    dataset to its staging table there, reading back the Parquet just written; with ``batch``,
    a name for this run and its retries, at most once.  ``source`` replaces the input file by
    an already read frame.
    """
    job = JOBS[name]
    df = read_source(spark, input, job.source, dialects) if source is None else source
    stored = {}
    with Scratch(spark) as scratch:
        if job.shared is not None:
            df = scratch.table(job.shared(df), name)
        for table, clean in job.clean(df, required).items():
            path = clean_path(output, table)
            write_parquet(clean, path)
            stored[table] = Clean(path, clean.schema)
    for table, clean in stored.items() if jdbc is not None else ():
        rows = read_parquet(spark, clean.path, schema=clean.schema)
        target = f"{jdbc.get('schema', 'movies')}.{STAGES[table]}"
        if batch is None:
            append_jdbc(rows, jdbc["url"], target, jdbc.get("properties"))
        else:
            append_jdbc_once(rows, jdbc["url"], target, f"{batch}-{table}", jdbc.get("properties"))
    return stored


def run_step(spark: SparkSession, name: str, input: str, output: str, required: str, **options) -> dict[str, Clean]:
    """``run_job`` as a step that can be repeated: what has finished is not done again.

    A step that begins leaves a mark below ``<output>/_steps``, one that has finished its
    outputs.  A repeated step with a first mark only deletes what the failed try had written.
    Outputs without a mark are somebody else's and an error, as in ``run_job``.
    """
    given = {"input": input, "required": required, "dialects": dict(options.get("dialects") or {})}
    begun, ended = (f"{output.rstrip('/')}/_steps/{name}.{x}.json" for x in ("begun", "ended"))
    raw = json.dumps(given | {"batch": uuid.uuid4().hex}).encode()
    fresh = create_new(spark, begun, raw)
    begin = json.loads(read_bytes(spark, begun))
    if {k: begin.get(k) for k in given} != given:
        raise UnfinishedLoad(f"{output} holds an unfinished run of {name!r} with other arguments: {begin}")
    done = read_bytes(spark, ended)
    if done is not None:
        return {t: Clean(clean_path(output, t), T.StructType.fromJson(s)) for t, s in json.loads(done).items()}
    if not fresh:
        for table in JOBS[name].tables:
            delete(spark, clean_path(output, table))
    stored = run_job(spark, name, input, output, required, batch=begin["batch"], **options)
    create_new(spark, ended, json.dumps({t: c.schema.jsonValue() for t, c in stored.items()}).encode())
    return stored


def close_output(spark: SparkSession, output: str) -> None:
    """Let no further run reuse the finished steps of this output."""
    create_new(spark, f"{output.rstrip('/')}/_steps/closed.json", b"{}")


def read_checked(
    spark: SparkSession, input: str, source: str, dialects: Mapping[str, str] | None, columns: list[str] | None
) -> DataFrame:
    """A source with what did not parse beside its rows (see ``rejected_rows``)."""
    file, schema, dialect = SOURCES[source]
    dialect = (dialects or {}).get(source, dialect)
    checked = read_csv_checked(spark, f"{input.rstrip('/')}/{file}", schema, dialect)
    return checked.select(*(columns or schema.names), RECORD, lost_cells(schema, dialect).alias(LOST))


def write_rejects(parsed: DataFrame, output: str, source: str, key: str) -> None:
    """The cells of a source that were read as NULL, with their text, below ``<output>/_rejected``."""
    path = f"{output.rstrip('/')}/_rejected/{source}.parquet"
    rejected_rows(parsed, [key]).write.mode("overwrite").parquet(path)


def run_cleaning(
    spark: SparkSession,
    input: str = "/source",
    output: str = "/output",
    required: str = "output",
    dialects: Mapping[str, str] | None = None,
    jdbc: Mapping[str, object] | None = None,
    keep_open: bool = False,
    rejects: bool = False,
) -> dict[str, Clean]:
    """All clean-up jobs.  The movie file is parsed once into columnar form for the four
    jobs that read it.

    A run that failed can be called again with the same arguments: jobs that had finished are
    not repeated.  Once all have, and ``keep_open`` is not set, the output takes no further run.
    ``rejects`` also writes the cells that did not parse (``write_rejects``); the sources are
    still parsed once.
    """
    if read_bytes(spark, f"{output.rstrip('/')}/_steps/closed.json") is not None:
        raise FileExistsError(f"PATH_ALREADY_EXISTS: {output} holds the outputs of a finished run")
    run = partial(
        run_step, spark, input=input, output=output, required=required, dialects=dialects, jdbc=jdbc
    )
    used = [
        "id", "adult", "budget", "genres", "original_language", "title", "popularity",
        "release_date", "revenue", "vote_count", "vote_average",
    ]

    def movie_jobs() -> list[dict[str, Clean]]:
        columns = None if required == "all" else used
        names = [n for n, job in JOBS.items() if job.source == "movies"]
        with Scratch(spark) as scratch:
            if rejects:
                parsed = scratch.table(read_checked(spark, input, "movies", dialects, columns), "movies-source")
                write_rejects(parsed, output, "movies", "id")
                parsed = parsed.drop(RECORD, LOST)
            else:
                wide = read_source(spark, input, "movies", dialects)
                parsed = scratch.table(wide.select(*columns) if columns else wide, "movies-source")
            return _side_by_side(spark, [partial(run, n, source=parsed) for n in names])

    def rating_jobs() -> list[dict[str, Clean]]:
        names = [n for n, job in JOBS.items() if job.source == "ratings"]
        if not rejects:
            return [run(n) for n in names]
        with Scratch(spark) as scratch:
            parsed = scratch.table(read_checked(spark, input, "ratings", dialects, None), "ratings-source")
            write_rejects(parsed, output, "ratings", "userId")
            return [run(n, source=parsed.drop(RECORD, LOST)) for n in names]

    found = _side_by_side(spark, [movie_jobs, rating_jobs])
    if not keep_open:
        close_output(spark, output)
    return {table: clean for part in found for stored in part for table, clean in stored.items()}


# -- merging -----------------------------------------------------------------------


def stage_clean(warehouse: Warehouse, stored: Mapping[str, Clean]) -> None:
    """Register clean datasets as staging batches, in place."""
    warehouse.stage_files({STAGES[t]: (c.path, c.schema) for t, c in stored.items()})


def require_nothing_staged(warehouse: Warehouse) -> None:
    """Raise if an earlier load still has batches to merge; new ones would mix with them."""
    state = warehouse.snapshot()
    left = [s for s in STAGES.values() if warehouse.staged(s, state)]
    if left:
        raise UnfinishedLoad(
            f"{left} hold batches of an unfinished load; finish it with "
            "'python -m starmart merge', or drop them"
        )


def staged_groups(warehouse: Warehouse) -> list[str]:
    """The groups with batches to merge."""
    state = warehouse.snapshot()
    return [n for n in MERGES if warehouse.staged(STAGES[n], state)]


@dataclass(frozen=True)
class Settled:
    """The checked batches of one group, ready to be merged into the tables of ``state``."""

    name: str
    state: Mapping[str, Entry]
    rows: Mapping[str, DataFrame]
    made: Prepared | None = None  # of a group that is only appended


def settle_group(
    warehouse: Warehouse,
    scratch: Scratch,
    name: str,
    on_violation: str = "fail",
    dedupe: bool | Mapping[str, list[str]] = False,
) -> Settled:
    """Check the staged batches of one group and write them with their keys settled.

    Each staging table is read once: the job that writes its rows counts what breaks a
    constraint or repeats a key.  What it found is raised here, before anything is merged.
    """
    state = warehouse.snapshot()

    def checked(table: str) -> tuple[DataFrame, Callable[[], None]]:
        spec = warehouse.specs[table]
        rows = conform(warehouse.read(STAGES[table], state), spec)
        if on_violation == "fail":
            return observed(rows, spec.stage_spec)
        return enforce(rows, spec.stage_spec, on_violation), lambda: None

    if name == "budgetrevenue":
        rows, hold = checked(name)
        made = warehouse.prepare(append={name: rows}, consume_if_exists=[STAGES[name]], state=state)
        try:
            hold()
        except ConstraintError:
            warehouse.abandon(made)
            raise
        return Settled(name, state, {}, made)
    kept = {}
    for table in MERGES[name]:
        spec = warehouse.specs[table]
        rows, hold = checked(table)
        if dedupe:
            by = dedupe.get(table) if isinstance(dedupe, Mapping) else None
            rows, unique = one_row_per_key(rows, spec.keys, by or spec.set_cols), lambda: None
        else:
            rows, unique = unique_observed(rows, spec.keys, spec.set_cols)
        kept[table] = scratch.table(rows, f"stage-{table}")
        hold()
        unique()
    return Settled(name, state, kept)


def prepare_merge(warehouse: Warehouse, settled: Settled) -> Prepared:
    """Merge one group's settled rows; ``Warehouse.commit`` lets it count.

    Target tables are read and written in the parts that the staged keys fall in.
    """
    if settled.made is not None:
        return settled.made
    name, state, staged = settled.name, settled.state, settled.rows
    parts = {table: warehouse.touched(table, rows, state) for table, rows in staged.items()}
    before = {table: warehouse.read(table, state, parts[table]) for table in staged}
    prepare = partial(warehouse.prepare, state=state, parts=parts)
    # The keys were settled: they are unique and never NULL.
    options = {"unique": True, "null_keys": False}
    with Scratch(warehouse.spark):
        if name == "movies":
            merged = movies.merge_movies(before[name], staged[name], **options)
            return prepare({name: merged}, consume=[STAGES[name]])
        if name == "genre":
            merged = genres.merge_genres(before["genre"], staged["genre"], **options)
            pairs = genres.new_movie_genres(before["movie_genre"], staged["movie_genre"], **options)
            return prepare(
                {"genre": merged},
                append={"movie_genre": pairs},
                consume=[STAGES["movie_genre"], STAGES["genre"]],
            )
        if name == "date":
            merged = dates.merge_dates(before[name], staged[name], **options)
            return prepare({name: merged}, consume_if_exists=[STAGES[name]])
        if name == "ratings":
            reserve = partial(warehouse.reserve, name)
            merged = ratings.merge_ratings(before[name], staged[name], reserve=reserve, **options)
            return prepare({name: merged}, consume_if_exists=[STAGES[name]])
    raise KeyError(name)


def merge_table(
    warehouse: Warehouse,
    name: str,
    on_violation: str = "fail",
    dedupe: bool | Mapping[str, list[str]] = False,
) -> None:
    """Merge the staging tables of one group into the warehouse and consume them.

    ``name`` is ``movies``, ``genre`` (with the bridge, one commit), ``date``,
    ``ratings`` or ``budgetrevenue``.  ``dedupe`` keeps one row per duplicate source
    key instead of raising: the one with the smallest values in the columns it names for
    the table, else in the updated columns.
    """
    merge_all(warehouse, [name], on_violation, dedupe)


#: Merge group -> the tables it publishes in one commit.
MERGES = {
    "genre": ("genre", "movie_genre"),
    "date": ("date",),
    "ratings": ("ratings",),
    "movies": ("movies",),
    "budgetrevenue": ("budgetrevenue",),
}


def merge_all(
    warehouse: Warehouse,
    names: Iterable[str] | None = None,
    on_violation: str = "fail",
    dedupe: bool | Mapping[str, list[str]] = False,
) -> None:
    """Merge several groups (default: all staged ones) side by side; they share no table.

    The staged rows of all groups are checked before the first is merged.  A group consumes
    its batches in the commit that publishes it, so after a failure a second call merges just
    what is left.
    """
    names = staged_groups(warehouse) if names is None else list(names)
    if not names:
        return
    spark = warehouse.spark
    with Scratch(spark) as scratch:
        ready: list[Settled] = []

        def settle(name: str) -> None:
            ready.append(settle_group(warehouse, scratch, name, on_violation, dedupe))

        def merge(settled: Settled) -> None:
            warehouse.commit(prepare_merge(warehouse, settled))

        try:
            _side_by_side(spark, [partial(settle, n) for n in names])
        except BaseException:
            warehouse.abandon(*[r.made for r in ready if r.made is not None])
            raise
        _side_by_side(spark, [partial(merge, r) for r in ready])


def run_all(
    spark: SparkSession,
    input: str,
    output: str,
    warehouse_root: str,
    required: str = "output",
    on_violation: str = "fail",
    dedupe: bool | Mapping[str, list[str]] = False,
    rating_type: T.DecimalType = RATING_TYPE,
    dialects: Mapping[str, str] | None = None,
    jdbc: Mapping[str, object] | None = None,
    database: str | None = None,
    rejects: bool = False,
) -> Warehouse:
    """Create what is missing, clean all sources, merge everything.

    Refuses to stage on top of an unfinished load; ``merge_all`` finishes that one.  A load that
    failed before anything was staged can be called again with the same arguments and goes on
    after the jobs that had finished.  With ``database`` the tables are also views there.
    """
    warehouse = Warehouse(spark, warehouse_root, warehouse_specs(rating_type), database)
    require_nothing_staged(warehouse)
    warehouse.create_if_absent()
    stage_clean(warehouse, run_cleaning(spark, input, output, required, dialects, jdbc, True, rejects))
    close_output(spark, output)
    merge_all(warehouse, on_violation=on_violation, dedupe=dedupe)
    return warehouse

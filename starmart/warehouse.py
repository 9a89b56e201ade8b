"""Versioned Parquet tables that change together or not at all.

A table is a list of immutable Parquet folders.  Publishing writes new folders and then claims
the next commit (``commits``); the commit names the new folders of every table in the publish,
so its appearance is the publish.  A failure before it leaves folders nobody refers to and the
old versions readable.

A table with a ``part_key`` lies in folders by ranges of that key, and a publish can replace
some of them and list the others unchanged.  A table with ``buckets`` lies in files by the hash
of its ``dist_key``; it is read through the session's catalog, so that joins on that key take
the buckets as they lie.  With ``database`` every table is also a view there.
"""

from __future__ import annotations

import hashlib
import time
import uuid
from bisect import bisect_right
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from starmart.commits import Change, CommitLog, Entry, PublishConflict
from starmart.operators.layout import (
    by_bucket,
    join_in_place,
    part_of,
    quantiles,
    replicated,
    require_even_files,
    write_bucketed,
)
from starmart.operators.metrics import collected
from starmart.schemas import TableSpec, warehouse_specs
from starmart.sources.files import delete, file_sizes, folder_bytes, list_paths
from starmart.sources.parquet import read_parquet, write_parquet

__all__ = ["Entry", "PublishConflict", "Prepared", "Warehouse"]

_PART, _RUN = "__part", "__run"


@dataclass
class Prepared:
    """Written folders and what a commit of them would change; nothing of it counts yet."""

    base: Mapping[str, Entry]
    changes: dict[str, Change] = field(default_factory=dict)
    counters: dict[str, int] = field(default_factory=dict)
    written: list[str] = field(default_factory=list)


class Warehouse:
    def __init__(
        self,
        spark: SparkSession,
        root: str,
        specs: Mapping[str, TableSpec] | None = None,
        database: str | None = None,
    ) -> None:
        self.spark = spark
        self.root = root.rstrip("/")
        self.specs = dict(warehouse_specs() if specs is None else specs)
        self.database = database
        self.log = CommitLog(spark, self.root)
        self._catalog = "starmart_" + hashlib.sha256(self.root.encode()).hexdigest()[:12]

    # -- state -----------------------------------------------------------------

    def snapshot(self) -> dict[str, Entry]:
        """The current version of every table, from the last summary and the commits since."""
        return self.log.state().tables

    def exists(self, name: str) -> bool:
        entry = self.snapshot().get(name)
        return entry is not None and entry.live

    def staged(self, name: str, state: Mapping[str, Entry] | None = None) -> bool:
        """Whether a staging table holds batches."""
        entry = (self.snapshot() if state is None else state).get(name)
        return entry is not None and entry.live and bool(entry.folders)

    def read(
        self, name: str, state: Mapping[str, Entry] | None = None, parts: Sequence[int] | None = None
    ) -> DataFrame:
        """The published rows; an empty frame for a table that was only created.

        With ``state``, an earlier ``snapshot()``, the rows as of that snapshot; with ``parts``
        only those parts' rows.
        """
        entry = (self.snapshot() if state is None else state).get(name)
        if entry is None or not entry.live:
            raise KeyError(f"no table {name!r} in {self.root}")
        folders = [f for f in entry.folders if parts is None or f[0] in parts]
        if not folders:
            columns = [F.lit(None).cast(f.dataType).alias(f.name) for f in entry.schema.fields]
            return self.spark.range(1).where(F.lit(False)).select(*columns)
        if not entry.buckets or self._crowded(name, entry, folders):
            return read_parquet(self.spark, *[path for _, path in folders], schema=entry.schema)
        rows = self.spark.table(self._cataloged(name, entry))
        if parts is not None:
            rows = rows.where(F.col(_PART).isin(*parts))
        return rows.select(*[F.col(_quote(f.name)) for f in entry.schema.fields])

    def _crowded(self, name: str, entry: Entry, folders: Sequence[tuple[int, str]]) -> bool:
        """Whether a bucket of these folders is too much for one task of a join; Spark then shuffles."""
        spec = self.specs.get(name)
        most = spec.join_bytes if spec is not None else TableSpec.join_bytes
        return sum(folder_bytes(self.spark, path) for _, path in folders) > entry.buckets * most

    def dimension(self, name: str) -> DataFrame:
        """The table for joining; a replicated one is broadcast if it measures small enough."""
        spec = self.specs[name]
        return replicated(self.read(name)) if spec.replicated else self.read(name)

    def touched(self, name: str, source: DataFrame, state: Mapping[str, Entry] | None = None) -> list[int] | None:
        """The parts the source's keys fall in: all that a merge of it needs to read and replace.

        None for a table without parts.  At most one number per part reaches the driver.
        """
        entry = (self.snapshot() if state is None else state).get(name)
        if entry is None or entry.part_key is None:
            return None
        if not entry.bounds:
            return [0]
        kind = entry.schema[entry.part_key].dataType
        part = part_of(F.col(_quote(entry.part_key)).cast(kind), kind, entry.bounds)
        return sorted(r[0] for r in source.select(part).distinct().collect())

    # -- catalog ---------------------------------------------------------------

    def register(self, database: str | None = None) -> None:
        """Create the database and a view of every table in it; each publish renews them."""
        self.database = database or self.database
        if self.database is None:
            raise ValueError("no database named")
        self._show(self.snapshot())

    def _show(self, entries: Mapping[str, Entry]) -> None:
        if self.database is None:
            return
        base = _quote(self.database)
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {base} LOCATION '{_text(self.root)}/_views'")
        for name, entry in entries.items():
            view = f"{base}.{_quote(name)}"
            if entry.live:
                columns = ", ".join(_quote(c) for c in entry.schema.names)
                self.spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT {columns} FROM {self._cataloged(name, entry)}")
            else:
                self.spark.sql(f"DROP VIEW IF EXISTS {view}")

    def _cataloged(self, name: str, entry: Entry) -> str:
        """The catalog table of one version, made when first asked for: its partitions are the folders."""
        base, table = _quote(self._catalog), f"{_quote(self._catalog)}.{_quote(f'{name}_v{entry.version}')}"
        if self.spark.catalog.tableExists(table):
            return table
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {base} LOCATION '{_text(self.root)}/_catalog'")
        columns = ", ".join(f"{_quote(f.name)} {f.dataType.simpleString()}" for f in entry.schema.fields)
        key = _quote(entry.dist_key) if entry.buckets else ""
        clustered = f"CLUSTERED BY ({key}) SORTED BY ({key}) INTO {entry.buckets} BUCKETS" if key else ""
        where = f"{_text(self.root)}/_catalog/{_text(name)}_v{entry.version}"
        new = f"{table[:-1]}_{uuid.uuid4().hex}`"
        self.spark.sql(
            f"CREATE TABLE {new} ({columns}, {_PART} INT, {_RUN} INT) USING parquet "
            f"PARTITIONED BY ({_PART}, {_RUN}) {clustered} LOCATION '{where}'"
        )
        for at in range(0, len(entry.folders), 200):
            runs = enumerate(entry.folders[at : at + 200], at)
            adds = " ".join(f"PARTITION ({_PART}={p}, {_RUN}={i}) LOCATION '{_text(path)}'" for i, (p, path) in runs)
            self.spark.sql(f"ALTER TABLE {new} ADD {adds}")
        try:
            # Whole or not at all: another thread may make the same one.
            self.spark.sql(f"ALTER TABLE {new} RENAME TO {table}")
        except Exception:
            self.spark.sql(f"DROP TABLE IF EXISTS {new}")
            if not self.spark.catalog.tableExists(table):
                raise
        return table

    def export_bucketed(self, name: str, table: str, buckets: int, max_skew: float | None = 4.0) -> None:
        """Copy a distributed table to a catalog table of its own, bucketed by its distribution key."""
        path = f"{self.root}/_exports/{table}-{uuid.uuid4().hex}"
        write_bucketed(self.read(name), table, path, buckets, self.specs[name].dist_key, max_skew=max_skew)

    # -- changes ---------------------------------------------------------------

    def create_if_absent(self) -> list[str]:
        """Declare every missing table, empty; the names that were missing."""
        have = self.snapshot()
        new = [s for s in self.specs.values() if s.name not in have or not have[s.name].live]
        if new:
            changes = {s.name: Change(True, s.schema, reset=True, layout=self._layout(s.name)) for s in new}
            self.commit(Prepared(have, changes))
        return [s.name for s in new]

    def stage(self, name: str, df: DataFrame) -> None:
        """Append a batch to a staging table, creating it if absent."""
        self.publish(append={name: df})

    def stage_files(self, batches: Mapping[str, tuple[str, object]]) -> None:
        """Append stored Parquet datasets (path, schema) to staging tables, without copying.

        The first batch decides the columns.
        """
        have = self.snapshot()
        changes = {}
        for name, (path, schema) in batches.items():
            first = not self.staged(name, have)
            kept = schema if first else have[name].schema
            changes[name] = Change(True, kept, ((0, path),), reset=first)
        self.commit(Prepared(have, changes))

    def drop(self, name: str, if_exists: bool = False) -> None:
        self.publish(consume=() if if_exists else (name,), consume_if_exists=(name,) if if_exists else ())

    def publish(
        self,
        replace: Mapping[str, DataFrame] | None = None,
        append: Mapping[str, DataFrame] | None = None,
        consume: Iterable[str] = (),
        consume_if_exists: Iterable[str] = (),
        state: Mapping[str, Entry] | None = None,
        parts: Mapping[str, Sequence[int] | None] | None = None,
    ) -> None:
        """Give tables new contents and drop staging tables, in one commit.

        ``replace`` frames become the whole table, or with ``parts`` (see ``touched``) those
        parts of it, and may read the old version.  ``append`` frames are added; stored rows
        are not rewritten.  ``consume`` raises for a table that is not there,
        ``consume_if_exists`` does not.  ``state`` is the snapshot the frames were built from:
        if another publish has changed one of the tables since, this one raises
        ``PublishConflict`` and changes nothing.
        """
        self.commit(self.prepare(replace, append, consume, consume_if_exists, state, parts))

    def prepare(
        self,
        replace: Mapping[str, DataFrame] | None = None,
        append: Mapping[str, DataFrame] | None = None,
        consume: Iterable[str] = (),
        consume_if_exists: Iterable[str] = (),
        state: Mapping[str, Entry] | None = None,
        parts: Mapping[str, Sequence[int] | None] | None = None,
    ) -> Prepared:
        """As ``publish``, up to the commit: ``commit`` or ``abandon`` comes next."""
        have = self.snapshot() if state is None else state

        def live(name: str) -> bool:
            return name in have and have[name].live

        missing = [name for name in consume if not live(name)]
        if missing:
            raise KeyError(f"no table {missing} in {self.root}")
        made = Prepared(have)
        try:
            with join_in_place(self.spark):
                for name, df in (replace or {}).items():
                    chosen = (parts or {}).get(name)
                    if chosen is not None and live(name):
                        self._replace_parts(made, name, df, list(chosen))
                    else:
                        layout = self._layout(name)
                        made.changes[name] = Change(True, df.schema, self._write(made, name, df, layout), True, (), layout)
                for name, df in (append or {}).items():
                    old = have[name] if live(name) else None
                    if old is not None:
                        df = df.select(*[F.col(_quote(f.name)).cast(f.dataType) for f in old.schema.fields])
                    layout = self._layout(name) if old is None else _layout(old)
                    folders = self._write(made, name, df, layout)
                    made.changes[name] = Change(True, df.schema, folders, old is None, (), layout)
        except BaseException:
            self.abandon(made)
            raise
        for name in [*consume, *consume_if_exists]:
            if live(name):
                made.changes[name] = Change(False, have[name].schema, reset=True)
        return made

    def commit(self, made: Prepared) -> None:
        """Let prepared changes count, all at once."""
        if not made.changes:
            return
        try:
            state = self.log.commit(made.changes, made.base, made.counters)
        except PublishConflict:
            self.abandon(made)
            raise
        self._show({n: state.tables[n] for n in made.changes})

    def abandon(self, *prepared: Prepared) -> None:
        """Delete what was written for changes that will not count."""
        for made in prepared:
            for path in made.written:
                delete(self.spark, path)

    def relayout(self, name: str) -> None:
        """Cut the parts of a table that have outgrown ``part_bytes``; the others stay as they are."""
        state = self.snapshot()
        large = list(self._outgrown(name, state[name], range(len(state[name].bounds) + 1)))
        if large:
            self.publish({name: self.read(name, state, large)}, state=state, parts={name: large})

    def reserve(self, table: str, n: int) -> int:
        """The first of ``n`` surrogate keys that no other writer gets; no row is read.

        The mark is kept by the commits: every publish of the table raises it to its highest
        key.  Numbers reserved for a publish that then fails are not used again.
        """
        return self.log.advance(f"{table}.{self.specs[table].surrogate}", n)

    # -- lifetime --------------------------------------------------------------

    def stale_paths(self) -> DataFrame:
        """Folders (``path``) below the tables that no current version refers to."""
        rows = [(p,) for p, _ in self._unused()]
        return self.spark.createDataFrame(rows, "path string")

    def vacuum(self, hours: float) -> list[str]:
        """Delete what no current version refers to and has not changed for ``hours``; the paths.

        That is: superseded folders, those of publishes that failed, and commits covered by the
        last summary.  Choose ``hours`` longer than any load or reader of an old snapshot runs.
        Batches staged in place lie outside the warehouse and stay.
        """
        before = (time.time() - 3600 * hours) * 1000
        gone = [p for p, t in self._unused() if t < before]
        for p in gone:
            delete(self.spark, p)
        return gone + self.log.forget(before)

    def _unused(self) -> list[tuple[str, int]]:
        """(path, time) of the written folders, or of single parts of them, that are not referred to."""
        used = {p for e in self.snapshot().values() for p in e.paths}
        found = []
        for table, _ in list_paths(self.spark, self.root):
            if table.rsplit("/", 1)[1].startswith("_"):
                continue
            for run, changed in list_paths(self.spark, table):
                if run in used:
                    continue
                inside = [(p, t) for p, t in list_paths(self.spark, run) if f"/{_PART}=" in p]
                left = [(p, t) for p, t in inside if p not in used]
                found += left if len(left) < len(inside) else [(run, changed)]
        return found

    # -- writing ---------------------------------------------------------------

    def _layout(self, name: str) -> tuple:
        spec = self.specs.get(name)
        if spec is None:
            return ((), None, None, 0)
        return ((), spec.part_key, spec.dist_key if spec.buckets else None, spec.buckets)

    def _outgrown(self, name: str, entry: Entry, parts: Iterable[int]) -> dict[int, int]:
        """Of these parts those with at least twice the bytes a part should have; how many parts each should be.

        What a part should have grows with a table that ``max_parts`` parts cannot hold otherwise: every
        part costs each version of the table some files, so their number must not grow with the rows.
        """
        spec = self.specs.get(name)
        if spec is None or entry.part_key is None:
            return {}
        sizes: dict[int, int] = {}
        for part, path in entry.folders:
            sizes[part] = sizes.get(part, 0) + folder_bytes(self.spark, path)
        share = max(spec.part_bytes, sum(sizes.values()) // spec.max_parts)
        return {p: sizes[p] // share for p in sorted(sizes) if p in parts and sizes[p] >= 2 * share}

    def _replace_parts(self, made: Prepared, name: str, df: DataFrame, parts: list[int]) -> None:
        """Write the new rows of some parts, cutting those that have outgrown their size."""
        old = made.base[name]
        df = df.select(*[F.col(_quote(f.name)).cast(f.dataType) for f in old.schema.fields])
        bounds = list(old.bounds)
        for part, n in self._outgrown(name, old, parts).items():
            stored = self.read(name, made.base, [part]).select(_quote(old.part_key))
            bounds += quantiles(stored, _quote(old.part_key), n)
        bounds = sorted(set(bounds))
        layout = (tuple(bounds), *_layout(old)[1:])
        # Untouched folders keep their rows and get the number of the part that begins where theirs did.
        place = {0: 0} | {i + 1: bisect_right(bounds, b) for i, b in enumerate(old.bounds)}
        kept = tuple((place[p], path) for p, path in old.folders if p not in parts)
        folders = self._write(made, name, df, layout)
        made.changes[name] = Change(True, old.schema, kept + folders, True, (), layout)

    def _write(self, made: Prepared, name: str, df: DataFrame, layout: tuple) -> tuple[tuple[int, str], ...]:
        """Write the rows as the layout says; the folders by part."""
        bounds, part_key, dist_key, buckets = layout
        path = f"{self.root}/{name}/{uuid.uuid4().hex}"
        made.written.append(path)
        spec = self.specs.get(name)
        seen = None
        if spec is not None and spec.surrogate in df.columns:
            seen = Observation()
            df = df.observe(seen, F.max(_quote(spec.surrogate)).alias("top"))
        by = []
        if bounds:
            by = [_PART]
            df = df.withColumn(_PART, part_of(F.col(_quote(part_key)), df.schema[part_key].dataType, bounds))
        if buckets:
            writer = by_bucket(df, buckets, [dist_key], *by).write.bucketBy(buckets, dist_key).sortBy(dist_key).mode("errorifexists").option("path", path)
            passing = f"{_quote('starmart_' + uuid.uuid4().hex)}"
            (writer.partitionBy(*by) if by else writer).saveAsTable(passing)
            self.spark.sql(f"DROP TABLE {passing}")
            require_even_files(file_sizes(self.spark, path), buckets, spec.max_skew, spec.skew_bytes)
        else:
            if spec is not None and spec.sort_by:
                # The task number cuts up a value that fills a third of the rows.
                df = df.withColumn("__task", F.spark_partition_id()).repartitionByRange(*by, _quote(spec.sort_by), "__task")
                df = df.drop("__task").sortWithinPartitions(*by, _quote(spec.sort_by))
            elif by:
                df = df.hint("rebalance", *by)
            if by:
                df.write.mode("errorifexists").partitionBy(*by).parquet(path)
            else:
                write_parquet(df, path)
        if seen is not None and (top := collected(seen).get("top")) is not None:
            counter = f"{name}.{spec.surrogate}"
            made.counters[counter] = max(made.counters.get(counter, 0), top + 1)
        if not by:
            return ((0, path),)
        mark = f"/{_PART}="
        return tuple((int(p.rsplit("=", 1)[1]), p) for p, _ in list_paths(self.spark, path) if mark in p)


def _layout(entry: Entry) -> tuple:
    return (entry.bounds, entry.part_key, entry.dist_key, entry.buckets)


def _quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _text(value: str) -> str:
    return value.replace("\\", "\\\\").replace("'", "\\'")

"""Where intermediate tables go, and how long they stay: a folder every executor can reach.

Each application writes below a folder of its own, ``<root>/starmart/<application>``.  What is
written inside a ``Scratch`` block, by ``materialize`` too, is deleted when the block ends; what
a returned frame still reads belongs to the block around it or, without one, stays until the
Python process ends.  ``remove_old`` deletes what killed applications left.
"""

from __future__ import annotations

import atexit
import gc
import tempfile
import time
import uuid
from contextvars import ContextVar

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession

from starmart.sources.files import delete, list_paths

_SETTING = "spark.checkpoint.dir"
_local: dict[str, tempfile.TemporaryDirectory] = {}
_roots: dict[str, SparkSession] = {}
_open: ContextVar[tuple[Scratch, ...]] = ContextVar("open", default=())


def is_local(spark: SparkSession) -> bool:
    return spark.conf.get("spark.master", "").startswith("local")


def scratch_root(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``.

    Only a local session without the setting gets a temporary folder of this
    process; on a cluster such a folder would not be shared, so that is an error.
    """
    configured = spark.conf.get(_SETTING, None)
    if configured:
        return configured.rstrip("/")
    if not is_local(spark) or spark.conf.get("spark.master").startswith("local-cluster"):
        raise ValueError(f"{_SETTING} must name a folder shared by all executors")
    if "dir" not in _local:
        _local["dir"] = tempfile.TemporaryDirectory(prefix="starmart-")
    return _local["dir"].name


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below the scratch root; never one that was used before."""
    own = f"{scratch_root(spark)}/starmart/{spark.sparkContext.applicationId}"
    _roots.setdefault(own, spark)
    return f"{own}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and continue from the files.

    Cuts the lineage: the written rows outlive any executor, and the frames built
    on them do not recompute ``df``.  Inside a ``Scratch`` block they go when it ends.
    """
    blocks = _open.get()
    if blocks:
        return blocks[-1].table(df, label)
    return _stored(df, scratch_path(df.sparkSession, label))


def _stored(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Scratch:
    """Intermediate tables of one computation, deleted when the block ends.

    ``with Scratch(spark) as scratch:`` write with ``scratch.table(df, label)``, drop one early
    with ``scratch.drop(df)``, and return ``scratch.result(df, label)``, which is written
    outside the block's reach.
    """

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self._around: tuple[Scratch, ...] = ()
        self._paths: list[tuple[str, DataFrame | None]] = []

    def __enter__(self) -> Scratch:
        self._around = _open.get()
        _open.set((*self._around, self))
        return self

    def __exit__(self, *_: object) -> None:
        _open.set(self._around)
        for path, _df in self._paths:
            delete(self.spark, path)
        self._paths.clear()

    def table(self, df: DataFrame, label: str) -> DataFrame:
        path = scratch_path(self.spark, label)
        self._paths.append((path, None))  # a failed write is deleted too
        out = _stored(df, path)
        self._paths[self._paths.index((path, None))] = (path, out)
        return out

    def drop(self, *tables: DataFrame) -> None:
        for df in tables:
            at = next(i for i, (_, held) in enumerate(self._paths) if held is df)
            delete(self.spark, self._paths.pop(at)[0])

    def release(self) -> None:
        """Let Spark delete the shuffle files of finished steps now.

        It does so when the driver collects garbage, which a driver with little to do does
        rarely; between the steps of a long job that keeps many times the input on disk.
        """
        gc.collect()
        self.spark._jvm.System.gc()

    def result(self, df: DataFrame, label: str) -> DataFrame:
        """Written outside the block's reach; a table of the block itself is handed over as it is."""
        for at, (path, held) in enumerate(self._paths):
            if held is df:
                del self._paths[at]
                if self._around:
                    self._around[-1]._paths.append((path, df))
                return df
        if self._around:
            return self._around[-1].table(df, label)
        return _stored(df, scratch_path(self.spark, label))


def remove_old(spark: SparkSession, hours: float) -> list[str]:
    """Delete the scratch folders of other applications not written to for ``hours``; their paths.

    An application's tables have folders of their own below its folder: the newest of them
    tells its age.  Choose ``hours`` longer than any job runs.
    """
    top = f"{scratch_root(spark)}/starmart"
    oldest = (time.time() - 3600 * hours) * 1000
    mine = spark.sparkContext.applicationId
    removed = []
    for path, changed in list_paths(spark, top):
        newest = max([changed, *[t for _, t in list_paths(spark, path)]])
        if path.rsplit("/", 1)[1] != mine and newest <= oldest:
            delete(spark, path)
            removed.append(path)
    return removed


def remove_own(spark: SparkSession) -> None:
    """Delete all scratch tables of this application; frames that read them can no longer run."""
    own = f"{scratch_root(spark)}/starmart/{spark.sparkContext.applicationId}"
    delete(spark, own)
    _roots.pop(own, None)


@atexit.register
def _at_exit() -> None:
    for own, spark in _roots.items():
        try:
            delete(spark, own)
        except (Py4JError, OSError, AttributeError, TypeError):
            pass  # the session is gone; remove_old() of a later one deletes the folder

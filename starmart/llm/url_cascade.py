"""URL filter: a cascade of Bloom filters with exact answers over a known universe of keys.

Level 0 holds the listed keys; level 1 the keys of the universe that level 0 takes for
listed; level 2 the listed keys that level 1 takes for those; and so on until a level is
empty.  A key's first level that turns it down says whether it is listed, for every key
of the universe without error.

The universe is dealt by hash into shards of about ``SHARD_KEYS`` distinct keys, one
cascade each, built in one task.  Rows are judged without a join, from cascades broadcast
in blocks of ``BLOCK_BYTES`` at most; a larger list takes more blocks, one pass each.

NULL keys are not listed.  Repeated keys are one key, listed if any of its rows is.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.llm.bits import mix
from starmart.llm.exprs import ascii_lower, col
from starmart.scratch import materialize

SHARD_KEYS = 100_000
BLOCK_BYTES = 32 << 20
_MOST_LEVELS = 200


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.coalesce(ascii_lower(F.regexp_extract(url, r"://([^/?#]*)", 1)), F.lit(""))


def path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def matching_rule(host: Column, path: Column, rules: dict[str, str]) -> Column:
    """The longest rule (``host/path``) whose host is the url's or a parent of it and whose path begins the url's.

    Of equally long rules the first in alphabetical order.
    """
    case = None
    for rule in sorted(rules, key=lambda r: (-len(r), r)):
        at, _, rest = rule.partition("/")
        fits = ((host == at) | host.endswith("." + at)) & path.startswith("/" + rest)
        case = F.when(fits, rule) if case is None else case.when(fits, rule)
    return F.lit(None).cast("string") if case is None else case


def _places(h1: np.ndarray, h2: np.ndarray, level: int, bits: int, k: int) -> np.ndarray:
    a, b = mix(h1, 2 * level + 1), mix(h2, 2 * level + 2) | np.uint64(1)
    with np.errstate(over="ignore"):
        return (a[:, None] + b[:, None] * np.arange(k, dtype=np.uint64)) % np.uint64(bits)


def _held(level: tuple[int, int, np.ndarray], number: int, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    bits, k, found = level
    at = _places(h1, h2, number, bits, k)
    return ((found[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1).all(axis=1)


def build_cascade(h1: np.ndarray, h2: np.ndarray, listed: np.ndarray) -> bytes:
    """The cascade of a shard's keys, as bytes: per level bits, hashes, filter."""
    inside, outside = np.flatnonzero(listed), np.flatnonzero(~listed)
    if not inside.size:
        return b""
    parts: list[bytes] = []
    hold, test = inside, outside
    # of the other keys let through as many as the later levels, at half a chance each, tell apart cheapest
    rate = min(0.5, inside.size / (math.sqrt(2) * max(1, outside.size)))
    for level in range(_MOST_LEVELS):
        k = max(1, round(-math.log2(rate)))
        bits = max(64, math.ceil(hold.size * k / math.log(2)))
        found = np.zeros(bits, dtype=np.uint8)
        found[_places(h1[hold], h2[hold], level, bits, k).astype(np.int64).ravel()] = 1
        packed = np.packbits(found, bitorder="little")
        parts += [np.array([bits, k], dtype="<i8").tobytes(), packed.tobytes()]
        hold, test = test[_held((bits, k, packed), level, h1[test], h2[test])], hold
        if not hold.size:
            return b"".join(parts)
        rate = 0.5
    raise ValueError("two different keys have the same hashes")


def judge_cascade(cascade: bytes, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    """Which keys are listed: those whose first refusing level is odd."""
    refused, live, at, level = np.zeros(h1.size, np.int64), np.arange(h1.size), 0, 0
    while at < len(cascade):
        bits, k = (int(x) for x in np.frombuffer(cascade, "<i8", 2, at))
        size = -(-bits // 8)
        live = live[_held((bits, k, np.frombuffer(cascade, np.uint8, size, at + 16)), level, h1[live], h2[live])]
        at, level = at + 16 + size, level + 1
        refused[live] = level
    return refused % 2 == 1


def _hashes(key: Column) -> list[Column]:
    return [F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(1), key).alias("h2")]


def cascades(keys: DataFrame) -> tuple[DataFrame, int]:
    """From ``key, listed`` the table ``shard, cascade`` and the number of shards."""
    known = keys.where("key IS NOT NULL").groupBy("key").agg(F.max("listed").alias("listed"))
    known = materialize(known.select(*_hashes(F.col("key")), "listed"), "url-keys")
    shards = max(1, math.ceil(known.count() / SHARD_KEYS))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True))
        for shard, group in groupby(rows, key=lambda r: r[0]):
            _, h1, h2, listed = zip(*group, strict=True)
            made = build_cascade(*(np.array(h, dtype=np.int64).view(np.uint64) for h in (h1, h2)), np.array(listed, bool))
            yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([made], pa.binary())], names=["shard", "cascade"])

    dealt = known.select(F.pmod("h1", F.lit(shards)).cast("int").alias("shard"), "h1", "h2", "listed")
    made = dealt.repartition(shards, "shard").sortWithinPartitions("shard").mapInArrow(build, "shard int, cascade binary")
    return materialize(made, "url-cascades"), shards


def with_listed(df: DataFrame, key: Column, made: DataFrame, shards: int, name: str = "listed") -> DataFrame:
    """``df`` with a column that tells whether the key is listed."""
    spark = df.sparkSession
    sizes = made.select(F.coalesce(F.max(F.octet_length("cascade")), F.lit(1)).alias("most")).first()
    per_block = max(1, BLOCK_BYTES // max(1, sizes["most"]))
    df = df.select("*", *[h.alias(f"__{i}") for i, h in enumerate(_hashes(key))], key.isNull().alias("__none"), F.lit(False).alias(name))
    schema = T.StructType(df.schema.fields)
    for low in range(0, shards, per_block):
        part = made.where(F.col("shard").between(low, low + per_block - 1))
        block = spark.sparkContext.broadcast({r["shard"]: bytes(r["cascade"]) for r in part.collect()})

        def judge(batches: Iterator[pa.RecordBatch], block=block) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                h1, h2 = (batch.column(f"__{i}").to_numpy() for i in (0, 1))
                none, listed = (batch.column(n).to_numpy(zero_copy_only=False) for n in ("__none", name))
                shard, listed = h1 % shards, listed.copy()
                for s in np.unique(shard):
                    if (cascade := block.value.get(int(s))) is not None:
                        rows = np.flatnonzero(shard == s)
                        listed[rows] = judge_cascade(cascade, h1[rows].view(np.uint64), h2[rows].view(np.uint64)) & ~none[rows]
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(listed)], names=schema.names)

        df = df.mapInArrow(judge, schema)
    return df.drop("__0", "__1", "__none")


def judge(
    pages: DataFrame,
    listed: Column,
    rules: dict[str, str],
    *,
    page_id: str = "page_id",
    url: str = "url",
) -> DataFrame:
    """Per page: host, path, the rule that fits best, and the verdict: the rule's, else block if its key is listed.

    A page's key is host and path; pages without a host have none.  ``listed`` tells which
    rows of ``pages`` put their key on the list.
    """
    u = col(pages, url)
    slim = pages.select(col(pages, page_id).alias("page_id"), host(u).alias("host"), path(u).alias("path"), F.coalesce(listed, F.lit(False)).alias("lists"))
    key = F.when(F.col("host") != "", F.concat("host", "path"))
    made, shards = cascades(slim.select(key.alias("key"), F.col("lists").alias("listed")))
    told = with_listed(slim.select("page_id", "host", "path"), key, made, shards)
    rule = matching_rule(F.col("host"), F.col("path"), rules)
    verdict = F.when(F.col("listed"), "block").otherwise("allow")
    for name, said in rules.items():
        verdict = F.when(F.col("rule") == name, said).otherwise(verdict)
    return told.withColumn("rule", rule).select("page_id", "host", "path", "rule", verdict.alias("verdict"), "listed")

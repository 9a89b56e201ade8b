"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

Rows and virtual nodes have places on a ring of 64-bit hashes; a row's home is the next
node clockwise.  A full shard's surplus goes on clockwise to the next nodes' shards.  The
loads are as tight as can be: shards hold n/shards rows, the first n mod shards one more,
so counts are at most one apart.

Only counts move: how many rows each arc of the ring has decides how many of them stay and
where the others go, a plan of at most nodes x shards entries.  A row finds its shard and
slot from its rank in its arc.  Arcs are cut into hash buckets, so that no window has more
than one bucket's rows.

A row's place comes from its id and text, so rows that share one of these are spread;
wholly equal rows are interchangeable.  NULL texts are empty; NULL ids are ids like others.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.llm.exprs import col
from starmart.scratch import materialize

#: Rows that a window's group has on average.
BUCKET_ROWS = 200_000


def ring(shards: int, nodes: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the virtual nodes in order, as signed 64-bit numbers, and their shards."""
    places = [
        (int.from_bytes(hashlib.sha256(f"shard {s} node {v}".encode()).digest()[:8], "big", signed=True), s)
        for s in range(shards)
        for v in range(nodes)
    ]
    places.sort()
    return np.array([p for p, _ in places], dtype=np.int64), np.array([s for _, s in places], dtype=np.int64)


def settle(counts: np.ndarray, owner: np.ndarray, shards: int) -> list[tuple[int, int, int]]:
    """(arc, shard, rows) in the order in which an arc's rows are dealt out.

    First every arc's rows go home, arcs in ring order; then the surplus of all arcs tries
    the next node clockwise, and so on round the ring.
    """
    total = int(counts.sum())
    room = np.full(shards, total // shards, dtype=np.int64)
    room[: total % shards] += 1
    left, dealt = counts.astype(np.int64).copy(), []
    for hop in range(counts.size):
        for arc in np.flatnonzero(left):
            shard = int(owner[(arc + hop) % counts.size])
            if take := min(int(left[arc]), int(room[shard])):
                dealt.append((int(arc), shard, take))
                left[arc] -= take
                room[shard] -= take
        if not left.any():
            break
    return dealt


def assign(docs: DataFrame, *, shards: int = 8, nodes: int = 128, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row's id, size, checksum, shard and slot; slots of a shard have no gaps."""
    spark = docs.sparkSession
    places, owner = ring(shards, nodes)
    t = F.coalesce(col(docs, text), F.lit(""))
    slim = docs.select(
        col(docs, doc_id).alias("doc_id"), (F.octet_length(t) + 1).cast("long").alias("size"), F.crc32(t.cast("binary")).alias("text_crc32")
    )
    slim = slim.withColumn("place", F.xxhash64("doc_id", "text_crc32", "size"))

    def home(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            arc = np.searchsorted(places, batch.column("place").to_numpy()) % places.size
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(arc.astype(np.int32))], names=[*batch.schema.names, "arc"])

    schema = T.StructType([*slim.schema.fields, T.StructField("arc", T.IntegerType())])
    placed = materialize(slim.mapInArrow(home, schema), "ring-places")
    cuts = max(1, -(-placed.count() // (BUCKET_ROWS * places.size)))
    placed = placed.withColumn("cut", F.pmod(F.xxhash64("place", F.lit(1)), F.lit(cuts)).cast("int"))
    counts = materialize(placed.groupBy("arc", "cut").agg(F.count("*").alias("n")), "ring-counts")
    per_arc = np.zeros(places.size, dtype=np.int64)
    for r in counts.groupBy("arc").agg(F.sum("n").alias("n")).collect():
        per_arc[r["arc"]] = r["n"]
    first, used = np.zeros(places.size, dtype=np.int64), np.zeros(shards, dtype=np.int64)
    plan: dict[int, list[tuple[int, int, int]]] = {}
    for arc, shard, n in settle(per_arc, owner, shards):
        plan.setdefault(arc, []).append((int(first[arc]), shard, int(used[shard])))
        first[arc] += n
        used[shard] += n
    dealt = spark.sparkContext.broadcast({a: tuple(np.array(c, dtype=np.int64) for c in zip(*x, strict=True)) for a, x in plan.items()})
    before = Window.partitionBy("arc").orderBy("cut").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("arc", "cut", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    order = Window.partitionBy("arc", "cut").orderBy("place", "doc_id", "text_crc32", "size")
    ranked = placed.withColumn("rank", F.row_number().over(order) - 1).join(bases, ["arc", "cut"])
    ranked = ranked.select("doc_id", "size", "text_crc32", "arc", (F.col("base") + F.col("rank")).cast("long").alias("rank"))
    out = T.StructType([*ranked.schema.fields[:3], T.StructField("shard", T.IntegerType()), T.StructField("slot", T.LongType())])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            arc, rank = batch.column("arc").to_numpy(), batch.column("rank").to_numpy()
            shard, slot = np.empty(arc.size, np.int32), np.empty(arc.size, np.int64)
            for a in np.unique(arc):
                rows = np.flatnonzero(arc == a)
                begin, to, base = dealt.value[int(a)]
                at = np.searchsorted(begin, rank[rows], side="right") - 1
                shard[rows], slot[rows] = to[at], base[at] + rank[rows] - begin[at]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(shard), pa.array(slot)], names=out.names)

    return ranked.mapInArrow(deal, out)

"""Near duplicates by SimHash: an inverted index of byte positions with count filtering.

Two fingerprints of 64 bits that differ in at most three bits share at least five of their
eight bytes, each at its position.  Lists by one byte would hold a 256th of all fingerprints.
The index therefore lists fingerprints by the bytes at four positions, for fourteen sets of
four: taking positions as the points of a space of three bits, its fourteen planes.  Three
points lie in exactly one plane and the plane's complement is a plane, so whichever three
bytes differ, one listed plane has four of the equal ones.  Within a list the shared positional
bytes of each pair are tallied, pairs with five or more are kept, and their bits are compared.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.llm.components import components, forest
from starmart.llm.exprs import col
from starmart.llm.skew import attach
from starmart.scratch import Scratch

BYTES = 8
SEED = 42
#: The planes of three bits: positions whose product with a vector has one parity.
PLANES = [[p for p in range(BYTES) if (p & a).bit_count() % 2 == c] for a in range(1, BYTES) for c in (0, 1)]
#: Fingerprints scanned together; longer lists are split by a further byte, then into blocks.
BLOCK = 4096
_WORDS = 1 << 16


def fingerprint(text: bytes, n: int = 3) -> int:
    """Per bit, whether it is set in over half of the hashes of the shingles; 0 without words.

    Words are runs without ASCII white space, A-Z lower-cased; repeated shingles count each
    time, a text of fewer than ``n`` words is one shingle.  Memory is bounded by the text.
    """
    words = text.lower().split()  # of bytes: only ASCII is lower-cased, only ASCII space splits
    if not words:
        return 0
    if len(words) < n:
        words, n = [b" ".join(words)], 1
    total, ones = len(words) - n + 1, np.zeros(64, np.int64)
    digest, join = xxhash.xxh64_intdigest, b" ".join
    for at in range(0, total, _WORDS):
        part = words[at : at + _WORDS + n - 1]
        hashes = np.fromiter((digest(join(s), SEED) for s in zip(*[part[i:] for i in range(n)], strict=False)), np.uint64)
        ones += np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > total, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, n: int = 3, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``id, fingerprint`` (its 64 bits as a long) of every row, whole texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            marks = np.fromiter((fingerprint(t.as_py() or b"", n) for t in texts), np.uint64, len(texts))
            yield pa.record_batch([batch.column(0), pa.array(marks.view(np.int64))], names=["id", "fingerprint"])

    kind = docs.schema[id].dataType.simpleString()
    return docs.select(col(docs, id).alias("id"), col(docs, text).cast("string")).mapInArrow(run, f"id {kind}, fingerprint long")


def _byte(mark: str, position: int) -> Column:
    return F.shiftrightunsigned(F.col(mark), 8 * position).bitwiseAND(F.lit(255))


def _listed(classes: DataFrame) -> DataFrame:
    """Every fingerprint once per plane, with ``key``: the plane and its four bytes."""
    keys = []
    for i, plane in enumerate(PLANES):
        parts = [F.shiftleft(_byte("fingerprint", p), 8 * k) for k, p in enumerate(plane)]
        keys.append(reduce(lambda a, b: a.bitwiseOR(b), parts, F.lit(i << 32)))
    return classes.select(F.explode(F.array(*keys)).alias("key"), F.lit(-1).alias("byte"), "fingerprint", "id")


def _split(lists: DataFrame) -> DataFrame:
    """The members of long lists once per byte outside their plane.

    Their plane's bytes are equal and at most three bits differ, so one of the other four
    bytes is equal too.
    """
    outside = F.array(*[F.array(*[F.lit(p) for p in range(BYTES) if p not in plane]) for plane in PLANES])
    at = F.explode(F.element_at(outside, (F.shiftright("key", 32) + 1).cast("int")))
    by = lists.select("key", "fingerprint", "id", at.alias("p"))
    value = F.expr("shiftrightunsigned(fingerprint, p * 8) & 255")
    return by.select("key", (F.col("p") * 256 + value).cast("int").alias("byte"), "fingerprint", "id")


def _blocks(lists: DataFrame) -> DataFrame:
    """Members of still longer lists, dealt into blocks; every two blocks meet in one part."""
    n, mine = F.ceil(F.col("n") / BLOCK).cast("int"), F.expr("cast(pmod(xxhash64(fingerprint), ceil(n / %d)) as int)" % BLOCK)
    dealt = lists.select("*", n.alias("blocks"), mine.alias("mine"))
    met = dealt.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    return met.select("key", "byte", F.least("mine", "other").alias("low"), F.greatest("mine", "other").alias("high"), "mine", "fingerprint", "id")


def _first_shared() -> tuple[np.ndarray, np.ndarray]:
    """Per set of equal positions: the first plane within it, and per plane the first other one."""
    planes = np.array([sum(1 << p for p in plane) for plane in PLANES])
    masks = np.arange(256)
    within = (masks[:, None] & planes) == planes
    outside = np.array([[next((p for p in range(BYTES) if m >> p & 1 and not plane >> p & 1), -1) for plane in planes.tolist()] for m in masks.tolist()])
    return np.where(within.any(1), within.argmax(1), -1), outside


def _near(bits: int):
    """Of rows sorted by list: a forest of the pairs at ``bits`` or fewer, as Arrow batches."""
    least = BYTES - bits

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, outside = _first_shared()

        def scan(rows: pa.Table) -> Iterator[pa.RecordBatch]:
            cols = {c: rows[c].to_numpy() for c in ("key", "byte", "low", "high", "mine")}
            marks = rows["fingerprint"].to_numpy().view(np.uint64)
            new = np.ones(len(marks), bool)
            new[1:] = False
            for c in ("key", "byte", "low", "high"):
                new[1:] |= cols[c][1:] != cols[c][:-1]
            run_of = np.cumsum(new)
            a, b, have = [], [], 0
            left, step = np.arange(len(marks)), 0
            while len(left):
                step += 1
                left = left[left + step < len(marks)]
                left = left[run_of[left + step] == run_of[left]]
                i, j = left, left + step
                x = marks[i] ^ marks[j]
                equal = x.astype("<u8", copy=False).view(np.uint8).reshape(-1, BYTES) == 0
                keep = equal.sum(axis=1) >= least  # the tally of shared positional bytes
                i, j, x, equal = i[keep], j[keep], x[keep], equal[keep]
                keep = np.bitwise_count(x) <= bits
                i, j, equal = i[keep], j[keep], np.packbits(equal[keep], axis=1, bitorder="little")[:, 0]
                # A pair meets in several lists: it counts in the first, and in its own two blocks.
                plane, byte = (cols["key"][i] >> 32).astype(int), cols["byte"][i]
                keep = (first[equal] == plane) & ((byte < 0) | (byte >> 8 == outside[equal, plane]))
                keep &= (cols["low"][i] == cols["high"][i]) | (cols["mine"][i] != cols["mine"][j])
                a.append(i[keep])
                b.append(j[keep])
                have += int(keep.sum())
                if have > 1 << 20:
                    i, j = forest(np.concatenate(a), np.concatenate(b))
                    a, b, have = [i], [j], len(i)
            if have:
                i, j = forest(np.concatenate(a), np.concatenate(b))
                yield from pa.table({
                    "fa": rows["fingerprint"].take(i), "ia": rows["id"].take(i), "fb": rows["fingerprint"].take(j), "ib": rows["id"].take(j),
                }).to_batches()

        carry = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = rows if carry is None else pa.concat_tables([carry, rows]).combine_chunks()
            if not len(rows):
                continue
            last = np.ones(len(rows), bool)
            for c in ("key", "byte", "low", "high"):
                values = rows[c].to_numpy()
                last &= values == values[-1]
            cut = len(rows) - int(np.argmin(last[::-1])) if not last.all() else 0
            carry = rows.slice(cut)
            if cut:
                yield from scan(rows.slice(0, cut).combine_chunks())
        if carry is not None and len(carry):
            yield from scan(carry.combine_chunks())

    return run


def link(classes: DataFrame, scratch: Scratch, bits: int = 3) -> DataFrame:
    """``fa, ia, fb, ib``: links that join the same fingerprints as all pairs at ``bits`` or fewer.

    ``classes`` holds each ``fingerprint`` once with its ``id``.  Lists of up to ``BLOCK``
    fingerprints are scanned by one task.  Longer ones are split by a fifth byte, and what is
    still longer into blocks that meet in pairs; no list is cut short.
    """
    if not 0 <= bits <= 3:
        raise ValueError("the index is built for at most three differing bits")
    kind = dict(classes.dtypes)["id"]

    def long(lists: DataFrame, label: str) -> DataFrame:
        return scratch.table(lists.groupBy("key", "byte").agg(F.count("*").alias("n")).where(F.col("n") > BLOCK), label)

    whole = [F.lit(0).alias(c) for c in ("low", "high", "mine")]
    order = ["key", "byte", "low", "high"]
    lists = _listed(classes)
    hot = long(lists, "long-lists")
    parts = lists.join(hot, ["key", "byte"], "left_anti").select("key", "byte", *whole, "fingerprint", "id")
    if not hot.isEmpty():
        finer = scratch.table(_split(lists.join(hot, ["key", "byte"], "left_semi")), "split-lists")
        hotter = long(finer, "longer-lists")
        parts = parts.unionByName(finer.join(hotter, ["key", "byte"], "left_anti").select("key", "byte", *whole, "fingerprint", "id"))
        parts = parts.unionByName(_blocks(finer.join(hotter, ["key", "byte"])))
    return parts.repartition(*order).sortWithinPartitions(*order).mapInArrow(_near(bits), f"fa long, ia {kind}, fb long, ib {kind}")


def near_duplicates(docs: DataFrame, bits: int = 3, n: int = 3, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: ``id``, ``fingerprint`` (16 hex digits), ``component_id``.

    ``component_id`` is the smallest ``id`` among the rows that links at ``bits`` or fewer
    differing bits reach, the row itself included; ids that are NULL count last, so it is NULL
    only where all reached ones are.  NULL, empty and blank texts have fingerprint zero and
    link like any other; rows stay apart whatever ids repeat; other columns are ignored; an
    empty table gives no rows.  Equal fingerprints are one class: they are linked once.
    """
    spark = docs.sparkSession
    with Scratch(spark) as scratch:
        marked = scratch.result(fingerprints(docs, n, id, text), "fingerprints")
        classes = marked.groupBy("fingerprint").agg(F.min("id").alias("id"), F.count("*").alias("n"))
        classes = scratch.table(classes, "classes")
        total = marked.count()

        def node(i: str, f: str) -> Column:
            return F.struct(F.col(i).isNull().alias("none"), F.col(i).alias("id"), F.col(f).alias("fingerprint"))

        links = link(classes.drop("n"), scratch, bits).select(node("ia", "fa").alias("a"), node("ib", "fb").alias("b"))
        roots = components(links).select(F.col("node.fingerprint").alias("fingerprint"), F.col("root.id").alias("least"))
        linked = F.col("found").isNotNull()
        table = classes.join(roots.withColumn("found", F.lit(True)), "fingerprint", "left").select(
            "fingerprint", "n", F.when(linked, F.col("least")).otherwise(F.col("id")).alias("component_id")
        )
        table = scratch.result(table, "component-of")
        out = attach(marked, table, "fingerprint", "n", total)
        return out.select(F.col("id").alias(id), F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")

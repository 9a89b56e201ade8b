"""Removal of long repeated byte strings with a run-length index of the repeats.

A byte goes if it lies in a string of ``length`` bytes that also starts anywhere else in
the corpus, in the same text or another.  Strings never cross texts.

Every string of ``length`` bytes is assigned to the anchor in it: the run of ``length // 4``
bytes of least hash, the leftmost of equal ones.  Equal strings have equal anchors, so
neighbouring starts of one anchor form a *segment*, and repeats are only looked for
between segments of one anchor.  A segment that occurs twice is repeated throughout.
Anchors with several different segments are indexed: blocks of about ``BLOCK_BYTES`` hold
each such segment once, their Burrows-Wheeler transform is kept as runs with the suffix
positions of the run ends, and longest matches are streamed in text order, compared anew at
the sampled run ends only and one shorter from one position to the next elsewhere.
Segments of an anchor that has more than ``HOT_SEGMENTS`` are compared string by string
through a hash aggregation over all tasks instead, as they would not fit a block.

NULL and empty texts have no bytes.  Rows of equal text are repeats of each other; ids are
carried as they are.  Positions are those of the input, not of what is left.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.llm.exprs import col, packed
from starmart.scratch import materialize

BLOCK_BYTES = 1 << 20
HOT_SEGMENTS = 10_000
#: Starts of a text that are handled at a time.
_CHUNK = 1 << 20
_PLACE = np.uint64((1 << 21) - 1)
_BASE = 0x9E3779B97F4A7C15 | 1
#: Rows of one anchor that a task holds back at most.
_HELD = 500_000


def _mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    factors = np.full(n + 1, np.uint64(base))
    factors[0] = 1
    return np.cumprod(factors, dtype=np.uint64)


class Hasher:
    """Hashes of all strings of one length in a text, from sums over its prefixes."""

    def __init__(self, seed: int = 11):
        self._bytes = np.random.default_rng(seed).integers(0, 1 << 64, 256, dtype=np.uint64)
        self._up = self._down = np.ones(1, dtype=np.uint64)

    def sums(self, b: np.ndarray) -> np.ndarray:
        if self._up.size <= b.size:
            n = 1 << int(b.size).bit_length()
            with np.errstate(over="ignore"):
                self._up, self._down = (_powers(x, n) for x in (_BASE, pow(_BASE, -1, 1 << 64)))
        with np.errstate(over="ignore"):
            return np.concatenate([[np.uint64(0)], np.cumsum(self._bytes[b] * self._up[: b.size], dtype=np.uint64)])

    def between(self, sums: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return _mix((sums[b] - sums[a]) * self._down[a])


def _least(v: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every ``w`` neighbours."""
    n = v.size - w + 1
    padded = np.concatenate([v, np.full(-v.size % w, np.uint64(0xFFFFFFFFFFFFFFFF))]).reshape(-1, w)
    ahead = np.minimum.accumulate(padded, axis=1).ravel()
    behind = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[w - 1 : w - 1 + n])


def segments(b: np.ndarray, length: int, hasher: Hasher) -> list[tuple[np.ndarray, ...]]:
    """First start, number of starts, anchor and hash of every segment of a text."""
    found, k = [], max(1, length // 4)
    for low in range(0, b.size - length + 1, _CHUNK):
        part = b[low : low + _CHUNK + length - 1]
        sums = hasher.sums(part)
        at = np.arange(part.size - k + 1)
        grams = hasher.between(sums, at, at + k)
        anchor = (_least((grams & ~_PLACE) | at.astype(np.uint64), length - k + 1) & _PLACE).astype(np.int64)
        first = np.flatnonzero(np.diff(anchor, prepend=-1))
        starts = np.diff(np.append(first, anchor.size))
        hashes = hasher.between(sums, first, first + starts - 1 + length)
        with np.errstate(over="ignore"):
            hashes = hashes + _mix(starts.astype(np.uint64) * np.uint64(1024) + (anchor[first] - first).astype(np.uint64))
        found.append((first + low, starts, grams[anchor[first]], hashes))
    return found


class RunIndex:
    """A run-compressed Burrows-Wheeler transform with sampled run ends."""

    def __init__(self, text: np.ndarray):
        self.text = text
        order = self._suffixes(text)
        before = text[order - 1]
        change = np.flatnonzero(before[1:] != before[:-1]) + 1
        heads, tails = np.concatenate([[0], change]), np.append(change - 1, text.size - 1)
        zero = int(np.flatnonzero(order == 0)[0])  # where the text begins nothing comes before
        heads, tails = np.union1d(heads, [zero]), np.union1d(tails, [zero])
        if zero + 1 < text.size:
            heads = np.union1d(heads, [zero + 1])
        if zero:
            tails = np.union1d(tails, [zero - 1])
        self.runs = change.size + 1
        self._ends = [(order[x], np.where((x + o >= 0) & (x + o < text.size), order[np.clip(x + o, 0, text.size - 1)], -1)) for x, o in ((heads, -1), (tails, 1))]

    @staticmethod
    def _suffixes(text: np.ndarray) -> np.ndarray:
        """Suffix order by prefix doubling, from keys of seven symbols of nine bits."""
        n = text.size
        padded = np.concatenate([text.astype(np.int64) + 1, np.zeros(7, np.int64)])
        key = np.zeros(n, np.int64)
        for i in range(7):
            key = (key << 9) | padded[i : i + n]
        width = 7
        while True:
            order = np.argsort(key, kind="stable")
            ranks = np.cumsum(np.diff(key[order], prepend=-1) != 0)
            if ranks[-1] == n:
                return order
            rank = np.empty(n, np.int64)
            rank[order] = ranks
            key = rank * (n + 1)
            key[: n - width] += rank[width:] if width < n else 0
            width *= 2

    def _common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the longest common prefix of suffixes a and b; 0 where b is -1."""
        step = 32
        text = np.concatenate([self.text, np.arange(-1, -1 - step, -1, dtype=self.text.dtype)])
        found, live = np.zeros(a.size, np.int64), np.flatnonzero(b >= 0)
        while live.size:
            going = []
            for part in np.array_split(live, live.size // 50_000 + 1):
                x, y = (np.minimum(p[part] + found[part], self.text.size)[:, None] + np.arange(step) for p in (a, b))
                differ = text[np.minimum(x, text.size - 1)] != text[np.minimum(y, text.size - 1)]
                some = differ.any(axis=1)
                found[part] += np.where(some, differ.argmax(axis=1), step)
                going.append(part[~some])
            live = np.concatenate(going)
        return found

    def longest_matches(self) -> np.ndarray:
        """For every position, the longest string from there that starts elsewhere too."""
        best = np.zeros(self.text.size, np.int64)
        at = np.arange(self.text.size)
        for position, other in self._ends:
            order = np.argsort(position)
            position, other = position[order], other[order]
            reach = position + self._common(position, other)
            last = np.searchsorted(position, at, side="right") - 1
            best = np.maximum(best, reach[last] - at)
        return best


def _keys(text: Column) -> dict[str, Column]:
    """Rows of equal text have equal results; these two stand for a text."""
    return {"k1": F.xxhash64(text), "k2": F.coalesce(F.octet_length(text), F.lit(-1))}


_SEGMENT = "part long, anchor long, seg long, k1 long, k2 int, first int, starts int, n int"


def _segments(texts: DataFrame, length: int) -> DataFrame:
    """Every segment; of one that a batch has twice, all but one row are settled (n = 0)."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, seen = Hasher(), set()
        for batch in batches:
            found = []
            for k1, k2, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                if k2 < length or (k1, k2) in seen:  # equal texts are told by their number
                    continue
                if len(seen) >= 200_000:
                    seen.clear()
                seen.add((k1, k2))
                b = np.frombuffer(text.as_buffer(), dtype=np.uint8)
                for first, starts, anchor, seg in segments(b, length, hasher):
                    found.append((anchor.view(np.int64), seg.view(np.int64), np.full(first.size, k1), np.full(first.size, k2), first, starts))
            if not found:
                continue
            anchor, seg, k1, k2, first, starts = (np.concatenate(x) for x in zip(*found, strict=True))
            order = np.lexsort((seg, anchor))
            a, s = anchor[order], seg[order]
            new = np.concatenate([[True], (a[1:] != a[:-1]) | (s[1:] != s[:-1])])
            times = np.diff(np.append(np.flatnonzero(new), a.size))
            n = np.zeros(a.size, np.int64)
            n[new] = np.minimum(times, 2)
            part = np.where(n > 0, a, k1[order])
            columns = [pa.array(x) for x in (part, a, s, k1[order])]
            columns += [pa.array(x[order], pa.int32()) for x in (k2, first, starts)] + [pa.array(n, pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in _SEGMENT.split(", ")])

    return texts.mapInArrow(cut, _SEGMENT)


def _classified(segs: DataFrame) -> DataFrame:
    """Segments that may be repeated: ``full`` if certainly, ``index`` once per segment to compare."""
    names = ["anchor", "seg", "k1", "k2", "first", "starts", "n"]

    def classify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, several = None, False  # rows of the last anchor; whether it had other segments before

        def settle(rows: list[np.ndarray], several: bool) -> pa.RecordBatch | None:
            a, s, n = rows[0], rows[1], rows[6]
            same = np.concatenate([[False], (a[1:] == a[:-1]) & (s[1:] == s[:-1])])
            new_a = np.concatenate([[True], a[1:] != a[:-1]])
            group = np.cumsum(new_a) - 1
            kinds = np.bincount(group, weights=~same)
            if several:
                kinds[0] += 1
            many = kinds[group] > 1
            full = same | np.append(same[1:], False) | (n >= 2)
            keep = full | many
            if not keep.any():
                return None
            out = [pa.array(x[keep]) for x in rows[:6]] + [pa.array(x[keep]) for x in (full, many & ~same)]
            return pa.RecordBatch.from_arrays(out, names=names[:6] + ["full", "index"])

        for batch in batches:
            rows = [batch.column(x).to_numpy() for x in names]
            done = rows[6] == 0
            if done.any():
                out = [pa.array(x[done]) for x in rows[:6]]
                yes = np.ones(int(done.sum()), bool)
                yield pa.RecordBatch.from_arrays(out + [pa.array(yes), pa.array(~yes)], names=names[:6] + ["full", "index"])
                rows = [x[~done] for x in rows]
            if held is not None:
                rows = [np.concatenate(x) for x in zip(held, rows, strict=True)]
            if not rows[0].size:
                continue
            cut = int(np.searchsorted(rows[0], rows[0][-1]))
            if cut:
                if out := settle([x[:cut] for x in rows], several):
                    yield out
                several = False
            held = [x[cut:] for x in rows]
            if held[0].size > _HELD:
                low = int(np.searchsorted(held[1], held[1][-1]))
                if low:
                    if out := settle([x[:low] for x in held], True):
                        yield out
                    several = True
                held = [x[low:] for x in held]
                if held[0].size > 2:
                    extra = [x[2:] for x in held]
                    yes = np.ones(extra[0].size, bool)
                    out = [pa.array(x) for x in extra[:6]]
                    yield pa.RecordBatch.from_arrays(out + [pa.array(yes), pa.array(~yes)], names=names[:6] + ["full", "index"])
                    held = [x[:2] for x in held]
        if held is not None and held[0].size and (out := settle(held, several)):
            yield out

    dealt = segs.repartition(segs.sparkSession.sparkContext.defaultParallelism * 4, "part").sortWithinPartitions("anchor", "seg")
    return dealt.mapInArrow(classify, "anchor long, seg long, k1 long, k2 int, first int, starts int, full boolean, index boolean")


def _index_texts(found: DataFrame, texts: DataFrame, length: int) -> DataFrame:
    """The bytes of every segment to compare, or the hashes of its strings if its anchor is hot."""
    asked = found.where("index")
    hot = asked.groupBy("anchor").count().where(F.col("count") > HOT_SEGMENTS).select("anchor", F.lit(True).alias("hot"))
    asked = asked.join(hot, "anchor", "left").groupBy("k1", "k2").agg(
        F.collect_list(F.struct("anchor", "seg", "first", "starts", "full", F.coalesce("hot", F.lit(False)).alias("hot"))).alias("asked")
    )

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, seen = Hasher(29), set()
        for batch in batches:
            rows = []
            for k1, k2, asked, text in zip(*(batch.column(n) for n in ("k1", "k2", "asked", "text")), strict=True):
                key = (k1.as_py(), k2.as_py())
                if key in seen:
                    continue
                if len(seen) >= 200_000:
                    seen.clear()
                seen.add(key)
                text = memoryview(text.as_buffer())
                for s in asked.as_py():
                    b = bytes(text[s["first"] : s["first"] + s["starts"] - 1 + length])
                    hashes = None
                    if s["hot"]:
                        at = np.arange(s["starts"])
                        hashes, b = hasher.between(hasher.sums(np.frombuffer(b, np.uint8)), at, at + length).view(np.int64).tolist(), None
                    rows.append((s["anchor"], s["seg"], s["full"], b, hashes))
            if rows:
                kinds = (pa.int64(), pa.int64(), pa.bool_(), pa.binary(), pa.list_(pa.int64()))
                columns = [pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=["anchor", "seg", "full", "bytes", "hashes"])

    joined = texts.join(asked, ["k1", "k2"]).select("k1", "k2", "asked", "text")
    return joined.mapInArrow(fetch, "anchor long, seg long, full boolean, bytes binary, hashes array<long>")


def _indexed(parts: DataFrame, length: int) -> DataFrame:
    """``anchor, seg, marked``: starts of a segment's repeated strings, by a run-length index."""

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ((r[0], r[1], r[2], r[3]) for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True))
        block: list[tuple] = []
        size = 0
        for _, group in groupby(rows, key=lambda r: r[0]):
            own = list({r[1]: r for r in group}.values())
            if len(own) < 2 and not own[0][2]:
                continue
            block += own
            size += sum(len(r[3]) + 1 for r in own)
            if size >= BLOCK_BYTES:
                yield from settle(block)
                block, size = [], 0
        if block:
            yield from settle(block)

    def settle(block: list[tuple]) -> Iterator[pa.RecordBatch]:
        text = np.concatenate([np.append(np.frombuffer(r[3], np.uint8).astype(np.int32), 256) for r in block])
        long = RunIndex(text).longest_matches() >= length
        ends = np.cumsum([0, *(len(r[3]) + 1 for r in block)])
        out = []
        for r, at in zip(block, ends, strict=False):
            hit = np.flatnonzero(long[at : at + len(r[3]) - length + 1])
            if hit.size and not r[2]:
                out.append((r[0], r[1], hit.tolist()))
        if out:
            kinds = (pa.int64(), pa.int64(), pa.list_(pa.int32()))
            columns = [pa.array(x, k) for x, k in zip(zip(*out, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names=["anchor", "seg", "marked"])

    cold = parts.where("bytes IS NOT NULL").select("anchor", "seg", "full", "bytes")
    dealt = cold.repartition(parts.sparkSession.sparkContext.defaultParallelism * 4, "anchor").sortWithinPartitions("anchor", "seg")
    return dealt.mapInArrow(mark, "anchor long, seg long, marked array<int>")


def _compared(parts: DataFrame) -> DataFrame:
    """The same for hot anchors: every string meets its equals in an aggregation."""
    strings = parts.where("hashes IS NOT NULL").select("anchor", "seg", "full", F.posexplode("hashes").alias("at", "h"))
    twice = strings.groupBy("h").agg((F.max("full") | (F.min("seg") != F.max("seg"))).alias("twice")).where("twice").select("h")
    return strings.where("NOT full").join(twice, "h").groupBy("anchor", "seg").agg(F.array_sort(F.collect_set("at")).alias("marked"))


def repeats(texts: DataFrame, length: int) -> DataFrame:
    """``k1, k2, spans``: per text with repeats, (first start, number of starts, chosen starts or NULL)."""
    found = materialize(_classified(_segments(texts, length)), "segments")
    parts = materialize(_index_texts(found, texts, length), "segment-texts")
    marks = _indexed(parts, length).unionAll(_compared(parts))
    full = found.where("full").select("k1", "k2", "first", "starts", F.lit(None).cast("array<int>").alias("marked"))
    part = found.where("NOT full").join(marks, ["anchor", "seg"]).select("k1", "k2", "first", "starts", "marked")
    return full.unionAll(part).groupBy("k1", "k2").agg(F.collect_set(F.struct("first", "starts", "marked")).alias("spans"))


def covered(n: int, spans: list[dict], length: int) -> np.ndarray:
    """Which of a text's ``n`` bytes lie in a repeated string."""
    edge = np.zeros(n + 1, np.int64)
    for s in spans:
        if s["marked"] is None:
            edge[s["first"]] += 1
            edge[s["first"] + s["starts"] - 1 + length] -= 1
        else:
            at = s["first"] + np.asarray(s["marked"])
            edge[at] += 1
            edge[at + length] -= 1
    return np.cumsum(edge[:n]) > 0


def _with_repeats(rows: DataFrame, length: int) -> DataFrame:
    """``rows`` (row, k1, k2, text) with the ``spans`` and the number of rows ``same`` of each text."""
    texts = rows.select("k1", "k2", "text").where(F.col("k2") >= length)
    spans = repeats(texts, length).withColumns({"same": F.lit(1).cast("long")})
    twice = texts.groupBy("k1", "k2").agg(F.count("*").alias("same")).where("same > 1")
    none = F.lit(None).cast(spans.schema["spans"].dataType)
    told = spans.unionByName(twice.withColumn("spans", none)).groupBy("k1", "k2").agg(F.max("same").alias("same"), F.max_by("spans", F.col("spans").isNotNull()).alias("spans"))
    return rows.join(told, ["k1", "k2"], "left").select("row", "k2", "text", "spans", "same")


def _removed(text: bytes, spans: list[dict] | None, same: int | None, length: int) -> np.ndarray:
    if same and same > 1:
        return np.ones(len(text), bool)
    return covered(len(text), spans, length) if spans else np.zeros(len(text), bool)


def _prepared(docs: DataFrame, doc_id: str | None, text: str) -> DataFrame:
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    raw = col(docs, text)
    row = packed(docs, **_keys(raw), text=F.coalesce(raw, F.lit("")).cast("binary"))
    return row.withColumn("row", F.col("row").getField(doc_id)) if doc_id else row


def digest(docs: DataFrame, *, length: int = 200, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: its bytes, how many are removed in how many runs, and the hash of the rest."""
    found = _with_repeats(_prepared(docs, doc_id, text), length)
    schema = T.StructType(
        [T.StructField("doc_id", found.schema["row"].dataType)]
        + [T.StructField(n, T.LongType()) for n in ("n_bytes", "n_removed", "n_spans")]
        + [T.StructField("kept_sha256", T.StringType())]
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, spans, same in zip(*(batch.column(n) for n in ("text", "spans", "same")), strict=True):
                b = text.as_py()
                gone = _removed(b, spans.as_py(), same.as_py(), length)
                kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
                rows.append((len(b), int(gone.sum()), int(np.sum(gone[1:] & ~gone[:-1]) + gone[:1].sum()), hashlib.sha256(kept).hexdigest()))
            if rows:
                columns = [pa.array(x) for x in zip(*rows, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=schema.names)

    return found.mapInArrow(count, schema)


def drop_repeats(docs: DataFrame, *, length: int = 200, text: str = "text", size: str | None = None) -> DataFrame:
    """``docs`` with repeats cut out of the text; a character that is cut through goes whole.

    ``size`` names a column that holds the text's number of characters and is renewed.
    NULL stays NULL.
    """
    found = _with_repeats(_prepared(docs, None, text), length)
    schema = T.StructType([found.schema["row"], T.StructField("left", T.StringType())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left = []
            for text, spans, same in zip(*(batch.column(n) for n in ("text", "spans", "same")), strict=True):
                b = text.as_py()
                gone = _removed(b, spans.as_py(), same.as_py(), length)
                left.append(np.frombuffer(b, np.uint8)[~gone].tobytes().decode("utf-8", "ignore"))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(left, pa.string())], names=["row", "left"])

    done = found.mapInArrow(cut, schema)
    old = F.col("row").getField(text)
    new = F.when(old.isNotNull(), F.col("left"))
    fields = {text: new} | ({size: F.length(new).cast(docs.schema[size].dataType)} if size else {})
    names = [f.name for f in found.schema["row"].dataType.fields]
    return done.select(*[(fields[n] if n in fields else F.col("row").getField(n)).alias(n) for n in names])

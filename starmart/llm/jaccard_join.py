"""Exact Jaccard self-join on sets of word n-grams: a size-aware heavy-light join.

Equal sets are one set.  *Light* (small) sets enumerate the subsets that an intersection
with a partner could be, each of a fixed size; two light sets are linked exactly if some
enumerated subset shows it, and the set that misses least of a subset is linked to all
others that are linked through it, so one star per subset loses nothing.

*Heavy* (large) sets are found through inverted lists.  A list of a single n-gram would
hold every text with a common passage, so lists are kept by block: the n-grams are dealt
into blocks by hash, more blocks than the sets of a linked pair can differ in, so such a
pair has a block in common that is not empty.  The boundary between light and heavy is
where the counted cost of enumerating and listing, over the sizes that there are, is least.

A list is not expanded into pairs.  Its members are compared with one of them, the hub,
first by parity bitmaps, whose distance is at most that of the sets, then by the sets;
lists whose members then lie in one component are done.  The members of the others are
scanned in blocks of ``LIST_BLOCK`` by the same bitmaps, so that only pairs of different
components that may be linked come out; before that, up to ``HUB_ROUNDS`` further hubs
join components while there is much to scan.
Every link is decided on whole sets.  Lists are streamed, not gathered; only sizes up to
``LIGHT_MOST`` and a fixed-size filter of set numbers pass through the driver.

A text's words are cut and hashed once for its postings and its own row, which travel together.

NULL, empty and blank texts have empty sets, linked with nothing.  Repeated rows are
linked; NULL ids are never the smallest of a component unless all its ids are NULL.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, groupby
from math import comb

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from starmart.llm.bits import mix
from starmart.llm.components import components
from starmart.llm.exprs import col, packed, unpacked
from starmart.llm.skew import attach
from starmart.scratch import Scratch, materialize

#: Sizes above this are always heavy: a set of 20 has over a thousand subsets to try.
LIGHT_MOST = 19
HUB_ROUNDS = 4
#: Members of one hub that one task compares.
HUB_SHARE = 2_000
#: Members of a list that are scanned against as many others at a time.
LIST_BLOCK = 2_000
#: Lists of lower key that a member of a list carries.
LISTS_TOLD = 32
#: Cross-component pairs per list entry up to which open lists are scanned without a new hub.
_SCAN = 2_000
_FILTER_BITS = 1 << 26
#: Bytes of a text that counts as short.
_SHORT = 2_000
#: Code of a text's own row among the postings.
_DOC = 1 << 30


def shingles(text: bytes | None, n: int) -> np.ndarray:
    """Hashes of the different runs of ``n`` words, sorted; of the whole sequence if there are fewer words."""
    words = text.lower().split() if text else []  # of bytes: only ASCII is lower-cased, only ASCII space splits
    if not words:
        return np.empty(0, np.uint64)
    digest, join = xxhash.xxh64_intdigest, b" ".join
    if len(words) < n:
        return np.array([digest(join(words), 1)], np.uint64)
    runs = zip(*[words[i:] for i in range(n)], strict=False)
    return np.unique(np.fromiter((digest(join(r)) for r in runs), np.uint64, len(words) - n + 1))


def _texts(column: pa.Array, n: int) -> Iterator[np.ndarray]:
    for text in column.cast(pa.binary()):
        yield shingles(text.as_py(), n)


def _sets(column: pa.ListArray) -> Iterator[np.ndarray]:
    """Stored sets, which are sorted and hold no element twice."""
    values, at = column.values.to_numpy(zero_copy_only=False).view(np.uint64), column.offsets.to_numpy()
    for a, b in zip(at[:-1], at[1:], strict=True):
        yield values[a:b]


def _number(s: np.ndarray, seed: int) -> int:
    """64 bits that stand for a set."""
    return int(np.add.reduce(mix(s, seed), dtype=np.uint64))


def _signed(values: list[int] | np.ndarray) -> pa.Array:
    return pa.array(np.asarray(values, dtype=np.uint64).view(np.int64))


class Threshold:
    """Linked: 100 x intersection >= percent x union."""

    def __init__(self, percent: int):
        self.percent = percent
        self.miss = 100 - percent

    def linked(self, a: np.ndarray, b: np.ndarray) -> bool:
        both = np.intersect1d(a, b, assume_unique=True).size
        return 100 * both >= self.percent * (a.size + b.size - both)

    def may_link(self, a: np.ndarray, b: np.ndarray) -> bool:
        """The same of cut elements: what seems to be common is at least the intersection."""
        both = min(int(np.isin(a, b).sum()), int(np.isin(b, a).sum()))
        return 100 * both >= self.percent * (a.size + b.size - both)

    def may_miss(self, common: int) -> int:
        """What two linked sets with ``common`` elements in common may have besides, together."""
        return self.miss * common // self.percent

    def size_class(self, n: int) -> tuple[int, int, int]:
        """Number and bounds of the class of size ``n``; linked sizes lie in neighbouring classes."""
        c, low = 0, 1
        while (high := 100 * low // self.percent + 1) <= n:
            c, low = c + 1, high
        return c, low, high - 1

    def blocks(self, high: int) -> tuple[int, int]:
        """Blocks for pairs whose smaller set has up to ``high`` elements, and how many may be empty."""
        differ = self.miss * high // self.percent
        spare = 1 + -(-differ // 50)
        return differ + 1 + spare, spare


def _subsets(s: np.ndarray, t: Threshold) -> Iterator[tuple[int, int]]:
    """Key and code of each subset that can be the intersection; code: missing + 256 x may_miss."""
    n, mixed = s.size, mix(s, 3)
    total = np.add.reduce(mixed, dtype=np.uint64)
    for missing in range(t.miss * n // 100 + 1):
        room = t.may_miss(n - missing)
        if missing > room:
            continue
        size = int(mix(np.uint64([n - missing]), 5)[0])
        out = np.array([sum(map(int, x)) & 0xFFFFFFFFFFFFFFFF for x in combinations(mixed, missing)], dtype=np.uint64)
        with np.errstate(over="ignore"):
            keys = mix(total - out + np.uint64(size), 7)
        for key in keys:
            yield int(key), missing + 256 * room


def _block_keys(s: np.ndarray, t: Threshold) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the set's blocks in its own size class and the one below, and -1 - class of each."""
    found, codes = [], []
    c, low, high = t.size_class(s.size)
    for cls, top in ((c, high), (c - 1, low - 1)):
        if cls < 0:
            continue
        n, spare = t.blocks(top)
        block = (mix(s, 11 + cls) % np.uint64(n)).astype(np.int64)
        order = np.argsort(block, kind="stable")
        first = np.flatnonzero(np.diff(block[order], prepend=-1))
        at = block[order][first].astype(np.uint64)
        sums = np.add.reduceat(mix(s, 13)[order], first)
        if n - at.size > spare:  # so many empty blocks that a partner may agree on these alone
            empty = np.setdiff1d(np.arange(n, dtype=np.uint64), at)
            at, sums = np.concatenate([at, empty]), np.concatenate([sums, np.zeros(empty.size, np.uint64)])
        with np.errstate(over="ignore"):
            found.append(mix(sums + mix(at + np.uint64(cls << 32), 17), 19))
        codes.append(np.full(at.size, -1 - cls, dtype=np.int32))
    return np.concatenate(found), np.concatenate(codes)


def light_up_to(sizes: dict[int, int], t: Threshold) -> int:
    """The size up to which enumerating subsets costs less than listing blocks and comparing."""

    def subsets(n: int) -> int:
        return sum(comb(n, a) for a in range(t.miss * n // 100 + 1))

    def lists(n: int) -> int:
        _, low, high = t.size_class(n)
        return 3 * (t.blocks(high)[0] + t.blocks(max(1, low - 1))[0])

    def cost(x: int) -> int:
        light = sum(k * subsets(n) for n, k in sizes.items() if n <= x)
        return light + sum(k * lists(n) for n, k in sizes.items() if 100 * n >= t.percent * (x + 1))

    return min(range(LIGHT_MOST + 1), key=lambda x: (cost(x), x))


def _postings(texts: DataFrame, n: int, light: int, t: Threshold) -> DataFrame:
    """``key, code, sid`` of every set's subsets and blocks, and a row of code ``_DOC`` for every text.

    That row's ``doc`` has the text's id, the set's size, a second number of the set, and the
    text's mark; it has a key of its own.
    """
    kind = pa.struct([("doc_id", to_arrow_type(texts.schema["doc_id"].dataType)), ("n", pa.int64()), ("check", pa.int64()), ("mark", pa.int64())])
    doc = f"struct<doc_id: {texts.schema['doc_id'].dataType.simpleString()}, n: bigint, check: bigint, mark: bigint>"

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["key", "code", "sid", "doc"]
        for batch in batches:
            keys, codes, sids, told = [], [], [], []
            for s in _texts(batch.column(1), n):
                sid = _number(s, 1)
                told.append((s.size, sid, _number(s, 2)))
                if not s.size:
                    continue
                if s.size <= light:
                    k, c = zip(*_subsets(s, t), strict=True)
                    keys.append(np.array(k, dtype=np.uint64))
                    codes.append(np.array(c, dtype=np.int32))
                    sids.append(np.full(len(k), sid, dtype=np.uint64))
                if 100 * s.size >= t.percent * (light + 1):
                    k, c = _block_keys(s, t)
                    keys.append(k)
                    codes.append(c)
                    sids.append(np.full(k.size, sid, dtype=np.uint64))
            if told:
                size, sid, check = (np.array(x, np.uint64) for x in zip(*told, strict=True))
                own = mix(sid + np.arange(sid.size, dtype=np.uint64), 29)
                rows = [batch.column(0).cast(kind.field(0).type), pa.array(size.astype(np.int64)), _signed(check), batch.column(2)]
                rows = pa.StructArray.from_arrays(rows, fields=list(kind))
                yield pa.RecordBatch.from_arrays([_signed(own), pa.array(np.full(sid.size, _DOC, np.int32)), _signed(sid), rows], names=names)
            if keys:
                codes = np.concatenate(codes)
                columns = [_signed(np.concatenate(keys)), pa.array(codes), _signed(np.concatenate(sids)), pa.nulls(codes.size, kind)]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return texts.select("doc_id", "text", "mark").mapInArrow(post, f"key long, code int, sid long, doc {doc}")


def _stars(postings: DataFrame) -> DataFrame:
    """``key, hub, sid, code``: each list's first set with each other one; lists of one set vanish.

    Rows of texts pass through.
    """

    def star(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # key, code and sid of the hub of the list that goes on
        for batch in batches:
            told = pc.equal(batch.column(1), _DOC)
            docs = batch.filter(told)
            if docs.num_rows:
                yield pa.RecordBatch.from_arrays([docs.column(i) for i in (0, 2, 2, 1, 3)], names=["key", "hub", "sid", "code", "doc"])
            batch = batch.filter(pc.invert(told))
            key, code, sid = (batch.column(i).to_numpy() for i in range(3))
            if not key.size:
                continue
            heavy = np.minimum(code, 0)  # sorts before light; one list has one class
            first = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (heavy[1:] != heavy[:-1])]))
            group = np.repeat(np.arange(first.size), np.diff(np.append(first, key.size)))
            hub, hub_code = sid[first], code[first]
            if last and last[0] == key[0] and min(last[1], 0) == heavy[0]:
                hub, hub_code = hub.copy(), hub_code.copy()
                hub_code[0], hub[0] = last[1:]
            last = key[-1], hub_code[-1], hub[-1]
            room, missing = code >> 8, (code & 255) + (hub_code[group] & 255)
            keep = (sid != hub[group]) & ((code < 0) | (missing <= room))
            keep[1:] &= (key[1:] != key[:-1]) | (sid[1:] != sid[:-1]) | ~keep[:-1]
            if keep.any():
                columns = [pa.array(x[keep]) for x in (key, hub[group], sid, code)]
                yield pa.RecordBatch.from_arrays([*columns, batch.column(3).filter(pa.array(keep))], names=["key", "hub", "sid", "code", "doc"])

    kind = postings.schema["doc"].dataType.simpleString()
    dealt = postings.repartition("key").sortWithinPartitions("key", "code", "sid")
    return dealt.mapInArrow(star, f"key long, hub long, sid long, code int, doc {kind}")


def _filter(marks: DataFrame) -> np.ndarray:
    """A fixed number of bits, set where a wanted mark falls; wanted marks always pass."""
    slot = F.shiftright(F.col("mark").bitwiseAND(F.lit(_FILTER_BITS - 1)), 6)
    words64 = marks.groupBy(slot.cast("int").alias("slot")).agg(F.bit_or(F.expr("shiftleft(1L, int(mark & 63))")).alias("bits"))
    found = np.zeros(_FILTER_BITS >> 6, dtype=np.uint64)
    for r in words64.toLocalIterator():
        found[r["slot"]] = np.int64(r["bits"]).view(np.uint64)
    return found


def _wanted(texts: DataFrame, marks: DataFrame, n: int) -> DataFrame:
    """``sid, set`` of the texts that may have one of the marks, each set once."""
    bits = texts.sparkSession.sparkContext.broadcast(_filter(marks))

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            mark = batch.column(1).to_numpy().view(np.uint64)
            slot = ((mark & np.uint64(_FILTER_BITS - 1)) >> np.uint64(6)).astype(np.int64)
            passes = (bits.value[slot] >> (mark & np.uint64(63))) & np.uint64(1) == 1
            new = []
            for i in np.flatnonzero(passes).tolist():
                if int(mark[i]) not in seen:
                    if len(seen) >= 100_000:
                        seen.clear()
                    seen.add(int(mark[i]))
                    new.append(i)
            found = [s for s in _texts(batch.column(0).take(pa.array(new, pa.int64())), n) if s.size]
            if found:
                ends = np.cumsum([0, *map(len, found)])
                sets = pa.LargeListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(found).view(np.int64))).cast(pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([_signed([_number(s, 1) for s in found]), sets], names=["sid", "set"])

    return texts.select("text", "mark").mapInArrow(pick, "sid long, set array<long>").dropDuplicates(["sid"])


def _near(pairs: DataFrame, signs: DataFrame, t: Threshold) -> DataFrame:
    """Of ``hub, sid, code`` the pairs ``hub, sid`` whose parity bitmaps are as near as a link asks; all light ones."""
    pairs = pairs.groupBy("hub", "sid").agg(F.max("code").alias("code"))
    hubs = signs.select(F.col("sid").alias("hub"), "code", F.col("n").alias("hub_n"), F.col("bits").alias("hub_bits"))
    signed = pairs.where("code < 0").join(signs, ["sid", "code"]).join(hubs, ["hub", "code"])

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = zip(batch.column(4).to_pylist(), batch.column(5).to_pylist(), strict=True)
            apart = np.array([(int.from_bytes(x) ^ int.from_bytes(y)).bit_count() for x, y in both], dtype=np.int64)
            total = batch.column(2).to_numpy() + batch.column(3).to_numpy()
            keep = pa.array((100 + t.percent) * apart <= t.miss * total)
            yield batch.select([0, 1]).filter(keep)

    kept = signed.select("hub", "sid", "n", "hub_n", "bits", "hub_bits").mapInArrow(near, "hub long, sid long")
    return kept.unionAll(pairs.where("code >= 0").select("hub", "sid"))


def _thin(sets: DataFrame) -> DataFrame:
    """``sid, set`` with 16 bits of each element: a quarter of the bytes, for a first comparison."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cuts = [(s & np.uint64(0xFFFF)).astype("<u2").tobytes() for s in _sets(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(cuts, pa.binary())], names=["sid", "set"])

    return sets.mapInArrow(cut, "sid long, set binary")


def _compare(sets: DataFrame, pairs: DataFrame, t: Threshold, scratch: Scratch) -> DataFrame:
    """The pairs ``a, b`` of ``hub, sid`` whose sets are linked; cut sets (``_thin``) let more pass, never fewer."""
    thin = dict(sets.dtypes)["set"] == "binary"
    pairs = materialize(pairs.select("hub", "sid").distinct(), "pairs")
    scratch.release()
    sizes = pairs.groupBy("hub").agg(F.count("*").alias("n"), F.ceil(F.count("*") / HUB_SHARE).cast("int").alias("shares"))
    sizes = materialize(sizes, "hubs")
    hubs = sizes.select("hub", F.col("hub").alias("sid"), F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("share"), F.lit(0).alias("no"))
    members = attach(pairs, sizes, "hub", "n", pairs.count()).select("hub", "sid", F.pmod(F.xxhash64("sid"), F.col("shares")).cast("int").alias("share"), F.lit(1).alias("no"))
    asked = hubs.unionByName(members)
    rows = asked.join(sets, "sid").select("hub", "share", "no", "sid", "set")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub, of = None, None
        for batch in batches:
            names, no, sid = (batch.column(i).to_pylist() for i in (0, 2, 3))
            found = []
            held = batch.column(4)
            held = (np.frombuffer(x.as_buffer(), "<u2") for x in held) if thin else _sets(held)
            for h, n, s, elements in zip(names, no, sid, held, strict=True):
                if n == 0:
                    hub, of = h, elements
                elif h == hub and (t.may_link(of, elements) if thin else t.linked(of, elements)):
                    found.append((h, s))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*found, strict=True)], names=["a", "b"])

    dealt = rows.repartition("hub", "share")
    return dealt.sortWithinPartitions("hub", "share", "no", "sid").mapInArrow(compare, "a long, b long").distinct()


def _parity(s: np.ndarray, cls: int, t: Threshold) -> bytes:
    """A bit for each of a number of slots: whether an odd number of elements falls there."""
    low = 1
    for _ in range(cls):
        low = 100 * low // t.percent + 1
    bits = 1 << max(6, (2 * low).bit_length())
    slots = np.bincount((mix(s, 23) % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
    return np.packbits(slots.astype(np.uint8)).tobytes()


def _parities(sets: DataFrame, t: Threshold) -> DataFrame:
    """``sid, code, n, bits`` of the sets, for either class they are listed in."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for sid, s in zip(batch.column(0).to_pylist(), _sets(batch.column(1)), strict=True):
                c = t.size_class(s.size)[0]
                rows += [(sid, -1 - cls, s.size, _parity(s, cls, t)) for cls in (c, c - 1) if cls >= 0]
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.binary())
            columns = list(zip(*rows, strict=True)) if rows else [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(columns, kinds, strict=True)], names=["sid", "code", "n", "bits"])

    return sets.mapInArrow(sign, "sid long, code int, n long, bits binary").dropDuplicates(["sid", "code"])


def _scan(signs: DataFrame, members: DataFrame, t: Threshold) -> DataFrame:
    """``hub, sid``: pairs of a list, of different components, that may be linked.

    A pair that has several lists in common comes out of the one of least key, and of others if
    that is not among the ``LISTS_TOLD`` least of either's lists: of few, as keys are hashes.
    Carrying all of them would take the square of a set's lists.
    """
    lists = members.groupBy("sid", "code").agg(F.slice(F.sort_array(F.collect_set("key")), 1, LISTS_TOLD).alias("lists"))
    sizes = members.groupBy("key", "code").agg(F.ceil(F.count("*") / LIST_BLOCK).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("sid"), F.col("blocks")).cast("int")
    dealt = members.join(sizes, ["key", "code"]).withColumn("own", own)
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    # Bitmaps and lists come last: wide rows are shuffled once, with the lists of lower key only.
    dealt = dealt.join(signs, ["sid", "code"]).join(lists, ["sid", "code"]).select("key", "code", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "sid", "root", "n", "bits", F.expr("filter(lists, k -> k < key)").alias("lists"))
    names = ["key", "code", "i", "j"]
    dealt = dealt.repartition(*names).sortWithinPartitions(*names, "own")

    def near(rows: list[tuple]) -> Iterator[tuple[int, int]]:
        _, _, i, j, own, sid, root, n, bits, lists = zip(*rows, strict=True)
        of: dict[int, set[int]] = {}
        own, sid, root, n = (np.array(x, dtype=np.int64) for x in (own, sid, root, n))
        signs = np.frombuffer(b"".join(bits), dtype=np.uint64).reshape(len(rows), -1)
        for a in np.flatnonzero(own == i[0]):
            others = np.arange(a + 1, len(rows)) if i[0] == j[0] else np.flatnonzero(own == j[0])
            others = others[root[others] != root[a]]
            apart = np.bitwise_count(signs[others] ^ signs[a]).sum(axis=1, dtype=np.int64)
            for b in others[(100 + t.percent) * apart <= t.miss * (n[others] + n[a])]:
                for x in (a, b):
                    if x not in of:
                        of[x] = set(lists[x])
                if of[a].isdisjoint(of[b]):
                    yield (int(sid[a]), int(sid[b])) if sid[a] < sid[b] else (int(sid[b]), int(sid[a]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _groups(batches, len(names)):
            if found := set(near(part)):
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*found, strict=True)], names=["hub", "sid"])

    return dealt.mapInArrow(scan, "hub long, sid long").distinct()


def _groups(batches: Iterator[pa.RecordBatch], by: int) -> Iterator[list[tuple]]:
    """Rows in runs of equal first ``by`` columns."""
    rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns), strict=True))
    for _, group in groupby(rows, key=lambda row: row[:by]):
        yield list(group)


def _unlike(members: DataFrame) -> DataFrame:
    """``key, code, sid`` of one list of all that have the same members; the others would give the same pairs."""
    marks = [F.bit_xor(F.xxhash64("sid")).alias("x"), F.bit_xor(F.xxhash64("sid", F.lit(1))).alias("y")]
    lists = members.groupBy("key", "code").agg(F.count("*").alias("n"), *marks)
    kept = lists.groupBy("code", "n", "x", "y").agg(F.min("key").alias("key")).select("key", "code")
    return members.join(kept, ["key", "code"], "left_semi")


def linked(texts: DataFrame, lists: DataFrame, n: int, t: Threshold, scratch: Scratch) -> DataFrame:
    """``node, root``: every linked set and the least number of its component.

    Each round adds its links to the components so far, not to all links before.
    """
    stars = lists.where(F.col("code") != _DOC).drop("doc")
    listed = stars.select(F.explode(F.array("hub", "sid")).alias("sid")).distinct()
    # One text of each listed set is read and cut up again; the sets are used several times.
    told = lists.where(F.col("code") == _DOC).groupBy("sid").agg(F.min("doc.mark").alias("mark"))
    listed = scratch.table(told.join(listed, "sid", "left_semi"), "listed")
    sets = scratch.table(_wanted(texts, listed, n).join(listed, "sid", "left_semi"), "listed-sets")
    scratch.drop(listed)
    scratch.release()
    heavy = stars.where("code < 0")
    signs = scratch.table(_parities(sets, t), "parities")
    found = scratch.table(_compare(sets, _near(stars.select("hub", "sid", "code"), signs, t), t, scratch), "links")
    roots = components(found)
    scratch.release()
    members = heavy.select("key", "code", "sid").unionAll(heavy.select("key", "code", F.col("hub").alias("sid"))).distinct()
    members = scratch.table(_unlike(members), "members")
    for number in range(HUB_ROUNDS + 1):
        listed = members.select("key", "code", "sid")
        rooted = listed.join(roots, F.col("sid") == F.col("node"), "left").select("key", "code", "sid", F.coalesce("root", "sid").alias("root"))
        rooted = scratch.table(rooted, "list-roots")
        scratch.drop(members, found)
        parts = rooted.groupBy("key", "code", "root").agg(F.count("*").alias("n"))
        open_lists = parts.groupBy("key", "code").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("within"), F.count("*").alias("parts"))
        open_lists = open_lists.where("parts > 1")
        total = open_lists.agg(F.sum("n").alias("n"), F.sum((F.col("n") * F.col("n") - F.col("within")) / 2).alias("cross")).first()
        if not total["n"]:
            break
        members = scratch.table(rooted.join(open_lists.select("key", "code"), ["key", "code"]), "open-lists")
        scratch.drop(rooted)
        scratch.release()
        if number == HUB_ROUNDS or total["cross"] <= _SCAN * total["n"]:
            # Bitmaps let many pairs pass that are not quite near enough: cut sets are shipped first.
            asked = scratch.table(_compare(_thin(sets), _scan(signs, members, t), t, scratch).toDF("hub", "sid"), "asked")
            scratch.release()
            return components(roots.toDF("a", "b").unionAll(_compare(sets, asked, t, scratch)))
        hub = F.min_by(F.struct(F.col("sid").alias("hub"), F.col("root").alias("hub_root")), F.xxhash64("key", "sid", F.lit(number)))
        hubs = members.groupBy("key", "code").agg(hub.alias("x")).select("key", "code", "x.*")
        pairs = members.join(hubs, ["key", "code"]).where("root != hub_root").select("hub", "sid", "code")
        found = scratch.table(_compare(sets, _near(pairs, signs, t), t, scratch), "links")
        roots = components(roots.toDF("a", "b").unionAll(found))
    return roots


def join(docs: DataFrame, *, percent: int = 85, n: int = 4, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: ``doc_id``, size of its set ``n_shingles``, and ``component_id``."""
    t = Threshold(percent)
    words = col(docs, text).cast("string")
    texts = docs.select(col(docs, doc_id).alias("doc_id"), words.alias("text"), F.xxhash64(words).alias("mark"))

    def small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(s.size, _number(s, 1)) for s in _texts(batch.column(0), n) if 0 < s.size <= 2 * LIGHT_MOST]
            size, sid = zip(*rows, strict=True) if rows else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(size, pa.int64()), _signed(sid)], names=["n", "sid"])

    with Scratch(docs.sparkSession) as scratch:
        # Small sets of short texts: enough to weigh the costs, and whatever the boundary the links are the same.
        short = texts.where(F.octet_length("text") <= _SHORT).select("text").mapInArrow(small, "n long, sid long")
        sizes = {r["n"]: r["k"] for r in short.groupBy("n").agg(F.count_distinct("sid").alias("k")).collect()}
        lists = scratch.table(_stars(_postings(texts, n, light_up_to(sizes, t), t)), "lists")
        rows = lists.where(F.col("code") == _DOC).select("doc.doc_id", F.col("doc.n").alias("n_shingles"), "sid", "doc.check")
        rows = scratch.result(rows, "sets")
        scratch.release()
        whole = rows.where("n_shingles > 0").drop("check")
        classes = rows.where("n_shingles > 0").groupBy("sid").agg(
            F.min("doc_id").alias("least"), F.count("*").alias("copies"), (F.min("check") != F.max("check")).alias("clash")
        )
        classes = scratch.table(classes, "classes")
        if not classes.where("clash").isEmpty():
            raise ValueError("two sets have one number; choose another seed")
        roots = linked(texts, lists, n, t, scratch)
        rooted = classes.join(roots, classes["sid"] == roots["node"], "left").select("sid", "least", "copies", F.coalesce("root", "sid").alias("root"))
        rooted = scratch.table(rooted, "rooted")
        least = rooted.groupBy("root").agg(F.min("least").alias("component_id"), F.count("*").alias("members"))
        least = scratch.table(least, "components")
        table = attach(rooted, least, "root", "members", rooted.count()).select("sid", "copies", "component_id")
        table = scratch.result(table, "component-of")
        single = rows.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
        total = rows.count()
    return attach(whole, table, "sid", "copies", total).select("doc_id", "n_shingles", "component_id").unionAll(single)


def keep_one(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", **kw) -> DataFrame:
    """``docs``, columns as they are, with the document of the smallest id of each component.

    Rows that repeat the id that stays, stay with it; rows with NULL id stay if none of
    their component has an id.
    """
    with Scratch(docs.sparkSession) as scratch:
        found = join(docs, doc_id=doc_id, text=text, **kw)
        stays = F.col("doc_id").eqNullSafe(F.col("component_id"))
        # The ids that go are the fewer ones, and stored, so that Spark knows their size.
        gone = found.groupBy("doc_id").agg(F.bool_or(stays).alias("stays")).where("NOT stays")
        gone = scratch.result(gone.select(F.col("doc_id").alias("gone")), "gone")
    rows = packed(docs, k=col(docs, doc_id))
    return unpacked(rows.join(gone, rows["k"].eqNullSafe(gone["gone"]), "left_anti"))

"""Quality by perplexity under an interpolated modified Kneser-Ney bigram model of trusted text.

Every word of the trusted texts and every count of theirs is in the model, language by
language; a word a language's trusted texts lack is its one unknown word.  Nothing of the
model is bounded: words and bigrams are tables sharded by hash, numbered by 64-bit hashes of
language and word.  A text's score is a sum of parts, one per word, context and bigram.  The
parts of the most frequent entries are broadcast and added up where the text is read; after a
fixed-size filter the keys of the others meet the bigrams, sharded by their context, in a
cogroup, which works their parts out.  Counts and keys are shuffled as packed arrays.

Trusted texts are dealt into folds by a hash of the text.  Each is scored without the counts
of its own fold, all other texts by the whole model, so that a language's threshold, the
``quantile`` over its trusted texts, is one for texts that the model has not seen.

A text is kept if its perplexity is at most its language's threshold.  NULL and blank texts
have no perplexity and are not kept; texts of a language (NULL is one) without trusted text
have none and are kept.  A language whose trusted texts all fall in one fold has nothing to
hold them against; these are scored by the whole model.  Equal rows get equal results.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import partial, reduce
from typing import Any, NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.bits import mix
from starmart.llm.exprs import SPACE, col, words
from starmart.scratch import Scratch

#: Trusted ids up to this number are broadcast, 16 bytes each; more are joined by a shuffle.
BROADCAST_IDS = 500_000
#: Entries of the model that are broadcast, so many words (about 12 bytes each) and for each four of
#: them one bigram or context (56 bytes); the others are joined.  Every executor writes them to disk.
BROADCAST_ENTRIES = 400_000
#: Folds of the trusted texts.
FOLDS = 5
#: Words of text that a task works on at a time.
WORDS_AT_ONCE = 1_000_000
#: Rounds in which bigrams are counted and texts meet them, by context, one after the other: the texts are read again, and less is shuffled at once.
ROUNDS = 2
_FILTER_BITS, _FILTER_PARTS = 1 << 27, 16
#: Before a text's first word; no word is blank.
_START = " "
#: Kinds of entries: a word after any context, a context before any word, a bigram; and a bigram of several folds.
_WORD, _CONTEXT, _BIGRAM, _SEVERAL = 1, 2, 3, 4
_CHUNK = "part int, l long, v binary, w binary, fold binary, n binary"
_HASHED = np.uint64(1 << 63)


def _key(kind: int, first: np.ndarray, place: np.ndarray, second: np.ndarray | None = None, place2: np.ndarray | None = None) -> np.ndarray:
    """Keys of the model's entries: the places of their words among the broadcast ones or, if one has none (-1), a hash."""
    key = mix(first.view(np.uint64), kind)
    if second is None:
        return np.where(place >= 0, (place + (kind << 56)).astype(np.uint64), key | _HASHED)
    key = mix(key ^ second.view(np.uint64), kind) | _HASHED
    return np.where((place >= 0) & (place2 >= 0), (place << 24 | place2).astype(np.uint64), key)


def _squeeze(x: np.ndarray) -> bytes:
    """An array's bytes, all first ones before all second ones, compressed."""
    x = np.ascontiguousarray(x)
    return zlib.compress(np.ascontiguousarray(x.view(np.uint8).reshape(x.size, x.itemsize).T).tobytes(), 1)


def _loose(packed: bytes, kind: type) -> np.ndarray:
    x = np.frombuffer(zlib.decompress(packed), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(x.T).view(kind).ravel()


def _packed_words(w: np.ndarray, c: np.ndarray) -> tuple[bytes, bytes]:
    """Sorted words and their figures, packed for a broadcast."""
    less = np.hstack([c[:, :1], c[:, :1] - c[:, 1:]])
    return _squeeze(np.diff(w, prepend=0)), _squeeze(less.astype(np.int32).T)


def _loose_words(packed: tuple[bytes, bytes]) -> tuple[np.ndarray, np.ndarray]:
    w = np.cumsum(_loose(packed[0], np.int64))
    less = _loose(packed[1], np.int32).reshape(FOLDS + 1, -1).T.astype(np.int64)
    return w, np.hstack([less[:, :1], less[:, :1] - less[:, 1:]])


def _starts(*columns: np.ndarray) -> np.ndarray:
    """Marks the first of each run of equal rows."""
    new = np.ones(columns[0].size, bool)
    if new.size:
        new[1:] = np.any([x[1:] != x[:-1] for x in columns], axis=0)
    return new


def _find(sorted_keys: np.ndarray, asked: np.ndarray) -> np.ndarray:
    """Places of keys, -1 where there is none."""
    if not sorted_keys.size:
        return np.full(asked.size, -1)
    at = np.minimum(np.searchsorted(sorted_keys, asked), sorted_keys.size - 1)
    return np.where(sorted_keys[at] == asked, at, -1)


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The values of all lists of an array, and the length of each; a NULL list has none."""
    n = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False), n


def _pairs(ids: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Neighbours in the same list, and the list's place."""
    owner = np.repeat(np.arange(n.size), n)
    same = owner[:-1] == owner[1:]
    return ids[:-1][same], ids[1:][same], owner[1:][same]


def _summed(l: np.ndarray, v: np.ndarray, w: np.ndarray, fold: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
    """Counts by bigram and fold, sorted by both."""
    order = np.lexsort((fold, w, v))
    l, v, w, fold, n = (x[order] for x in (l, v, w, fold, n))
    at = np.flatnonzero(_starts(v, w, fold))
    return l[at], v[at], w[at], fold[at], np.add.reduceat(n, at) if at.size else n


def _chunks(trusted: DataFrame, parts: int, turn: int) -> DataFrame:
    """Counts by fold of the trusted texts' bigrams of a round: a row per part and language, with all bigrams of its contexts.

    ``seen`` has, fold by fold left out, how many bigrams occur once, twice, three and four times,
    ``often`` how many bigrams and contexts there are of each count.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []

        def flush() -> pa.RecordBatch:
            l, v, w, fold = (np.concatenate(x) for x in zip(*held, strict=True))
            columns = _summed(l, v, w, fold, np.ones(v.size, np.int64))
            part = np.mod(columns[1], parts)
            order = np.argsort(part, kind="stable")
            at = np.flatnonzero(_starts(part[order]))
            cut = np.split(order, at[1:]) if at.size else []
            packed = [[_squeeze(x[i]) for i in cut] for x in columns]
            return pa.RecordBatch.from_arrays([pa.array(part[order][at].astype(np.int32)), *(pa.array(x, pa.binary()) for x in packed)], names=["part", "l", "v", "w", "fold", "n"])

        size = 0
        for batch in batches:
            v, w, owner = _pairs(*_lists(batch.column("ids")))
            own = np.mod(v, parts) % ROUNDS == turn
            v, w, owner = v[own], w[own], owner[own]
            held.append((batch.column("l").to_numpy()[owner], v, w, batch.column("fold").to_numpy().astype(np.uint8)[owner]))
            size += v.size
            if size > WORDS_AT_ONCE:
                yield flush()
                held, size = [], 0
        if size:
            yield flush()

    def merge(told: pa.Table) -> pa.Table:
        kinds = {"l": np.int64, "v": np.int64, "w": np.int64, "fold": np.uint8, "n": np.int64}
        l, v, w, fold, n = _summed(*(np.concatenate([_loose(x, k) for x in told.column(c).to_pylist()]) for c, k in kinds.items()))
        rows = []
        for lang in np.unique(l):
            own = l == lang
            packed = {c: _squeeze(x[own]) for c, x in {"v": v, "w": w, "fold": fold, "n": n}.items()}
            v_of, _, left = _grams(packed)
            seen = [int((left[:, f] == k).sum()) for f in range(FOLDS + 1) for k in (1, 2, 3, 4)]
            of = np.flatnonzero(_starts(v_of))
            often, k = np.unique(np.minimum(np.concatenate([left[:, 0], np.add.reduceat(left[:, 0], of)]), 100_000), return_counts=True)
            rows.append({"part": told.column("part")[0].as_py(), "l": int(lang), **packed, "seen": seen, "often": dict(zip(often.tolist(), k.tolist(), strict=True))})
        types = [("part", pa.int32()), ("l", pa.int64()), *((c, pa.binary()) for c in ("v", "w", "fold", "n")), ("seen", pa.list_(pa.int64())), ("often", pa.map_(pa.int64(), pa.int64()))]
        return pa.Table.from_pylist(rows, pa.schema(types))

    told = trusted.select("l", "fold", "ids").mapInArrow(count, "part int, l binary, v binary, w binary, fold binary, n binary")
    return told.groupBy("part").applyInArrow(merge, _CHUNK + ", seen array<long>, often map<long, long>")


def _grams(chunk: dict[str, Any]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``v`` and ``w`` of a chunk's bigrams, sorted, and their counts: of all folds, and without each."""
    v, w, fold, n = (_loose(chunk[c], k) for c, k in (("v", np.int64), ("w", np.int64), ("fold", np.uint8), ("n", np.int64)))
    new = _starts(v, w)
    each = np.zeros((int(new.sum()), FOLDS + 1), np.int64)
    each[np.cumsum(new) - 1, fold] = n
    return v[new], w[new], each.sum(axis=1)[:, None] - each


def _words(chunks: DataFrame) -> DataFrame:
    """``l, w`` and ``c0, c1, ...``: before how many different words each stands, in all folds and without each."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in batch.to_pylist():
                _, w, n = _grams(chunk)
                order = np.argsort(w)
                at = np.flatnonzero(_starts(w[order]))
                c = np.add.reduceat((n[order] > 0).astype(np.int64), at, axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(at.size, chunk["l"])), pa.array(w[order][at]), *(pa.array(c[:, f]) for f in range(FOLDS + 1))], names=names)

    names = ["l", "w", *(f"c{f}" for f in range(FOLDS + 1))]
    told = chunks.mapInArrow(count, ", ".join(f"{c} long" for c in names))
    return told.groupBy("l", "w").agg(*[F.sum(c).alias(c) for c in names[2:]])


def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts for counts of one, two, and three or more."""
    y = n1 / (n1 + 2 * n2) if n1 and n2 else 0.5
    d = [1 - 2 * y * n2 / n1 if n1 else 0.5, 2 - 3 * y * n3 / n2 if n2 else 1.0, 3 - 4 * y * n4 / n3 if n3 else 1.5]
    return tuple(min(max(x, 0.05), k - 0.05) for x, k in zip(d, (1, 2, 3), strict=True))


class _Level(NamedTuple):
    """A language's figures, a row or number for each fold left out: discounts of bigrams and, for single words, discounts, sum and the unknown word's share."""

    bigram: np.ndarray
    word: np.ndarray
    total: np.ndarray
    unknown: np.ndarray

    def share(self, c: np.ndarray) -> np.ndarray:
        """A word's probability after an unknown context."""
        return (c - _cut(c, self.word)) / self.total + self.unknown


def _cut(n: np.ndarray, d: np.ndarray) -> np.ndarray:
    return np.hstack([np.zeros((FOLDS + 1, 1)), d])[np.arange(FOLDS + 1), np.minimum(n, 3)]


def _levels(chunks: DataFrame, words_of: DataFrame) -> tuple[dict[int, _Level], dict[tuple[int, int], float]]:
    """Figures by language, and the log probability of the unknown word by language and fold that leaves something when left out."""
    folds = range(FOLDS + 1)
    ones: dict[int, np.ndarray] = {}
    for r in chunks.select("l", F.posexplode("seen")).groupBy("l", "pos").agg(F.sum("col").alias("n")).collect():
        ones.setdefault(r["l"], np.zeros((FOLDS + 1) * 4, np.int64))[r["pos"]] = r["n"]
    aggs = [F.count_if(F.col(f"c{f}") == k).alias(f"c{f}_{k}") for f in folds for k in (1, 2, 3, 4)]
    aggs += [F.sum(f"c{f}").alias(f"sum{f}") for f in folds] + [F.count_if(F.col(f"c{f}") > 0).alias(f"size{f}") for f in folds]
    levels, unknown = {}, {}
    for r in words_of.groupBy("l").agg(*aggs).collect():
        bigram = np.array([discounts(*ones[r["l"]].reshape(FOLDS + 1, 4)[f].tolist()) for f in folds])
        word = np.array([discounts(*(r[f"c{f}_{k}"] for k in (1, 2, 3, 4))) for f in folds])
        total, size, one, two = (np.array([r[f"{x}{f}{y}"] for f in folds]) for x, y in (("sum", ""), ("size", ""), ("c", "_1"), ("c", "_2")))
        total = np.maximum(total, 1)
        rest = (word[:, 0] * one + word[:, 1] * two + word[:, 2] * (size - one - two)) / total
        some = size > 0
        share = np.where(some, rest / (size + 1), 1.0)
        levels[r["l"]] = _Level(bigram, word, total, share)
        unknown |= {(r["l"], f): float(np.log(share[f])) for f in folds if some[f]}
    return levels, unknown


class _Bigrams(NamedTuple):
    """Bigrams of a chunk of the model, sorted by context and word, and their contexts."""

    v: np.ndarray
    w: np.ndarray
    n: np.ndarray
    #: Places among the broadcast words, -1 for others.
    place_v: np.ndarray
    place_w: np.ndarray
    #: Where each context starts.
    at: np.ndarray

    def keys(self) -> tuple[np.ndarray, np.ndarray]:
        """Keys of the contexts and of the bigrams."""
        v, place = self.v[self.at], self.place_v[self.at]
        return _key(_CONTEXT, v, place), _key(_BIGRAM, self.v, self.place_v, self.w, self.place_w)


def _coded(chunk: dict[str, Any], known: np.ndarray) -> dict[str, Any]:
    """A chunk with the places of words among the ``known`` ones, and as hashes only the others."""
    w = _loose(chunk["w"], np.int64)
    place = _find(known, w)
    return {**{c: chunk[c] for c in ("part", "l", "v", "fold", "n")}, "w": _squeeze(place.astype(np.int32)), "other": _squeeze(w[place < 0])}


def _bigrams(chunk: dict[str, Any], known: np.ndarray) -> _Bigrams:
    place = _loose(chunk["w"], np.int32).astype(np.int64)
    w = known[place] if known.size else np.zeros(place.size, np.int64)
    w[place < 0] = _loose(chunk["other"], np.int64)
    v, fold, n = (_loose(chunk[c], k) for c, k in (("v", np.int64), ("fold", np.uint8), ("n", np.int64)))
    new = _starts(v, w)
    each = np.zeros((int(new.sum()), FOLDS + 1), np.int64)
    each[np.cumsum(new) - 1, fold] = n
    v, w, place = v[new], w[new], place[new]
    first = _starts(v)
    at = np.flatnonzero(first)
    return _Bigrams(v, w, each.sum(axis=1)[:, None] - each, _find(known, v[at])[np.cumsum(first) - 1], place, at)


def _gains(b: _Bigrams, level: _Level, c: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """What contexts and bigrams add to a text's log probability, a column for each fold left out; ``c`` is of the bigrams' words.

    A context adds the weight that it leaves to the lower order, a bigram what it has over the
    product of both.
    """
    cut = _cut(b.n, level.bigram)
    # what bigrams below ``least`` (all of theirs) and the others (a discount) leave
    left = np.add.reduceat(np.where(b.n < least, b.n, cut), b.at, axis=0)
    total = np.add.reduceat(b.n, b.at, axis=0)
    of = np.repeat(np.arange(b.at.size), np.diff(b.at, append=b.v.size))
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = np.where(b.n >= max(least, 1), np.log1p((b.n - cut) / (left[of] * level.share(c))), 0.0)
        return np.where(total > 0, np.log(left / total), 0.0), gain


def _figures(b: _Bigrams, known: tuple[np.ndarray, np.ndarray], more: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Before how many different words each bigram's word stands; a word that is in neither table stands before this context alone."""
    c = (b.n > 0).astype(np.int64)
    has = b.place_w >= 0
    c[has] = known[1][b.place_w[has]]
    rest = np.flatnonzero(~has)
    place = _find(more[0], b.w[rest])
    c[rest[place >= 0]] = more[1][place[place >= 0]]
    return c


def _word_entries(levels: dict[int, _Level], l: np.ndarray, c: np.ndarray) -> np.ndarray:
    """What words add over the unknown word."""
    gains = np.zeros(c.shape)
    for lang in np.unique(l):
        own, level = l == lang, levels[int(lang)]
        gains[own] = np.where(c[own] > 0, np.log(level.share(c[own]) / level.unknown), 0.0)
    return gains


def _from(df: DataFrame, n: str, room: int) -> int:
    """The least number from which on at most ``room`` of the rows counted in ``n, k`` remain."""
    size, least = 0, 1 << 62
    for r in df.groupBy(F.least(n, F.lit(100_000)).alias("n")).agg(F.sum("k").alias("k")).orderBy(F.desc("n")).collect():
        if size + r["k"] > room:
            break
        size, least = size + r["k"], r["n"]
    return least


def _slots(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return tuple((mix(keys, seed) % np.uint64(_FILTER_BITS)).astype(np.int64) for seed in (7, 8))


def _filter(slots: DataFrame) -> np.ndarray:
    """Fixed-size bits, set where a key of the model falls; one part of the range each."""
    size = _FILTER_BITS // _FILTER_PARTS

    def fill(told: pa.Table) -> pa.Table:
        bits = np.zeros(size, np.uint8)
        for x in told.column("slots").to_pylist():
            bits[np.cumsum(_loose(x, np.uint32))] = 1
        return pa.table({"part": told.column("part").slice(0, 1), "bits": pa.array([np.packbits(bits, bitorder="little").tobytes()], pa.binary())})

    bits = np.zeros(_FILTER_BITS >> 3, dtype=np.uint8)
    for r in slots.groupBy("part").applyInArrow(fill, "part int, bits binary").collect():
        bits[r["part"] * (size >> 3) : (r["part"] + 1) * (size >> 3)] = np.frombuffer(r["bits"], np.uint8)
    return bits


def _placed(keys: np.ndarray) -> pa.RecordBatch:
    size = _FILTER_BITS // _FILTER_PARTS
    slots = np.unique(np.concatenate(_slots(keys)))
    cuts = np.searchsorted(slots, np.arange(1, _FILTER_PARTS) * size)
    packed = [_squeeze(np.diff(x - i * size, prepend=0).astype(np.uint32)) for i, x in enumerate(np.split(slots, cuts))]
    return pa.RecordBatch.from_arrays([pa.array(range(_FILTER_PARTS), pa.int32()), pa.array(packed, pa.binary())], names=["part", "slots"])


def _c(table: pa.Table | pa.RecordBatch) -> np.ndarray:
    return np.column_stack([table.column(f"c{f}").to_numpy() for f in range(FOLDS + 1)])


def perplexity(
    docs: DataFrame, trusted_ids: DataFrame, *, least: int = 1, doc_id: str = "doc_id", text: str = "text", lang: str = "lang"
) -> DataFrame:
    """Per row ``doc_id, lang, trusted, n_words, perplexity``; ``trusted_ids`` has one column ``doc_id``."""
    spark = docs.sparkSession
    sc = spark.sparkContext
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    with Scratch(spark) as scratch:
        ids = scratch.table(trusted_ids.select("doc_id").where("doc_id IS NOT NULL").distinct(), "trusted-ids")
        ids = ids.select(F.col("doc_id").alias("t_id"))
        few = ids.count() <= BROADCAST_IDS
        t = col(docs, text)
        slim = docs.select(col(docs, doc_id).alias("doc_id"), col(docs, lang).alias("lang"), F.coalesce(t, F.lit("")).alias("text"))
        slim = slim.join(F.broadcast(ids) if few else ids, slim["doc_id"] == F.col("t_id"), "left")
        slim = slim.withColumn("fold", F.when(F.col("t_id").isNull(), 0).otherwise(F.pmod(F.xxhash64("text"), F.lit(FOLDS)) + 1))
        # each round, and a task that is run again, must meet the same texts in the same order
        slim = slim if few else slim.repartition(parts, "doc_id", "lang", "text").sortWithinPartitions("doc_id", "lang", "text")
        numbers = F.transform(words(F.col("text"), SPACE), lambda w: F.xxhash64("lang", w))
        numbers = F.concat(F.array(F.xxhash64("lang", F.lit(_START))), numbers)
        slim = slim.select("doc_id", "lang", F.col("fold").cast("int").alias("fold"), F.xxhash64("lang").alias("l"), numbers.alias("ids"))

        counted = []
        for turn in range(ROUNDS):
            counted.append(scratch.table(_chunks(slim.where("fold > 0"), parts, turn), "bigram-counts"))
            scratch.release()
        chunks = reduce(DataFrame.unionAll, counted)
        words_of = scratch.table(_words(chunks), "words")
        scratch.release()
        levels, unknown = _levels(chunks, words_of)
        common = _from(words_of.select(F.col("c0").alias("n"), F.lit(1).alias("k")), "n", BROADCAST_ENTRIES)
        rare = words_of.where(F.col("c0") < common)
        told = words_of.where(F.col("c0") >= common).orderBy("w").toArrow()
        langs = sorted(levels)
        known_l = np.searchsorted(langs, told.column("l").to_numpy()).astype(np.int32) if langs else np.zeros(0, np.int32)
        known = sc.broadcast((*_packed_words(told.column("w").to_numpy(), _c(told)), _squeeze(known_l)))

        def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            words, _ = _loose_words(known.value)
            for batch in batches:
                rows = [_coded(chunk, words) for chunk in batch.to_pylist()]
                yield pa.RecordBatch.from_pylist(rows, pa.schema([("part", pa.int32()), ("l", pa.int64()), *((c, pa.binary()) for c in ("v", "w", "fold", "n", "other"))]))

        # rare words go to their own part, where texts ask for them, and to those with bigrams that end with
        # them; a word that stands after one word only is known from the bigram
        def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            words, _ = _loose_words(known.value)
            for batch in batches:
                for chunk in batch.to_pylist():
                    w = np.unique(_loose(chunk["w"], np.int64))
                    w = w[_find(words, w) < 0]
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(w.size, chunk["part"], np.int32)), pa.array(w)], names=["part", "w"])

        def pack(told: pa.Table) -> pa.Table:
            w, at = np.unique(told.column("w").to_numpy(), return_index=True)
            a, b = _packed_words(w, _c(told)[at])
            return told.select(["part", "l"]).slice(0, 1).append_column("words", pa.array([a], pa.binary())).append_column("c", pa.array([b], pa.binary()))

        names = ["part", "l", "w", *(f"c{f}" for f in range(FOLDS + 1))]
        used = rare.withColumn("part", F.pmod("w", F.lit(parts)).cast("int")).select(names)
        if common > 2:
            used = used.unionAll(chunks.mapInArrow(ends, "part int, w long").join(rare.where("c0 > 1"), "w").select(names))
        used = used.groupBy("part", "l").applyInArrow(pack, "part int, l long, words binary, c binary")
        often = _from(chunks.select(F.explode("often").alias("n", "k")), "n", BROADCAST_ENTRIES // 4)
        coded = chunks.mapInArrow(code, _CHUNK + ", other binary")
        model = scratch.table(coded.unionByName(used, allowMissingColumns=True), "bigram-model")
        scratch.drop(*counted, words_of)
        scratch.release()
        none = np.zeros(0, np.int64), np.zeros((0, FOLDS + 1), np.int64)

        def most(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            all_known = _loose_words(known.value)
            for batch in batches:
                for chunk in batch.to_pylist():
                    b = _bigrams(chunk, all_known[0])
                    keys, gains = np.concatenate(b.keys()), np.concatenate(_gains(b, levels[chunk["l"]], _figures(b, all_known, none), least))
                    at = np.concatenate([np.add.reduceat(b.n[:, 0], b.at), np.where(b.place_w >= 0, b.n[:, 0], 0)]) >= often
                    yield pa.RecordBatch.from_arrays([pa.array(keys[at].view(np.int64)), *(pa.array(gains[at, f]) for f in range(FOLDS + 1))], names=["key", *(f"c{f}" for f in range(FOLDS + 1))])

        bigrams = model.where("words IS NULL")
        told = bigrams.mapInArrow(most, "key long, " + ", ".join(f"c{f} double" for f in range(FOLDS + 1))).toArrow()
        keys = told.column("key").to_numpy().view(np.uint64)
        order = np.argsort(keys)
        frequent = sc.broadcast((_squeeze(np.diff(keys[order], prepend=np.uint64(0))), _squeeze(_c(told)[order])))

        def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            words, _ = _loose_words(known.value)
            for batch in batches:
                for chunk in batch.to_pylist():
                    if chunk["words"] is None:
                        b = _bigrams(chunk, words)
                        contexts, keys = b.keys()
                        there, several = b.n[:, 0] >= least, (b.n[:, 1:] > 0).all(axis=1)
                        yield _placed(np.concatenate([contexts, keys[there], mix(keys[there & several], _SEVERAL)]))
                    else:
                        w, _ = _loose_words((chunk["words"], chunk["c"]))
                        yield _placed(_key(_WORD, w, np.full(w.size, -1)))

        filled = _filter(model.mapInArrow(place, "part int, slots binary"))
        packed_bits = sc.broadcast(zlib.compress(filled.tobytes(), 1))
        scratch.release()

        kind = slim.schema["doc_id"].dataType.simpleString()
        row = f"rid long, part int, place int, doc_id {kind}, lang string, trusted boolean, n_words long, base double"

        def score(batches: Iterator[pa.RecordBatch], turn: int) -> Iterator[pa.RecordBatch]:
            rid = TaskContext.get().partitionId() << 32
            w, c = _loose_words(known.value)
            word_gains = _word_entries(levels, np.array(langs, np.int64)[_loose(known.value[2], np.int32)] if w.size else w, c)
            keys, gains = frequent.value
            held = w, word_gains, np.cumsum(_loose(keys, np.uint64), dtype=np.uint64), _loose(gains, np.float64).reshape(-1, FOLDS + 1)
            bits = np.frombuffer(zlib.decompress(packed_bits.value), np.uint8)
            texts, size = [], 0
            for batch in batches:
                texts.append(batch)
                size += len(batch.column("ids").flatten())
                if size > WORDS_AT_ONCE:
                    yield from flush(texts, rid, turn, bits, *held)
                    texts, size, rid = [], 0, rid + 1
            if size:
                yield from flush(texts, rid, turn, bits, *held)

        def flush(
            texts: list[pa.RecordBatch], rid: int, turn: int, bits: np.ndarray, known_w: np.ndarray, word_gains: np.ndarray, known_keys: np.ndarray, known_gains: np.ndarray
        ) -> Iterator[pa.RecordBatch]:
            batch = pa.concat_batches(texts)
            ids, n = _lists(batch.column("ids"))
            l, trusted = batch.column("l").to_pylist(), batch.column("fold").to_numpy()
            fold = np.array([f if (x, f) in unknown else 0 for x, f in zip(l, trusted.tolist(), strict=True)])  # all of a language is not left out
            at_v, at_w, owner = _pairs(np.arange(ids.size), n)
            of = fold[owner]
            total = np.zeros(n.size)
            asks: list[tuple[np.ndarray, ...]] = []

            def meet(gains: np.ndarray, keys: np.ndarray, place: np.ndarray, passes: np.ndarray, owner: np.ndarray, of: np.ndarray, first: np.ndarray) -> None:
                found = place >= 0
                total[:] += np.bincount(owner[found], gains[place[found], of[found]], total.size)
                part = np.mod(first, parts)
                rest = ~found & passes & (part % ROUNDS == turn)
                asks.append((keys[rest], part[rest], owner[rest] << 3 | of[rest]))

            different, at = np.unique(ids, return_inverse=True)
            word = _find(known_w, different)
            keys = _key(_WORD, different, word)
            meet(word_gains, keys[at[at_w]], word[at[at_w]], passing(bits, keys)[at[at_w]], owner, of, ids[at_w])
            keys = _key(_CONTEXT, different, word)
            meet(known_gains, keys[at[at_v]], _find(known_keys, keys)[at[at_v]], passing(bits, keys)[at[at_v]], owner, of, ids[at_v])
            keys = _key(_BIGRAM, ids[at_v], word[at[at_v]], ids[at_w], word[at[at_w]])
            order = np.argsort(keys)
            keys, of, owner, first = keys[order], of[order], owner[order], ids[at_v][order]
            place = _find(known_keys, keys)
            passes = np.zeros(keys.size, bool)
            rest = np.flatnonzero(place < 0)
            passes[rest] = passing(bits, np.where(of[rest] > 0, mix(keys[rest], _SEVERAL), keys[rest]))
            meet(known_gains, keys, place, passes, owner, of, first)

            k = np.maximum(n - 1, 0)
            base = [s + m * unknown[p] if m and p in unknown else None for s, m, p in zip(total.tolist(), k.tolist(), zip(l, fold.tolist(), strict=True), strict=True)]
            numbered = np.arange(n.size)
            columns = [np.full(n.size, rid), (numbered % parts).astype(np.int32), numbered.astype(np.int32)]
            columns = [*map(pa.array, columns), batch.column("doc_id"), batch.column("lang"), pa.array(trusted > 0), pa.array(k), pa.array(base, pa.float64())]
            names = ["rid", "part", "place", "doc_id", "lang", "trusted", "n_words", "base", "keys", "docs"]
            if turn == 0:
                yield pa.RecordBatch.from_arrays([*columns, pa.nulls(n.size, pa.binary()), pa.nulls(n.size, pa.binary())], names=names)

            keys, part, doc = (np.concatenate(x) for x in zip(*asks, strict=True))
            order = np.lexsort((doc, keys, part))
            keys, part, doc = keys[order], part[order], doc[order].astype(np.uint32)
            at = np.flatnonzero(_starts(part))
            if at.size:
                packed = [[_squeeze(np.diff(x, prepend=np.uint64(0))) for x in np.split(keys, at[1:])], [_squeeze(x) for x in np.split(doc, at[1:])]]
                empty = [pa.nulls(at.size, c.type) for c in columns[2:]]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(at.size, rid)), pa.array(part[at].astype(np.int32)), *empty, *(pa.array(x, pa.binary()) for x in packed)], names=names)

        def passing(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
            passes = np.ones(keys.size, bool)
            for slot in _slots(keys):
                passes &= (bits[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 == 1
            return passes

        def answer(asked: pa.Table, model: pa.Table) -> pa.Table:
            texts = asked.filter(asked.column("place").is_valid()).drop_columns(["keys"])
            asked = asked.filter(asked.column("place").is_null())
            all_known = _loose_words(known.value)
            made, more = [], [none]
            for r in model.filter(model.column("words").is_valid()).to_pylist():
                w, c = _loose_words((r["words"], r["c"]))
                more.append((w, c))
                made.append((_key(_WORD, w, np.full(w.size, -1)), _word_entries(levels, np.full(w.size, r["l"]), c)))
            w, c = (np.concatenate(x) for x in zip(*more, strict=True))
            order = np.argsort(w)
            rare = w[order], c[order]
            for chunk in model.filter(model.column("words").is_null()).to_pylist():
                b = _bigrams(chunk, all_known[0])
                made += zip(b.keys(), _gains(b, levels[chunk["l"]], _figures(b, all_known, rare), least), strict=True)
            if not made:
                made.append((np.zeros(0, np.uint64), np.zeros((0, FOLDS + 1))))
            keys, gains = (np.concatenate(x) for x in zip(*made, strict=True))
            order = np.argsort(keys)
            keys, gains = keys[order], gains[order]
            docs, sums = [], []
            for a, b in zip(asked.column("keys").to_pylist(), asked.column("docs").to_pylist(), strict=True):
                place, doc = _find(keys, np.cumsum(_loose(a, np.uint64), dtype=np.uint64)), _loose(b, np.uint32)
                place, doc = place[place >= 0], doc[place >= 0]
                sum_of = np.bincount(doc >> 3, gains[place, doc & 7])
                some = np.flatnonzero(np.bincount(doc >> 3))
                docs.append(_squeeze(np.diff(some, prepend=0).astype(np.uint32)))
                sums.append(_squeeze(sum_of[some]))
            asked = asked.drop_columns(["keys", "docs"]).append_column("docs", pa.array(docs, pa.binary())).append_column("gains", pa.array(sums, pa.binary()))
            return pa.concat_tables([texts.append_column("gains", pa.nulls(texts.num_rows, pa.binary())), asked])

        def told_of(answers: pa.Table) -> pa.Table:
            texts = answers.filter(answers.column("place").is_valid())
            total = np.zeros(texts.num_rows)
            for r in sorted(answers.filter(answers.column("place").is_null()).select(["part", "docs", "gains"]).to_pylist(), key=lambda r: r["part"]):
                total[np.cumsum(_loose(r["docs"], np.uint32))] += _loose(r["gains"], np.float64)
            base = texts.column("base").to_numpy()  # NULL as NaN
            with np.errstate(all="ignore"):
                value = np.exp(-(base + total[texts.column("place").to_numpy()]) / texts.column("n_words").to_numpy())
            value = pa.array(value, pa.float64(), mask=np.isnan(base))
            return texts.select(["doc_id", "lang", "trusted", "n_words"]).append_column("perplexity", value)

        answers = []
        for turn in range(ROUNDS):
            asked = slim.mapInArrow(partial(score, turn=turn), f"{row}, keys binary, docs binary")
            own = model.where(F.col("part") % ROUNDS == turn)
            answered = asked.groupBy("part").cogroup(own.groupBy("part")).applyInArrow(answer, f"{row}, docs binary, gains binary")
            answers.append(scratch.table(answered, "answers"))
            scratch.release()
        scratch.drop(model)
        result = reduce(DataFrame.unionAll, answers).groupBy("rid").applyInArrow(told_of, f"doc_id {kind}, lang string, trusted boolean, n_words long, perplexity double")
        return scratch.result(result, "perplexities")


def classify(docs: DataFrame, trusted_ids: DataFrame, *, quantile: float = 0.995, **kw) -> DataFrame:
    """Perplexity of every row, its language's threshold, and whether it is kept."""
    told = perplexity(docs, trusted_ids, **kw)
    limits = told.where("trusted AND perplexity IS NOT NULL").groupBy("lang").agg(F.percentile_approx("perplexity", quantile, 100_000).alias("threshold"))
    limits = limits.withColumnRenamed("lang", "l_lang")
    told = told.join(F.broadcast(limits), told["lang"].eqNullSafe(limits["l_lang"]), "left")
    good = F.when(F.col("n_words") == 0, False).when(F.col("threshold").isNull(), True).otherwise(F.col("perplexity") <= F.col("threshold"))
    return told.select("doc_id", "lang", "n_words", "perplexity", "threshold", good.alias("kept"))

"""Best-fit packing of documents into token sequences by exact-complement hashing.

A document is its token ids and one end id; only what is longer than a sequence is cut.
Which lengths go together depends on how many pieces of each length there are, a table of
at most ``capacity`` counts, whatever the corpus.  From the longest length down, the gap a
piece leaves is looked up among single lengths, sums of two and sums of three, and as many
combinations are consumed at once as the counts allow; what has no exact complement is
packed best fit, again many sequences at once.  The plan is a bounded list of (lengths,
times); a piece finds its sequence from its rank among the pieces of its length, which is
counted per task and added up over tasks, so no length is ever gathered in one place.

NULL and empty texts are documents of the end id alone.  Repeated rows are packed like any
others; NULL ids stay NULL.  An empty table gives no pieces.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.llm.exprs import col
from starmart.scratch import materialize

#: A task's table of ids by chunk: letters of a chunk that is kept at most, and of all of
#: them together; it is emptied when full.
CACHED_CHUNK, CACHED_LETTERS = 40, 5_000_000


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


#: Letters below this code point need no normal form but lower case.
_PLAIN_BELOW = "\u0250"
#: What may stand behind a word.
_MARKS = (".", ",", ";", ":", "!", "?")


def _byte_letters() -> dict[int, str]:
    """How a byte-level vocabulary spells a letter: printable bytes as they are, the others from 256 on."""
    printable = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    others = [b for b in range(256) if b not in set(printable)]
    spelled = {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}
    return {c: "".join(spelled[b] for b in chr(c).encode()) for c in range(128, ord(_PLAIN_BELOW))}


class ChunkTokenizer(dict):
    """Ids of a text as little-endian bytes, chunk by chunk between blanks and line ends.

    The tokenizer drops white space and lets no token cross it, so the ids of a text are
    those of its chunks in a row, and a chunk seen before need not be tokenized again.  A
    chunk of letters, with one mark behind it at most, goes straight to the vocabulary's
    model in lower case; every other chunk takes the whole way.
    """

    def __init__(self, path: str):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._model = self._tokenizer.model
        self._spelling = _byte_letters()
        self._letters = 0

    def __missing__(self, chunk: str) -> bytes:
        word, mark = (chunk[:-1], chunk[-1]) if chunk[-1:] in _MARKS else (chunk, "")
        lower = word.lower()
        if not word.isalpha() or max(word) >= _PLAIN_BELOW or not lower.isalpha():
            found = _bytes(self._tokenizer.encode(chunk, add_special_tokens=False).ids)
        elif mark or lower != word:
            found = self[lower] + self[mark] if mark else self[lower]
        else:
            spelled = word if word.isascii() else word.translate(self._spelling)
            found = _bytes([t.id for t in self._model.tokenize(spelled)])
        if len(chunk) <= CACHED_CHUNK:
            self._letters += len(chunk) + 1
            self[chunk] = found
        return found

    def ids(self, text: str | None) -> bytes:
        if self._letters > CACHED_LETTERS:
            self.clear()
            self._letters = 0
        return b"".join(map(self.__getitem__, (text or "").replace("\n", " ").split(" ")))


def _bytes(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def pieces(docs: DataFrame, *, capacity: int, tokenizer: str, end_id: int, doc_id: str, text: str) -> DataFrame:
    """One row per piece, with its rank among the pieces of its length in its task."""
    slim = docs.select(col(docs, doc_id).alias("doc_id"), col(docs, text).cast("string").alias("text"))
    schema = T.StructType(
        [
            T.StructField("doc_id", slim.schema["doc_id"].dataType),
            T.StructField("piece", T.IntegerType()),
            T.StructField("start", T.LongType()),
            T.StructField("length", T.LongType()),
            T.StructField("ids_crc32", T.LongType()),
            T.StructField("task", T.IntegerType()),
            T.StructField("rank", T.LongType()),
        ]
    )
    end = np.array([end_id], dtype="<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, seen, task = ChunkTokenizer(tokenizer), Counter(), TaskContext.get().partitionId()
        for batch in batches:
            rows: list[tuple] = []
            for i, text in enumerate(batch.column(1)):
                ids = tokens.ids(text.as_py()) + end
                for piece, begin in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[begin : begin + 4 * capacity]
                    n = len(part) // 4
                    rows.append((i, piece, begin // 4, n, zlib.crc32(part), task, seen[n]))
                    seen[n] += 1
            if rows:
                i, *rest = zip(*rows, strict=True)
                columns = [batch.column(0).take(pa.array(i)), pa.array(rest[0], pa.int32()), *(pa.array(x, pa.int64()) for x in rest[1:4])]
                columns += [pa.array(rest[4], pa.int32()), pa.array(rest[5], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return slim.mapInArrow(cut, schema)


Plan = list[tuple[tuple[int, ...], int]]


def plan(counts: dict[int, int], capacity: int) -> Plan:
    """Which lengths share a sequence, and how many such sequences: a few per length.

    Exact complements taken from the longest length down can use up the short pieces that other
    gaps need.  So best fit alone is planned over the same counts too, and the plan of fewer
    sequences is taken; it is never above best fit.
    """
    made = [_exact(counts, capacity), _best_fit(counts, capacity)]
    return min(made, key=lambda p: sum(times for _, times in p))


def _best_fit(counts: dict[int, int], capacity: int) -> Plan:
    """Best fit decreasing, many sequences of the same contents at once."""
    open_by_gap: dict[int, Plan] = {}

    def put(lengths: tuple[int, ...], times: int) -> None:
        if times:
            open_by_gap.setdefault(capacity - sum(lengths), []).append((lengths, times))

    for length in sorted(counts, reverse=True):
        n = counts[length]
        while n:
            gap = min((g for g in open_by_gap if g >= length), default=None)
            if gap is None:
                lengths, times, gap = (), n, capacity
            else:
                lengths, times = open_by_gap[gap].pop()
                if not open_by_gap[gap]:
                    del open_by_gap[gap]
            # A sequence is the best fit for the next piece too, until it has no more room.
            each = min(gap // length, n)
            full = min(times, n // each)
            put(lengths + (length,) * each, full)
            n, rest = n - full * each, times - full
            if lengths:
                put(lengths, rest)
    return [group for groups in open_by_gap.values() for group in groups]


def _exact(counts: dict[int, int], capacity: int) -> Plan:
    """Exact complements first, then best fit of what is left."""
    left = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in counts.items():
        left[length] = n
    packed: Plan = []

    def consume(lengths: tuple[int, ...]) -> None:
        used = Counter(lengths)
        times = min(int(left[x]) // k for x, k in used.items())
        if times:
            for x, k in used.items():
                left[x] -= times * k
            packed.append((lengths, times))

    def sums_of_two(total: int, most: int) -> Iterator[tuple[int, int]]:
        a = np.arange(min(most, total - 1), (total - 1) // 2, -1)
        for x in a[(left[a] > 0) & (left[total - a] > 0)]:
            yield int(x), total - int(x)

    for length in range(capacity, 0, -1):
        gap = capacity - length
        if not left[length]:
            continue
        if gap == 0:
            consume((length,))
            continue
        consume((length, gap))
        for a, b in sums_of_two(gap, gap):
            if not left[length]:
                break
            consume((length, a, b))
        for a in range(gap - 2, (gap - 1) // 3, -1) if left[length] else ():
            if not left[length]:
                break
            if left[a]:
                for b, c in sums_of_two(gap - a, a):
                    consume((length, a, b, c))
                    if not left[length] or not left[a]:
                        break
    for length in range(capacity, 0, -1):
        while left[length]:
            lengths, gap = [length], capacity - length
            free = left.copy()
            free[length] -= 1
            while gap and (fit := np.flatnonzero(free[1 : gap + 1])).size:
                best = int(fit[-1]) + 1
                take = min(int(free[best]), gap // best)
                lengths += [best] * take
                free[best] -= take
                gap -= take * best
            consume(tuple(lengths))
    return packed


def _ranges(packed: Plan) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per length, by the first rank of each range: that rank, its sequence and its offset."""
    used: Counter = Counter()
    found: dict[int, list[tuple[int, int, int]]] = {}
    sequence = 0
    for lengths, times in packed:
        offset = 0
        for x in lengths:
            found.setdefault(x, []).append((used[x], sequence, offset))
            used[x] += times
            offset += x
        sequence += times
    return {x: tuple(np.array(c, dtype=np.int64) for c in zip(*rows, strict=True)) for x, rows in found.items()}


def pack(
    docs: DataFrame,
    *,
    capacity: int = 2048,
    tokenizer: str | None = None,
    end_id: int = 0,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Every piece with its sequence and its place there."""
    spark = docs.sparkSession
    tokenizer = tokenizer or tokenizer_path()
    cut = materialize(pieces(docs, capacity=capacity, tokenizer=tokenizer, end_id=end_id, doc_id=doc_id, text=text), "pieces")
    counts = materialize(cut.groupBy("length", "task").count(), "piece-counts")
    packed = plan({r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("count").alias("n")).collect()}, capacity)
    ranges = spark.sparkContext.broadcast(_ranges(packed))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("length", "task", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base"))
    ranked = cut.join(bases, ["length", "task"])
    ranked = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("rank")).alias("rank"))
    schema = T.StructType(ranked.schema.fields[:-1] + [T.StructField(n, T.LongType()) for n in ("sequence_id", "offset")])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(n).to_numpy() for n in ("length", "rank"))
            sequence, offset = np.empty_like(rank), np.empty_like(rank)
            order = np.argsort(length, kind="stable")
            bounds = np.flatnonzero(np.diff(length[order])) + 1
            for rows in np.split(order, bounds) if order.size else ():
                first, base, place = ranges.value[int(length[rows[0]])]
                at = np.searchsorted(first, rank[rows], side="right") - 1
                sequence[rows] = base[at] + rank[rows] - first[at]
                offset[rows] = place[at]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(sequence), pa.array(offset)], names=schema.names)

    return ranked.mapInArrow(place, schema)

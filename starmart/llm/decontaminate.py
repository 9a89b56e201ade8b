"""Benchmark decontamination with a broadcast hash set of test n-grams.

Words are lower-cased (A-Z) runs of letters, digits and non-ASCII characters.  A test
item's windows are its ``n`` consecutive words; an item of fewer words is one window.

The texts are read once.  A bitmap of the hashes of the windows' first words goes out with
the plan; a text's window whose first words are in it is kept with its words, of most
texts none.  These are probed against the broadcast windows and count if all words are
equal.  A test set larger than ``block_bytes`` goes out in blocks of that size, one pass
over the texts each, so what is broadcast is bounded whatever the test set.

NULL and texts without words have no window and are never hit; items without words match
nothing.  Repeated items count by distinct id, items with NULL id hit words but are not
counted as items.  Repeated rows get equal results.  All work is done by built-in functions.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.llm.exprs import NOT_ALNUM, ascii_lower, col, let, packed, starts, unpacked, words
from starmart.scratch import materialize

#: One word and what separates it from the next, in a text that is not lower-cased.
_PIECE = r"([^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*)"


def _words(text: Column) -> Column:
    return words(ascii_lower(text), NOT_ALNUM)


def _of_window(word_hashes: Column, i: Column, n: int) -> Column:
    """Element by element: slice() would copy the whole array for every window."""
    return F.xxhash64(*[F.get(word_hashes, i - 1 + o) for o in range(n)])


def _hashes(w: Column) -> Column:
    return F.transform(w, lambda x: F.xxhash64(x))


def item_windows(items: DataFrame, n: int, item_id: str, text: str) -> DataFrame:
    """Distinct (item, window): ``item_id, len, h, gram`` (the words as an array)."""
    w = items.select(col(items, item_id).cast("string").alias("item_id"), _words(col(items, text)).alias("w"))
    w = w.where(F.size("w") > 0).withColumn("len", F.least(F.size("w"), F.lit(n)))
    grams = w.select(
        "item_id",
        "len",
        F.explode(
            F.when(F.size("w") < n, F.array("w")).otherwise(
                let(
                    F.col("w"),
                    lambda x: F.transform(starts(x, n), lambda i: F.array(*[F.get(x, i - 1 + o) for o in range(n)])),
                )
            )
        ).alias("gram"),
    )
    hashed = F.coalesce(*[F.when(F.col("len") == k, _of_window(_hashes(F.col("gram")), F.lit(1), k)) for k in range(1, n + 1)])
    return grams.select("item_id", "len", hashed.alias("h"), "gram").distinct()


def _keyed(docs: DataFrame, doc_id: str, text: str) -> dict[str, Column]:
    """Rows of equal id and text have equal results, so these two stand for a row."""
    return {"k": col(docs, doc_id), "kt": F.xxhash64(col(docs, text))}


def _in_bitmap(bitmap: Column, bits: int, h: Column) -> Column:
    word = F.get(bitmap, F.shiftright(h.bitwiseAND(F.lit(bits - 1)), 6).cast("int"))
    return F.getbit(word, h.bitwiseAND(F.lit(63)).cast("int")) == 1


def _bitmap(grams: DataFrame, lead: int, bits: int) -> Column:
    """Of the hashes of the first ``lead`` words; ``bits`` / 64 longs, a literal of the plan."""
    h = grams.select(_lead_hash(F.col("gram"), F.lit(1), lead).alias("h"))
    slots = h.groupBy(F.shiftright(F.col("h").bitwiseAND(F.lit(bits - 1)), 6).alias("slot")).agg(
        F.bit_or(F.expr("shiftleft(1L, int(h & 63))")).alias("bits")
    )
    longs = {r["slot"]: r["bits"] for r in slots.collect()}
    return F.split(F.lit(",".join(str(longs.get(i, 0)) for i in range(bits // 64))), ",").cast("array<bigint>")


def _lead_hash(w: Column, i: Column, lead: int) -> Column:
    return F.xxhash64(*[F.get(w, i - 1 + o) for o in range(lead)])


def _candidates(w: Column, lengths: list[int], lead: int, bitmap: Column, bits: int) -> Column:
    """Windows whose first words are in the bitmap: ``pos, len, h, gram``."""

    def of_length(w: Column, bitmap: Column, n: int) -> Column:
        found = F.filter(starts(w, n), lambda i: _in_bitmap(bitmap, bits, _lead_hash(w, i, lead)))
        grams = F.transform(
            found, lambda i: F.struct(i.alias("pos"), F.array(*[F.get(w, i - 1 + o) for o in range(n)]).alias("gram"))
        )
        return F.transform(
            grams,
            lambda x: F.struct(
                x["pos"].alias("pos"),
                F.lit(n).alias("len"),
                _of_window(_hashes(x["gram"]), F.lit(1), n).alias("h"),
                x["gram"].alias("gram"),
            ),
        )

    return let(w, lambda w: let(bitmap, lambda b: F.flatten(F.array(*[of_length(w, b, n) for n in lengths]))))


def scan(
    docs: DataFrame, items: DataFrame, *, n: int, doc_id: str, text: str, item_id: str, block_bytes: int
) -> tuple[DataFrame, DataFrame]:
    """Every document's ``k, kt, n_words``, and per document with a hit its ``spans`` and ``items``."""
    tests = materialize(item_windows(items, n, item_id, text), "test-windows")
    grams = tests.select("len", "h", "gram").distinct()
    seen = grams.groupBy("len").agg(F.count("*").alias("n"), F.sum(F.length(F.array_join("gram", " ")) + 64).alias("bytes")).collect()
    lengths = sorted(r["len"] for r in seen)
    lead = min([4, *lengths])
    blocks = max(1, math.ceil(sum(r["bytes"] for r in seen) / block_bytes))
    bits = 1 << max(10, math.ceil(math.log2(16 * max(1, sum(r["n"] for r in seen) / blocks))))
    keyed = docs.select(*[c.alias(a) for a, c in _keyed(docs, doc_id, text).items()], _words(col(docs, text)).alias("w"))

    def probe(block: int) -> tuple[DataFrame, DataFrame]:
        part = grams.where(F.pmod("h", F.lit(blocks)) == block) if blocks > 1 else grams
        found = _candidates(F.col("w"), lengths, lead, _bitmap(part, lead, bits), bits) if lengths else None
        read = materialize(
            keyed.select("k", "kt", F.size("w").cast("long").alias("n_words"), *([found.alias("found")] if lengths else [])),
            "test-candidates",
        )
        if not lengths:
            return read, None
        windows = read.select("k", "kt", F.explode("found").alias("x")).select("k", "kt", "x.*")
        return read, windows.join(F.broadcast(part), ["len", "h", "gram"])

    probed = [probe(block) for block in range(blocks)]
    rows = probed[0][0].select("k", "kt", "n_words")
    if not lengths:
        none = rows.select("k", "kt", F.expr("CAST(NULL AS array<struct<pos int, len int>>) AS spans"), F.expr("CAST(NULL AS array<string>) AS items"))
        return rows, none.limit(0)
    found = reduce(DataFrame.unionByName, [p[1] for p in probed])
    spans = found.groupBy("k", "kt").agg(
        F.collect_set(F.struct("pos", "len")).alias("spans"), F.collect_set(F.struct("len", "h", "gram")).alias("grams")
    )
    return rows, (
        spans.select("k", "kt", "spans", F.explode("grams").alias("g"))
        .select("k", "kt", "spans", "g.len", "g.h", "g.gram")
        .join(tests, ["len", "h", "gram"])
        .groupBy("k", "kt")
        .agg(F.any_value("spans").alias("spans"), F.sort_array(F.collect_set("item_id")).alias("items"))
    )


def covered(spans: Column) -> Column:
    """Number of words inside any of the spans."""
    return F.aggregate(
        F.sort_array(spans),
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda acc, s: F.struct(
            (acc["n"] + F.greatest(F.lit(0), s["pos"] + s["len"] - F.greatest(acc["end"], s["pos"]))).alias("n"),
            F.greatest(acc["end"], s["pos"] + s["len"]).alias("end"),
        ),
    )["n"].cast("long")


def report(
    docs: DataFrame,
    items: DataFrame,
    *,
    n: int = 13,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    block_bytes: int = 32 << 20,
) -> DataFrame:
    """Per document: words, hit words, items found and whether it is contaminated.

    Contaminated: some word is hit, and at least one word in twenty.
    """
    base, found = scan(docs, items, n=n, doc_id=doc_id, text=text, item_id=item_id, block_bytes=block_bytes)
    found = found.select(F.col("k").alias("f_k"), F.col("kt").alias("f_kt"), covered(F.col("spans")).alias("n_hit"), "items")
    base = base.join(found, base["k"].eqNullSafe(found["f_k"]) & base["kt"].eqNullSafe(found["f_kt"]), "left")
    none = F.array().cast("array<string>")
    base = base.withColumns({"n_hit": F.coalesce("n_hit", F.lit(0).cast("long")), "items": F.coalesce("items", none)})
    return base.select(
        F.col("k").alias("doc_id"),
        "kt",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        "items",
        ((F.col("n_hit") > 0) & (F.col("n_hit") * 20 >= F.col("n_words"))).alias("contaminated"),
    )


def drop_documents(docs: DataFrame, items: DataFrame, *, doc_id: str = "doc_id", text: str = "text", **kw) -> DataFrame:
    """``docs`` without its contaminated rows, columns as they are."""
    bad = report(docs, items, doc_id=doc_id, text=text, **kw).where("contaminated")
    bad = bad.select(F.col("doc_id").alias("b_k"), F.col("kt").alias("b_kt")).distinct()
    rows = packed(docs, **_keyed(docs, doc_id, text))
    same = rows["k"].eqNullSafe(bad["b_k"]) & rows["kt"].eqNullSafe(bad["b_kt"])
    return unpacked(rows.join(bad, same, "left_anti"))


def cut_spans(
    docs: DataFrame,
    items: DataFrame,
    *,
    n: int = 13,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    block_bytes: int = 32 << 20,
) -> DataFrame:
    """``docs`` with every hit word, and what follows it up to the next word, cut from the text."""
    _, found = scan(docs, items, n=n, doc_id=doc_id, text=text, item_id=item_id, block_bytes=block_bytes)
    found = found.select(F.col("k").alias("f_k"), F.col("kt").alias("f_kt"), "spans")
    rows = packed(docs, **_keyed(docs, doc_id, text))
    rows = rows.join(found, rows["k"].eqNullSafe(found["f_k"]) & rows["kt"].eqNullSafe(found["f_kt"]), "left")
    old = F.col("row").getField(text)
    lead = F.regexp_extract(old, r"\A([\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*)", 1)
    hit = let(
        F.flatten(F.transform("spans", lambda s: F.sequence(s["pos"] - 1, s["pos"] + s["len"] - 2))),
        lambda at: F.filter(F.regexp_extract_all(old, F.lit(_PIECE), 1), lambda _, i: ~F.array_contains(at, i)),
    )
    new = F.when(F.col("spans").isNull(), old).otherwise(F.concat(lead, F.array_join(hit, "")))
    return rows.select(F.col("row").withField("`" + text.replace("`", "``") + "`", new).alias("row")).select("row.*")

"""Queries with SQL equal it on the smallest driver tables; the pipeline equals its stages by brute force."""

import re
import struct
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pytest

import corpus_pipeline
from starmart.llm.queries import ORACLES, QUERIES
from starmart.scratch import materialize

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
pytestmark = pytest.mark.skipif(not Path(SF).is_dir(), reason="driver tables not present")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, name, monkeypatch):
    compare = pytest.importorskip("checks.compare")
    monkeypatch.setattr(compare, "QUERIES", QUERIES)
    monkeypatch.setattr(compare, "ORACLES", ORACLES)
    assert compare.compare(spark, compare.connect(SF), SF, name) is None


def words(text, between):
    return [w for w in re.split(f"[{between}]+", text or "") if w]


def good(text):
    w = words(text, r"\x20\x09-\x0D")
    grams = Counter(zip(w, w[1:], w[2:], strict=False))
    repeated = {p + o for p in range(len(w) - 2) if grams[tuple(w[p : p + 3])] > 1 for o in range(3)}
    lines = [x for x in (text or "").split("\n") if words(x, r"\x20\x09-\x0D")]
    chars, symbols, capitals = sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), sum("A" <= c <= "Z" for c in text or "")
    return not (
        len(w) < 50 or 100 * len(repeated) > 50 * len(w) or symbols * 10 > len(w) * 3 or capitals * 2 > chars
        or 2 * (len(lines) - len(set(lines))) > len(lines) or chars < 2 * len(w) or chars > 20 * len(w)
    )


def one_of_each_group(docs):
    sets = []
    for d in docs:
        w = words(d["text"].translate(LOWER), r"\x20\x09-\x0D")
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)})
    part = list(range(len(docs)))

    def find(i):
        while part[i] != i:
            i = part[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                x, y = find(i), find(j)
                part[max(x, y)] = min(x, y)
    least = {}
    for i, d in enumerate(docs):
        least[find(i)] = min(least.get(find(i), d["doc_id"]), d["doc_id"])
    return [d for i, d in enumerate(docs) if least[find(i)] == d["doc_id"]]


def without_repeats(docs, length=200):
    texts = [d["text"].encode() for d in docs]
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for d, t in zip(docs, texts, strict=True):
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        left = bytes(b for b, g in zip(t, gone, strict=True) if not g).decode("utf-8", "ignore")
        out.append(d | {"text": left, "n_chars": len(left)})
    return out


def uncontaminated(docs, items, n=13):
    windows = {k: {} for k in range(1, n + 1)}
    for item, text in items:
        w = words((text or "").translate(LOWER), r"\x00-\x2F\x3A-\x60\x7B-\x7F")
        k = min(len(w), n)
        for i in range(len(w) - k + 1) if w else ():
            windows[k][tuple(w[i : i + k])] = item
    kept = []
    for d in docs:
        w = words(d["text"].translate(LOWER), r"\x00-\x2F\x3A-\x60\x7B-\x7F")
        hit = {p for k, known in windows.items() if known for i in range(len(w) - k + 1) if tuple(w[i : i + k]) in known for p in range(i, i + k)}
        if not (hit and 20 * len(hit) >= len(w)):
            kept.append(d)
    return kept


def tokens(docs):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for d in docs:
        ids = tokenizer.encode(d["text"], add_special_tokens=False).ids + [0]
        for piece, start in enumerate(range(0, len(ids), 2048)):
            part = ids[start : start + 2048]
            yield d["doc_id"], piece, start, len(part), zlib.crc32(struct.pack(f"<{len(part)}I", *part))


def test_pipeline(spark):
    """Every stage on what the one before kept, in plain Python, row by row."""
    table = spark.read.parquet(f"{SF}/documents.parquet")
    docs = [r.asDict() for r in table.collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    by_hand = [
        lambda docs: [d for d in docs if good(d["text"])],
        one_of_each_group,
        without_repeats,
        lambda docs: uncontaminated(docs, items),
    ]
    counts = [len(docs)]
    frame = table
    for (name, stage), expected in zip(corpus_pipeline.STAGES, by_hand, strict=False):
        before, docs = docs, expected(docs)
        frame = materialize(stage(spark, frame, SF), f"test-{name}")
        assert frame.dtypes == table.dtypes
        assert sorted((tuple(r) for r in frame.collect()), key=repr) == sorted((tuple(d.values()) for d in docs), key=repr), name
        assert docs != before or name == "suffix_dedup", f"{name} has nothing to do here"
        counts.append(len(docs))
    assert counts[0] > counts[1] >= counts[2] == counts[3] >= counts[4] > 0
    packed = corpus_pipeline.run(spark, SF).collect()
    pieces = [(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in packed]
    assert sorted(pieces) == sorted(tokens(docs))
    places = {}
    for r in packed:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for held in places.values():
        ends = [0, *np.cumsum([n for _, n in sorted(held)]).tolist()]
        assert [o for o, _ in sorted(held)] == ends[:-1] and ends[-1] <= 2048
    assert len(places) <= 1 + -(-sum(p[3] for p in pieces) // 2048)

"""License scans by patience alignment of texts with license templates.

Words are lower-cased runs of letters, digits and non-ASCII characters; Roman numerals of
two or more letters up to ten are read as their numbers.  A template is aligned with the
text from every word of its own on, over little more than its own length, wherever enough of
its words fall there; so no single word decides where a notice is looked for, and a notice
given twice is found as well.  The alignment takes equal words off both ends, anchors on
words that occur once on either side, keeps the longest increasing run of anchors, and goes
on in the gaps between them; coverage is the share of the template's words aligned.

An alignment counts only if the words that tell the license from others (``TELLING``) are
aligned, with no further word in the text just before them: "BY-NC-SA 4.0" is not "BY-NC 4.0".

A text has one row: its best license by coverage, then matched words, then name, and all
licenses that are covered enough; NULL and none if there is none.  Of equal alignments the
earliest counts.  NULL and empty texts have none.  Rows are judged alone, so repeated rows
get equal results.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from math import ceil

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from starmart.llm.exprs import col

_WORD = re.compile(r"[0-9a-z\u0080-\U0010ffff]+")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

#: Notices as they stand in texts (fixed values); a caller may bring whole licenses.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "MIT": "Released under the MIT License.",
}
#: Words without which a notice is another license's, by template; a caller's own may have none.
TELLING = {
    "Apache-2.0": "apache 2 0",
    "BSD-3-Clause": "redistribution source binary",
    "CC-BY-4.0": "creative commons attribution 4 0",
    "CC-BY-NC-4.0": "cc by nc 4 0",
    "GPL-3.0": "gnu general public 3",
    "MIT": "mit",
}
_ROMAN = {"ii": "2", "iii": "3", "iv": "4", "vi": "6", "vii": "7", "viii": "8", "ix": "9"}
_SPELLED = {n: (n, r) for r, n in _ROMAN.items()}


def words(text: str) -> list[str]:
    return [_ROMAN.get(w, w) for w in _WORD.findall(text.translate(_LOWER))]


def _increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest run of pairs, given in order of the first, that rises in the second."""
    tops: list[int] = []
    at: list[int] = []
    back: list[int] = []
    for i, (_, b) in enumerate(pairs):
        k = bisect_left(tops, b)
        back.append(at[k - 1] if k else -1)
        if k == len(tops):
            tops.append(b)
            at.append(i)
        else:
            tops[k], at[k] = b, i
    out, i = [], at[-1] if at else -1
    while i >= 0:
        out.append(pairs[i])
        i = back[i]
    return out[::-1]


def align(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Pairs of places of equal words, rising on both sides."""
    found: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            found.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            found.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        ours, theirs = Counter(a[a0:a1]), Counter(b[b0:b1])
        place = {b[j]: j for j in range(b0, b1) if theirs[b[j]] == 1}
        anchors = _increasing([(i, place[a[i]]) for i in range(a0, a1) if ours[a[i]] == 1 and a[i] in place])
        found += anchors
        if anchors:
            ends = [(a0 - 1, b0 - 1), *anchors, (a1, b1)]
            todo += [(x[0] + 1, y[0], x[1] + 1, y[1]) for x, y in zip(ends, ends[1:], strict=False)]
    return sorted(found)


def _told(pairs: list[tuple[int, int]], template: list[str], telling: set[str]) -> bool:
    """Whether all telling words are aligned, and nothing is put in before them."""
    before = {b: (a - x, b - y) for (x, y), (a, b) in zip(pairs, pairs[1:], strict=False)} | ({pairs[0][1]: (0, 0)} if pairs else {})
    return all(w not in telling or (b in before and before[b][0] <= before[b][1]) for b, w in enumerate(template))


def best_alignment(text: list[str], template: list[str], telling: set[str] = frozenset(), least: float = 0.0) -> tuple[int, int, int]:
    """Words aligned, and first and last place in the text, of the best window with ``least`` of the template."""
    limit = Counter(template)
    need = max(1, ceil(least * len(template) - 1e-9))
    length = len(template) + max(2, len(template) // 4)
    places = [i for i, w in enumerate(text) if w in limit]
    best = (0, -1, -1)
    if not telling.issubset({text[i] for i in places}):
        return best
    held: Counter[str] = Counter()
    # enough: words of the window that the template has, none counted more often than there
    enough = end = 0
    for at in places:
        while end < len(places) and places[end] < at + length:
            w = text[places[end]]
            held[w] += 1
            enough += held[w] <= limit[w]
            end += 1
        if enough >= max(need, best[0] + 1):
            for size in (length, len(template)):
                pairs = align(text[at : at + size], template)
                if len(pairs) >= need and len(pairs) > best[0] and _told(pairs, template, telling):
                    best = (len(pairs), at + pairs[0][0], at + pairs[-1][0])
        enough -= held[text[at]] <= limit[text[at]]
        held[text[at]] -= 1
    return best


def scan_text(text: str | None, templates: dict[str, list[str]], least: float, telling: dict[str, set[str]]) -> tuple:
    """License, matched words, template words, coverage, first and last word, all licenses; NULLs if none is covered."""
    lower = (text or "").translate(_LOWER)
    own, found = None, []
    for name, template in sorted(templates.items()):
        # a word of the text is a substring of it: without enough of them there is no use in aligning
        if sum(any(x in lower for x in _SPELLED.get(w, (w,))) for w in template) < least * len(template):
            continue
        own = words(lower) if own is None else own
        matched, first, last = best_alignment(own, template, telling.get(name, frozenset()), least)
        if matched and matched / len(template) >= least:
            found.append((name, matched, len(template), matched / len(template), first, last))
    if not found:
        return None, 0, None, 0.0, None, None, []
    found.sort(key=lambda x: (-x[3], -x[1]))
    return *found[0], [x[0] for x in found]


def scan(
    docs: DataFrame, templates: dict[str, str] = TEMPLATES, *, telling: dict[str, str] = TELLING, least: float = 0.8, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Every document's best license, how it is covered, and all licenses that are."""
    slim = docs.select(col(docs, doc_id).alias("doc_id"), col(docs, text).alias("text"))
    split = {name: words(t) for name, t in templates.items() if words(t)}
    telling = {name: set(words(t)) for name, t in telling.items()}
    schema = T.StructType(
        [
            slim.schema["doc_id"],
            T.StructField("license", T.StringType()),
            T.StructField("matched_words", T.LongType()),
            T.StructField("template_words", T.LongType()),
            T.StructField("coverage", T.DoubleType()),
            T.StructField("first_word", T.LongType()),
            T.StructField("last_word", T.LongType()),
            T.StructField("licenses", T.ArrayType(T.StringType())),
        ]
    )
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64(), pa.list_(pa.string()))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [scan_text(t.as_py(), split, least, telling) for t in batch.column(1)]
            columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True) if rows else [()] * 7, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=schema.names)

    return slim.mapInArrow(judge, schema)

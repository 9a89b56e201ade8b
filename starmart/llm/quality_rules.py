"""Quality rules as a short-circuit cascade.

Every rule is a column expression that is true where a text is rejected.  Cost and
rejection rate of each rule are measured on a bounded random sample; the rules then run
in the order of rejections per second, in one ``CASE``, so that a text which a cheap rule
rejects never reaches the dearer ones.  The order changes the running time only: a text
is kept if no rule rejects it.

NULL counts as the empty text.  All results are per row, so repeated rows get equal
results; an empty table gives an empty result.  All work is done by built-in functions.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.llm.exprs import SPACE, col, let, packed, starts, unpacked, words
from starmart.scratch import materialize

SYMBOLS = "#*$%&|<>"
_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


@dataclass(frozen=True)
class Text:
    """What a rule may use: the text and its words."""

    text: Column
    words: Column

    @property
    def n_words(self) -> Column:
        return F.size(self.words).cast("long")

    @property
    def word_chars(self) -> Column:
        """Code points in words."""
        return F.length(F.array_join(self.words, "")).cast("long")

    @property
    def n_symbols(self) -> Column:
        return _count_of(self.text, SYMBOLS)

    @property
    def n_capitals(self) -> Column:
        return _count_of(self.text, _CAPITALS)

    @property
    def lines(self) -> Column:
        """Lines with a word."""
        return F.filter(F.split(self.text, "\n"), lambda x: x.rlike(f"[^{SPACE}]"))

    @property
    def n_dup_lines(self) -> Column:
        """Lines with a word that equal an earlier line."""
        return let(self.lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")

    @property
    def n_repeat_words(self) -> Column:
        """Words inside three-word windows that occur twice or more, the first included."""
        return _repeat_words(self.words)


def _count_of(text: Column, characters: str) -> Column:
    return (F.length(text) - F.length(F.translate(text, characters, ""))).cast("long")


_PLACE_BITS = 20


def _repeat_words(words: Column) -> Column:
    """Sort the windows so that equal ones are neighbours.  O(n log n) a text.

    Sorted are longs of 44 bits of a window's hash and its place.  Neighbours of equal
    hash are compared word by word; should any differ, or the text be too long for the
    place's bits, the text is done again with the windows themselves.
    """

    def same(w: Column, i: Column, j: Column) -> Column:
        return reduce(and_, [F.get(w, i - 1 + o) == F.get(w, j - 1 + o) for o in range(3)])

    def key(w: Column, i: Column) -> Column:
        h = F.xxhash64(F.get(w, i - 1), F.get(w, i), F.get(w, i + 1))
        return F.shiftleft(h, _PLACE_BITS).bitwiseOR(i.cast("long"))

    def group(s: Column, k: Column) -> Column:
        return F.shiftright(F.get(s, k), _PLACE_BITS)

    def place(x: Column) -> Column:
        return x.bitwiseAND(F.lit((1 << _PLACE_BITS) - 1)).cast("int")

    def quick(w: Column, s: Column) -> Column:
        def equal(x: Column, k: Column) -> Column:
            g = F.shiftright(x, _PLACE_BITS)
            return F.coalesce(g == group(s, k - 1), F.lit(False)) | F.coalesce(g == group(s, k + 1), F.lit(False))

        def mixed(r: Column) -> Column:
            runs = F.transform(
                r,
                lambda x, k: (k > 0)
                & (group(r, k) == group(r, k - 1))
                & ~same(w, place(x), place(F.get(r, k - 1))),
            )
            return F.exists(runs, lambda x: x)

        return let(
            F.filter(s, equal),
            lambda r: F.when(mixed(r), plain(w)).otherwise(covered(F.sort_array(F.transform(r, place)))),
        )

    def plain(w: Column) -> Column:
        windows = F.transform(
            starts(w, 3),
            lambda i: F.struct(F.concat_ws(" ", F.get(w, i - 1), F.get(w, i), F.get(w, i + 1)).alias("g"), i.alias("i")),
        )
        return let(
            F.sort_array(windows),
            lambda s: covered(
                F.sort_array(
                    F.transform(
                        F.filter(
                            s,
                            lambda x, k: F.coalesce(x["g"] == F.get(s, k - 1)["g"], F.lit(False))
                            | F.coalesce(x["g"] == F.get(s, k + 1)["g"], F.lit(False)),
                        ),
                        lambda x: x["i"],
                    )
                )
            ),
        )

    def covered(places: Column) -> Column:
        return F.aggregate(
            places,
            F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")),
            lambda acc, i: F.struct((acc["n"] + F.least(F.lit(3), i - acc["last"])).alias("n"), i.alias("last")),
        )["n"]

    def count(w: Column) -> Column:
        sort = F.sort_array(F.transform(starts(w, 3), lambda i: key(w, i)))
        return F.when(F.size(w) >= 1 << _PLACE_BITS, plain(w)).otherwise(let(sort, lambda s: quick(w, s)))

    return let(words, count).cast("long")


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[Text], Column]


#: Too short, or mostly made of repeated three-word windows.
BASE_RULES = (
    Rule("few_words", lambda t: t.n_words < 50),
    Rule("repetition", lambda t: t.n_repeat_words * 100 > t.n_words * 50),
)
#: Texts that are mostly markup, capitals, repeated lines, or words of odd length.
MORE_RULES = (
    Rule("symbols", lambda t: t.n_symbols * 10 > t.n_words * 3),
    Rule("capitals", lambda t: t.n_capitals * 2 > t.word_chars),
    Rule("repeated_lines", lambda t: t.n_dup_lines * 2 > F.size(t.lines)),
    Rule("word_length", lambda t: (t.word_chars < t.n_words * 2) | (t.word_chars > t.n_words * 20)),
)
RULES = BASE_RULES + MORE_RULES


@dataclass(frozen=True)
class Measured:
    rule: Rule
    rejected: float
    seconds: float

    @property
    def rejections_per_second(self) -> float:
        return self.rejected / max(self.seconds, 1e-9)


def measure_rules(
    docs: DataFrame, rules: Sequence[Rule] = RULES, *, text: str = "text", sample_rows: int = 2000, seed: int = 7
) -> list[Measured]:
    """Cost and rejection rate of each rule on about ``sample_rows`` random rows."""
    rows = docs.count()
    fraction = min(1.0, sample_rows / rows) if rows else 1.0
    sample = _with_words(docs.select(col(docs, text).alias("text")).sample(fraction=fraction, seed=seed), "text")
    sample = materialize(sample.select("t", "w"), "rule-sample")
    of = Text(F.col("t"), F.col("w"))
    rates = sample.agg(*[F.avg(r.rejects(of).cast("double")).alias(f"r{i}") for i, r in enumerate(rules)]).first()
    measured = []
    for i, rule in enumerate(rules):
        began = time.perf_counter()
        sample.agg(F.count_if(rule.rejects(of))).collect()
        measured.append(Measured(rule, rates[i] or 0.0, time.perf_counter() - began))
    return measured


def in_order(measured: Sequence[Measured]) -> list[Rule]:
    """The rules by rejections per second, the best first; ties by name."""
    return [m.rule for m in sorted(measured, key=lambda m: (-m.rejections_per_second, m.rule.name))]


def first_rejection(of: Text, rules: Sequence[Rule]) -> Column:
    """Name of the first rule that rejects, NULL if none does; later rules are not evaluated."""
    case = None
    for rule in rules:
        case = F.when(rule.rejects(of), rule.name) if case is None else case.when(rule.rejects(of), rule.name)
    return F.lit(None).cast("string") if case is None else case


def _with_words(df: DataFrame, text: str) -> DataFrame:
    t = F.coalesce(col(df, text), F.lit(""))
    return packed(df, t=t, w=words(t, SPACE))


def keep_good(docs: DataFrame, rules: Sequence[Rule] = RULES, *, text: str = "text", sample_rows: int = 2000) -> DataFrame:
    """The rows of ``docs``, columns as they are, that no rule rejects."""
    order = in_order(measure_rules(docs, rules, text=text, sample_rows=sample_rows))
    of = Text(F.col("t"), F.col("w"))
    return unpacked(_with_words(docs, text).where(first_rejection(of, order).isNull()))


def judge(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", sample_rows: int = 2000) -> DataFrame:
    """Measures and verdict of every row: base rules first, then the cascade of the others."""
    order = in_order(measure_rules(docs, MORE_RULES, text=text, sample_rows=sample_rows))
    of = Text(F.col("t"), F.col("w"))
    measured = _with_words(docs.select(col(docs, doc_id).alias("doc_id"), col(docs, text).alias("text")), "text").select(
        F.col("row.doc_id").alias("doc_id"),
        "t",
        "w",
        *[getattr(of, n).alias(n) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
    )
    base_failed = (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)
    return measured.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        base_failed.alias("base_failed"),
        F.when(base_failed, False).otherwise(first_rejection(of, order).isNull()).alias("kept"),
    )

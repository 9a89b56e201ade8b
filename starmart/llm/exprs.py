"""Column expressions shared by the text operators; all run inside the JVM."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Characters between words: ASCII white space.
SPACE = r"\x20\x09-\x0D"
#: Characters between words after lower-casing: all of ASCII but digits and a-z.
NOT_ALNUM = r"\x00-\x2F\x3A-\x60\x7B-\x7F"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over ``value``, which is computed once even where body uses it in a lambda."""
    return F.element_at(F.transform(F.array(value), body), 1)


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, every other character as it is."""
    return F.translate(text, _UPPER, _UPPER.lower())


def words(text: Column, between: str) -> Column:
    """The maximal runs of characters outside ``between``; none for NULL."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), f"[{between}]+"), "")


def starts(words: Column, length: int | Column) -> Column:
    """1-based starts of all windows of ``length`` words; empty if there is none."""
    n = F.size(words) - F.lit(length) + 1
    return F.when(n >= 1, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))


def packed(df: DataFrame, **columns: Column) -> DataFrame:
    """The rows of ``df`` as one struct ``row`` beside ``columns``.

    Whatever names ``df`` has, they cannot clash with those an operator adds.
    """
    return df.select(F.struct(*[df[_quoted(c)] for c in df.columns]).alias("row"), *[c.alias(n) for n, c in columns.items()])


def unpacked(df: DataFrame) -> DataFrame:
    return df.select("row.*")


def col(df: DataFrame, name: str) -> Column:
    return df[_quoted(name)]


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"

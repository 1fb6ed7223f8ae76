"""Small text helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexspark import fixed


def strip(text: Column) -> Column:
    """Remove Unicode whitespace at both ends (``trim`` alone removes only U+0020)."""
    return F.btrim(text, F.lit(fixed.WHITESPACE))


def or_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def digits_or(text: Column, default: int | None) -> Column:
    """``bigint`` of an all-digit string, else ``default``. No signs, no surrounding spaces."""
    return F.coalesce(F.when(text.rlike(r"\A[0-9]+\z"), text.try_cast("bigint")), F.lit(default).cast("bigint"))


def int_or_zero(text: Column) -> Column:
    """``bigint`` of a string that may carry spaces or a sign, else 0."""
    bare = strip(text)
    return F.coalesce(
        F.when(bare.rlike(r"\A[+-]?[0-9]+(?:_[0-9]+)*\z"), F.replace(bare, F.lit("_"), F.lit("")).try_cast("bigint")),
        F.lit(0).cast("bigint"),
    )


def count_substring(text: Column, needle: str) -> Column:
    """Non-overlapping occurrences of a literal, without running a regex."""
    gone = F.char_length(text) - F.char_length(F.replace(text, F.lit(needle), F.lit("")))
    return (gone / F.lit(len(needle))).cast("bigint")


def count_paragraphs(text: Column) -> Column:
    """0 for an empty text, else blank-line breaks + 1."""
    return F.when(text == "", F.lit(0).cast("bigint")).otherwise(count_substring(text, "\n\n") + 1)


def replace_all(text: Column, rules: Iterable[tuple[str, str]]) -> Column:
    """Apply regex rewrites one after the other."""
    for pattern, replacement in rules:
        text = F.regexp_replace(text, pattern, replacement)
    return text


def join_numbers(numbers: Column, separator: str = ", ") -> Column:
    return F.array_join(F.transform(numbers, lambda n: n.cast("string")), separator)


def numbers_in(text: Column) -> Column:
    """All digit runs of a text as ``array<bigint>``, in order, duplicates kept."""
    return F.transform(
        F.regexp_extract_all(text, F.lit(r"(\d+)"), F.lit(1)), lambda n: n.try_cast("bigint")
    )

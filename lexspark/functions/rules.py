"""Rule-based classification and number extraction as column expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexspark import fixed
from lexspark.functions.text import numbers_in


def no_numbers() -> Column:
    return F.array().cast("array<bigint>")


# --- outcome of a ruling -----------------------------------------------------------------------
def outcome_flags(text: Column, patterns: Mapping[str, str] = fixed.OUTCOME_PATTERNS) -> dict[str, Column]:
    return {name: F.coalesce(text.rlike(pattern), F.lit(False)) for name, pattern in patterns.items()}


def outcome_of_flags(
    flags: Mapping[str, Column], none: str = fixed.NO_OUTCOME, mixed: str = fixed.MIXED_OUTCOME
) -> Column:
    """The name of the only flag that is set; ``none`` if there is none, ``mixed`` if several."""
    n = len(flags)
    # Weights from n + 1 on: no sum of several is a weight, so one number tells all and each flag is computed once.
    raised = sum((flag.cast("int") * (n + i) for i, flag in enumerate(flags.values(), 1)), F.lit(0))
    place = F.greatest(F.least(raised - (n - 1), F.lit(n + 2)), F.lit(1))
    return F.element_at(F.array(*map(F.lit, (none, *flags, mixed))), place)


def outcome(text: Column, patterns: Mapping[str, str] = fixed.OUTCOME_PATTERNS) -> Column:
    """Outcome of one text; an empty or null text has none."""
    return outcome_of_flags(outcome_flags(text, patterns))


# --- laws --------------------------------------------------------------------------------------
def title_numbers(title: Column, ranges: Mapping[str, tuple[int, int]] = fixed.TITLE_RANGES) -> Column:
    """Article numbers named in a law's title; the first pattern that fits decides."""
    whole = F.regexp_extract(title, fixed.TITLE_WHOLE_TITLE, 1)
    by_title = F.lit(None).cast("array<bigint>")
    for roman, (first, last) in ranges.items():
        span = F.sequence(F.lit(first).cast("bigint"), F.lit(last).cast("bigint"))
        by_title = F.when(whole == roman, span).otherwise(by_title)
    numbers = F.coalesce(by_title, no_numbers())
    for pattern in (fixed.TITLE_REVISION, fixed.TITLE_ONE, fixed.TITLE_MANY):
        numbers = F.when(title.rlike(pattern), numbers_in(F.regexp_extract(title, pattern, 1))).otherwise(numbers)
    return numbers


def body_numbers(
    text: Column,
    words: Sequence[str] = fixed.CHANGE_WORDS,
    link: str = fixed.ARTICLE_LINK,
    link_group: int = 2,
) -> Column:
    """Distinct ascending article numbers linked from the changing blocks of a law's body."""
    bare = F.regexp_replace(text, fixed.BODY_FRONTMATTER, "")
    blocks = F.filter(
        F.split(bare, rf"(?mdU)^(?={fixed.BODY_HEADER})"),
        lambda b: b.rlike(rf"(?U)\A{fixed.BODY_HEADER}"),
    )
    blocks = F.transform(blocks, lambda b: F.regexp_replace(b, fixed.BODY_NOTES, ""))
    blocks = F.filter(blocks, lambda b: F.lower(b).rlike("|".join(words)))
    linked = F.transform(blocks, lambda b: F.regexp_extract_all(b, F.lit(link), F.lit(link_group)))
    numbers = F.transform(F.flatten(linked), lambda n: n.try_cast("bigint"))
    return F.sort_array(F.array_distinct(numbers))


def law_type(title: Column, numbers: Column) -> Column:
    def any_of(patterns: Sequence[str]) -> Column:
        return title.rlike("(?iU)" + "|".join(patterns))

    return (
        F.when(any_of(fixed.STATUTE_TITLES), F.lit(fixed.STATUTE))
        .when(any_of(fixed.OTHER_LAW_TITLES), F.lit(fixed.OTHER_LAW))
        .when(F.size(numbers) > 0, F.lit(fixed.AMENDMENT))
        .otherwise(F.lit(fixed.OTHER_LAW))
    )

"""Outcome of a group of texts that sit in different rows.

The outcome is that of the group's texts joined by a space, in order. Joining them in one task
would not work for a group holding a large share of all rows, so the texts are never collected:

* a match inside one text is a flag of that row, and flags combine with ``bool_or``;
* a match across texts covers at most ``words`` words, a number that follows from the patterns, so
  it can only touch the first and last ``words - 1`` words of each text. Only these edges are folded, in order, in chunks of
  consecutive positions; each chunk yields its flags and again an edge.

A round folds chunks of at most 16,384 positions, and the last round what is left of a group.
Three rounds cover positions up to 2**42 in pieces of that size. Fewer are enough, and faster, where
positions are known to be small.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexspark import fixed
from lexspark.functions.rules import outcome_flags, outcome_of_flags
from lexspark.functions.spans import words_spanned
from lexspark.functions.text import strip

_CUT = " \x00 "
_CHUNK_BITS = 14
_POSITION_BITS = 42


def _first_words(text: Column, n: int) -> Column:
    return F.regexp_extract(text, rf"(?U)\A\s*(?:\S+\s+){{0,{n - 1}}}\S*", 0)


def _edge(text: Column, n: int) -> Column:
    """The text, or only its first and last ``n`` words with a cut between them."""
    head = _first_words(text, n)
    tail = F.reverse(_first_words(F.reverse(text), n))
    short = F.char_length(head) + F.char_length(tail) >= F.char_length(text)
    return F.when(short, text).otherwise(F.concat(head, F.lit(_CUT), tail))


def group_outcome(
    df: DataFrame,
    key: str,
    position: str,
    text: str,
    patterns: Mapping[str, str] = fixed.OUTCOME_PATTERNS,
    words: int | None = None,
    position_bits: int = _POSITION_BITS,
    chunk_bits: int = _CHUNK_BITS,
) -> DataFrame:
    """``(key, esito)``, one row per key.

    ``position`` is an integer that orders the texts of a group, from 0 to below
    ``2 ** position_bits`` and once per text; others stop the job. ``words`` is what a match may
    span; by default it follows from the patterns, and fewer than that are refused, as are patterns
    without a bound.
    """
    needed = max(map(words_spanned, patterns.values()), default=1)
    if words is None:
        words = needed
    if words < needed:
        raise ValueError(f"the patterns span {needed} words, not {words}")
    names = [f"_f{i}" for i in range(len(patterns))]
    flags = outcome_flags(F.col(text), patterns)
    rows = df.select(
        key,
        F.col(position).cast("bigint").alias("_at"),
        *[flag.alias(n) for n, flag in zip(names, flags.values(), strict=True)],
        (_edge(F.col(text), words - 1) if words > 1 else F.lit("")).alias("_edge"),
    )

    def merged() -> list[Column]:
        return [F.bool_or(n).alias(n) for n in names]

    if words > 1:
        rounds = max(1, -(-position_bits // chunk_bits))
        fits = F.col("_at").between(0, (1 << min(position_bits, rounds * chunk_bits, 62)) - 1)
        rows = rows.withColumn("_at", F.when(fits, F.col("_at")).otherwise(F.raise_error(F.lit("a position is null or out of range")).cast("bigint")))
        for left in reversed(range(rounds)):
            chunk = F.shiftright("_at", chunk_bits) if left else F.lit(0).cast("bigint")
            joined = F.array_join(F.transform(
                F.sort_array(F.collect_list(F.when(strip(F.col("_edge")) != "", F.struct("_at", "_edge")))),
                lambda e: e["_edge"],
            ), " ")
            distinct = F.size(F.collect_set("_at")) == F.count(F.lit(1))
            folded = rows.groupBy(key, chunk.alias("_chunk")).agg(
                *merged(), F.when(distinct, joined).otherwise(F.raise_error(F.lit("a position occurs twice in a group")).cast("string")).alias("_edge"))
            across = outcome_flags(F.col("_edge"), patterns).values()
            rows = folded.select(
                key, F.col("_chunk").alias("_at"),
                *[(F.col(n) | hit).alias(n) for n, hit in zip(names, across, strict=True)],
                _edge(F.col("_edge"), words - 1).alias("_edge"),
            )
    else:
        rows = rows.groupBy(key).agg(*merged())
    verdict = outcome_of_flags({name: F.col(n) for name, n in zip(patterns, names, strict=True)})
    return rows.select(key, verdict.alias("esito"))

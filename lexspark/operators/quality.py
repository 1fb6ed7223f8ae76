"""Dataset contract checks.

All row-level rules of a dataset are aggregates, so a report is a single pass over the table with
partial aggregation; it is then laid out as one row per rule.
"""

from __future__ import annotations

from collections.abc import Collection, Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexspark.operators.enrich import missing_keys


@dataclass(frozen=True)
class Rule:
    """A named aggregate and the range its value has to fall in."""

    name: str
    measure: Column
    at_least: int | None = None
    at_most: int | None = None


def rows_exactly(n: int) -> Rule:
    return Rule("rows", F.count(F.lit(1)), n, n)


def rows_at_least(n: int) -> Rule:
    return Rule("rows", F.count(F.lit(1)), n)


def not_null_exactly(column: str, n: int) -> Rule:
    return Rule(f"{column} not null", F.count(column), n, n)


def has_value(column: str, value: object) -> Rule:
    return Rule(f"{column} has {value}", F.count_if(F.col(column) == F.lit(value)), 1)


def only_values(column: str, values: Iterable[object]) -> Rule:
    return Rule(f"{column} in domain", F.count_if(~F.coalesce(F.col(column).isin(list(values)), F.lit(False))), 0, 0)


def at_least_where(name: str, condition: Column, n: int) -> Rule:
    return Rule(name, F.count_if(condition), n)


def array_has(column: str, value: object) -> Rule:
    return Rule(f"{column} has {value}", F.count_if(F.array_contains(column, F.lit(value))), 1)


def no_match(column: str, pattern: str) -> Rule:
    return Rule(f"{column} free of {pattern}", F.count_if(F.col(column).rlike(pattern)), 0, 0)


def not_empty(column: str) -> Rule:
    empty = F.coalesce(F.col(column).cast("string"), F.lit("")).isin("", "0")
    return Rule(f"{column} not empty", F.count_if(empty), 0, 0)


def always(name: str, condition: Column) -> Rule:
    return Rule(name, F.count_if(~F.coalesce(condition, F.lit(False))), 0, 0)


def version_is(column: str, version: int, columns: Collection[str]) -> Rule:
    """Every row has the version; a table without the column fails."""
    have = F.col(column) == version if column in columns else F.lit(False)
    return always(f"{column} is {version}", have)


def marker_count(column: str, pattern: str, at_least: int, at_most: int | None = None) -> Rule:
    found = F.coalesce(F.sum(F.regexp_count(F.col(column), F.lit(pattern)).cast("bigint")), F.lit(0))
    return Rule(f"{column} markers {pattern}", found, at_least, at_most)


def _line(rule: Rule, seen: Column) -> Column:
    ok = F.lit(True)
    if rule.at_least is not None:
        ok = ok & (seen >= rule.at_least)
    if rule.at_most is not None:
        ok = ok & (seen <= rule.at_most)
    return F.struct(F.lit(rule.name).alias("rule"), ok.alias("ok"), seen.alias("observed"))


def dq_report(df: DataFrame, rules: list[Rule]) -> DataFrame:
    measured = df.agg(*[r.measure.cast("bigint").alias(f"_m{i}") for i, r in enumerate(rules)])
    return measured.select(F.inline(F.array(*[_line(r, F.col(f"_m{i}")) for i, r in enumerate(rules)])))


def report_of(spark: SparkSession, rules: Sequence[Rule], seen: Sequence[int | None]) -> DataFrame:
    """The report of rules that were measured already."""
    lines = [_line(r, F.lit(x).cast("bigint")) for r, x in zip(rules, seen, strict=True)]
    shape = "array<struct<rule: string, ok: boolean, observed: bigint>>"
    return spark.range(1).select(F.inline(F.array(*lines).cast(shape)))


def schema_report(df: DataFrame, required: dict[str, str | None]) -> DataFrame:
    """Required columns and, where given, their types. Reads no data."""
    have = {f.name: f.dataType.simpleString() for f in df.schema}
    lines = []
    for name, kind in required.items():
        lines.append((f"column {name}", name in have))
        if kind is not None:
            lines.append((f"type {name} {kind}", have.get(name) == kind))
    report = F.array(*[
        F.struct(F.lit(rule).alias("rule"), F.lit(ok).alias("ok"), F.lit(int(ok)).cast("bigint").alias("observed"))
        for rule, ok in lines
    ])
    return df.sparkSession.range(1).select(F.inline(report))


def reference_report(df: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None) -> DataFrame:
    """Keys of ``df`` that ``parent`` lacks."""
    absent = missing_keys(df, parent, key, parent_key).agg(F.count(F.lit(1)).alias("observed"))
    return absent.select(
        F.lit(f"{key} references").alias("rule"), (F.col("observed") == 0).alias("ok"), "observed"
    )

"""Counts, shares, rates and scorecards per key."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexspark import fixed
from lexspark.functions.arrays import each


def count_by(df: DataFrame, key: str, alias: str = "volte") -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias(alias))


def ranked(counts: DataFrame, key: str, alias: str = "volte") -> DataFrame:
    """Descending by count, ties by key."""
    return counts.orderBy(F.col(alias).desc(), F.col(key))


def top(df: DataFrame, key: str, n: int = fixed.TOP_ARTICLES, alias: str = "volte") -> DataFrame:
    """The ``n`` most frequent keys; ties by key, so the report is the same on every run."""
    return ranked(count_by(df, key, alias), key, alias).limit(n)


def rate(df: DataFrame, key: str, hit: Column, minimum: int = fixed.MIN_RULINGS, alias: str = "pct") -> DataFrame:
    """Percentage of rows with ``hit`` per key, for keys with more than ``minimum`` rows."""
    totals = df.groupBy(key).agg(
        F.count_if(hit).alias("_hits"), F.count(F.lit(1)).alias("_rows")
    ).where(F.col("_rows") > minimum)
    return totals.select(key, (F.col("_hits") * F.lit(100.0) / F.col("_rows")).alias(alias))


def acceptance_rate(maxims: DataFrame, minimum: int = fixed.MIN_RULINGS) -> DataFrame:
    by_rate = rate(maxims, "parametro_articolo", F.col("esito") == fixed.ACCEPTED_OUTCOME, minimum)
    return by_rate.orderBy(F.col("pct").desc(), "parametro_articolo")


def shares(df: DataFrame, key: str, count_alias: str = "n", share_alias: str = "pct") -> DataFrame:
    """Count and percentage of all rows per key. The total is a scalar subquery over the counts."""
    counts = count_by(df, key, count_alias)
    total = counts.select(F.sum(count_alias)).scalar()
    return counts.select(key, count_alias, (F.col(count_alias) * F.lit(100.0) / total).alias(share_alias))


def totals(df: DataFrame, parent: tuple[str, ...], item: str, decided: Column) -> DataFrame:
    """One row: rows, distinct parents, distinct items, decided rows and their percentage."""
    # Distinct counts expand each row; grouped first, only one row per parent and item is expanded.
    groups = df.groupBy(F.struct(*parent).alias("_parent"), F.col(item).alias("_item")).agg(
        F.count(F.lit(1)).alias("_n"), F.count_if(decided).alias("_decided"))
    none = F.lit(0).cast("bigint")
    counted = groups.agg(
        F.coalesce(F.sum("_n"), none).alias("righe"),
        F.count_distinct("_parent").alias("pronunce"),
        F.count_distinct("_item").alias("massime"),
        F.coalesce(F.sum("_decided"), none).alias("con_esito"),
    )
    return counted.withColumn(
        "pct_con_esito", F.try_divide(F.col("con_esito") * F.lit(100.0), F.col("righe"))
    )


def maxim_totals(maxims: DataFrame) -> DataFrame:
    return totals(maxims, ("anno_pronuncia", "numero_pronuncia"), "id_massima", F.col("esito") != fixed.NO_OUTCOME)


def conditional_counts(df: DataFrame, conditions: Mapping[str, Column], by: tuple[str, ...] = ()) -> DataFrame:
    """Several counts in one pass, over everything or per key."""
    counts = [F.count_if(c).alias(name) for name, c in conditions.items()]
    return df.groupBy(*by).agg(*counts) if by else df.agg(*counts)


def segment_totals(segments: DataFrame) -> DataFrame:
    return segments.agg(
        F.count(F.lit(1)).alias("segmenti"), F.coalesce(F.sum("commi"), F.lit(0)).cast("bigint").alias("commi")
    )


def covered_keys(df: DataFrame, key: str) -> DataFrame:
    return df.select(key).distinct().orderBy(key)


def element_counts(df: DataFrame, array: str, alias: str = "elemento", count_alias: str = "volte") -> DataFrame:
    """How often each element occurs in an array column, duplicates counted."""
    return count_by(df.select(each(array).alias(alias)), alias, count_alias)


def scorecard(hub: DataFrame, key: str, facts: Sequence[tuple[DataFrame, Mapping[str, Column]]]) -> DataFrame:
    """One row per hub key with counts from every fact table, 0 where there is none.

    A fact is a table with the key column and its counters, each a condition on the rows it
    counts. All tables are read once, stacked as 0/1 counters and summed in a single aggregation:
    one shuffle whatever the number of facts, with partial sums first, so a hot key costs one row
    per task.
    """
    names = [name for _, counters in facts for name in counters]

    def stack(df: DataFrame, counters: Mapping[str, Column], in_hub: bool) -> DataFrame:
        def counter(name: str) -> Column:
            hit = F.coalesce(counters[name], F.lit(False)) if name in counters else F.lit(False)
            return hit.cast("bigint").alias(name)

        return df.where(F.col(key).isNotNull()).select(
            F.col(key).cast("bigint").alias(key), F.lit(in_hub).alias("_hub"), *[counter(n) for n in names]
        )

    stacked = stack(hub, {}, True)
    for table, counters in facts:
        stacked = stacked.unionByName(stack(table, counters, False))
    summed = stacked.groupBy(key).agg(F.bool_or("_hub").alias("_hub"), *[F.sum(n).alias(n) for n in names])
    return summed.where("_hub").drop("_hub")

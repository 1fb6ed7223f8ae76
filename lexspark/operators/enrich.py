"""Lookup joins with defaults, referential checks and key differences.

No join is forced to broadcast: Spark broadcasts a lookup side below
``spark.sql.autoBroadcastJoinThreshold`` (from statistics, or from its real size under AQE) and
sorts and merges otherwise.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexspark import fixed
from lexspark.functions.text import or_empty


def last_per_key(df: DataFrame, key: str, *order_by: Column) -> DataFrame:
    """One row per key, the last in ``order_by``.

    Spark limits every map task to one row per key before the shuffle, so a hot key costs one row
    per task. The rows are spread by a hash of the key rather than by the key itself: a join on
    the key then gets an exchange of its own on this side, which is what lets AQE split a hot key
    on the other side.
    """
    spread = F.xxhash64(key)
    newest_first = Window.partitionBy(spread, F.col(key)).orderBy(*[c.desc_nulls_last() for c in order_by])
    return df.withColumn("_rank", F.row_number().over(newest_first)).where("_rank = 1").drop("_rank")


def lookup(left: DataFrame, right: DataFrame, key: str, columns: Mapping[str, Column]) -> DataFrame:
    """Left join to a table that is unique on ``key``; every left row stays, once.

    ``columns`` are computed after the join; an unmatched row sees nulls.
    """
    joined = left.join(right, key, "left")
    return joined.select(*[F.col(c) for c in left.columns], *[c.alias(n) for n, c in columns.items()])


def add_snippet(left: DataFrame, texts: DataFrame, key: str, text: str, order_by: Column,
                alias: str = "articolo_testo", chars: int = fixed.SNIPPET_CHARS) -> DataFrame:
    """First ``chars`` characters of the text with the same key, ``""`` if there is none.

    Of several texts with a key the last one wins; null keys and empty texts do not take part.
    """
    usable = texts.where(F.col(key).isNotNull() & (or_empty(F.col(text)) != "")).select(
        key, F.substring(text, 1, chars).alias("_text"), order_by.alias("_order")
    )
    unique = last_per_key(usable, key, F.col("_order")).select(key, "_text")
    return lookup(left, unique, key, {alias: or_empty(F.col("_text"))})


def add_citation_text(citations: DataFrame, articles: DataFrame | None, order_by: Column) -> DataFrame:
    """Citations with the cited article's text; without an articles table the column is left out.

    ``order_by`` says which of several rows of an article is the last. Where no row has a text the
    column is there and empty.
    """
    base = citations.select("fonte_filename", "fonte_collezione", "fonte_anno", "fonte_tipo", "articolo", "contesto")
    if articles is None:
        return base
    return add_snippet(base, articles, "articolo", "testo", order_by)


def add_registry(mapping: DataFrame, registry: DataFrame) -> DataFrame:
    """Indicator rows: name and source of the dataset, the slug and ``""`` where they are absent."""
    has_name, has_source = F.coalesce("has_name", F.lit(False)), F.coalesce("has_source", F.lit(False))
    slug = F.col("dataset_slug")
    found = lookup(mapping, registry, "dataset_slug", {
        "dataset_name": F.when(has_name, F.col("name")).otherwise(slug),
        "fonte": F.when(has_source, F.col("source")).otherwise(F.lit("")),
    })
    return found.select(
        "ordinal", "articolo", "dataset_slug", "dataset_name", "fonte", "dimensione",
        F.col("tipo").alias("tipo_indicatore"),
    )


def missing_keys(left: DataFrame, right: DataFrame, key: str, right_key: str | None = None) -> DataFrame:
    """Distinct non-null keys of ``left`` that ``right`` lacks.

    Both sides are stacked and grouped by key: one shuffle, of at most one row per key and task,
    so a hot key on either side is harmless and no side has to fit anywhere.
    """
    here = left.select(F.col(key), F.lit(False).alias("_known"))
    there = right.select(F.col(right_key or key).cast(left.schema[key].dataType).alias(key), F.lit(True).alias("_known"))
    both = here.unionByName(there).where(F.col(key).isNotNull())
    seen = both.groupBy(key).agg(F.bool_or("_known").alias("_known"))
    return seen.where(~F.col("_known")).select(key)


class MissingReferences(ValueError):
    """A mapping names datasets the registry does not have."""


def require_references(mapping: DataFrame, registry: DataFrame, key: str = "dataset_slug", show: int = 20) -> None:
    """Stop the job if a key is missing; the message lists the first few, the check sees all."""
    absent = missing_keys(mapping, registry, key)
    first = [row[key] for row in absent.orderBy(key).limit(show).collect()]
    if first:
        raise MissingReferences(f"{absent.count()} missing: {', '.join(map(str, first))}")

"""CSV, Parquet and JSON tables: readers and writers with the options the datasets need."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexspark import fixed, schemas
from lexspark.functions.arrays import each_with_position
from lexspark.functions.text import join_numbers, or_empty
from lexspark.operators.enrich import last_per_key

_CSV = {"header": True, "quote": '"', "escape": '"', "encoding": "UTF-8"}


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Quotes are doubled, cells may hold newlines, and empty text cells are ``""`` again."""
    raw = spark.read.options(**_CSV, multiLine=True, ignoreLeadingWhiteSpace=False,
                             ignoreTrailingWhiteSpace=False).schema(schema).csv(path)
    return raw.select(*[
        or_empty(F.col(f.name)).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name)
        for f in schema
    ])


def write_csv(df: DataFrame, path: str) -> None:
    """Header, doubled quotes, null as empty cell; arrays become ``", "``-joined text."""
    flat = [
        join_numbers(F.col(f.name)).alias(f.name) if isinstance(f.dataType, T.ArrayType) else F.col(f.name)
        for f in df.schema
    ]
    df.select(*flat).write.mode("overwrite").options(
        **_CSV, emptyValue="", nullValue="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
    ).csv(path)


def write_parquet(df: DataFrame, path: str, schema: T.StructType, partition_by: tuple[str, ...] = ()) -> None:
    writer = schemas.select_as(df, schema).write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def publish(df: DataFrame, path: str, schema: T.StructType,
            text_form: Callable[[DataFrame], DataFrame] | None = None, when_empty: str = "write") -> bool:
    """Write ``path/parquet`` and ``path/csv``; true if they were written.

    The CSV twin is read back from the Parquet files, so the job that makes the table runs once.
    ``text_form`` adjusts the twin where its text differs from the typed columns. An empty table
    is written, left alone or an error (``when_empty`` = ``write``, ``skip`` or ``error``). Rows
    are not sorted: order is for whoever presents them.
    """
    if when_empty != "write" and df.isEmpty():
        if when_empty == "error":
            raise ValueError(f"nothing to publish at {path}")
        return False
    write_parquet(df, f"{path}/parquet", schema)
    written = df.sparkSession.read.schema(schema).parquet(f"{path}/parquet")
    write_csv(text_form(written) if text_form else written, f"{path}/csv")
    return True


# --- curated mapping and registry --------------------------------------------------------------
def clean_mapping(entries: DataFrame) -> DataFrame:
    """``(ordinal, articolo, dataset_slug, dimensione, tipo)`` with defaults.

    Entries without article (null or 0) or without slug are dropped.
    """
    versions = [c for c in ("schema_version",) if c in entries.columns]
    return entries.where((F.coalesce("articolo", F.lit(0)) != 0) & (or_empty(F.col("dataset_slug")) != "")).select(
        "ordinal", F.col("articolo").cast("bigint").alias("articolo"), "dataset_slug",
        or_empty(F.col("dimensione")).alias("dimensione"),
        F.coalesce("tipo", F.lit(fixed.DEFAULT_INDICATOR_KIND)).alias("tipo"), *versions,
    )


def read_mapping(spark: SparkSession, path: str) -> DataFrame:
    """Curated mapping from JSON lines with an ``ordinal`` per entry."""
    return clean_mapping(spark.read.schema(
        "ordinal bigint, articolo bigint, dataset_slug string, dimensione string, tipo string, schema_version bigint"
    ).json(path))


def registry_entries(documents: DataFrame, datasets: str, order_by: tuple[Column, ...] = ()) -> DataFrame:
    """``(dataset_slug, has_name, name, has_source, source)``, one row per slug; the last one wins.

    ``datasets`` is an array of JSON objects as text, so that a key that is absent can be told
    from one that is null.
    """
    order_names = [f"_o{i}" for i in range(len(order_by))]
    flat = documents.select(
        *[c.alias(n) for c, n in zip(order_by, order_names, strict=True)],
        each_with_position(datasets).alias("_pos", "_ds"),
    )
    parsed = flat.select(
        *order_names, "_pos",
        F.from_json("_ds", "slug string, name string, source string").alias("_d"),
        F.json_object_keys("_ds").alias("_keys"),
    )
    rows = parsed.select(
        *order_names, "_pos",
        or_empty(F.col("_d.slug")).alias("dataset_slug"),
        F.array_contains("_keys", "name").alias("has_name"), F.col("_d.name").alias("name"),
        F.array_contains("_keys", "source").alias("has_source"), F.col("_d.source").alias("source"),
    ).where(F.col("dataset_slug") != "")
    newest = [F.col(n) for n in (*order_names, "_pos")]
    return last_per_key(rows, "dataset_slug", *newest).drop("_pos", *order_names)


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """Registry JSON document with a ``datasets`` array."""
    return registry_entries(
        spark.read.schema("datasets array<string>").json(path, multiLine=True), "datasets"
    )

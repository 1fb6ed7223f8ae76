"""Helpers the operators of this subpackage share."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexspark.session import shared_dir

#: A word: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}.parquet")


def stash(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once below ``spark.checkpoint.dir`` and read back: its lineage ends at the files.

    Unlike ``checkpoint()`` this computes every row once, and later reads prune columns.
    """
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(name: str) -> str:
    """A column name no input has."""
    return f"__{name}_{uuid.uuid4().hex[:8]}"


def text_or_empty(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def words(text: Column) -> Column:
    """The words of a text, in order."""
    return F.filter(F.split(text, SPACE), lambda w: w != "")


def lower_ascii(text: Column) -> Column:
    """A text with A-Z in lower case, and no other letter changed."""
    # Most texts are ASCII alone or nearly so; for the former the built-in does the same, faster.
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))


def bind(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once, however often ``use`` mentions it."""
    return F.transform(F.array(value), use)[0]

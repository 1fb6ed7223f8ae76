"""Whole-document Markdown and wikitext: one row per file."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexspark import schemas

DOCUMENT = schemas.struct("file_name", "value")


def if_exists(read: Callable[[], DataFrame]) -> DataFrame | None:
    """What ``read`` gives, or None if its path does not exist."""
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def _file_name() -> Column:
    """Names come with blanks and percent signs encoded; a plus is itself."""
    return F.url_decode(F.replace("_metadata.file_name", F.lit("+"), F.lit("%2B")))


def _with_name(texts: DataFrame) -> DataFrame:
    """File name and text, every line end a plain newline."""
    unix = F.replace(F.replace("value", F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))
    return texts.select(_file_name().alias("file_name"), unix.alias("value"))


def read_documents(spark: SparkSession, folder: str, glob: str = "*.md") -> DataFrame:
    """``(file_name, value)`` of the files directly in a folder; a missing folder gives no rows, nor does an empty file."""
    found = if_exists(lambda: spark.read.option("pathGlobFilter", glob).text(folder, wholetext=True))
    return spark.createDataFrame([], DOCUMENT) if found is None else _with_name(found)


def read_lines(spark: SparkSession, path: str, glob: str = "*.md") -> DataFrame:
    """``(file_name, split, at, line)`` of the lines of files, which may be larger than a cell: a file is read in splits by many tasks.

    Lines go by ``split``, the place in the file where a task began, and within one by ``at``.
    """
    lines = spark.read.option("pathGlobFilter", glob).text(path)
    return lines.select(
        _file_name().alias("file_name"), F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("at"), F.col("value").alias("line"))


def read_document(spark: SparkSession, path: str) -> DataFrame:
    """``(file_name, value)`` of one file, which has to exist."""
    found = if_exists(lambda: spark.read.text(path, wholetext=True))
    if found is None:
        raise FileNotFoundError(path)
    return _with_name(found)


def write_documents(documents: DataFrame, path: str, name: str = "documento", content: str = "contenuto") -> None:
    """Documents as rows of Parquet, many to a file: the number of files does not follow that of the documents."""
    documents.select(F.col(name).alias("documento"), F.col(content).alias("contenuto")).write.mode("overwrite").parquet(path)


def write_text(documents: DataFrame, path: str, content: str = "contenuto") -> None:
    """One text file per document in a flat folder, for a few published texts.

    The writer ends each document with a newline, so the one it already has is left out.
    """
    ended = F.regexp_replace(F.col(content), r"\n\z", "")
    documents.select(ended).write.mode("overwrite").option("maxRecordsPerFile", 1).text(path)


def read_written_documents(spark: SparkSession, path: str) -> DataFrame:
    """``(documento, contenuto)`` as written by ``write_documents``."""
    return spark.read.schema("documento string, contenuto string").parquet(path)

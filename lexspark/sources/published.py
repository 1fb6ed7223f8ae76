"""Tables and documents published as versions: whoever reads sees the former one until the next is whole.

A version is a folder of its own below the published path. The table ``versions`` beside them says which
came when; a row is appended to it as the last step, so a job that dies before leaves things as they were.
All of it goes through Spark's readers and writers, whatever the store; named documents are files that
``pyarrow.fs`` writes.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexspark import schemas
from lexspark.operators.quality import Rule, report_of
from lexspark.sources import documents, files, tables

_VERSIONS = "number bigint, version string"


class Refused(ValueError):
    """A table that breaks its contract; ``report`` says where."""

    def __init__(self, path: str, report: DataFrame):
        broken = [r["rule"] for r in report.where("NOT coalesce(ok, false)").collect()]
        super().__init__(f"{path} is not published: {', '.join(broken)}")
        self.report = report


def versions(spark: SparkSession, path: str) -> DataFrame | None:
    """``(number, version)`` of what was published at a path, or None."""
    return documents.if_exists(lambda: spark.read.schema(_VERSIONS).parquet(f"{path}/versions"))


def current(spark: SparkSession, path: str) -> str | None:
    """The folder of the latest version, or None if nothing was published."""
    known = versions(spark, path)
    last = known.orderBy(F.desc("number"), F.desc("version")).first() if known is not None else None
    return None if last is None else f"{path}/{last['version']}"


def _switch(spark: SparkSession, path: str, version: str) -> None:
    known = versions(spark, path)
    number = 0 if known is None else known.agg(F.max("number")).first()[0] or 0
    spark.range(1).select(F.lit(number + 1).cast("bigint").alias("number"), F.lit(version).alias("version")).coalesce(1).write.mode("append").parquet(f"{path}/versions")


def publish(df: DataFrame, path: str, schema: T.StructType, text_form: Callable[[DataFrame], DataFrame] | None = None,
            when_empty: str = "write", rules: Sequence[Rule] = ()) -> DataFrame | None:
    """Publishes a version with ``parquet`` and ``csv``; returns the report of ``rules``, or None if it was left out for being empty.

    The table is made once: rows and rules are counted while Parquet is written, the CSV twin is read back
    from it. A version whose rules don't hold is refused (``Refused``), an empty one written, left out or an
    error (``when_empty`` = ``write``, ``skip`` or ``error``); the former version then stays the current one.
    """
    spark, version, seen = df.sparkSession, f"v-{uuid.uuid4().hex}", Observation()
    measures = [F.count(F.lit(1)).alias("rows"), *(r.measure.cast("bigint").alias(f"m{i}") for i, r in enumerate(rules))]
    schemas.select_as(df, schema).observe(seen, *measures).write.parquet(f"{path}/{version}/parquet")
    counted = seen.get
    if counted["rows"] == 0 and when_empty != "write":
        if when_empty == "error":
            raise ValueError(f"nothing to publish at {path}")
        return None
    report = report_of(spark, rules, [counted[f"m{i}"] for i in range(len(rules))])
    if rules and report.where("NOT coalesce(ok, false)").head(1):
        raise Refused(path, report)
    written = spark.read.schema(schema).parquet(f"{path}/{version}/parquet")
    tables.write_csv(text_form(written) if text_form else written, f"{path}/{version}/csv")
    _switch(spark, path, version)
    return report


def publish_documents(docs: DataFrame, path: str, name: str = "documento", content: str = "contenuto") -> None:
    """Publishes a version with a file per document, under the document's own name. A name that is no legal one, or that occurs twice, fails the job."""
    spark, version = docs.sparkSession, f"v-{uuid.uuid4().hex}"
    named = docs.select(F.col(name).cast("string").alias("name"), F.col(content).alias("content"))
    spark.dataSource.register(files.NamedFiles)
    named.write.format("named_files").mode("append").save(f"{path}/{version}")
    _switch(spark, path, version)


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The current version of a table."""
    return spark.read.schema(schema).parquet(f"{_known(spark, path)}/parquet")


def read_twin(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The CSV twin of the current version."""
    return tables.read_csv(spark, f"{_known(spark, path)}/csv", schema)


def read_documents(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """``(file_name, value)`` of the documents of the current version."""
    return documents.read_documents(spark, _known(spark, path), glob)


def _known(spark: SparkSession, path: str) -> str:
    found = current(spark, path)
    if found is None:
        raise FileNotFoundError(f"nothing is published at {path}")
    return found

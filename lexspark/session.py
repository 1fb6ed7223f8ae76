"""Session settings and the shared folder for written intermediates."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, app: str = "lexspark", **conf: str) -> SparkSession:
    """A session with the settings the operators are tuned for.

    Broadcasts are left to ``spark.sql.autoBroadcastJoinThreshold`` and AQE, which check the size
    of the small side; no operator forces one.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        **conf,
    }
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder name below the cluster's shared folder (``spark.checkpoint.dir``).

    A session of one machine may do without that setting and gets the machine's temporary folder;
    on a cluster, where executors would not see each other's files, it is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "").split("[")[0] == "local":
            raise ValueError("spark.checkpoint.dir is not set; it has to name a folder all executors share")
        base = f"{tempfile.gettempdir()}/lexspark"
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def spread(table: DataFrame, columns: Sequence[str] = ("*",)) -> DataFrame:
    """Columns of a table, dealt out to ``spark.lexspark.spread`` partitions if the session sets that.

    For tables in so few unsplittable files that a scan leaves cores idle. Without the setting rows
    stay where they are read, whatever the table's size.
    """
    parts = int(table.sparkSession.conf.get("spark.lexspark.spread", "0"))
    chosen = table.select(*columns)
    return chosen.repartition(parts) if parts else chosen

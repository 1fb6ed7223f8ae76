"""Exploding arrays that are expensive to make."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _present(array: Column | str) -> Column:
    """The array, empty for null.

    The ``coalesce`` keeps Spark from inferring a filter on a bare exploded column. That filter
    would be pushed below whatever makes the array (parsing, regexes) and run it a second time.
    """
    return F.coalesce(F.col(array) if isinstance(array, str) else array, F.array())


def each(array: Column | str) -> Column:
    return F.explode(_present(array))


def each_with_position(array: Column | str) -> Column:
    return F.posexplode(_present(array))

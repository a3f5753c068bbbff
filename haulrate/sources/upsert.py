"""Keyed upsert of a reference table that has audit times."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CREATED, UPDATED = "datecreatedutc", "dateupdatedutc"
NEW = "__new"


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    values: Sequence[str],
    now: datetime,
) -> DataFrame:
    """The target after a merge: matched rows take the source's values and a new update time,
    other source rows are inserted, other target rows stay.

    It is an update join plus an anti join, so a small source is broadcast to a large target,
    which then is not shuffled with all its columns. Two source rows for one target row are
    an error. Write the result to a new path: Spark cannot replace what it is reading.
    """
    keys, values = list(keys), list(values)
    repeated = source.groupBy(*keys).count().where(F.col("count") > 1)
    if not repeated.join(target.select(*keys), keys, "left_semi").isEmpty():
        raise ValueError(f"several source rows match one target row on {keys}")

    stamp = F.lit(now.isoformat(sep=" "))
    hit = F.col(NEW).isNotNull()

    def merged(name: str) -> Column:
        if name in values:
            return F.when(hit, F.col(f"{NEW}.{name}")).otherwise(F.col(name)).alias(name)
        if name == UPDATED:
            now_as_stored = stamp.cast(target.schema[name].dataType)
            return F.when(hit, now_as_stored).otherwise(F.col(name)).alias(name)
        return F.col(name)

    def inserted(name: str) -> Column:
        if name in keys or name in values:
            return F.col(name)
        kind = target.schema[name].dataType
        return (stamp if name in (CREATED, UPDATED) else F.lit(None)).cast(kind).alias(name)

    offered = source.select(*keys, F.struct(*values).alias(NEW))
    updated = target.join(offered, keys, "left").select(*[merged(c) for c in target.columns])
    added = source.join(target.select(*keys), keys, "left_anti")
    return updated.unionByName(added.select(*[inserted(c) for c in target.columns]))

"""Joins of large tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulrate.operators.lookups import SALT, row_hash
from haulrate.params import Limits

COPIES = "__copies"


def join_hot_keys(
    rows: DataFrame,
    side: DataFrame,
    key: str,
    counts: DataFrame,
    count: str,
    limits: Limits,
    total: int,
) -> DataFrame:
    """Inner join where one key may hold much of ``rows``.

    ``counts`` has the row count of each key, and ``side`` carries that count as well. A hot key
    is split into parts, and its side row is copied once per part. A key is hot from
    ``limits.hot_rows`` rows, or from so many that of ``total``, a bound of all counts together,
    at most ``limits.broadcast_rows`` keys can be hot: so the list of them may be broadcast.
    """
    least = limits.hot_rows
    if limits.broadcast_rows:
        least = max(least, -(-total // limits.broadcast_rows))
    copies = F.ceil(F.col(count) / least).cast("int")
    hot = counts.where(F.col(count) > least).select(key, copies.alias(COPIES))
    marked = rows.join(F.broadcast(hot) if limits.broadcast_rows else hot, key, "left")
    part = F.pmod(row_hash(rows), F.col(COPIES)).cast("int")
    marked = marked.withColumn(SALT, F.coalesce(part, F.lit(0))).drop(COPIES)
    parts = F.sequence(F.lit(0), F.greatest(copies, F.lit(1)) - 1)
    spread = side.withColumn(SALT, F.explode(parts)).drop(count)
    return marked.join(spread, [key, SALT]).drop(SALT)

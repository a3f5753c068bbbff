"""Keeping the reference tables current: extract, reshape, and load into several targets."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulrate.sources.commits import CommitLog
from haulrate.sources.shared import staged

log = logging.getLogger(__name__)

# Series of the fuel feed that become columns.
FUEL_SERIES = {"gas": "Total Gasoline", "diesel": "No 2 Diesel"}

#: The record of a fan-out's staged rows, beside those named like its targets.
SOURCE = "_source"
STATUS = "target string, rows bigint, ok boolean, attempts int, error string"


@dataclass(frozen=True)
class Table:
    """A table behind a Spark data source, e.g. ``parquet`` with ``path``, or ``jdbc`` with
    ``url`` and ``dbtable``."""

    name: str
    format: str = "parquet"
    options: Mapping[str, str] = field(default_factory=dict)

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.format(self.format).options(**self.options).load()

    def write(self, df: DataFrame, mode: str, **more: str) -> None:
        options = {**self.options, **more}
        df.write.format(self.format).options(**options).mode(mode).save()


def extract(spark: SparkSession, table: Table, query: str | None = None) -> DataFrame:
    """The table as it is, or what a query returns that its database runs."""
    if query is None:
        return table.read(spark)
    options = {name: v for name, v in table.options.items() if name != "dbtable"}
    return spark.read.format(table.format).options(**options, query=query).load()


def pivot_fuel(feed: DataFrame, as_of: datetime, days: int = 7) -> DataFrame:
    """One row per date of the last days with the gas and diesel price as columns."""
    start = F.lit((as_of - timedelta(days=days)).isoformat(sep=" ")).cast("timestamp_ntz")
    recent = feed.where(F.col("date") > start)
    prices = [
        F.max(F.when(F.col("type") == series, F.col("ppg"))).alias(name)
        for name, series in FUEL_SERIES.items()
    ]
    return recent.groupBy("date").agg(*prices)


def append(df: DataFrame, target: Table) -> None:
    """Add rows and keep what is there."""
    target.write(df, "append")


def full_refresh(df: DataFrame, target: Table) -> None:
    """Replace all rows; over JDBC the table itself is kept and truncated."""
    more = {"truncate": "true"} if target.format == "jdbc" else {}
    target.write(df, "overwrite", **more)


def fan_out(
    df: DataFrame,
    targets: Sequence[Table],
    load=append,
    attempts: int = 1,
    state: CommitLog | None = None,
) -> DataFrame:
    """The same load into every target; one that fails, of whatever error, never stops the others.

    The source is read once, into a staged table, so that every target gets the same rows even if
    executors are lost in between. A failed target is tried again alone, from the staged rows, up
    to ``attempts`` times in all. With a ``state`` each target that is loaded leaves a record there
    (as does the staged table), and a call with the same state loads what has none: a run that was
    lost, or had failures, goes on where it ended. (A target whose record was lost is loaded again:
    ``load`` should then be one that may, as a refresh or a ledger's append.) Returns target, rows and ok, and with a state
    also the attempts of this call and the last error.
    """
    spark = df.sparkSession
    known = state.records() if state else {}
    if state and SOURCE not in known:
        path = f"{state.folder}/_rows-{uuid.uuid4().hex}"
        df.write.parquet(path)
        state.commit(SOURCE, {"path": path})
        known = state.records()
    source = spark.read.schema(df.schema).parquet(known[SOURCE]["path"]) if state else staged(df)
    rows = source.count()
    tried, errors = dict.fromkeys([t.name for t in targets], 0), {}
    left = [t for t in targets if t.name not in known]
    while left := [t for t in left if tried[t.name] < attempts]:
        failed = []
        for target in left:
            tried[target.name] += 1
            try:
                load(source, target)
            except Exception as error:  # a target's own failure, found out by analysis or at run
                log.exception("load into %s failed", target.name)
                errors[target.name] = type(error).__name__
                failed.append(target)
            else:
                errors.pop(target.name, None)
                if state:
                    state.commit(target.name, {"rows": rows})
        left = failed
    status = [
        (t.name, 0 if t.name in errors else rows, t.name not in errors, tried[t.name], errors.get(t.name))
        for t in targets
    ]
    told = spark.createDataFrame(status, STATUS)
    return told if state else told.select("target", "rows", "ok")

"""Fact tables of the back-test."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulrate.sources.cards import conform
from haulrate.sources.schemas import FACT_DDL, schema_of

ROWS = "__rows"


@dataclass(frozen=True)
class Facts:
    """The seven fact tables; ``listing`` and ``rate_comparison`` are keyed by packageid, ``bids``,
    ``tracking`` and ``revenue`` by packagematchid, ``users`` by userid, ``items`` by (packageid,
    rank)."""

    listing: DataFrame
    bids: DataFrame
    items: DataFrame
    tracking: DataFrame
    revenue: DataFrame
    users: DataFrame
    rate_comparison: DataFrame

    @cached_property
    def bid_rows(self) -> int:
        """All bids, counted once; a stored table knows the number without reading rows."""
        return self.bids.count()

    def unique(self, name: str, key: str, *columns: str) -> DataFrame:
        """The key and columns of a table that may hold each key once; a repeated one fails the
        query that reads it, by name.

        The check rides on the pass that reads the rows: they are grouped by the key in the
        partitioning that the join on it needs anyway. NULL keys, which join nothing, are left out.
        """
        rows = getattr(self, name).where(F.col(key).isNotNull())
        grouped = rows.groupBy(key).agg(
            F.count("*").alias(ROWS), *[F.any_value(c).alias(c) for c in columns]
        )
        message = F.concat(F.lit(f"{name} holds {key} "), F.col(key).cast("string"), F.lit(" twice"))
        repeated = F.raise_error(message).cast("boolean")
        return grouped.where(F.when(F.col(ROWS) == 1, True).otherwise(repeated)).drop(ROWS)

    def check_keys(self) -> None:
        """Fails if listing, too wide to be grouped as it is read, holds a packageid twice."""
        rows = self.listing.groupBy("packageid").agg(F.count("*").alias("n"))
        if repeated := rows.where("n > 1 and packageid is not null").first():
            raise ValueError(f"listing holds packageid {repeated['packageid']} twice")


def load_facts(spark: SparkSession, directory: str) -> Facts:
    """One Parquet table per fact in a directory; an absent column fails, and so does a NULL
    where the schema has none."""
    return Facts(
        **{
            name: conform(spark.read.parquet(f"{directory}/{name}"), schema_of(name))
            for name in FACT_DDL
        }
    )

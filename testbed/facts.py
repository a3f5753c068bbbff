"""Fact tables derived from the test tables, as set out in FIXTURES.md."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from haulrate.operators.lookups import equi_lookup
from haulrate.params import Limits
from haulrate.sources.cards import Card
from haulrate.sources.facts import Facts

ITEM_ORDER = [
    "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice", "l_quantity",
    "l_discount", "l_tax",
]


# Columns of the test tables that are read.
TABLE_DDL = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_nationkey int",
    "part": "p_partkey bigint, p_name string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_shipdate timestamp_ntz",
    "events": "ts timestamp_ntz, event_type string, value double",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLE_DDL[name]).parquet(f"{sf_dir}/{name}.parquet")


def _mileage() -> Column:
    return (F.col("o_orderkey") * 37 % 3400).cast("double")


def _padded(number: Column) -> Column:
    return F.lpad(number.cast("string"), 5, "0")


def _state(nation: str) -> Column:
    named = F.concat(F.lit("State"), F.col(nation).cast("string"))
    return F.when(F.col(nation) == 0, "Alaska").otherwise(named)


def _days_later(days: Column) -> Column:
    return F.col("o_orderdate") + F.make_dt_interval(days)


def items(spark: SparkSession, sf_dir: str, limits: Limits) -> DataFrame:
    """Line items with their rank. A filter on the rank reaches the window, which then keeps
    only that many rows per order before the shuffle; unread columns cost nothing."""
    rank = F.row_number().over(W.partitionBy("l_orderkey").orderBy(*ITEM_ORDER))
    line = table(spark, sf_dir, "lineitem").select("*", rank.alias("rank"))
    part = table(spark, sf_dir, "part")
    part = Card(part, limits, part.count())
    joined = equi_lookup(line, part, [("l_partkey", "p_partkey")], ["p_name", "p_size"], "part")
    size = F.col("part.p_size")
    return joined.select(
        F.col("l_orderkey").alias("packageid"),
        "rank",
        F.col("part.p_name").alias("title"),
        (1 + F.col("l_quantity").cast("int") % 4).cast("string").alias("unitcount"),
        (20 + 2 * size).cast("string").alias("length"),
        (10 + size).cast("string").alias("height"),
        (15 + size).cast("string").alias("width"),
        (3 * F.col("l_quantity")).cast("string").alias("weight"),
    )


def _heads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per order its weight, number of items and first item; combined before the shuffle."""
    line = table(spark, sf_dir, "lineitem")
    return line.groupBy("l_orderkey").agg(
        F.sum(3 * F.col("l_quantity")).alias("totalweight"),
        F.count("*").cast("int").alias("items"),
        # What else orders items comes after the columns that are read.
        F.min(F.struct(*ITEM_ORDER[:3])).alias("first"),
    )


def listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = table(spark, sf_dir, "orders")
    customer, supplier, part = (
        table(spark, sf_dir, name) for name in ("customer", "supplier", "part")
    )
    joined = (
        order.join(_heads(spark, sf_dir), F.col("o_orderkey") == F.col("l_orderkey"))
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(supplier, F.col("first.l_suppkey") == F.col("s_suppkey"))
        .join(part, F.col("first.l_partkey") == F.col("p_partkey"))
    )
    key = F.col("o_orderkey")
    mark = F.when(F.col("o_orderpriority") == "1-URGENT", " HV").otherwise("")
    note = F.when(key % 97 == 0, " *comp*").otherwise("")
    suffix = F.when(key % 20 == 0, "-1234").otherwise("")
    far = F.col("c_custkey") % 41 == 40
    return joined.select(
        key.alias("packageid"),
        F.col("o_orderdate").alias("datecreated"),
        F.col("o_orderdate").cast("date").alias("d_datecreated"),
        F.concat("p_name", mark, note).alias("title"),
        F.when(F.col("o_orderstatus") == "P", "Vehicles")
        .otherwise("Household Goods")
        .alias("category"),
        F.concat(F.lit("City "), F.col("s_suppkey").cast("string")).alias("origincity"),
        _state("s_nationkey").alias("originstate"),
        F.concat(_padded(F.col("s_suppkey") % 100), suffix).alias("originzip"),
        F.when(key % 50 == 0, 2).otherwise(1).alias("origincountryid"),
        F.concat(F.lit("City "), F.col("c_custkey").cast("string")).alias("destinationcity"),
        _state("c_nationkey").alias("destinationstate"),
        F.when(far, "99999").otherwise(_padded(F.col("c_custkey") % 150)).alias("destinationzip"),
        F.lit(1).alias("destinationcountryid"),
        _mileage().alias("mileage"),
        _days_later((key % 12).cast("int")).alias("timeframelatestpickup"),
        _days_later((key % 25).cast("int")).alias("timeframelatestdelivery"),
        "totalweight",
        "items",
        (key % 6).cast("int").alias("bids"),
        (key % 7).cast("int").alias("nm"),
        (key % 3).cast("int").alias("gm"),
        (key % 5).cast("string").alias("nypchanges"),
        (F.col("o_totalprice") / 200).alias("originalnypamount"),
        F.col("c_mktsegment").alias("forecastsegment"),
    )


def _matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One bid per order, and a second one for every 31st order."""
    key = F.col("o_orderkey")
    copies = F.when(key % 31 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    order = table(spark, sf_dir, "orders").withColumn("copy", F.explode(copies))
    return order.select(
        "*",
        (key * 10 + F.col("copy")).alias("packagematchid"),
        (60 + _mileage() * (0.15 + key % 10 * 0.09)).alias("bidvolumeusd"),
    )


def load(spark: SparkSession, sf_dir: str, limits: Limits) -> Facts:
    order = table(spark, sf_dir, "orders")
    matches = _matches(spark, sf_dir)
    key = F.col("o_orderkey")
    post = F.when(key % 4 != 0, F.col("bidvolumeusd") * 0.1)
    return Facts(
        listing=listing(spark, sf_dir),
        bids=matches.select(
            key.alias("packageid"),
            "packagematchid",
            F.col("o_custkey").alias("userid"),
            F.when(key % 11 == 0, 0).otherwise(1).alias("netmatch"),
            _days_later(F.lit(3)).alias("dateaccepted"),
            "bidvolumeusd",
        ),
        items=items(spark, sf_dir, limits),
        tracking=matches.select("packagematchid", _days_later(F.lit(10)).alias("delivereddate")),
        revenue=matches.select("packagematchid", post.alias("nmr_post")),
        users=table(spark, sf_dir, "customer").select(
            F.col("c_custkey").alias("userid"), F.col("c_name").alias("username")
        ),
        rate_comparison=order.select(
            key.alias("packageid"),
            (F.col("o_totalprice") / 210).alias("rate_table_nyp_amount"),
        ),
    )

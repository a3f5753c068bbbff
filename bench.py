"""Times the headline queries, and the naive forms they replace; prints one JSON line.

BENCH_SF_DIR and BENCH_CPUS choose the data and the cores. Each time is the median of warm
runs to the ``noop`` sink, with plan building included, as a caller sees it.
"""

from __future__ import annotations

import json
import os
import statistics
import time
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulrate.operators.keywords import PARTS
from testbed import catalog
from testbed.catalog import Bench

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
HEADLINE = [
    "package_quantity",
    "item_slots",
    "shipment_base",
    "keyword_indexes",
    "short_haul_base_rate",
    "priced_shipments",
    "evaluation_summary",
    "fuel_feed_pivot",
    "full_refresh",
    "ratecard_upsert",
    "equi_lookup",
    "band_lookup",
]

#: Queries whose plan takes long to build; how long is reported beside their whole time.
BUILT = ["priced_shipments", "evaluation_summary"]


def five_self_joins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """item_slots as one join per rank."""
    items = Bench(spark, sf_dir).facts.items
    out = items.select("packageid").distinct()
    for k in range(1, 6):
        ranked = items.where(F.col("rank") == k).drop("rank")
        names = {c: f"item{k}{c}" for c in ranked.columns if c != "packageid"}
        out = out.join(ranked.withColumnsRenamed(names), "packageid", "left")
    return out


def join_per_keyword(spark: SparkSession, sf_dir: str) -> DataFrame:
    """keyword_indexes (difficulties only) as one update step per keyword and text."""
    bench = Bench(spark, sf_dir)
    words = [row for row in bench.cards["furniture_indexes"].literals if row.keyword]
    df = bench.base.withColumns({f"{part}diff": F.lit(0.0) for part in PARTS})
    for word in words:
        row = (word.keyword.lower(), word.difficulty_idx)
        one = spark.createDataFrame([row], "w string, d double")
        for k, part in enumerate(PARTS):
            text = F.lower("title") if k == 0 else F.lower(F.expr(f"get(slots, {k - 1}).title"))
            df = df.join(F.broadcast(one), F.contains(text, F.col("w")), "left")
            df = df.withColumn(f"{part}diff", F.greatest(f"{part}diff", "d")).drop("w", "d")
    return df.select("packagematchid", *[f"{part}diff" for part in PARTS])


def joined_quantity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """package_quantity with all bids and items of a package meeting as pairs."""
    facts = Bench(spark, sf_dir).facts
    listing = facts.listing.where(
        "origincountryid = 1 and destinationcountryid = 1 and nm > 0 "
        "and category = 'Household Goods' "
        "and not (originstate = 'Alaska' and destinationstate = 'Alaska')"
    )
    joined = (
        listing.select("packageid")
        .join(facts.bids.where("netmatch > 0").select("packageid"), "packageid")
        .join(facts.items.select("packageid", "unitcount"), "packageid")
    )
    return joined.groupBy("packageid").agg(F.sum(F.col("unitcount").cast("double")).alias("qty"))


NAIVE = {
    "naive_item_slots": five_self_joins,
    "naive_keyword_indexes": join_per_keyword,
    "naive_package_quantity": joined_quantity,
}


def seconds(run, spark: SparkSession) -> float:
    start = time.perf_counter()
    run(spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def build_seconds(run, spark: SparkSession) -> float:
    """What building the plan takes, analysis included, without running it."""
    start = time.perf_counter()
    run(spark, SF_DIR).schema
    return time.perf_counter() - start


def timed(run, spark: SparkSession) -> float:
    seconds(run, spark)  # warm up
    return round(statistics.median(seconds(run, spark) for _ in range(RUNS)), 3)


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("haulrate-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = {name: timed(catalog.query(name), spark) for name in HEADLINE}
    naive = {name: timed(run, spark) for name, run in NAIVE.items()}
    building = {
        name: round(statistics.median(build_seconds(catalog.query(name), spark) for _ in range(RUNS)), 3)
        for name in BUILT
    }
    report = {
        "metric": "headline queries, sum of median warm seconds",
        "value": round(reduce(float.__add__, queries.values()), 3),
        "unit": "sec",
        "queries": queries,
        "naive": naive,
        "plan_building": building,
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(report))
    spark.stop()


if __name__ == "__main__":
    main()

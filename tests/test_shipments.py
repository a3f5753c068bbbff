from dataclasses import replace
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from haulrate import Limits, Params
from haulrate.operators import shipments as s
from haulrate.operators.joins import join_hot_keys
from haulrate.sources.facts import Facts
from haulrate.sources.schemas import schema_of
from testbed.catalog import Bench


def table(spark, name, *rows):
    schema = schema_of(name)
    data = [tuple({**row}.get(field.name) for field in schema) for row in rows]
    return spark.createDataFrame(data, schema)


def listing_row(packageid, **changes):
    row = {
        "packageid": packageid,
        "datecreated": datetime(2023, 5, 1, 13, 30),
        "title": "Sofa",
        "category": "HOUSEHOLD goods ",
        "originstate": "Ohio",
        "destinationstate": "Texas",
        "origincountryid": 1,
        "destinationcountryid": 1,
        "nm": 1,
        "forecastsegment": "Partner",
    }
    return {**row, **changes}


def item_row(packageid, rank, **changes):
    row = {"packageid": packageid, "rank": rank, "title": f"item {rank}", "unitcount": "2"}
    sizes = {"length": "10", "height": "2.5", "width": "4", "weight": "7"}
    return {**row, **sizes, **changes}


def test_quantity_counts_the_items_again_for_every_matched_bid(spark):
    listing = table(
        spark,
        "listing",
        listing_row(1),
        listing_row(2, nm=0),
        listing_row(3, category="Vehicles"),
        listing_row(4, originstate="ALASKA", destinationstate="alaska "),
        listing_row(5, origincountryid=2),
        listing_row(6),
        listing_row(7, originstate=None, destinationstate="Alaska"),
    )
    bids = table(
        spark,
        "bids",
        *[{"packageid": p, "packagematchid": 10 * p, "netmatch": 1} for p in (1, 2, 3, 4, 5, 7)],
        {"packageid": 1, "packagematchid": 11, "netmatch": 2},
        {"packageid": 1, "packagematchid": 12, "netmatch": 0},
        {"packageid": 6, "packagematchid": 60, "netmatch": 0},
    )
    items = table(
        spark,
        "items",
        *[item_row(p, rank) for p in range(1, 8) for rank in (1, 2)],
        item_row(1, 3, unitcount=None),
        item_row(1, 4, unitcount="1.5"),
    )
    found = s.package_quantity(listing, bids, items).collect()
    assert {row.packageid: row.qty for row in found} == {1: 11.0}


def test_slots_keep_gaps_and_reject_repeated_ranks(spark):
    items = table(spark, "items", item_row(1, 1), item_row(1, 3), item_row(1, 6), item_row(2, 9))
    rows = s.item_slots(items).collect()
    assert [row.packageid for row in rows] == [1]
    assert [slot and slot.title for slot in rows[0].slots] == ["item 1", None, "item 3", None, None]
    twice = table(spark, "items", item_row(1, 2), item_row(1, 2))
    with pytest.raises(Exception, match="item ranks repeat in package 1"):
        s.item_slots(twice).collect()


def test_measures(spark):
    items = table(spark, "items", item_row(1, 2))
    row = s.item_slots(items).select(*s.item_measures()).collect()[0]
    assert (row.item1qty, row.item1volume, row.item1title) == (0, None, None)
    assert (row.item2qty, row.item2volume, row.item2totalvolume) == (2, 100.0, 200.0)
    assert (row.item2height, row.item2totalweight) == (2.5, 14.0)


def test_filter_drops_null_titles_and_marked_titles(spark):
    p = Params(partner="PARTNER ", as_of=date(2023, 11, 1))
    listing = table(
        spark,
        "listing",
        listing_row(1),
        listing_row(2, title=None),
        listing_row(3, title="a *COMP* b"),
        listing_row(4, title="a comp b"),
        listing_row(5, originstate="Alaska", destinationstate="Alaska"),
        listing_row(6, originstate="Alaska", destinationstate=None),
        listing_row(7, datecreated=datetime(2023, 3, 31, 23, 59)),
        listing_row(8, datecreated=datetime(2023, 4, 1)),
        listing_row(9, forecastsegment="other"),
    )
    kept = listing.where(s.shipment_filter(p)).select("packageid").collect()
    assert sorted(row.packageid for row in kept) == [1, 4, 8]


def test_size_rating_compares_numbers_or_texts(spark):
    def rate(weight, length, as_text=False):
        items = table(spark, "items", item_row(1, 1, length=length))
        df = s.item_slots(items).withColumn("totalweight", F.lit(weight).cast("double"))
        return s.size_rating(df, as_text).collect()[0].bb

    assert [rate(w, "10") for w in (200, 200.5, 400, 400.5, None)] == [0, 1, 1, 2, 0]
    assert [rate(1, length) for length in ("84", "84.1", "100", "9")] == [0, 1, 1, 0]
    assert [rate(1, length, True) for length in ("84", "84.1", "100", "9")] == [0, 1, 0, 1]


def test_price_per_mile_bands_are_open_below_and_closed_above(spark):
    rows = [
        (0.0, 50.0, 0), (250.0, 1.0, 0), (250.5, 1.0, 1), (500.0, 0.534 * 500, 0),
        (500.0, 0.68 * 500, 0), (500.5, 0.686 * 500.5, 1), (3000.0, 0.2 * 3000, 0),
        (3000.5, 0.25 * 3000.5, 0), (9000.0, 0.26 * 9000, 1), (None, 5.0, 0), (600.0, None, 0),
    ]
    df = spark.createDataFrame(rows, "mileage double, matchprice double, expected int")
    for row in s.price_per_mile_outlier(df).collect():
        assert row.match_price_out_of_range == row.expected, row


@pytest.mark.parametrize("hot_rows", [1, 7, 1_000_000])
def test_hot_keys_join_like_any_other(spark, hot_rows):
    rows = spark.range(300).select(
        F.col("id").alias("packagematchid"),
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 10).cast("long").alias("packageid"),
    )
    counts = rows.groupBy("packageid").agg(F.count("*").alias("matched"))
    side = counts.where("packageid <> 4").withColumn("label", F.concat(F.lit("p"), "packageid"))
    limits = Limits(hot_rows=hot_rows)
    joined = join_hot_keys(rows, side, "packageid", counts, "matched", limits, rows.count())
    expected = rows.join(side.drop("matched"), "packageid")
    assert sorted(joined.columns) == sorted(expected.columns)
    assert sorted(map(tuple, joined.collect())) == sorted(
        map(tuple, expected.select(*joined.columns).collect())
    )


@pytest.mark.parametrize(
    ("name", "key"),
    [
        ("bids", "packagematchid"),
        ("tracking", "packagematchid"),
        ("revenue", "packagematchid"),
        ("users", "userid"),
        ("rate_comparison", "packageid"),
    ],
)
def test_a_repeated_key_fails_the_query_that_reads_it(spark, sf_dir, name, key):
    bench = Bench(spark, sf_dir)
    priced = bench.base.agg(F.min("packagematchid"), F.max("carrier")).first()
    assert priced[0] is not None
    rows = getattr(bench.facts, name)
    broken = replace(bench.facts, **{name: rows.union(rows)})
    with pytest.raises(Exception, match=f"{name} holds {key} .* twice"):
        s.shipment_base(broken, bench.cards, bench.params).write.format("noop").mode("overwrite").save()


def test_missing_keys_may_repeat_and_the_check_adds_no_shuffle(spark):
    tracking = spark.createDataFrame([(None,), (None,), (1,), (2,)], "packagematchid bigint")
    facts = Facts(*[tracking] * 7)
    rows = facts.unique("tracking", "packagematchid")
    assert sorted(r[0] for r in rows.collect()) == [1, 2]
    other = spark.range(4).withColumnRenamed("id", "packagematchid")
    plan = rows.hint("merge").join(other.hint("merge"), "packagematchid")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 2  # one for each side of the join

"""From the fact tables to one row per matched bid."""

from __future__ import annotations

from dataclasses import replace
from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulrate.functions import contains_text, match_key, zip5
from haulrate.operators.fuel import with_lagged_fuel
from haulrate.operators.joins import join_hot_keys
from haulrate.operators.lookups import equi, equi_lookup, looked_up
from haulrate.params import Params
from haulrate.sources.cards import Cards
from haulrate.sources.facts import Facts

SLOTS = 5
BIG_INCHES = 84

# Mileage above and up to, lowest and highest plausible price per mile.
PRICE_PER_MILE_BANDS = [
    (250, 500, 0.534, 1.14),
    (500, 1000, 0.32, 0.685),
    (1000, 1500, 0.237, 0.41),
    (1500, 2000, 0.193, 0.356),
    (2000, 2500, 0.168, 0.295),
    (2500, 3000, 0.14, 0.24),
    (3000, None, 0.136, 0.258),
]


def _within_alaska() -> Column:
    origin, destination = match_key(F.col("originstate")), match_key(F.col("destinationstate"))
    return (origin == "alaska") & (destination == "alaska")


def _countable() -> Column:
    """Listings whose items are counted."""
    return (
        (F.col("origincountryid") == 1)
        & (F.col("destinationcountryid") == 1)
        & ~_within_alaska()
        & (match_key(F.col("category")) == "household goods")
        & (F.col("nm") > 0)
    )


def matched_bids(bids: DataFrame) -> DataFrame:
    return bids.where(F.col("netmatch") > 0)


def bid_counts(bids: DataFrame) -> DataFrame:
    """Matched bids per package."""
    return matched_bids(bids).groupBy("packageid").agg(F.count("*").alias("matched"))


def item_totals(items: DataFrame) -> DataFrame:
    """Sum of unit counts per package."""
    units = F.sum(F.col("unitcount").cast("double"))
    return items.groupBy("packageid").agg(units.alias("units"))


def package_quantity(listing: DataFrame, bids: DataFrame, items: DataFrame) -> DataFrame:
    """Units per countable package; every matched bid counts the package's items again.

    ``listing`` is unique by packageid (``Facts.check_keys``). Bids and items are reduced to one
    row per package before the join, so they never meet as pairs.
    """
    listed = listing.where(_countable()).select("packageid")
    joined = listed.join(bid_counts(bids), "packageid").join(item_totals(items), "packageid")
    return joined.select("packageid", (F.col("units") * F.col("matched")).alias("qty"))


def items_by_package(items: DataFrame, n: int = SLOTS) -> DataFrame:
    """Items of rank 1 to n side by side, as array ``slots``, and the sum of all unit counts, as
    ``units``; one pass and one shuffle.

    Values stay as the source text. Two items of one package with the same rank are an error.
    """
    values = F.struct("title", "unitcount", "length", "height", "width", "weight")
    ranked = items.select("packageid", "rank", "unitcount", values.alias("item"))
    names = [f"item{k}" for k in range(1, n + 1)]
    picks = [
        F.max(F.when(F.col("rank") == k, F.col("item"))).alias(name)
        for k, name in enumerate(names, 1)
    ]
    packed = ranked.groupBy("packageid").agg(
        F.sum(F.col("unitcount").cast("double")).alias("units"),
        F.count(F.when(F.col("rank").between(1, n), 1)).alias("given"),
        *picks,
    )
    kept = sum((F.col(name).isNotNull().cast("int") for name in names), F.lit(0))
    problem = F.raise_error(F.concat(F.lit("item ranks repeat in package "), "packageid"))
    checked = F.when(F.col("given") == kept, F.array(*names)).otherwise(problem)
    return packed.select("packageid", checked.alias("slots"), "units")


def item_slots(items: DataFrame, n: int = SLOTS) -> DataFrame:
    """The ``slots`` of the packages that have an item of rank 1 to n."""
    ranked = items.where(F.col("rank").between(1, n))
    return items_by_package(ranked, n).select("packageid", "slots")


def slot(k: int, field: str) -> Column:
    """A field of item k, NULL when the package has no such item."""
    return F.expr(f"get(slots, {k - 1}).{field}")


def slot_quantity(k: int) -> Column:
    return F.coalesce(slot(k, "unitcount").cast("int"), F.lit(0))


def item_measures() -> list[Column]:
    """Quantity, title, sizes, volumes and weights of items 1 to 5, from ``slots``."""
    out = []
    for k in range(1, SLOTS + 1):
        units, length, height, width, weight = (
            slot(k, field).cast("double")
            for field in ("unitcount", "length", "height", "width", "weight")
        )
        columns = {
            "qty": slot_quantity(k),
            "title": slot(k, "title"),
            "length": length,
            "height": height,
            "width": width,
            "weight": weight,
            "volume": length * height * width,
            "totalvolume": units * length * height * width,
            "totalweight": units * weight,
        }
        out += [value.alias(f"item{k}{name}") for name, value in columns.items()]
    return out


def shipment_filter(p: Params) -> Column:
    """Listings of the partner; a NULL title or state pair drops the row."""
    return (
        (match_key(F.col("forecastsegment")) == F.lit(p.partner.lower().rstrip(" ")))
        & ~_within_alaska()
        & ~contains_text(F.col("title"), "*comp*")
        & (F.col("datecreated") >= F.lit(p.start_date))
    )


def _deals(facts: Facts, p: Params) -> DataFrame:
    """Matched bids delivered in the window, kept narrow until they meet their listing."""
    delivered = F.col("delivereddate")
    day_after = p.end_date + timedelta(days=1)
    within = (delivered >= F.lit(p.start_date)) & (delivered < F.lit(day_after))
    dated = replace(
        facts, tracking=facts.tracking.where(within), bids=matched_bids(facts.bids)
    )
    bids = dated.unique(
        "bids", "packagematchid", "packageid", "userid", "dateaccepted", "bidvolumeusd"
    ).withColumnRenamed("bidvolumeusd", "matchprice")
    return bids.join(dated.unique("tracking", "packagematchid"), "packagematchid").join(
        facts.unique("revenue", "packagematchid", "nmr_post"), "packagematchid"
    )


def _packages(facts: Facts, counts: DataFrame, p: Params) -> DataFrame:
    """Listings with their items, old prediction and quantity: all joined on packageid."""
    listing = facts.listing.where(shipment_filter(p)).select(
        "packageid",
        "datecreated",
        "d_datecreated",
        "title",
        "origincity",
        "originstate",
        "originzip",
        "destinationcity",
        "destinationstate",
        "destinationzip",
        "mileage",
        F.col("timeframelatestpickup").alias("listing_latest_pickup"),
        F.col("timeframelatestdelivery").alias("listing_latest_delivery"),
        "totalweight",
        F.col("items").alias("totalitems"),
        "bids",
        "gm",
        F.col("nypchanges").cast("int").alias("nypchanges"),
        F.col("originalnypamount").alias("posted_at"),
        F.col("forecastsegment").alias("partner"),
        _countable().alias("countable"),
    )
    compared = facts.unique("rate_comparison", "packageid", "rate_table_nyp_amount")
    compared = compared.withColumnRenamed("rate_table_nyp_amount", "old_prediction")
    joined = (
        listing.join(compared, "packageid")
        .join(counts, "packageid")
        .join(items_by_package(facts.items), "packageid", "left")
    )
    quantity = F.when(F.col("countable"), F.col("units") * F.col("matched"))
    return joined.withColumn("totalqty", quantity).drop("countable", "units")


def _with_carrier(shipments: DataFrame, facts: Facts, p: Params) -> DataFrame:
    """Add the carrier's name; a shipment without one is dropped."""
    users = facts.unique("users", "userid", "username").withColumnRenamed("username", "carrier")
    most = p.limits.broadcast_rows
    if facts.users.limit(most + 1).count() <= most:
        joined = shipments.join(F.broadcast(users), "userid")
    else:
        counts = matched_bids(facts.bids).groupBy("userid").agg(F.count("*").alias("deals"))
        users = users.join(counts, "userid")
        joined = join_hot_keys(
            shipments, users, "userid", counts, "deals", p.limits, facts.bid_rows
        )
    return joined.drop("userid")


def shipment_base(facts: Facts, cards: Cards, p: Params) -> DataFrame:
    """One row per matched bid of the partner's delivered shipments."""
    counts = bid_counts(facts.bids)
    packages = _packages(facts, counts, p)
    shipments = join_hot_keys(
        _deals(facts, p), packages, "packageid", counts, "matched", p.limits, facts.bid_rows
    )
    shipments = _with_carrier(shipments, facts, p)
    shipments = with_lagged_fuel(shipments, cards, p)
    sides = {"originst": "origin", "destinationst": "destination"}
    found = [
        equi(cards["stateabb"], [(f"{side}state", "state")], ["stateabbr"], f"of_{name}")
        for name, side in sides.items()
    ]
    return looked_up(shipments, found, {name: F.col(f"of_{name}.stateabbr") for name in sides})


def with_zip_tier(df: DataFrame, cards: Cards) -> DataFrame:
    """Add struct ``zip_tier``: the tier of the destination zip, and the amounts of its first
    tier that has any, which may be another one if the zip is assigned several."""
    assigned, tiers = cards["zipcode_tier_assignments"], cards["zipcode_tiers_4_v6"]
    priced = equi_lookup(
        assigned.df, tiers, [("dtier", "tier")], ["surchargep", "surcharged"], "amounts"
    ).where("amounts is not null")
    zip_code = zip5(F.col("destinationzip"))
    found = [
        equi(assigned, [(zip_code, "zip")], ["dtier"], "__tier"),
        equi(assigned.derive(priced), [(zip_code, "zip")], ["amounts"], "__priced"),
    ]
    both = F.struct(F.col("__tier.dtier"), F.col("__priced.amounts"))
    return looked_up(df, found, {"zip_tier": both})


def shipment_flags(df: DataFrame, cards: Cards) -> DataFrame:
    """Rematched and high-value flags, zip tier, and what the carrier keeps."""
    df = with_zip_tier(df, cards)
    return df.withColumns(
        {
            "rematched": F.when(F.col("gm") > 1, 1).otherwise(0),
            "highvalue": F.when(contains_text(F.col("title"), "hv"), 1).otherwise(0),
            "multi_item": F.col("totalitems"),
            "zipcode_tier": F.coalesce(F.col("zip_tier.dtier"), F.lit("")),
            "amount_to_carrier": F.col("matchprice") - F.coalesce("nmr_post", F.lit(0.0)),
        }
    )


def size_rating(df: DataFrame, text_size_compare: bool = False) -> DataFrame:
    """Big-and-bulky rating bb: 2 above 400 pounds, 1 above 200 or if item 1 is long.

    With ``text_size_compare`` the sizes of item 1 are compared as texts.
    """
    sizes = [slot(1, field) for field in ("length", "height", "width")]
    if text_size_compare:
        long, high, wide = (size > str(BIG_INCHES) for size in sizes)
    else:
        long, high, wide = (size.cast("double") > BIG_INCHES for size in sizes)
    weight = F.col("totalweight")
    rating = F.when(weight > 400, 2).when((weight > 200) | long | high | wide, 1).otherwise(0)
    return df.withColumn("bb", rating)


def price_per_mile_outlier(df: DataFrame, bands=PRICE_PER_MILE_BANDS) -> DataFrame:
    """Flag a match price whose price per mile is implausible for its distance."""
    miles = F.col("mileage")
    per_mile = F.try_divide("matchprice", "mileage")
    odd = F.lit(False)
    for above, up_to, lowest, highest in bands:
        inside = miles > above
        if up_to is not None:
            inside = inside & (miles <= up_to)
        odd = odd | (inside & ((per_mile < lowest) | (per_mile > highest)))
    return df.withColumn("match_price_out_of_range", F.when(odd, 1).otherwise(0))

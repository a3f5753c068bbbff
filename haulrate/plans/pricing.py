"""The pricing chain, from facts and cards to priced and judged shipments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulrate.functions import match_key
from haulrate.operators.base_rate import base_rates
from haulrate.operators.evaluate import TERMS, evaluation_flags, evaluation_summary, total
from haulrate.operators.keywords import PARTS, difficulty_index, keyword_indexes
from haulrate.operators.shipments import (
    item_measures,
    price_per_mile_outlier,
    shipment_base,
    shipment_flags,
    size_rating,
)
from haulrate.operators.surcharges import with_terms
from haulrate.params import Params
from haulrate.sources.cards import Cards
from haulrate.sources.facts import Facts


def price(facts: Facts, cards: Cards, p: Params) -> DataFrame:
    """Priced shipments as the working frame: one row per matched bid, items as an array."""
    df = shipment_flags(shipment_base(facts, cards, p), cards)
    df = price_per_mile_outlier(size_rating(df, p.text_size_compare))
    df = keyword_indexes(df, cards["furniture_indexes"], p.keyword_passes)
    df = base_rates(difficulty_index(df), cards)
    return evaluation_flags(total(with_terms(df, cards)), cards)


def detail(priced: DataFrame, p: Params, omsa: str | None = None, dmsa: str | None = None):
    """Every column of the priced shipments, optionally of one lane only.

    The wide projection comes last: the chain before it stays within the column count up to
    which Spark generates code for whole stages.
    """
    for name, area in (("omsa", omsa), ("dmsa", dmsa)):
        if area is not None:
            priced = priced.where(match_key(F.col(name)) == area.lower().rstrip(" "))
    described = [
        "packageid", "packagematchid", "datecreated", "title", "omsa", "dmsa", "omsa_miles",
        "dmsa_miles", "ppm", "origincity", "originstate", "originst", "originzip",
        "destinationcity", "destinationstate", "destinationst", "destinationzip", "mileage",
        "listing_latest_pickup", "listing_latest_delivery", "totalweight", "totalitems",
        "totalqty", "bids",
    ]
    rated = [
        "bb", "carrier", "dateaccepted", "matchprice", "amount_to_carrier", "partner",
        "rematched", "posted_at", "old_prediction", "gas_2wa", "highvalue", "multi_item",
        "zipcode_tier", "difficulty_idx",
    ]
    judged = ["toohigh", "toolow", "good", "match_price_out_of_range", "rate_engine_prediction"]
    return priced.select(
        F.lit(p.as_of).cast("timestamp_ntz").alias("rundate"),
        *described,
        *item_measures(),
        "nypchanges",
        *[f"{part}{kind}" for kind in ("keyword", "diff", "frag") for part in PARTS],
        *rated,
        F.lit(0).alias("servicelevel"),
        *TERMS,
        *judged,
        F.col("posted_at").alias("posted_amt"),
        F.col("old_prediction").alias("old_prediction2"),
        F.col("matchprice").alias("match_price"),
    )


def scorecard(facts: Facts, cards: Cards, p: Params) -> DataFrame:
    """Shipments per verdict."""
    return evaluation_summary(price(facts, cards, p))

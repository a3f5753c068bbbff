"""The predicted price, its verdict against the price paid, and the scorecard."""

from __future__ import annotations

from functools import reduce
from operator import add, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulrate.functions import match_key
from haulrate.sources.cards import Cards

# Fixed order: sums of doubles depend on it.
TERMS = [
    "base_rate",
    "fixedcost",
    "fuel_surcharge",
    "zipcode_tier_surcharge",
    "servicelevel_surcharge",
    "stateo_surcharge",
    "stated_surcharge",
    "state_route_surcharge",
    "congestedo_surcharge",
    "congestedd_surcharge",
    "omsa_surcharge",
    "dmsa_surcharge",
    "weight_surcharge",
    "bb_surcharge",
    "difficulty_surcharge",
    "mileage_surcharge",
    "expedited_pu_surcharge",
    "expedited_del_surcharge",
    "multi_item_surcharge",
    "close_to_omsa_surcharge",
    "close_to_dmsa_surcharge",
    "addtl_qty_surcharge",
]


def total(df: DataFrame) -> DataFrame:
    """Sum of all terms, NULL counting as 0; the fixed cost is always 0."""
    terms = [F.coalesce(F.col(term), F.lit(0.0)) for term in TERMS if term != "fixedcost"]
    terms.insert(TERMS.index("fixedcost"), F.lit(0.0))
    return df.withColumns(
        {"fixedcost": F.lit(0), "rate_engine_prediction": reduce(add, terms)}
    )


def _tolerances(cards: Cards) -> dict[str, tuple[float, float, float]]:
    """Per rating: lowest and highest percentage and lowest positive amount, at most two rows.

    A verdict applies if any row of its rating says so; for that only these three count.
    """
    rating = match_key(F.col("rating"))
    rows = (
        cards["evaluation"]
        .df.where(rating.isin("too high", "too low"))
        .groupBy(rating.alias("rating"))
        .agg(
            F.min("pct").alias("least"),
            F.max("pct").alias("most"),
            F.min(F.when(F.col("amount") > 0, F.col("amount"))).alias("amount"),
        )
        .collect()
    )
    return {row["rating"]: (row["least"], row["most"], row["amount"]) for row in rows}


def _any(conditions: list[Column]) -> Column:
    return F.coalesce(reduce(or_, conditions, F.lit(False)), F.lit(False)).cast("int")


def evaluation_flags(df: DataFrame, cards: Cards) -> DataFrame:
    """Flags toohigh, toolow and good; a shipment without a price paid counts as good."""
    predicted, paid = F.col("rate_engine_prediction"), F.col("matchprice")
    tolerances = _tolerances(cards)
    high, low = [], []
    for sign, rating, found in ((1, "too high", high), (-1, "too low", low)):
        least, most, amount = tolerances.get(rating, (None, None, None))
        for pct in {least, most} - {None}:
            bound = paid * (1 + sign * F.lit(pct))
            found.append(predicted > bound if sign > 0 else predicted < bound)
        if amount is not None:
            found.append((predicted - paid if sign > 0 else paid - predicted) > amount)
    df = df.withColumns({"toohigh": _any(high), "toolow": _any(low)})
    neither = (F.col("toohigh") == 0) & (F.col("toolow") == 0)
    return df.withColumn("good", neither.cast("int"))


def evaluation_summary(df: DataFrame) -> DataFrame:
    """Shipments per verdict."""
    verdict = (
        F.when(F.col("toohigh") > 0, "Too high")
        .when(F.col("toolow") > 0, "Too Low")
        .when(F.col("good") > 0, "Good")
    )
    return df.groupBy(verdict.alias("evaluation")).agg(F.count("*").alias("shipments"))

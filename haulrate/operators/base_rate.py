"""Metropolitan areas of both ends, and the base rate between them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulrate.functions import has_text, match_key, zip5
from haulrate.operators.lookups import Lookup, equi, looked_up, one_per_key, pair_band_lookup
from haulrate.sources.cards import Card, Cards

LANE_BAND_MILES = 10
SHORT_HAUL_MILES = 250


def msa_by_zip(cards: Cards) -> Card:
    """Per zip: the area it lies in at 0 miles, else the closest area and whole miles to it."""
    primary, closest = cards["zipcodes"], cards["zips_with_closest_msa"]
    primary_rows = primary.df.where(match_key(F.col("primaryrecord")) == "p")
    sides = []
    for card, rows, miles in ((primary, primary_rows, "0"), (closest, closest.df, "distance")):
        keyed = rows.select(
            match_key(F.col("zipcode")).alias("zip"),
            F.col("msa_name").alias("msa"),
            F.expr(f"cast({miles} as int)").alias("miles"),
            "id",
        )
        sides.append(
            one_per_key(
                keyed,
                ["zip"],
                F.struct("msa", "miles"),
                F.struct("id", "msa", "miles"),
                "area",
                card.small,
            )
        )
    both = sides[0].withColumn("side", F.lit(0)).unionAll(sides[1].withColumn("side", F.lit(1)))
    if primary.small and closest.small:
        both = both.coalesce(1)
    pick = [F.max(F.when(F.col("side") == i, F.col("area"))).alias(f"area{i}") for i in (0, 1)]
    areas = both.groupBy("zip").agg(*pick)
    named = F.coalesce(has_text(F.col("area0.msa")), F.lit(False))
    area = F.when(named, F.col("area0")).otherwise(F.col("area1"))
    return primary.derive(areas.select("zip", area.alias("area")), closest)


def _area(areas: Card, side: str) -> tuple[Lookup, dict[str, Column]]:
    """The lookup of one side's area, and what it adds."""
    name, prefix = f"{side}_area", side[0]
    found = equi(areas, [(zip5(F.col(f"{side}zip")), "zip")], ["area"], name)
    columns = {"msa": F.col(f"{name}.area.msa"), "msa_miles": F.col(f"{name}.area.miles")}
    return found, {f"{prefix}{kind}": value for kind, value in columns.items()}


def resolve_msa(df: DataFrame, areas: Card, side: str) -> DataFrame:
    """Add omsa and omsa_miles, or dmsa and dmsa_miles, for side origin or destination."""
    found, columns = _area(areas, side)
    return looked_up(df, [found], columns)


def with_areas(df: DataFrame, cards: Cards) -> DataFrame:
    """The areas of both ends."""
    areas = msa_by_zip(cards)
    (origin, first), (destination, second) = (_area(areas, s) for s in ("origin", "destination"))
    return looked_up(df, [origin, destination], first | second)


def ppm_base_rate(df: DataFrame, cards: Cards) -> DataFrame:
    """Base rate from the price per mile of the area pair; NULL where the pair has none."""
    pair = [("omsa", "o_msa"), ("dmsa", "d_msa")]
    lane, ppm = equi(cards["ppm_master"], pair, ["ppm"], "lane"), F.col("lane.ppm")
    return looked_up(df, [lane], {"base_rate": ppm * F.col("mileage"), "ppm": ppm})


def lane_rate_override(df: DataFrame, cards: Cards) -> DataFrame:
    """A flat lane rate replaces the base rate if both ends lie inside their areas."""
    found = pair_band_lookup(
        df,
        cards["msa_to_msa_rates_by_mileage"],
        [("omsa", "omsa"), ("dmsa", "dmsa")],
        "mileage",
        "maxmiles",
        LANE_BAND_MILES,
        ["rate"],
        "lane",
    )
    inside = (F.col("omsa_miles") == 0) & (F.col("dmsa_miles") == 0)
    hit = F.col("lane").isNotNull() & inside
    miles = F.when(F.col("mileage") < 1, 1.0).otherwise(F.col("mileage"))
    rate = F.col("lane.rate")
    return found.withColumns(
        {
            "base_rate": F.when(hit, rate).otherwise(F.col("base_rate")),
            "ppm": F.when(hit, rate * 1.0 / miles).otherwise(F.col("ppm")),
        }
    ).drop("lane")


def short_haul(df: DataFrame) -> DataFrame:
    """Mileage pricing of short trips that have no base rate yet."""
    miles = F.col("mileage")
    rate = F.when(miles <= 10, 100.0).when(miles <= 20, 115.0).otherwise(105 + (miles - 15) / 2)
    short = F.col("base_rate").isNull() & (miles <= SHORT_HAUL_MILES)
    return df.withColumns(
        {
            "base_rate": F.when(short, rate).otherwise(F.col("base_rate")),
            "ppm": F.when(short, 0.0).otherwise(F.col("ppm")),
        }
    )


def base_rates(df: DataFrame, cards: Cards) -> DataFrame:
    """Areas, then the three layers of the base rate."""
    return short_haul(lane_rate_override(ppm_base_rate(with_areas(df, cards), cards), cards))

"""Weekly fuel prices and the price two weeks before a shipment's week."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulrate.operators.lookups import equi, looked_up
from haulrate.params import Params
from haulrate.sources.cards import Card, Cards


def _priced_days(cards: Cards, p: Params) -> DataFrame:
    days = cards["calendar"].df.where(
        (F.col("day_date") >= F.lit(p.fuel_start)) & (F.col("week_end_date") < F.lit(p.as_of))
    )
    prices = cards["fuelprices"].df.select("date", "gas", "id")
    same_day = F.col("day_date").cast("timestamp_ntz") == F.col("date")
    return days.select("day_date", "week_end_date").join(prices, same_day)


def fuel_weekly(cards: Cards, p: Params) -> DataFrame:
    """Gas price rows by the end of their week, for finished weeks only."""
    return _priced_days(cards, p).select("week_end_date", "gas")


def fuel_by_day(cards: Cards, p: Params) -> Card:
    """Calendar days with their week's end and the gas price of the lagged week.

    A week with several prices, as a repeated load leaves behind, counts with its latest one.
    """
    latest = F.max_by("gas", F.struct("date", "id"))
    weekly = _priced_days(cards, p).groupBy(F.col("week_end_date").alias("priced_week"))
    weekly = weekly.agg(latest.alias("gas_2wa"))
    days = cards["calendar"].df.select("day_date", "week_end_date", "id")
    lagged = F.date_sub("week_end_date", p.fuel_lag_days) == F.col("priced_week")
    by_day = days.join(weekly, lagged, "left").drop("priced_week")
    return cards["calendar"].derive(by_day)


def with_lagged_fuel(df: DataFrame, cards: Cards, p: Params) -> DataFrame:
    """Add week_end_date and gas_2wa; a row whose day is not in the calendar is dropped."""
    day = equi(
        fuel_by_day(cards, p),
        [("d_datecreated", "day_date")],
        ["week_end_date", "gas_2wa"],
        "day",
    )
    week, gas = F.col("day.week_end_date"), F.col("day.gas_2wa")
    found = looked_up(
        df, [day], {"week_end_date": week, "gas_2wa": gas, "known": F.col("day").isNotNull()}
    )
    return found.where("known").drop("known")

"""Surcharges: each adds one term (or a pair of terms) to a shipment that has a base rate.

A term is 0 where its card has no matching row, unless stated otherwise, and NULL where the
matched rule computes over NULLs; the total counts NULL as 0.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulrate.operators.lookups import Lookup, band, equi, looked_up
from haulrate.operators.shipments import slot_quantity, with_zip_tier
from haulrate.sources.cards import Card, Cards

WEIGHT_INCLUDED = 200
WEIGHT_STEP = 50
CONGESTED_PAIR_MILES = 50
BASE = "base_rate"


def _if_hit(name: str, value: Column) -> Column:
    """The value where the lookup hit, else the initial 0."""
    return F.when(F.col(name).isNotNull(), value).otherwise(0.0)


def _dollars_first(dollars: Column, percent: Column) -> Column:
    return F.when(dollars > 0, dollars).otherwise(percent * F.col(BASE))


def _percent_and_dollars(percent: Column, dollars: Column) -> Column:
    return F.col(BASE) * percent + dollars


@dataclass(frozen=True)
class Rule:
    """What a surcharge looks up, and the terms it computes from the lookups and the shipment."""

    lookups: Sequence[Lookup]
    terms: Mapping[str, Column]


def fuel_rule(cards: Cards) -> Rule:
    """Started steps of the lagged gas price above the baseline, by mileage band."""
    take = ["fuel_baseline", "fuel_tiers", "fuel_surcharge"]
    found = band(cards["fuel_surcharge_v6"], "mileage", "low", "high", take, "fuel")
    gas, baseline = F.col("gas_2wa").cast("double"), F.col("fuel.fuel_baseline")
    steps = F.ceil((gas - baseline) / F.col("fuel.fuel_tiers")).cast("double")
    rate = steps * F.col("fuel.fuel_surcharge") * F.col(BASE)
    above = F.when(gas > baseline, rate).otherwise(0.0)
    return Rule([found], {"fuel_surcharge": _if_hit("fuel", above)})


def zip_tier_rule(cards: Cards) -> Rule:
    """Percent and dollars of the destination zip's tier, which the shipment carries already."""
    amounts = "zip_tier.amounts"
    rate = _percent_and_dollars(F.col(f"{amounts}.surchargep"), F.col(f"{amounts}.surcharged"))
    return Rule([], {"zipcode_tier_surcharge": _if_hit(amounts, rate)})


def service_level_rule(cards: Cards) -> Rule:
    """Percent by partner."""
    partner = [("partner", "partner")]
    found = equi(cards["servicelevel_v6"], partner, ["sl_surchargep"], "level")
    rate = F.col(BASE) * F.col("level.sl_surchargep")
    return Rule([found], {"servicelevel_surcharge": _if_hit("level", rate)})


def state_rule(cards: Cards) -> Rule:
    """Origin and destination state, beyond the state's minimum miles."""
    lookups, terms = [], {}
    for side, mark in (("origin", "o"), ("destination", "d")):
        term, name = f"state{mark}_surcharge", f"state{mark}"
        take = ["minmiles", f"{term}d", f"{term}p"]
        lookups.append(equi(cards[f"state{mark}_v6"], [(f"{side}state", "state")], take, name))
        rate = _dollars_first(F.col(f"{name}.{term}d"), F.col(f"{name}.{term}p"))
        far = F.col("mileage") > F.col(f"{name}.minmiles")
        terms[term] = F.when(far, rate).otherwise(0.0)
    return Rule(lookups, terms)


def state_route_rule(cards: Cards) -> Rule:
    """Dollars, or else percent, by the pair of states."""
    pair = [("originst", "o_st"), ("destinationst", "d_st")]
    found = equi(cards["state_route"], pair, ["surcharged", "surchargep"], "route")
    rate = _dollars_first(F.col("route.surcharged"), F.col("route.surchargep"))
    return Rule([found], {"state_route_surcharge": _if_hit("route", rate)})


def congested_rule(cards: Cards) -> Rule:
    """Flat amounts for congested zips, which match on the whole zip code.

    A destination close to a congested origin is not charged again.
    """
    zips, lookups, terms = cards["congested_zipcodes"], [], {}
    for side, mark in (("origin", "o"), ("destination", "d")):
        amount = cards[f"congested{mark}_v6"].single
        term, name = f"congested{mark}_surcharge", f"busy{mark}"
        if amount is None:
            terms[term] = F.lit(0.0)
            continue
        lookups.append(equi(zips, [(f"{side}zip", "zipcode")], ["zipcode"], name))
        flat = F.lit(amount["congested_surcharge"]).cast("double")
        if mark == "d":
            paired = (terms["congestedo_surcharge"] > 0) & (F.col("mileage") <= CONGESTED_PAIR_MILES)
            flat = F.when(paired, 0.0).otherwise(flat)
        terms[term] = _if_hit(name, flat)
    return Rule(lookups, terms)


def weight_rule(cards: Cards) -> Rule:
    """Percent per weight step, or else dollars per step, above the minimum weight."""
    rule = cards["weight_v6"].single
    if rule is None:
        return Rule([], {"weight_surcharge": F.lit(0.0)})
    least, dollars, percent = (
        F.lit(rule[name]).cast("double") for name in ("minweight", "surcharged", "surchargep")
    )
    weight = F.col("totalweight")
    by_percent = (weight - WEIGHT_INCLUDED) / WEIGHT_STEP * percent * F.col(BASE)
    by_dollars = dollars * (weight - least) / WEIGHT_STEP
    rate = F.when((weight > least) & (percent > 0), by_percent)
    rate = rate.when((weight > least) & (dollars > 0), by_dollars).otherwise(0.0)
    return Rule([], {"weight_surcharge": rate})


def size_rule(cards: Cards) -> Rule:
    """Percent and dollars by size rating."""
    take = ["bb_surchargep", "bb_surcharged"]
    found = equi(cards["bb_v6"], [("bb", "bb_rating")], take, "size")
    rate = _percent_and_dollars(F.col("size.bb_surchargep"), F.col("size.bb_surcharged"))
    return Rule([found], {"bb_surcharge": _if_hit("size", rate)})


def difficulty_rule(cards: Cards) -> Rule:
    """Percent and dollars by difficulty."""
    index = F.col("difficulty_idx").cast("double")
    take = ["surchargep", "surcharged"]
    found = equi(cards["difficulty_v6"], [(index, "diffidx")], take, "hard")
    rate = _percent_and_dollars(F.col("hard.surchargep"), F.col("hard.surcharged"))
    return Rule([found], {"difficulty_surcharge": _if_hit("hard", rate)})


def mileage_rule(cards: Cards) -> Rule:
    """Percent by mileage band."""
    card = cards["mileage_surcharge_v6"]
    found = band(card, "mileage", "minmiles", "maxmiles", ["surchargep"], "far")
    rate = F.col("far.surchargep") * F.col(BASE)
    return Rule([found], {"mileage_surcharge": _if_hit("far", rate)})


def msa_rule(cards: Cards) -> Rule:
    """Origin and destination area."""
    lookups, terms = [], {}
    for area in ("omsa", "dmsa"):
        name, take = f"in{area}", ["surcharged", "surchargep"]
        lookups.append(equi(cards[f"{area}_surcharge"], [(area, "msa")], take, name))
        rate = _dollars_first(F.col(f"{name}.surcharged"), F.col(f"{name}.surchargep"))
        terms[f"{area}_surcharge"] = _if_hit(name, rate)
    return Rule(lookups, terms)


def expedited_rule(cards: Cards) -> Rule:
    """Days from creation to the latest pickup and delivery; here the percent comes first."""
    lookups, terms = [], {}
    for part, latest in (("pu", "listing_latest_pickup"), ("del", "listing_latest_delivery")):
        days = F.date_diff(F.col(latest).cast("date"), F.col("datecreated").cast("date"))
        card, name, take = cards[f"expedited_{part}"], f"rush{part}", ["surchargep", "surcharged"]
        lookups.append(band(card, days, f"{part}_days_min", f"{part}_days_max", take, name))
        percent, dollars = F.col(f"{name}.surchargep"), F.col(f"{name}.surcharged")
        rate = F.when(percent > 0, percent * F.col(BASE)).otherwise(F.coalesce(dollars, F.lit(0.0)))
        terms[f"expedited_{part}_surcharge"] = rate
    return Rule(lookups, terms)


def multi_item_rule(cards: Cards) -> Rule:
    """Discounted base rate for every item after the first."""
    rule = cards["multi_item_discount_v6"].single
    if rule is None:
        return Rule([], {"multi_item_surcharge": F.lit(0.0)})
    items, discount = F.col("totalitems"), F.lit(rule["discount"]).cast("double")
    rate = F.col(BASE) * (items - 1) * (1 - discount)
    return Rule([], {"multi_item_surcharge": F.when(items > 1, rate).otherwise(0.0)})


def near_msa_rule(cards: Cards) -> Rule:
    """Flat amounts by the miles from either end to its closest area, if outside it."""
    card, lookups, terms = cards["miles_to_msa_surcharge"], [], {}
    for area in ("omsa", "dmsa"):
        miles, name = f"{area}_miles", f"near{area}"
        lookups.append(band(card, miles, "minmiles", "maxmiles", ["surcharged"], name))
        hit = F.col(name).isNotNull() & (F.col(miles) > 0)
        terms[f"close_to_{area}_surcharge"] = F.when(hit, F.col(f"{name}.surcharged")).otherwise(0.0)
    return Rule(lookups, terms)


def extra_quantity_rule(cards: Cards) -> Rule:
    """Started groups of item 1 beyond the first, by the row of item 1's keyword text.

    The keyword text equals a keyword only where a single keyword matched; NULL on a miss.
    """
    take, words = ["singleitemqty", "addtl_percent"], cards["furniture_indexes"]
    found = equi(words, [("item1keyword", "keyword")], take, "extra")
    group, quantity = F.col("extra.singleitemqty"), slot_quantity(1)
    groups = F.ceil(F.try_divide(quantity, group)).cast("double") - 1
    rate = groups * F.col(BASE) * F.col("extra.addtl_percent")
    rate = F.when(quantity <= group, 0.0).when(quantity > group, rate)
    return Rule([found], {"addtl_qty_surcharge": rate})


RULES = (
    fuel_rule,
    zip_tier_rule,
    service_level_rule,
    state_rule,
    state_route_rule,
    congested_rule,
    weight_rule,
    size_rule,
    difficulty_rule,
    mileage_rule,
    msa_rule,
    expedited_rule,
    multi_item_rule,
    near_msa_rule,
    extra_quantity_rule,
)


def with_terms(df: DataFrame, cards: Cards, rules: Sequence[Callable[[Cards], Rule]] = RULES):
    """Add the terms of the rules to shipments that have a base rate.

    No rule reads another's term, so their lookups are joined one after the other and one
    projection computes all terms. A rule that reads the zip's tier has it looked up where the
    shipment does not carry it; it ends here.
    """
    tiered = zip_tier_rule in rules
    if tiered and "zip_tier" not in df.columns:
        df = with_zip_tier(df, cards)
    made = [rule(cards) for rule in rules]
    lookups = [lookup for rule in made for lookup in rule.lookups]
    terms = {name: term for rule in made for name, term in rule.terms.items()}
    done = looked_up(df, lookups, terms)
    return done.drop("zip_tier") if tiered else done


def _operator(rule: Callable[[Cards], Rule]) -> Callable[[DataFrame, Cards], DataFrame]:
    """The rule alone, as an operator that adds its terms to a frame."""

    def add(df: DataFrame, cards: Cards) -> DataFrame:
        return with_terms(df, cards, [rule])

    add.__doc__ = rule.__doc__
    return add


fuel_surcharge = _operator(fuel_rule)
zip_tier_surcharge = _operator(zip_tier_rule)
service_level_surcharge = _operator(service_level_rule)
state_surcharge = _operator(state_rule)
state_route_surcharge = _operator(state_route_rule)
congested_surcharge = _operator(congested_rule)
weight_surcharge = _operator(weight_rule)
size_surcharge = _operator(size_rule)
difficulty_surcharge = _operator(difficulty_rule)
mileage_surcharge = _operator(mileage_rule)
msa_surcharge = _operator(msa_rule)
expedited_surcharge = _operator(expedited_rule)
multi_item_surcharge = _operator(multi_item_rule)
near_msa_surcharge = _operator(near_msa_rule)


def extra_quantity_surcharge(df: DataFrame, keywords: Card) -> DataFrame:
    """The extra quantity rule alone, of a given keyword card."""
    return with_terms(df, {"furniture_indexes": keywords}, [extra_quantity_rule])

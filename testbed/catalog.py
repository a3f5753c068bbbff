"""The registered queries: one per operator, over the whole test tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime
from functools import cached_property, reduce

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulrate.operators import base_rate, evaluate, keywords, shipments, surcharges
from haulrate.operators.fuel import fuel_weekly
from haulrate.operators.lookups import band_lookup, equi_lookup
from haulrate.params import Limits, Params
from haulrate.plans import backtest, pricing
from haulrate.sources.cards import Card, Cards
from haulrate.sources.commits import CommitLog, LedgerTable, VersionedTable, Window
from haulrate.sources.facts import Facts
from haulrate.sources.schemas import CARD_DDL, FACT_DDL
from haulrate.sources.seeds import SIZE_RATING_VALUES, size_ratings
from haulrate.sources.shared import shared_folder
from haulrate.sources.sync import (
    FUEL_SERIES,
    Table,
    append,
    extract,
    fan_out,
    full_refresh,
    pivot_fuel,
)
from haulrate.sources.upsert import upsert
from testbed import cards as card_rows
from testbed import facts as fact_tables

ENVIRONMENTS = ("dev", "qa", "sand", "prod")


class Bench:
    """Everything one query needs, made on first use."""

    def __init__(self, spark: SparkSession, sf_dir: str, limits: Limits | None = None):
        self.spark = spark
        self.sf_dir = sf_dir
        self.limits = limits or Limits()
        self.params = Params(
            partner="FURNITURE",
            as_of=date(2002, 1, 1),
            start_date=date(1996, 1, 1),
            end_date=date(2001, 12, 31),
            fuel_start=date(1995, 1, 1),
            limits=self.limits,
        )

    def table(self, name: str) -> DataFrame:
        return fact_tables.table(self.spark, self.sf_dir, name)

    @cached_property
    def facts(self) -> Facts:
        return fact_tables.load(self.spark, self.sf_dir, self.limits)

    @cached_property
    def cards(self) -> Cards:
        return card_rows.load(self.spark, self.limits)

    @cached_property
    def base(self) -> DataFrame:
        return shipments.shipment_base(self.facts, self.cards, self.params)

    @cached_property
    def rated(self) -> DataFrame:
        return base_rate.base_rates(self.base, self.cards)

    @cached_property
    def worded(self) -> DataFrame:
        return self._worded(self.base)

    def _worded(self, df: DataFrame) -> DataFrame:
        return keywords.keyword_indexes(
            df, self.cards["furniture_indexes"], self.params.keyword_passes
        )

    @cached_property
    def worded_rated(self) -> DataFrame:
        return keywords.difficulty_index(self._worded(self.rated))

    @cached_property
    def priced(self) -> DataFrame:
        return pricing.price(self.facts, self.cards, self.params)

    def fuel_feed(self) -> DataFrame:
        """Long fuel feed: two event types stand for the two series."""
        kind = F.col("event_type")
        series = F.when(kind == "view", FUEL_SERIES["gas"]).when(
            kind == "click", FUEL_SERIES["diesel"]
        )
        return self.table("events").select(
            F.col("ts").cast("date").alias("date"),
            F.coalesce(series, kind).alias("type"),
            F.col("value").alias("ppg"),
        )

    def stored(self, name: str) -> Table:
        return Table(name, options={"path": shared_folder(self.spark, name)})

    def parts(self, dearer: float = 0.0) -> DataFrame:
        price = F.col("p_retailprice") + dearer
        return self.table("part").select("p_partkey", "p_name", price.alias("p_retailprice"))

    def offers(self) -> DataFrame:
        """Customers as rows of the part table: their tripled keys are partly new to it."""
        return self.table("customer").select(
            (F.col("c_custkey") * 3).alias("p_partkey"),
            F.col("c_name").alias("p_name"),
            F.col("c_acctbal").alias("p_retailprice"),
        )


def _of_shipments(frame: DataFrame, *columns: str) -> DataFrame:
    return frame.select("packagematchid", *columns)


def _package_quantity(b: Bench) -> DataFrame:
    return shipments.package_quantity(b.facts.listing, b.facts.bids, b.facts.items)


def _item_slots(b: Bench) -> DataFrame:
    fields = ("title", "unitcount", "length", "height", "width", "weight")
    return shipments.item_slots(b.facts.items).select(
        "packageid",
        *[
            shipments.slot(k, field).alias(f"item{k}{field}")
            for k in range(1, shipments.SLOTS + 1)
            for field in fields
        ],
    )


def _item_measures(b: Bench) -> DataFrame:
    slots = shipments.item_slots(b.facts.items)
    return slots.select("packageid", *shipments.item_measures())


def _shipment_base(b: Bench) -> DataFrame:
    return _of_shipments(
        b.base.withColumn("gas_2wa", F.col("gas_2wa").cast("double")),
        "packageid", "datecreated", "title", "origincity", "originstate", "originst",
        "originzip", "destinationcity", "destinationstate", "destinationst", "destinationzip",
        "mileage", "listing_latest_pickup", "listing_latest_delivery", "totalweight",
        "totalitems", "totalqty", "bids", "nypchanges", "carrier", "dateaccepted",
        "matchprice", "nmr_post", "partner", "posted_at", "old_prediction", "week_end_date",
        "gas_2wa",
    )


def _shipment_flags(b: Bench) -> DataFrame:
    return _of_shipments(
        shipments.shipment_flags(b.base, b.cards),
        "rematched", "highvalue", "multi_item", "zipcode_tier", "amount_to_carrier",
    )


def _size_rating(b: Bench) -> DataFrame:
    return _of_shipments(shipments.size_rating(b.base), "totalweight", "bb")


def _price_per_mile_outlier(b: Bench) -> DataFrame:
    return _of_shipments(
        shipments.price_per_mile_outlier(b.base),
        "mileage",
        "matchprice",
        "match_price_out_of_range",
    )


def _fuel_weekly(b: Bench) -> DataFrame:
    """Prices and calendar come from the feed itself, so the work grows with it."""
    prices = pivot_fuel(b.fuel_feed(), datetime(2024, 1, 31), days=365)
    day = F.col("date").cast("date")
    week_end = F.date_add(day, F.pmod(F.lit(5) - F.weekday(day), F.lit(7)))
    calendar = prices.select(day.alias("day_date"), week_end.alias("week_end_date"))
    params = Params(partner="", as_of=date(2024, 1, 31), fuel_start=date(2024, 1, 3))
    cards = Cards({"calendar": calendar, "fuelprices": prices}, b.limits)
    return fuel_weekly(cards, params).withColumn("gas", F.col("gas").cast("double"))


def _fuel_two_weeks_ago(b: Bench) -> DataFrame:
    gas = F.col("gas_2wa").cast("double").alias("gas_2wa")
    return b.base.select("packagematchid", "d_datecreated", "week_end_date", gas)


def _keyword_indexes(b: Bench) -> DataFrame:
    kinds = ("keyword", "diff", "frag")
    return _of_shipments(b.worded, *[f"{part}{kind}" for kind in kinds for part in keywords.PARTS])


def _difficulty_index(b: Bench) -> DataFrame:
    return _of_shipments(keywords.difficulty_index(b.worded), "difficulty_idx")


def _msa_resolution(b: Bench) -> DataFrame:
    return _of_shipments(
        base_rate.with_areas(b.base, b.cards),
        "originzip", "destinationzip", "omsa", "dmsa", "omsa_miles", "dmsa_miles",
    )


def _ppm_base_rate(b: Bench) -> DataFrame:
    rated = base_rate.ppm_base_rate(base_rate.with_areas(b.base, b.cards), b.cards)
    return _of_shipments(rated, "mileage", "ppm", "base_rate")


def _lane_rate_override(b: Bench) -> DataFrame:
    rated = base_rate.ppm_base_rate(base_rate.with_areas(b.base, b.cards), b.cards)
    rated = base_rate.lane_rate_override(rated, b.cards)
    return _of_shipments(rated, "mileage", "ppm", "base_rate")


def _short_haul_base_rate(b: Bench) -> DataFrame:
    return _of_shipments(b.rated, "mileage", "ppm", "base_rate")


def _surcharge(operator, *columns: str) -> Callable[[Bench], DataFrame]:
    return lambda b: _of_shipments(operator(b.rated, b.cards), *columns)


def _size_surcharge(b: Bench) -> DataFrame:
    sized = shipments.size_rating(b.rated)
    return _of_shipments(surcharges.size_surcharge(sized, b.cards), "bb", "bb_surcharge")


def _difficulty_surcharge(b: Bench) -> DataFrame:
    return _of_shipments(
        surcharges.difficulty_surcharge(b.worded_rated, b.cards),
        "difficulty_idx", "difficulty_surcharge",
    )


def _extra_quantity_surcharge(b: Bench) -> DataFrame:
    return _of_shipments(
        surcharges.extra_quantity_surcharge(b.worded_rated, b.cards["furniture_indexes"]),
        "item1keyword", "addtl_qty_surcharge",
    )


def _priced_shipments(b: Bench) -> DataFrame:
    detail = pricing.detail(b.priced, b.params)
    return detail.withColumn("gas_2wa", F.col("gas_2wa").cast("double"))


def _evaluation_flags(b: Bench) -> DataFrame:
    return _of_shipments(
        b.priced, "rate_engine_prediction", "matchprice", "toohigh", "toolow", "good"
    )


def _evaluation_summary(b: Bench) -> DataFrame:
    return evaluate.evaluation_summary(b.priced)


def _fuel_feed_pivot(b: Bench) -> DataFrame:
    return pivot_fuel(b.fuel_feed(), datetime(2024, 1, 31))


def _append_load(b: Bench) -> DataFrame:
    target = b.stored("append_load")
    full_refresh(b.parts(), target)
    append(b.parts(dearer=100.0), target)
    return extract(b.spark, target)


def _full_refresh(b: Bench) -> DataFrame:
    target = b.stored("full_refresh")
    full_refresh(b.parts(), target)
    full_refresh(b.parts(dearer=100.0), target)
    return extract(b.spark, target)


def _fan_out_load(b: Bench) -> DataFrame:
    targets = [b.stored(name) for name in ENVIRONMENTS]
    status = fan_out(b.parts(), targets, full_refresh)
    loaded = None
    for target in targets:
        rows = extract(b.spark, target).select(
            F.lit(target.name).alias("target"), "p_partkey", "p_retailprice"
        )
        loaded = rows if loaded is None else loaded.unionAll(rows)
    return loaded.join(F.broadcast(status), "target")  # one status row per target


class _LostOnce(CommitLog):
    """A log whose first commit is lost, as of a driver that dies after the data are written."""

    lost = False

    def commit(self, name: str, record: dict) -> bool:
        if not self.lost:
            self.lost = True
            raise RuntimeError("lost before the commit")
        return super().commit(name, record)


def _append_ledger(b: Bench) -> DataFrame:
    """Fuel loads that run twice, overlap, and are lost before their commit."""
    prices = pivot_fuel(b.fuel_feed(), datetime(2024, 1, 31), days=3650)
    table = LedgerTable(b.spark, shared_folder(b.spark, "append_ledger"))
    first = Window(date(2024, 1, 1), date(2024, 1, 12))
    last = Window(date(2024, 1, 20), date(2024, 1, 31))
    for window in (first, Window(date(2024, 1, 8), date(2024, 1, 20)), first):
        table.append(prices, "date", window)
    table.ledger = _LostOnce(b.spark, table.ledger.folder)
    for _ in range(3):
        try:
            table.append(prices, "date", last)
        except RuntimeError:
            continue
    return table.read()


def _refresh_versioned(b: Bench) -> DataFrame:
    """What readers see beside a refresh that fails, and before and after one that ends."""
    table = VersionedTable(b.spark, shared_folder(b.spark, "refresh_versioned"))
    table.refresh(b.parts())
    lost = F.when(F.col("p_partkey") > 0, F.col("p_retailprice"))
    broken = b.parts(dearer=50.0).withColumn(
        "p_retailprice", lost.otherwise(F.raise_error(F.lit("lost")).cast("double"))
    )
    try:
        table.refresh(broken)
        raise AssertionError("the refresh was to fail")
    except PySparkException:
        before = table.read()
    table.refresh(b.parts(dearer=100.0))
    return reduce(
        DataFrame.unionAll,
        [
            rows.select(F.lit(seen).alias("seen"), F.lit(version).alias("version"), "*")
            for seen, version, rows in (
                ("before", 1, before),
                ("after", table.version(), table.read()),
            )
        ],
    )


def _fan_out_resume(b: Bench) -> DataFrame:
    """One target cannot hold the columns at first; a second call loads it alone."""
    state = CommitLog(b.spark, shared_folder(b.spark, "fan_out_state"))
    targets = [b.stored(name) for name in ENVIRONMENTS]
    narrow = [Table("qa", "text", t.options) if t.name == "qa" else t for t in targets]
    calls = [
        fan_out(b.parts(), narrow, full_refresh, attempts=2, state=state),
        fan_out(b.parts(dearer=1.0), targets, full_refresh, attempts=2, state=state),
    ]
    told = [c.select(F.lit(k + 1).alias("call"), "*") for k, c in enumerate(calls)]
    loaded = reduce(
        DataFrame.unionAll,
        [
            extract(b.spark, t).select(F.lit(t.name).alias("target"), "p_partkey", "p_retailprice")
            for t in targets
        ],
    )
    status = reduce(DataFrame.unionAll, told)  # a row for each target and call
    return loaded.join(F.broadcast(status), "target")


def _ratecard_upsert(b: Bench) -> DataFrame:
    """At table size, with the target as it was stored a month ago."""
    then = F.lit("2024-01-01").cast("timestamp_ntz")
    current = b.stored("ratecard")
    stamped = b.parts().withColumns({"datecreatedutc": then, "dateupdatedutc": then})
    full_refresh(stamped, current)
    merged = upsert(
        extract(b.spark, current),
        b.offers(),
        ["p_partkey"],
        ["p_name", "p_retailprice"],
        datetime(2024, 2, 1),
    )
    version = b.stored("ratecard")
    full_refresh(merged, version)
    return extract(b.spark, version)


def _equi_lookup(b: Bench) -> DataFrame:
    """Every line item: a miss keeps the old value or overwrites it; and the part of half its
    key."""
    rows = [(1, "a", 1.5), (2, "A ", 2.5), (3, "r", None)]
    flags = b.spark.createDataFrame(rows, "id int, flag string, amount double")
    parts = b.table("part").withColumn("doubled", F.col("p_partkey") * 2)
    found = equi_lookup(
        b.table("lineitem"),
        Card(flags, b.limits),
        [("l_returnflag", "flag")],
        ["amount"],
        "flag",
    )
    found = equi_lookup(
        found,
        Card(parts, b.limits),
        [("l_partkey", "doubled")],
        ["p_name", "p_retailprice"],
        "part",
    )
    hit = F.col("flag").isNotNull()
    return found.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        "l_quantity",
        F.when(hit, F.col("flag.amount")).otherwise(F.col("l_discount")).alias("kept"),
        F.col("flag.amount").alias("overwritten"),
        F.col("part.p_name").alias("part_name"),
        F.col("part.p_retailprice").alias("price"),
    )


def _band_lookup(b: Bench) -> DataFrame:
    """Every line item: overlapping bands, a gap, and two equal bands."""
    rows = [
        (1, 0, 20000, "small"),
        (2, 20000, 50000, "middle"),
        (3, 15000, 30000, "mixed"),
        (4, 60000, 90000, "large"),
        (5, 60000, 90000, "twin"),
    ]
    bands = b.spark.createDataFrame(rows, "id int, low int, high int, label string")
    found = band_lookup(
        b.table("lineitem"),
        Card(bands, b.limits),
        "l_extendedprice",
        "low",
        "high",
        ["label"],
        "band",
    )
    return found.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        "l_extendedprice",
        F.col("band.label").alias("label"),
    )


def _band_lookup_many(b: Bench) -> DataFrame:
    """Every line item in as many bands as there are orders; they overlap, and have no ids."""
    low = F.col("o_totalprice")
    bands = b.table("orders").select(
        low.alias("low"),
        (low + (F.col("o_orderkey") % 50) * 10).alias("high"),
        F.col("o_orderpriority").alias("label"),
    )
    found = band_lookup(
        b.table("lineitem"),
        Card(bands, b.limits),
        "l_extendedprice",
        "low",
        "high",
        ["low", "label"],
        "band",
    )
    return found.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
        F.col("band.low").alias("low"), F.col("band.label").alias("label"),
    )


def _band_lookup_open(b: Bench) -> DataFrame:
    """Every line item in two bands per line item, a third of them open at one end."""
    price, half = F.col("l_extendedprice"), F.col("half")
    at = F.when(half == 0, price).otherwise(price * 0.75)
    kind = (F.col("l_orderkey") + F.col("l_linenumber") + half) % 6
    infinite = F.lit(float("inf"))
    bands = (
        b.table("lineitem")
        .withColumn("half", F.explode(F.array(F.lit(0), F.lit(1))))
        .select(
            ((F.col("l_orderkey") * 8 + F.col("l_linenumber")) * 2 + half).alias("id"),
            F.when(kind == 0, -infinite).otherwise(at).alias("low"),
            F.when(kind == 0, at)
            .when(kind == 1, infinite)
            .otherwise(at + F.col("l_partkey") % 40 * 5)
            .alias("high"),
            "l_suppkey",
        )
    )
    take = ["low", "high", "l_suppkey"]
    card = Card(bands, b.limits)
    found = band_lookup(b.table("lineitem"), card, "l_extendedprice", "low", "high", take, "band")
    return found.select(
        "l_orderkey", "l_linenumber", "l_extendedprice",
        F.col("band.low").alias("low"), F.col("band.high").alias("high"),
        F.col("band.l_suppkey").alias("supplier"),
    )


def _keyword_indexes_many(b: Bench) -> DataFrame:
    """Parts as shipments whose ids repeat or are missing; every third order number is a keyword,
    some without an id."""
    number, key = F.col("p_partkey"), F.col("o_orderkey")
    words = b.table("orders").where(key % 3 == 0).select(
        F.when(key % 50 > 0, key.cast("int")).alias("id"),
        key.cast("string").alias("keyword"),
        (key % 7 + 0.5).alias("difficulty_idx"),
        F.when(key % 4 > 0, key % 5 * 0.25).alias("fragile_idx"),
    )
    kept = F.struct(F.concat(F.lit("size "), (number * 611).cast("string")).alias("title"))
    empty = F.struct(F.lit(None).cast("string").alias("title"))
    parts = b.table("part").select(
        F.when(number % 10 > 0, number % 700).alias("packagematchid"),
        F.concat("p_name", F.lit(" "), (number % 900 * 37).cast("string")).alias("title"),
        F.array(kept, F.when(number % 3 > 0, kept).otherwise(empty)).alias("slots"),
        (1 + number % 2).cast("int").alias("totalitems"),
    )
    found = keywords.keyword_indexes(parts, Card(words, b.limits), passes=1)
    names = [f"{part}{kind}" for part in ("title", "item1", "item2") for kind in ("keyword", "diff", "frag")]
    return found.select("packagematchid", "title", *names)


def _size_rating_seeds(b: Bench) -> DataFrame:
    """The seeds merged into ratings as large as the part table, stored a month ago."""
    then = F.lit("2024-01-01").cast("timestamp_ntz")
    rated = b.table("part").select(
        (F.col("p_partkey") - 1).cast("int").alias("bb_rating"),
        F.col("p_retailprice").alias("bb_surcharged"),
        F.lit(0.5).alias("bb_surchargep"),
        then.alias("datecreatedutc"),
        then.alias("dateupdatedutc"),
    )
    merged = upsert(
        rated, size_ratings(b.spark), ["bb_rating"], SIZE_RATING_VALUES, datetime(2024, 2, 1)
    )
    version = b.stored("size_ratings")
    full_refresh(merged, version)
    return extract(b.spark, version)


def _backtest_job(b: Bench) -> DataFrame:
    """Facts and cards written, loaded by the job, priced, saved and read back."""
    root = shared_folder(b.spark, "job")
    for name in FACT_DDL:
        getattr(b.facts, name).write.parquet(f"{root}/facts/{name}")
    for name in CARD_DDL:
        b.cards[name].df.write.parquet(f"{root}/cards/{name}")
    saved, _ = backtest.run(b.spark, f"{root}/facts", f"{root}/cards", f"{root}/out", b.params)
    return _of_shipments(
        saved, "rate_engine_prediction", "matchprice", "toohigh", "toolow", "good"
    )


QUERIES: dict[str, Callable[[Bench], DataFrame]] = {
    "package_quantity": _package_quantity,
    "item_slots": _item_slots,
    "item_measures": _item_measures,
    "shipment_base": _shipment_base,
    "shipment_flags": _shipment_flags,
    "size_rating": _size_rating,
    "price_per_mile_outlier": _price_per_mile_outlier,
    "fuel_weekly": _fuel_weekly,
    "fuel_two_weeks_ago": _fuel_two_weeks_ago,
    "keyword_indexes": _keyword_indexes,
    "difficulty_index": _difficulty_index,
    "msa_resolution": _msa_resolution,
    "ppm_base_rate": _ppm_base_rate,
    "lane_rate_override": _lane_rate_override,
    "short_haul_base_rate": _short_haul_base_rate,
    "fuel_surcharge": _surcharge(surcharges.fuel_surcharge, "fuel_surcharge"),
    "zip_tier_surcharge": _surcharge(surcharges.zip_tier_surcharge, "zipcode_tier_surcharge"),
    "service_level_surcharge": _surcharge(
        surcharges.service_level_surcharge, "servicelevel_surcharge"
    ),
    "state_surcharge": _surcharge(
        surcharges.state_surcharge, "stateo_surcharge", "stated_surcharge"
    ),
    "state_route_surcharge": _surcharge(
        surcharges.state_route_surcharge, "state_route_surcharge"
    ),
    "congested_surcharge": _surcharge(
        surcharges.congested_surcharge, "congestedo_surcharge", "congestedd_surcharge"
    ),
    "weight_surcharge": _surcharge(
        surcharges.weight_surcharge, "totalweight", "weight_surcharge"
    ),
    "size_surcharge": _size_surcharge,
    "difficulty_surcharge": _difficulty_surcharge,
    "mileage_surcharge": _surcharge(surcharges.mileage_surcharge, "mileage_surcharge"),
    "msa_surcharge": _surcharge(surcharges.msa_surcharge, "omsa_surcharge", "dmsa_surcharge"),
    "expedited_surcharge": _surcharge(
        surcharges.expedited_surcharge, "expedited_pu_surcharge", "expedited_del_surcharge"
    ),
    "multi_item_surcharge": _surcharge(
        surcharges.multi_item_surcharge, "totalitems", "multi_item_surcharge"
    ),
    "near_msa_surcharge": _surcharge(
        surcharges.near_msa_surcharge, "close_to_omsa_surcharge", "close_to_dmsa_surcharge"
    ),
    "extra_quantity_surcharge": _extra_quantity_surcharge,
    "priced_shipments": _priced_shipments,
    "evaluation_flags": _evaluation_flags,
    "evaluation_summary": _evaluation_summary,
    "fuel_feed_pivot": _fuel_feed_pivot,
    "append_load": _append_load,
    "full_refresh": _full_refresh,
    "fan_out_load": _fan_out_load,
    "append_ledger": _append_ledger,
    "refresh_versioned": _refresh_versioned,
    "fan_out_resume": _fan_out_resume,
    "ratecard_upsert": _ratecard_upsert,
    "equi_lookup": _equi_lookup,
    "band_lookup": _band_lookup,
    "band_lookup_many": _band_lookup_many,
    "band_lookup_open": _band_lookup_open,
    "keyword_indexes_many": _keyword_indexes_many,
    "size_rating_seeds": _size_rating_seeds,
    "backtest_job": _backtest_job,
}


def query(name: str, limits: Limits | None = None) -> Callable[[SparkSession, str], DataFrame]:
    """A registered query as (spark, sf_dir) -> DataFrame."""
    return lambda spark, sf_dir: QUERIES[name](Bench(spark, sf_dir, limits))

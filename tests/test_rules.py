"""Hand-computed rows at the edges of the pricing rules."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from haulrate import Params
from haulrate.operators import base_rate, evaluate, fuel
from haulrate.operators import surcharges as sur
from haulrate.sources.cards import Cards
from haulrate.sources.schemas import schema_of


def cards(spark, limits, **rows):
    def frame(name):
        schema = schema_of(name)
        numbered = [{"id": i, **row} for i, row in enumerate(rows.get(name, []), 1)]
        data = [tuple(row.get(field.name) for field in schema) for row in numbered]
        return spark.createDataFrame(data, schema)

    return Cards(frame, limits)


def frame(spark, schema, *rows):
    """Rows with an id and a base rate of 100."""
    df = spark.createDataFrame([(i, *row) for i, row in enumerate(rows)], f"packagematchid bigint, {schema}")
    return df if "base_rate" in df.columns else df.withColumn("base_rate", F.lit(100.0))


def column(df, name):
    return [row[name] for row in df.orderBy("packagematchid").collect()]


def test_short_haul_fills_only_missing_base_rates(spark):
    df = frame(
        spark,
        "mileage double, base_rate double, ppm double",
        (0.0, None, None), (10.0, None, None), (10.1, None, None), (20.0, None, None),
        (25.0, None, None), (250.0, None, None), (250.1, None, None), (None, None, None),
        (5.0, 7.0, 1.4),
    )
    out = base_rate.short_haul(df)
    assert column(out, "base_rate") == [100.0, 100.0, 115.0, 115.0, 110.0, 222.5, None, None, 7.0]
    assert column(out, "ppm") == [0.0] * 6 + [None, None, 1.4]


def test_msa_is_the_own_one_or_the_closest_in_whole_miles(spark, limits):
    c = cards(
        spark,
        limits,
        zipcodes=[
            {"zipcode": "00001", "msa_name": "Own", "primaryrecord": "p"},
            {"zipcode": "00001", "msa_name": "Later", "primaryrecord": "P"},
            {"zipcode": "00002", "msa_name": "  ", "primaryrecord": "P"},
            {"zipcode": "00003", "msa_name": "Secondary", "primaryrecord": "S"},
            {"zipcode": "00004", "msa_name": None, "primaryrecord": "P"},
        ],
        zips_with_closest_msa=[
            {"zipcode": "00001", "msa_name": "Near", "distance": 5.0},
            {"zipcode": "00002", "msa_name": "Near", "distance": 0.4},
            {"zipcode": "00003", "msa_name": "Near", "distance": 1.9},
        ],
    )
    zips = [("00001-9999",), ("00002",), ("00003",), ("00004",), ("00005",), (None,)]
    df = frame(spark, "originzip string", *zips)
    out = base_rate.resolve_msa(df, base_rate.msa_by_zip(c), "origin")
    assert column(out, "omsa") == ["Own", "Near", "Near", None, None, None]
    assert column(out, "omsa_miles") == [0, 0, 1, None, None, None]


def test_lane_rate_needs_both_ends_inside_their_areas(spark, limits):
    lane = [{"omsa": "A", "dmsa": "B", "maxmiles": 5, "rate": 50.0}]
    c = cards(spark, limits, msa_to_msa_rates_by_mileage=lane)
    df = frame(
        spark,
        "omsa string, dmsa string, omsa_miles int, dmsa_miles int, mileage double, "
        "base_rate double, ppm double",
        ("A", "B", 0, 0, 0.5, 1.0, 2.0), ("A", "B", 0, 1, 0.5, 1.0, 2.0),
        ("A", "B", 0, 0, 5.0, None, None), ("B", "A", 0, 0, 5.0, 1.0, 2.0),
    )
    out = base_rate.lane_rate_override(df, c)
    assert column(out, "base_rate") == [50.0, 1.0, 50.0, 1.0]
    assert column(out, "ppm") == [50.0, 2.0, 10.0, 2.0]


def test_fuel_counts_started_steps(spark, limits):
    band = {"low": 0.0, "high": 500.0, "fuel_baseline": 2.5, "fuel_tiers": 0.1, "fuel_surcharge": 0.01}
    c = cards(spark, limits, fuel_surcharge_v6=[band])
    given = [(500.0, Decimal("3.1")), (500.1, Decimal("3.1")), (1.0, Decimal("2.5")), (1.0, None)]
    df = frame(spark, "mileage double, gas_2wa decimal(19,4)", *given)
    found = column(sur.fuel_surcharge(df, c), "fuel_surcharge")
    assert found == pytest.approx([7.0, 0.0, 0.0, 0.0])  # (3.1 - 2.5) / 0.1 is just above 6


def test_state_amounts_apply_beyond_the_minimum_miles(spark, limits):
    rows = [("A", 100, 25.0, 0.5), ("B", 0, 0.0, 0.5), ("C", 0, None, 0.5), ("D", None, 9.0, 0.0)]
    names = ("state", "minmiles", "stateo_surcharged", "stateo_surchargep")
    c = cards(spark, limits, stateo_v6=[dict(zip(names, row)) for row in rows])
    df = frame(
        spark,
        "originstate string, destinationstate string, mileage double",
        *[(st, None, m) for st, m in (("a", 100.0), ("A ", 100.1), ("B", 1.0), ("C", 1.0), ("D", 1.0), ("X", 1.0))],
    )
    out = sur.state_surcharge(df, c)
    assert column(out, "stateo_surcharge") == [0.0, 25.0, 50.0, 50.0, 0.0, 0.0]
    assert column(out, "stated_surcharge") == [0.0] * 6


def test_congestion_matches_whole_zips_and_spares_near_destinations(spark, limits):
    c = cards(
        spark,
        limits,
        congested_zipcodes=[{"zipcode": "10000"}, {"zipcode": "10000"}, {"zipcode": "20000"}],
        congestedo_v6=[{"congested_surcharge": 35.0}],
        congestedd_v6=[{"congested_surcharge": 45.0}],
    )
    df = frame(
        spark,
        "originzip string, destinationzip string, mileage double",
        ("10000", "20000", 50.0), ("10000", "20000", 50.1), ("10000-1234", "20000", 1.0),
        ("30000", "30000", 1.0), (None, None, 1.0),
    )
    out = sur.congested_surcharge(df, c)
    assert column(out, "congestedo_surcharge") == [35.0, 35.0, 0.0, 0.0, 0.0]
    assert column(out, "congestedd_surcharge") == [0.0, 45.0, 45.0, 0.0, 0.0]
    none = sur.congested_surcharge(df, cards(spark, limits, congested_zipcodes=[{"zipcode": "10000"}]))
    assert column(none, "congestedo_surcharge") == [0.0] * 5


@pytest.mark.parametrize(
    "percent, dollars, expected",
    [
        (0.04, 9.0, [0.0, 16.0, 0.0]),  # steps count from the included weight of 200
        (0.0, 2.0, [0.0, 6.0, 0.0]),  # dollars count from the minimum weight
        (0.0, 0.0, [0.0, 0.0, 0.0]),
        (None, None, [0.0, 0.0, 0.0]),
    ],
)
def test_weight_takes_percent_before_dollars(spark, limits, percent, dollars, expected):
    rule = {"minweight": 250, "surcharged": dollars, "surchargep": percent}
    df = frame(spark, "totalweight double", (250.0,), (400.0,), (None,))
    out = sur.weight_surcharge(df, cards(spark, limits, weight_v6=[rule]))
    assert column(out, "weight_surcharge") == pytest.approx(expected)


def test_a_single_row_card_may_not_have_two(spark, limits):
    c = cards(spark, limits, weight_v6=[{"minweight": 1}, {"minweight": 2}])
    with pytest.raises(ValueError, match="at most one row"):
        sur.weight_surcharge(frame(spark, "totalweight double", (1.0,)), c)


def test_expedited_counts_midnights_and_takes_percent_first(spark, limits):
    names = ("pu_days_min", "pu_days_max", "surchargep", "surcharged")
    pu = [(0, 0, 0.1, 99.0), (1, 1, 0.0, 25.0), (2, 2, None, None)]
    c = cards(spark, limits, expedited_pu=[dict(zip(names, row)) for row in pu])
    late, next_day = datetime(2023, 5, 1, 23, 59), datetime(2023, 5, 2, 0, 1)
    df = frame(
        spark,
        "datecreated timestamp_ntz, listing_latest_pickup timestamp_ntz, "
        "listing_latest_delivery timestamp_ntz",
        (late, late, None), (late, next_day, None), (late, datetime(2023, 5, 3), None),
        (late, datetime(2023, 5, 9), None), (late, None, None),
    )
    out = sur.expedited_surcharge(df, c)
    assert column(out, "expedited_pu_surcharge") == pytest.approx([10.0, 25.0, 0.0, 0.0, 0.0])
    assert column(out, "expedited_del_surcharge") == [0.0] * 5


def test_near_area_amounts_need_miles(spark, limits):
    bands = [{"minmiles": 0.0, "maxmiles": 20.0, "surcharged": 15.0}]
    df = frame(spark, "omsa_miles int, dmsa_miles int", (0, 1), (20, 21), (None, None))
    out = sur.near_msa_surcharge(df, cards(spark, limits, miles_to_msa_surcharge=bands))
    assert column(out, "close_to_omsa_surcharge") == [0.0, 15.0, 0.0]
    assert column(out, "close_to_dmsa_surcharge") == [15.0, 0.0, 0.0]


def test_extra_quantity_counts_started_groups_of_a_single_keyword(spark, limits):
    names = ("keyword", "singleitemqty", "addtl_percent")
    rows = [("Ring", 2.0, 0.1), ("zero", 0.0, 0.1), ("none", None, 0.1)]
    c = cards(spark, limits, furniture_indexes=[dict(zip(names, row)) for row in rows])
    df = spark.createDataFrame(
        [(0, "ring", "2"), (1, "ring", "3"), (2, "ring", "5"), (3, "ring / old", "5"), (4, None, "5"),
         (5, "zero", "1"), (6, "none", "1")],
        "packagematchid bigint, item1keyword string, units string",
    )
    item = F.struct(F.col("units").alias("unitcount"))
    df = df.select("*", F.lit(100.0).alias("base_rate"), F.array(item).alias("slots"))
    out = sur.extra_quantity_surcharge(df, c["furniture_indexes"])
    assert column(out, "addtl_qty_surcharge") == [0.0, 10.0, 20.0, None, None, None, None]


def test_a_repeated_week_counts_with_its_latest_price(spark, limits):
    days = [date(2023, 5, d) for d in range(1, 29)]
    ends = {d: date(2023, 5, 6 + 7 * ((d.day - 1) // 7)) for d in days}
    prices = [(datetime(2023, 5, 1), "3.0"), (datetime(2023, 5, 2), "3.5"), (datetime(2023, 5, 2), "3.7")]
    c = cards(
        spark,
        limits,
        calendar=[{"day_date": d, "week_end_date": ends[d]} for d in days],
        fuelprices=[{"date": d, "gas": Decimal(g)} for d, g in prices],
    )
    p = Params(partner="", as_of=date(2023, 5, 7))
    assert sorted(float(row.gas) for row in fuel.fuel_weekly(c, p).collect()) == [3.0, 3.5, 3.7]
    df = frame(spark, "d_datecreated date", (date(2023, 5, 15),), (date(2023, 5, 8),), (date(2024, 1, 1),))
    out = fuel.with_lagged_fuel(df, c, p).orderBy("packagematchid").collect()
    assert [(row.packagematchid, row.gas_2wa and float(row.gas_2wa)) for row in out] == [
        (0, 3.7),
        (1, None),
    ]
    early = Params(partner="", as_of=date(2023, 5, 6))
    assert fuel.fuel_weekly(c, early).count() == 0  # the week is not over


def test_verdicts(spark, limits):
    rows = [("TOO high ", 0.25, 50.0), ("too low", 0.25, 0.0)]
    c = cards(spark, limits, evaluation=[dict(zip(("rating", "pct", "amount"), r)) for r in rows])
    df = frame(
        spark,
        "rate_engine_prediction double, matchprice double",
        (125.0, 100.0), (125.1, 100.0), (1051.0, 1000.0), (75.0, 100.0), (74.9, 100.0),
        (900.0, 1000.0), (5.0, None),
    )
    out = evaluate.evaluation_flags(df, c)
    high, low, good = (column(out, name) for name in ("toohigh", "toolow", "good"))
    assert list(zip(high, low, good)) == [
        (0, 0, 1), (1, 0, 0), (1, 0, 0), (0, 0, 1), (0, 1, 0), (0, 0, 1), (0, 0, 1),
    ]
    counts = {r.evaluation: r.shipments for r in evaluate.evaluation_summary(out).collect()}
    assert counts == {"Too high": 2, "Too Low": 1, "Good": 4}


def test_total_counts_null_terms_as_zero(spark):
    df = spark.range(1).select(
        *[F.lit(1.0 if i % 2 else None).cast("double").alias(t) for i, t in enumerate(evaluate.TERMS) if t != "fixedcost"]
    )
    row = evaluate.total(df).collect()[0]
    assert row.rate_engine_prediction == 10.0
    assert row.fixedcost == 0

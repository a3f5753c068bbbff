"""Rate-card rows for the test runs, as set out in FIXTURES.md."""

from __future__ import annotations

from datetime import date, datetime, timedelta
from decimal import Decimal

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema

from haulrate.params import Limits
from haulrate.sources.cards import Cards
from haulrate.sources.schemas import schema_of

ZIPS, AREAS = range(150), range(8)
FIRST_DAY, LAST_DAY = date(1994, 12, 1), date(2001, 12, 31)


def _zip(n: int) -> str:
    return f"{n:05d}"


def _msa(k: int) -> str:
    return f"MSA {k}"


def _abbreviation(i: int) -> str:
    return "AK" if i == 0 else "S" + chr(64 + i)


def _states(mark: str) -> list[dict]:
    return [
        {
            "state": f"State{i}",
            "minmiles": 100 * (i % 4),
            f"state{mark}_surcharged": 25.0 if i % 3 == 0 else 0.0,
            f"state{mark}_surchargep": 0.01 * i,
        }
        for i in range(1, 13)
    ]


def _days() -> list[date]:
    return [FIRST_DAY + timedelta(days=i) for i in range((LAST_DAY - FIRST_DAY).days + 1)]


def _fuel_prices() -> list[dict]:
    rows = []
    for day in _days():
        if day.weekday() == 0:
            gas = Decimal("2.3") + Decimal("0.15") * (day.isocalendar().week % 9)
            when = datetime(day.year, day.month, day.day)
            rows.append({"date": when, "gas": gas, "diesel": gas + Decimal("0.6")})
    return rows


def _lane_rates() -> list[dict]:
    rows = []
    for o in AREAS:
        for d in AREAS:
            if (o + d) % 2 == 1:
                for k in range(1, 69):
                    for high, flat in ((50 * k, 80.0), (50 * k + 10, 75.0)):
                        lane = {"omsa": _msa(o), "dmsa": _msa(d)}
                        rows.append({**lane, "maxmiles": high, "rate": flat + 20 * k})
    return rows


def _rows(names: str, *values: tuple) -> list[dict]:
    return [dict(zip(names.split(), row)) for row in values]


def card_rows() -> dict[str, list[dict]]:
    """Rows of every card; ``id`` is added in the order given here."""
    area_amounts = _rows(
        "msa surchargep surcharged",
        ("MSA 1", 0.05, 0.0),
        ("MSA 3", 0.0, 20.0),
        ("MSA 5", 0.02, 0.0),
    )
    primary = [
        {"zipcode": _zip(n), "msa_name": _msa(n % 8) if n % 3 else "", "primaryrecord": "P"}
        for n in ZIPS
    ]
    secondary = [
        {"zipcode": _zip(n), "msa_name": "MSA X", "primaryrecord": "S"} for n in ZIPS if n % 10 == 0
    ]
    return {
        "furniture_indexes": _rows(
            "keyword difficulty_idx fragile_idx singleitemqty addtl_percent",
            ("ring", 1.5, 1.0, 2.0, 0.1),
            ("small ring", 2.0, 1.0, 2.0, 0.2),
            ("old", 1.0, 0.0, 2.0, 0.1),
            ("GEAR", 2.7, 2.0, 2.0, 0.15),
            ("gizmo", 3.0, 1.0, 3.0, 0.1),
            ("bolt", None, None, 2.0, 0.1),
            ("", 9.0, 9.0, 1.0, 1.0),
        ),
        "zipcodes": primary + secondary,
        "zips_with_closest_msa": [
            {"zipcode": _zip(n), "msa_name": _msa(n % 8), "distance": n % 57 + 0.4}
            for n in ZIPS
            if n % 3 == 0 and n % 30 != 0
        ],
        "ppm_master": [
            {"o_msa": _msa(o), "d_msa": _msa(d), "ppm": 0.30 + 0.05 * ((3 * o + d) % 6)}
            for o in AREAS
            for d in AREAS
            if (o + 2 * d) % 5 != 0
        ],
        "msa_to_msa_rates_by_mileage": _lane_rates(),
        "fuel_surcharge_v6": _rows(
            "low high fuel_baseline fuel_tiers fuel_surcharge",
            (0.0, 500.0, 2.5, 0.1, 0.01),
            (501.0, 1500.0, 2.5, 0.1, 0.008),
            (1501.0, 4000.0, 2.5, 0.1, 0.006),
        ),
        "fuelprices": _fuel_prices(),
        "calendar": [
            {"day_date": d, "week_end_date": d + timedelta(days=(5 - d.weekday()) % 7)}
            for d in _days()
        ],
        "zipcode_tier_assignments": [
            {"zip": _zip(n), "dtier": "ABCD"[n % 4]} for n in ZIPS if n % 5 != 0
        ],
        "zipcode_tiers_4_v6": _rows(
            "tier surcharged surchargep", ("A", 0.0, 0.0), ("B", 5.0, 0.02), ("C", 10.0, 0.05)
        ),
        "servicelevel_v6": _rows(
            "partner sl_surchargep", ("FURNITURE", 0.05), ("HOUSEHOLD", 0.08)
        ),
        "stateo_v6": _states("o"),
        "stated_v6": _states("d"),
        "state_route": [
            {
                "o_st": _abbreviation(i),
                "d_st": _abbreviation(j),
                "surchargep": 0.02,
                "surcharged": 15.0 if i % 2 == 0 else 0.0,
            }
            for i in range(25)
            for j in range(25)
            if (i + j) % 6 == 0
        ],
        "stateabb": [
            {"state": f"State{i}" if i else "Alaska", "stateabbr": _abbreviation(i)}
            for i in range(25)
        ],
        "congested_zipcodes": [{"zipcode": _zip(n)} for n in ZIPS if n % 2 == 0],
        "congestedo_v6": _rows("congested_surcharge", (35.0,)),
        "congestedd_v6": _rows("congested_surcharge", (45.0,)),
        "weight_v6": _rows("minweight surcharged surchargep", (200, 0.0, 0.04)),
        "bb_v6": _rows(
            "bb_rating bb_surcharged bb_surchargep", (0, 0.0, 0.0), (1, 0.0, 0.1), (2, 0.0, 0.18)
        ),
        "difficulty_v6": _rows(
            "diffidx surcharged surchargep", (0.0, 0.0, 0.0), (1.0, 10.0, 0.03), (2.0, 20.0, 0.06)
        ),
        "mileage_surcharge_v6": _rows(
            "minmiles maxmiles surchargep",
            (0, 250, 0.0),
            (251, 1000, 0.02),
            (1000, 2000, 0.03),
            (2001, 4000, 0.04),
        ),
        "omsa_surcharge": area_amounts,
        "dmsa_surcharge": area_amounts,
        "expedited_pu": _rows(
            "pu_days_min pu_days_max surchargep surcharged",
            (0, 2, 0.1, None),
            (3, 5, 0.0, 25.0),
            (5, 7, 0.0, 15.0),
        ),
        "expedited_del": _rows(
            "del_days_min del_days_max surchargep surcharged",
            (0, 5, 0.08, None),
            (6, 10, 0.0, 20.0),
        ),
        "multi_item_discount_v6": _rows("discount", (0.6,)),
        "miles_to_msa_surcharge": _rows(
            "minmiles maxmiles surcharged", (1.0, 20.0, 15.0), (20.0, 40.0, 30.0)
        ),
        "evaluation": _rows(
            "rating pct amount", ("Too High", 0.15, 50.0), ("Too Low", 0.15, 50.0)
        ),
    }


def frame(spark: SparkSession, name: str, rows: list[dict]) -> DataFrame:
    """Rows as a table with the card's declared schema."""
    schema = schema_of(name)
    numbered = [{"id": i, **row} for i, row in enumerate(rows, 1)]
    data = [{field.name: row.get(field.name) for field in schema} for row in numbered]
    return spark.createDataFrame(pa.Table.from_pylist(data, to_arrow_schema(schema)))


def load(spark: SparkSession, limits: Limits | None = None) -> Cards:
    rows = card_rows()
    return Cards(lambda name: frame(spark, name, rows[name]), limits)

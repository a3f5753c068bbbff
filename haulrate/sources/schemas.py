"""Declared columns of every table the engine reads.

Each entry is a Spark DDL string. ``id`` is the load order of a card's rows and breaks ties.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Table and column names of the rate cards.
CARD_DDL = {
    "furniture_indexes": "keyword string, difficulty_idx double, fragile_idx double, "
    "singleitemqty double, addtl_percent double, id int NOT NULL",
    "zipcodes": "zipcode string NOT NULL, latitude decimal(12,6), longitude decimal(12,6), "
    "state string, statefullname string, areacode string, city string, msa_name string, "
    "cbsa_name string, pmsa_name string, region string, division string, "
    "primaryrecord string, id int",
    "zips_with_closest_msa": "zipcode string, msa_name string, distance double, id int",
    "ppm_master": "o_msa string, d_msa string, ppm double, avgmiles int, minmiles int, "
    "maxmiles int, listings int, id int",
    "msa_to_msa_rates_by_mileage": "omsa string, dmsa string, maxmiles int, rate double, id int",
    "fuel_surcharge_v6": "low double, high double, fuel_baseline double, fuel_tiers double, "
    "fuel_surcharge double, id int",
    "fuelprices": "date timestamp_ntz, gas decimal(19,4), diesel decimal(19,4), id int",
    "calendar": "mmdd string, day_date date, day_week double, year_week string, "
    "week_start_date date, week_end_date date, month_start_date date, month_end_date date, "
    "day_year double, day_month string, day_quarter string, quarter_start_date date, "
    "quarter_end_date date, days_in_month double, days_in_quarter double, weekday string, "
    "weekday_weekend string, ly_date_adjusted date, id int",
    "zipcode_tier_assignments": "zip string, otier string, dtier string, id int",
    "zipcode_tiers_4_v6": "tier string, surcharged double, surchargep double, id int",
    "servicelevel_v6": "partner string, sl_surchargep double, id int",
    "stateo_v6": "state string, minmiles int, stateo_surcharged double, "
    "stateo_surchargep double, id int",
    "stated_v6": "state string, minmiles int, stated_surcharged double, "
    "stated_surchargep double, id int",
    "state_route": "o_st string, d_st string, surchargep double, surcharged double, id int",
    "stateabb": "state string, stateabbr string, id int",
    "congested_zipcodes": "zipcode string, id int",
    "congestedo_v6": "congested_surcharge double, id int",
    "congestedd_v6": "congested_surcharge double, id int",
    "weight_v6": "minweight int, surcharged double, surchargep double, id int",
    "bb_v6": "bb_rating int NOT NULL, bb_surcharged double, bb_surchargep double, "
    "datecreatedutc timestamp, dateupdatedutc timestamp",
    "difficulty_v6": "diffidx double, surcharged double, surchargep double, id int",
    "mileage_surcharge_v6": "minmiles int, maxmiles int, surchargep double, id int",
    "omsa_surcharge": "msa string, surchargep double, surcharged double, id int",
    "dmsa_surcharge": "msa string, surchargep double, surcharged double, id int",
    "expedited_pu": "pu_days_min int, pu_days_max int, surchargep double, "
    "surcharged double, id int",
    "expedited_del": "del_days_min int, del_days_max int, surchargep double, "
    "surcharged double, id int",
    "multi_item_discount_v6": "discount double, id int",
    "miles_to_msa_surcharge": "minmiles double, maxmiles double, surcharged double, id int",
    "evaluation": "rating string, pct double, amount double, id int",
}

# Declared, but read by no pricing rule: a card may come without these columns.
UNREAD = {
    "zipcodes": "latitude longitude statefullname areacode city cbsa_name pmsa_name region "
    "division",
    "ppm_master": "avgmiles listings",
    "fuelprices": "diesel",
    "calendar": "mmdd day_week year_week week_start_date month_start_date month_end_date "
    "day_year day_month day_quarter quarter_start_date quarter_end_date days_in_month "
    "days_in_quarter weekday weekday_weekend ly_date_adjusted",
    "zipcode_tier_assignments": "otier",
    "bb_v6": "datecreatedutc dateupdatedutc",
}

# Declared, but read by no pricing rule.
SPARE_CARD_DDL = {
    "rural_v6": "rural_rating int, rural_surcharged double, rural_surchargep double, id int",
    "multi_item_markup": "totalvolume_min double, totalvolume_max double, "
    "markup_p double, id int",
    "prediction_adjustment_v6": "adjustment_easy double, adjustment_noteasy double",
}

# Fact columns the pricing rules read.
FACT_DDL = {
    "listing": "packageid bigint NOT NULL, datecreated timestamp_ntz, d_datecreated date, "
    "title string, category string, origincity string, originstate string, "
    "originzip string, origincountryid int, destinationcity string, "
    "destinationstate string, destinationzip string, destinationcountryid int, "
    "mileage double, timeframelatestpickup timestamp_ntz, "
    "timeframelatestdelivery timestamp_ntz, totalweight double, items int, bids int, "
    "nm int, gm int, nypchanges string, originalnypamount double, forecastsegment string",
    "bids": "packageid bigint, packagematchid bigint, userid bigint, netmatch int, "
    "dateaccepted timestamp_ntz, bidvolumeusd double",
    "items": "packageid bigint, rank int, title string, unitcount string, length string, "
    "height string, width string, weight string",
    "tracking": "packagematchid bigint, delivereddate timestamp_ntz",
    "revenue": "packagematchid bigint, nmr_post double",
    "users": "userid bigint, username string",
    "rate_comparison": "packageid bigint, rate_table_nyp_amount double",
}


def schema_of(name: str) -> T.StructType:
    """The declared schema of a card or fact table."""
    for group in (CARD_DDL, SPARE_CARD_DDL, FACT_DDL):
        if name in group:
            return T.StructType.fromDDL(group[name])
    raise KeyError(f"no schema is declared for table {name!r}")

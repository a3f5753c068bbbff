"""Oracle SQL of every registered query, for DuckDB over the test tables.

Written as plain joins, CASE and row_number() tie-breaks, so that it shares no idiom with the
engine. Named parts are put in front of a statement only where it uses them.
"""

from __future__ import annotations

import re

# Fact tables and cards, as set out in FIXTURES.md.
FACTS = {
    "line_items": """
        select l.*, p.p_name, p.p_size, row_number() over (
            partition by l_orderkey
            order by l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice,
                     l_quantity, l_discount, l_tax) as rank
        from lineitem l join part p on l_partkey = p_partkey""",
    "items": """
        select l_orderkey as packageid, rank, p_name as title,
               cast(1 + cast(trunc(l_quantity) as integer) % 4 as varchar) as unitcount,
               cast(20 + 2 * p_size as varchar) as length,
               cast(10 + p_size as varchar) as height,
               cast(15 + p_size as varchar) as width,
               cast(3 * l_quantity as varchar) as weight
        from line_items""",
    "listing": """
        select o_orderkey as packageid, o_orderdate as datecreated,
               cast(o_orderdate as date) as d_datecreated,
               f.p_name || case when o_orderpriority = '1-URGENT' then ' HV' else '' end
                        || case when o_orderkey % 97 = 0 then ' *comp*' else '' end as title,
               case when o_orderstatus = 'P' then 'Vehicles' else 'Household Goods' end as category,
               'City ' || s_suppkey as origincity,
               case when s_nationkey = 0 then 'Alaska' else 'State' || s_nationkey end
                   as originstate,
               lpad(cast(s_suppkey % 100 as varchar), 5, '0')
                   || case when o_orderkey % 20 = 0 then '-1234' else '' end as originzip,
               case when o_orderkey % 50 = 0 then 2 else 1 end as origincountryid,
               'City ' || c_custkey as destinationcity,
               case when c_nationkey = 0 then 'Alaska' else 'State' || c_nationkey end
                   as destinationstate,
               case when c_custkey % 41 = 40 then '99999'
                    else lpad(cast(c_custkey % 150 as varchar), 5, '0') end as destinationzip,
               1 as destinationcountryid,
               cast((o_orderkey * 37) % 3400 as double) as mileage,
               o_orderdate + to_days(cast(o_orderkey % 12 as integer)) as latest_pickup,
               o_orderdate + to_days(cast(o_orderkey % 25 as integer)) as latest_delivery,
               g.totalweight, g.items,
               cast(o_orderkey % 6 as integer) as bids, cast(o_orderkey % 7 as integer) as nm,
               cast(o_orderkey % 3 as integer) as gm,
               cast(o_orderkey % 5 as integer) as nypchanges,
               o_totalprice / 200 as originalnypamount, c_mktsegment as forecastsegment
        from orders
        join (select l_orderkey, sum(3 * l_quantity) as totalweight,
                     cast(count(*) as integer) as items
              from line_items group by l_orderkey) g on g.l_orderkey = o_orderkey
        join line_items f on f.l_orderkey = o_orderkey and f.rank = 1
        join supplier on s_suppkey = f.l_suppkey
        join customer on c_custkey = o_custkey""",
    "bids": """
        select o_orderkey as packageid, 10 * o_orderkey + copy as packagematchid,
               o_custkey as userid, case when o_orderkey % 11 = 0 then 0 else 1 end as netmatch,
               o_orderdate + interval 3 day as dateaccepted,
               60::double + cast((o_orderkey * 37) % 3400 as double)
                   * (0.15::double + (o_orderkey % 10) * 0.09::double) as bidvolumeusd
        from orders, (values (1), (2)) c(copy)
        where copy = 1 or o_orderkey % 31 = 0""",
    "tracking": """
        select 10 * o_orderkey + copy as packagematchid,
               o_orderdate + interval 10 day as delivereddate
        from orders, (values (1), (2)) c(copy) where copy = 1 or o_orderkey % 31 = 0""",
    "revenue": """
        select packagematchid,
               case when packageid % 4 = 0 then null else bidvolumeusd * 0.1::double end as nmr_post
        from bids""",
    "users": "select c_custkey as userid, c_name as username from customer",
    "rate_comparison": """
        select o_orderkey as packageid, o_totalprice / 210 as rate_table_nyp_amount from orders""",
}

CARDS = {
    "days": """
        select cast(d as date) as d
        from range(timestamp '1994-12-01', timestamp '2002-01-01', interval 1 day) r(d)""",
    "calendar": """
        select d as day_date, d + cast((6 - dayofweek(d)) % 7 as integer) as week_end_date
        from days""",
    "fuelprices": """
        select d as date, cast(2.3 + 0.15 * (week(d) % 9) as decimal(19, 4)) as gas
        from days where dayofweek(d) = 1""",
    "zips": "select n, lpad(cast(n as varchar), 5, '0') as zip from range(150) r(n)",
    "zipcodes": """
        select zip as zipcode, case when n % 3 <> 0 then 'MSA ' || (n % 8) else '' end as msa_name,
               'P' as primaryrecord from zips
        union all select zip, 'MSA X', 'S' from zips where n % 10 = 0""",
    "zips_with_closest_msa": """
        select zip as zipcode, 'MSA ' || (n % 8) as msa_name, (n % 57) + 0.4::double as distance
        from zips where n % 3 = 0 and n % 30 <> 0""",
    "area_pairs": "select o, d from range(8) a(o), range(8) b(d)",
    "ppm_master": """
        select 'MSA ' || o as o_msa, 'MSA ' || d as d_msa,
               0.30::double + 0.05::double * ((3 * o + d) % 6) as ppm
        from area_pairs where (o + 2 * d) % 5 <> 0""",
    "lane_rates": """
        select 'MSA ' || o as omsa, 'MSA ' || d as dmsa, 50 * k + extra as maxmiles,
               flat::double + 20 * k as rate
        from area_pairs, range(1, 69) r(k), (values (0, 80), (10, 75)) v(extra, flat)
        where (o + d) % 2 = 1""",
    "fuel_bands": """
        select low::double as low, high::double as high, rate::double as rate
        from (values (0, 500, .01), (501, 1500, .008), (1501, 4000, .006)) v(low, high, rate)""",
    "tier_assignments": """
        select zip, substring('ABCD', cast(n % 4 as integer) + 1, 1) as dtier
        from zips where n % 5 <> 0""",
    "tiers": """
        select tier, dollars::double as dollars, percent::double as percent
        from (values ('A', 0, 0), ('B', 5, .02), ('C', 10, .05)) v(tier, dollars, percent)""",
    "service_levels": """
        select partner, percent::double as percent
        from (values ('FURNITURE', .05), ('HOUSEHOLD', .08)) v(partner, percent)""",
    "states": """
        select 'State' || i as state, 100 * (i % 4) as minmiles,
               case when i % 3 = 0 then 25::double else 0::double end as dollars,
               0.01::double * i as percent
        from range(1, 13) r(i)""",
    "stateabb": """
        select case when i = 0 then 'Alaska' else 'State' || i end as state,
               case when i = 0 then 'AK' else 'S' || chr(cast(64 + i as integer)) end as abbr, i
        from range(25) r(i)""",
    "state_route": """
        select a.abbr as o_st, b.abbr as d_st, .02::double as percent,
               case when a.i % 2 = 0 then 15::double else 0::double end as dollars
        from stateabb a, stateabb b where (a.i + b.i) % 6 = 0""",
    "congested": "select zip from zips where n % 2 = 0",
    "sizes": """
        select rating, percent::double as percent
        from (values (0, 0), (1, .1), (2, .18)) v(rating, percent)""",
    "difficulties": """
        select idx, dollars::double as dollars, percent::double as percent
        from (values (0, 0, 0), (1, 10, .03), (2, 20, .06)) v(idx, dollars, percent)""",
    "keywords": """
        select id, keyword, idx::double as idx, fragile::double as fragile, q::double as q,
               extra::double as extra
        from (values (1, 'ring', 1.5, 1, 2, .1), (2, 'small ring', 2, 1, 2, .2),
                     (3, 'old', 1, 0, 2, .1), (4, 'GEAR', 2.7, 2, 2, .15),
                     (5, 'gizmo', 3, 1, 3, .1), (6, 'bolt', null, null, 2, .1))
             v(id, keyword, idx, fragile, q, extra)""",
    "mileage_bands": """
        select id, low, high, percent::double as percent
        from (values (1, 0, 250, 0), (2, 251, 1000, .02), (3, 1000, 2000, .03),
                     (4, 2001, 4000, .04)) v(id, low, high, percent)""",
    "area_amounts": """
        select msa, percent::double as percent, dollars::double as dollars
        from (values ('MSA 1', .05, 0), ('MSA 3', 0, 20), ('MSA 5', .02, 0))
             v(msa, percent, dollars)""",
    "expedited": """
        select part, low, high, percent::double as percent, dollars::double as dollars
        from (values ('pu', 0, 2, .1, null), ('pu', 3, 5, 0, 25), ('pu', 5, 7, 0, 15),
                     ('del', 0, 5, .08, null), ('del', 6, 10, 0, 20))
             v(part, low, high, percent, dollars)""",
    "near_bands": """
        select low::double as low, high::double as high, dollars::double as dollars
        from (values (1, 20, 15), (20, 40, 30)) v(low, high, dollars)""",
}

_ITEM_COLUMNS = ", ".join(
    f"i{k}.{name} as item{k}{name}"
    for k in range(1, 6)
    for name in ("title", "unitcount", "length", "height", "width", "weight")
)
_ITEM_JOINS = " ".join(
    f"left join items i{k} on i{k}.packageid = l.packageid and i{k}.rank = {k}"
    for k in range(1, 6)
)


def _measures(k: int) -> str:
    units, length, height, width, weight = (
        f"cast(item{k}{name} as double)"
        for name in ("unitcount", "length", "height", "width", "weight")
    )
    return f"""
        coalesce(cast(item{k}unitcount as integer), 0) as item{k}qty, item{k}title,
        {length} as item{k}length, {height} as item{k}height, {width} as item{k}width,
        {weight} as item{k}weight, {length} * {height} * {width} as item{k}volume,
        {units} * {length} * {height} * {width} as item{k}totalvolume,
        {units} * {weight} as item{k}totalweight"""


_MEASURES = ", ".join(_measures(k) for k in range(1, 6))


def _keyword_part(part: str, text: str, condition: str = "true") -> str:
    """Matches of one text: the first keyword once, every later one three times."""
    return f"""
        select packagematchid, '{part}' as part,
               string_agg(case when place = 1 then keyword
                               else keyword || ' / ' || keyword || ' / ' || keyword end,
                          ' / ' order by id) as words,
               greatest(coalesce(max(idx), 0), 0) as diff,
               greatest(coalesce(max(fragile), 0), 0) as frag
        from (select packagematchid, k.*,
                     row_number() over (partition by packagematchid order by id) as place
              from base join keywords k on instr(lower({text}), lower(keyword)) > 0
              where {condition})
        group by packagematchid"""


_KEYWORD_PARTS = " union all ".join(
    [_keyword_part("title", "title"), _keyword_part("item1", "item1title")]
    + [_keyword_part(f"item{k}", f"item{k}title", f"totalitems >= {k}") for k in range(2, 6)]
)
_PARTS = ["title", "item1", "item2", "item3", "item4", "item5"]
_KEYWORD_COLUMNS = ", ".join(
    f"max(words) filter (part = '{part}') as {part}keyword, "
    f"coalesce(max(diff) filter (part = '{part}'), 0::double) as {part}diff, "
    f"coalesce(max(frag) filter (part = '{part}'), 0::double) as {part}frag"
    for part in _PARTS
)
_KEYWORD_NAMES = ", ".join(f"{part}{kind}" for kind in ("keyword", "diff", "frag") for part in _PARTS)


def _banded(term: str, card: str, value: str, result: str, condition: str = "true") -> str:
    """One band per shipment: the lowest upper bound wins; 0 where no band holds the value."""
    return f"""
        select packagematchid, coalesce_hit as {term} from (
            select r.packagematchid, case when c.low is null then 0 else {result} end as coalesce_hit,
                   row_number() over (partition by r.packagematchid order by c.high) as place
            from rated r left join {card} c
              on {value} between c.low and c.high and {condition})
        where place = 1"""


SHIPMENTS = {
    "fuel_days": """
        select week_end_date, p.date, gas from calendar c join fuelprices p on day_date = p.date
        where day_date >= date '1995-01-01' and week_end_date < date '2002-01-01'""",
    "fuel_week": """
        select week_end_date, gas from (
            select *, row_number() over (partition by week_end_date order by date desc) as place
            from fuel_days) where place = 1""",
    "quantity": """
        select l.packageid, sum(cast(i.unitcount as double)) as qty
        from listing l
        join bids b on l.packageid = b.packageid and b.netmatch > 0
        join items i on l.packageid = i.packageid
        where origincountryid = 1 and destinationcountryid = 1
          and not (lower(originstate) = 'alaska' and lower(destinationstate) = 'alaska')
          and lower(category) = 'household goods' and nm > 0
        group by l.packageid""",
    "slots": f"""
        select l.packageid, {_ITEM_COLUMNS}
        from (select distinct packageid from items) l {_ITEM_JOINS}""",
    "base": f"""
        select b.packagematchid, l.*, l.items as totalitems, q.qty as totalqty, {_ITEM_COLUMNS},
               sa.abbr as originst, sd.abbr as destinationst, u.username as carrier,
               b.dateaccepted, b.bidvolumeusd as matchprice, r.nmr_post,
               y.rate_table_nyp_amount as old_prediction, c.week_end_date,
               cast(fp.gas as double) as gas_2wa
        from listing l
        join bids b on l.packageid = b.packageid and b.netmatch > 0
        {_ITEM_JOINS}
        left join quantity q on q.packageid = l.packageid
        join tracking t on b.packagematchid = t.packagematchid
        join revenue r on b.packagematchid = r.packagematchid
        left join stateabb sa on l.originstate = sa.state
        left join stateabb sd on l.destinationstate = sd.state
        join users u on b.userid = u.userid
        join rate_comparison y on l.packageid = y.packageid
        join calendar c on c.day_date = l.d_datecreated
        left join fuel_week fp on fp.week_end_date = c.week_end_date - 14
        where lower(forecastsegment) = 'furniture'
          and not (lower(originstate) = 'alaska' and lower(destinationstate) = 'alaska')
          and l.title not like '%*comp%'
          and cast(t.delivereddate as date) between date '1996-01-01' and date '2001-12-31'
          and cast(datecreated as date) >= date '1996-01-01'""",
    "flags": """
        select packagematchid, case when gm > 1 then 1 else 0 end as rematched,
               case when lower(title) like '%hv%' then 1 else 0 end as highvalue,
               totalitems as multi_item, coalesce(dtier, '') as zipcode_tier,
               matchprice - coalesce(nmr_post, 0) as amount_to_carrier
        from base left join tier_assignments on substring(destinationzip, 1, 5) = zip""",
    "rating": """
        select packagematchid, totalweight,
               case when totalweight > 400 then 2
                    when totalweight > 200 or cast(item1length as double) > 84
                         or cast(item1height as double) > 84 or cast(item1width as double) > 84
                    then 1 else 0 end as bb
        from base""",
    "outlier": """
        select packagematchid, mileage, matchprice,
               case when (mileage > 250 and mileage <= 500 and (ppm < .534 or ppm > 1.14))
                      or (mileage > 500 and mileage <= 1000 and (ppm < .32 or ppm > .685))
                      or (mileage > 1000 and mileage <= 1500 and (ppm < .237 or ppm > .41))
                      or (mileage > 1500 and mileage <= 2000 and (ppm < .193 or ppm > .356))
                      or (mileage > 2000 and mileage <= 2500 and (ppm < .168 or ppm > .295))
                      or (mileage > 2500 and mileage <= 3000 and (ppm < .14 or ppm > .24))
                      or (mileage > 3000 and (ppm < .136 or ppm > .258))
                    then 1 else 0 end as match_price_out_of_range
        from (select *, case when mileage <> 0 then matchprice / mileage end as ppm from base)""",
    "keyword_parts": _KEYWORD_PARTS,
    "keyworded": f"""
        select b.packagematchid, {_KEYWORD_COLUMNS}
        from base b left join keyword_parts k on k.packagematchid = b.packagematchid
        group by b.packagematchid""",
    "difficulty": """
        select packagematchid,
               cast(trunc(greatest(titlediff, item1diff, item2diff, item3diff, item4diff,
                                   item5diff)) as integer) as difficulty_idx
        from keyworded""",
    "areas": """
        select b.*,
               case when zo.msa_name > '' then zo.msa_name else co.msa_name end as omsa,
               case when zd.msa_name > '' then zd.msa_name else cd.msa_name end as dmsa,
               cast(trunc(case when zo.msa_name > '' then 0 else co.distance end) as integer)
                   as omsa_miles,
               cast(trunc(case when zd.msa_name > '' then 0 else cd.distance end) as integer)
                   as dmsa_miles
        from base b
        left join zipcodes zo on substring(originzip, 1, 5) = zo.zipcode
            and zo.primaryrecord = 'P'
        left join zips_with_closest_msa co on substring(originzip, 1, 5) = co.zipcode
        left join zipcodes zd on substring(destinationzip, 1, 5) = zd.zipcode
            and zd.primaryrecord = 'P'
        left join zips_with_closest_msa cd on substring(destinationzip, 1, 5) = cd.zipcode""",
    "ppm_rated": """
        select a.*, p.ppm * mileage as base_rate, p.ppm
        from areas a left join ppm_master p on omsa = o_msa and dmsa = d_msa""",
    "lane_hits": """
        select packagematchid, rate from (
            select packagematchid, rate,
                   row_number() over (partition by packagematchid order by maxmiles) as place
            from areas a join lane_rates x on a.omsa = x.omsa and a.dmsa = x.dmsa
                 and mileage between maxmiles - 10 and maxmiles
            where omsa_miles = 0 and dmsa_miles = 0)
        where place = 1""",
    "lane_rated": """
        select p.* exclude (base_rate, ppm), coalesce(h.rate, p.base_rate) as base_rate,
               case when h.rate is null then p.ppm
                    else h.rate * 1.0::double / case when mileage < 1 then 1 else mileage end
               end as ppm
        from ppm_rated p left join lane_hits h using (packagematchid)""",
    "rated": """
        select * exclude (base_rate, ppm),
               case when base_rate is not null or mileage > 250 then base_rate
                    when mileage <= 10 then 100 when mileage <= 20 then 115
                    else 105 + (mileage - 15) / 2 end as base_rate,
               case when base_rate is null and mileage <= 250 then 0 else ppm end as ppm
        from lane_rated""",
    "t_fuel": _banded(
        "fuel_surcharge",
        "fuel_bands",
        "r.mileage",
        "case when gas_2wa > 2.5::double then ceil((gas_2wa - 2.5::double) / 0.1::double)"
        " * rate * base_rate else 0 end",
    ),
    "t_tier": """
        select packagematchid,
               case when t.tier is null then 0 else base_rate * percent + dollars end
                   as zipcode_tier_surcharge
        from rated left join tier_assignments z on substring(destinationzip, 1, 5) = z.zip
        left join tiers t on t.tier = z.dtier""",
    "t_level": """
        select packagematchid,
               case when partner is null then 0 else base_rate * percent end
                   as servicelevel_surcharge
        from rated left join service_levels on partner = forecastsegment""",
    "t_state": """
        select packagematchid,
               case when mileage > o.minmiles
                    then case when o.dollars > 0 then o.dollars else o.percent * base_rate end
                    else 0 end as stateo_surcharge,
               case when mileage > d.minmiles
                    then case when d.dollars > 0 then d.dollars else d.percent * base_rate end
                    else 0 end as stated_surcharge
        from rated left join states o on o.state = originstate
        left join states d on d.state = destinationstate""",
    "t_route": """
        select packagematchid,
               case when o_st is null then 0 when dollars > 0 then dollars
                    else percent * base_rate end as state_route_surcharge
        from rated left join state_route on originst = o_st and destinationst = d_st""",
    "t_congested": """
        select packagematchid, congestedo_surcharge,
               case when d is null then 0::double
                    when congestedo_surcharge > 0 and mileage <= 50 then 0::double
                    else 45::double end as congestedd_surcharge
        from (select r.*, case when o.zip is null then 0::double else 35::double end
                         as congestedo_surcharge, d.zip as d
              from rated r left join congested o on o.zip = originzip
              left join congested d on d.zip = destinationzip)""",
    "t_weight": """
        select packagematchid, totalweight,
               case when totalweight > 200 then (totalweight - 200) / 50 * 0.04::double * base_rate
                    else 0 end as weight_surcharge
        from rated""",
    "t_size": """
        select packagematchid, bb, base_rate * percent + 0 as bb_surcharge
        from rated join rating using (packagematchid) join sizes s on s.rating = bb""",
    "t_difficulty": """
        select packagematchid, difficulty_idx,
               case when idx is null then 0 else base_rate * percent + dollars end
                   as difficulty_surcharge
        from rated join difficulty using (packagematchid)
        left join difficulties on idx = difficulty_idx""",
    "t_mileage": _banded("mileage_surcharge", "mileage_bands", "r.mileage", "percent * base_rate"),
    "t_area": """
        select packagematchid,
               case when o.msa is null then 0 when o.dollars > 0 then o.dollars
                    else base_rate * o.percent end as omsa_surcharge,
               case when d.msa is null then 0 when d.dollars > 0 then d.dollars
                    else base_rate * d.percent end as dmsa_surcharge
        from rated left join area_amounts o on o.msa = omsa
        left join area_amounts d on d.msa = dmsa""",
    "t_pickup": _banded(
        "expedited_pu_surcharge",
        "expedited",
        "date_diff('day', cast(datecreated as date), cast(latest_pickup as date))",
        "case when percent > 0 then percent * base_rate else coalesce(dollars, 0) end",
        "c.part = 'pu'",
    ),
    "t_delivery": _banded(
        "expedited_del_surcharge",
        "expedited",
        "date_diff('day', cast(datecreated as date), cast(latest_delivery as date))",
        "case when percent > 0 then percent * base_rate else coalesce(dollars, 0) end",
        "c.part = 'del'",
    ),
    "t_multi": """
        select packagematchid, totalitems,
               case when totalitems > 1 then base_rate * (totalitems - 1) * (1 - 0.6::double)
                    else 0 end as multi_item_surcharge
        from rated""",
    "t_near_o": _banded(
        "close_to_omsa_surcharge", "near_bands", "omsa_miles", "dollars", "omsa_miles > 0"
    ),
    "t_near_d": _banded(
        "close_to_dmsa_surcharge", "near_bands", "dmsa_miles", "dollars", "dmsa_miles > 0"
    ),
    "t_extra": """
        select packagematchid, item1keyword,
               case when qty <= q then 0
                    when qty > q then (ceil(qty / q) - 1) * base_rate * extra end
                   as addtl_qty_surcharge
        from (select r.*, k.item1keyword, f.*,
                     coalesce(cast(item1unitcount as integer), 0) as qty
              from rated r join keyworded k using (packagematchid)
              left join keywords f on lower(k.item1keyword) = lower(f.keyword))""",
    "terms": """
        select * from rated
        join t_fuel using (packagematchid) join t_tier using (packagematchid)
        join t_level using (packagematchid) join t_state using (packagematchid)
        join t_route using (packagematchid) join t_congested using (packagematchid)
        join (select packagematchid, weight_surcharge from t_weight) using (packagematchid)
        join (select packagematchid, bb, bb_surcharge from t_size) using (packagematchid)
        join t_difficulty using (packagematchid) join t_mileage using (packagematchid)
        join t_area using (packagematchid) join t_pickup using (packagematchid)
        join t_delivery using (packagematchid)
        join (select packagematchid, multi_item_surcharge from t_multi) using (packagematchid)
        join t_near_o using (packagematchid) join t_near_d using (packagematchid)
        join (select packagematchid, addtl_qty_surcharge from t_extra) using (packagematchid)
        join keyworded using (packagematchid) join flags using (packagematchid)
        join (select packagematchid, match_price_out_of_range from outlier)
            using (packagematchid)""",
    "totals": """
        select *, coalesce(base_rate, 0::double) + 0::double + coalesce(fuel_surcharge, 0)
                  + coalesce(zipcode_tier_surcharge, 0) + coalesce(servicelevel_surcharge, 0)
                  + coalesce(stateo_surcharge, 0) + coalesce(stated_surcharge, 0)
                  + coalesce(state_route_surcharge, 0) + coalesce(congestedo_surcharge, 0)
                  + coalesce(congestedd_surcharge, 0) + coalesce(omsa_surcharge, 0)
                  + coalesce(dmsa_surcharge, 0) + coalesce(weight_surcharge, 0)
                  + coalesce(bb_surcharge, 0) + coalesce(difficulty_surcharge, 0)
                  + coalesce(mileage_surcharge, 0) + coalesce(expedited_pu_surcharge, 0)
                  + coalesce(expedited_del_surcharge, 0) + coalesce(multi_item_surcharge, 0)
                  + coalesce(close_to_omsa_surcharge, 0) + coalesce(close_to_dmsa_surcharge, 0)
                  + coalesce(addtl_qty_surcharge, 0) as rate_engine_prediction
        from terms""",
    "verdicts": """
        select *, case when toohigh = 0 and toolow = 0 then 1 else 0 end as good from (
            select *,
                   case when rate_engine_prediction > matchprice * (1 + 0.15::double)
                          or rate_engine_prediction - matchprice > 50 then 1 else 0 end as toohigh,
                   case when rate_engine_prediction < matchprice * (1 - 0.15::double)
                          or matchprice - rate_engine_prediction > 50 then 1 else 0 end as toolow
            from totals)""",
}

PARTS = {**FACTS, **CARDS, **SHIPMENTS}


def statement(body: str) -> str:
    """The statement with the named parts it needs, directly or through other parts."""
    needed: set[str] = set()
    pending = [body]
    while pending:
        for word in set(re.findall(r"\w+", pending.pop())):
            if word in PARTS and word not in needed:
                needed.add(word)
                pending.append(PARTS[word])
    ordered = _in_order(needed)
    if not ordered:
        return body
    return "with " + ",\n".join(f"{name} as ({PARTS[name]})" for name in ordered) + "\n" + body


def _in_order(names: set[str]) -> list[str]:
    """Parts after the parts they use."""
    done: list[str] = []

    def visit(name: str) -> None:
        if name in done:
            return
        for word in set(re.findall(r"\w+", PARTS[name])) & names - {name}:
            visit(word)
        done.append(name)

    for name in sorted(names):
        visit(name)
    return done


def _terms(part: str, columns: str) -> str:
    return f"select packagematchid, {columns} from {part}"


_PARTS_NOW = "select p_partkey, p_name, p_retailprice from part"
_PARTS_DEARER = """select p_partkey, p_name, p_retailprice + 100::double as p_retailprice
    from part"""

BODIES = {
    "package_quantity": "select packageid, qty from quantity",
    "item_slots": "select * from slots",
    "item_measures": f"select packageid, {_MEASURES} from slots",
    "shipment_base": """
        select packagematchid, packageid, datecreated, title, origincity, originstate, originst,
               originzip, destinationcity, destinationstate, destinationst, destinationzip,
               mileage, latest_pickup as listing_latest_pickup,
               latest_delivery as listing_latest_delivery, totalweight, totalitems, totalqty,
               bids, nypchanges, carrier, dateaccepted, matchprice, nmr_post,
               forecastsegment as partner, originalnypamount as posted_at, old_prediction,
               week_end_date, gas_2wa
        from base""",
    "shipment_flags": "select * from flags",
    "size_rating": "select * from rating",
    "price_per_mile_outlier": "select * from outlier",
    "fuel_weekly": """
        with feed as (
            select cast(ts as date) as date, max(value) filter (event_type = 'view') as gas
            from events group by 1)
        select cast(date + cast((6 - dayofweek(date)) % 7 as integer) as date) as week_end_date,
               cast(cast(gas as decimal(19, 4)) as double) as gas
        from feed where date >= date '2024-01-03'
          and date + cast((6 - dayofweek(date)) % 7 as integer) < date '2024-01-31'""",
    "fuel_two_weeks_ago": "select packagematchid, d_datecreated, week_end_date, gas_2wa from base",
    "keyword_indexes": f"select packagematchid, {_KEYWORD_NAMES} from keyworded",
    "difficulty_index": "select * from difficulty",
    "msa_resolution": _terms(
        "areas", "originzip, destinationzip, omsa, dmsa, omsa_miles, dmsa_miles"
    ),
    "ppm_base_rate": _terms("ppm_rated", "mileage, ppm, base_rate"),
    "lane_rate_override": _terms("lane_rated", "mileage, ppm, base_rate"),
    "short_haul_base_rate": _terms("rated", "mileage, ppm, base_rate"),
    "fuel_surcharge": _terms("t_fuel", "fuel_surcharge"),
    "zip_tier_surcharge": _terms("t_tier", "zipcode_tier_surcharge"),
    "service_level_surcharge": _terms("t_level", "servicelevel_surcharge"),
    "state_surcharge": _terms("t_state", "stateo_surcharge, stated_surcharge"),
    "state_route_surcharge": _terms("t_route", "state_route_surcharge"),
    "congested_surcharge": _terms("t_congested", "congestedo_surcharge, congestedd_surcharge"),
    "weight_surcharge": _terms("t_weight", "totalweight, weight_surcharge"),
    "size_surcharge": _terms("t_size", "bb, bb_surcharge"),
    "difficulty_surcharge": _terms("t_difficulty", "difficulty_idx, difficulty_surcharge"),
    "mileage_surcharge": _terms("t_mileage", "mileage_surcharge"),
    "msa_surcharge": _terms("t_area", "omsa_surcharge, dmsa_surcharge"),
    "expedited_surcharge": """
        select packagematchid, expedited_pu_surcharge, expedited_del_surcharge
        from t_pickup join t_delivery using (packagematchid)""",
    "multi_item_surcharge": _terms("t_multi", "totalitems, multi_item_surcharge"),
    "near_msa_surcharge": """
        select packagematchid, close_to_omsa_surcharge, close_to_dmsa_surcharge
        from t_near_o join t_near_d using (packagematchid)""",
    "extra_quantity_surcharge": _terms("t_extra", "item1keyword, addtl_qty_surcharge"),
    "priced_shipments": f"""
        select timestamp '2002-01-01' as rundate, packageid, packagematchid, datecreated, title,
               omsa, dmsa, omsa_miles, dmsa_miles, ppm, origincity, originstate, originst,
               originzip, destinationcity, destinationstate, destinationst, destinationzip,
               mileage, latest_pickup as listing_latest_pickup,
               latest_delivery as listing_latest_delivery, totalweight, totalitems, totalqty,
               bids, {_MEASURES}, nypchanges, {_KEYWORD_NAMES}, bb, carrier, dateaccepted,
               matchprice, amount_to_carrier, forecastsegment as partner, rematched,
               originalnypamount as posted_at, old_prediction, gas_2wa, highvalue, multi_item,
               zipcode_tier, difficulty_idx, 0 as servicelevel, base_rate, 0 as fixedcost,
               fuel_surcharge, zipcode_tier_surcharge, servicelevel_surcharge, stateo_surcharge,
               stated_surcharge, state_route_surcharge, congestedo_surcharge,
               congestedd_surcharge, omsa_surcharge, dmsa_surcharge, weight_surcharge,
               bb_surcharge, difficulty_surcharge, mileage_surcharge, expedited_pu_surcharge,
               expedited_del_surcharge, multi_item_surcharge, close_to_omsa_surcharge,
               close_to_dmsa_surcharge, addtl_qty_surcharge, toohigh, toolow, good,
               match_price_out_of_range, rate_engine_prediction,
               originalnypamount as posted_amt, old_prediction as old_prediction2,
               matchprice as match_price
        from verdicts""",
    "evaluation_flags": _terms(
        "verdicts", "rate_engine_prediction, matchprice, toohigh, toolow, good"
    ),
    "evaluation_summary": """
        select case when toohigh > 0 then 'Too high' when toolow > 0 then 'Too Low'
                    when good > 0 then 'Good' end as evaluation, count(*) as shipments
        from verdicts group by 1""",
    "fuel_feed_pivot": """
        select cast(ts as date) as date,
               max(case when event_type = 'view' then value end) as gas,
               max(case when event_type = 'click' then value end) as diesel
        from events where cast(ts as date) > timestamp '2024-01-31' - interval 7 day
        group by 1""",
    "append_load": f"{_PARTS_NOW} union all {_PARTS_DEARER}",
    "full_refresh": _PARTS_DEARER,
    "fan_out_load": f"""
        with loaded as ({_PARTS_NOW}), counts as (select count(*) as rows from loaded)
        select target, rows, true as ok, p_partkey, p_retailprice
        from (values ('dev'), ('qa'), ('sand'), ('prod')) t(target), counts, loaded""",
    "append_ledger": """
        select cast(ts as date) as date,
               max(case when event_type = 'view' then value end) as gas,
               max(case when event_type = 'click' then value end) as diesel
        from events
        where cast(ts as date) > date '2024-01-01' and cast(ts as date) <= date '2024-01-31'
        group by 1""",
    "refresh_versioned": f"""
        select 'before' as seen, 1 as version, * from ({_PARTS_NOW})
        union all select 'after', 2, * from ({_PARTS_DEARER})""",
    "fan_out_resume": f"""
        with loaded as ({_PARTS_NOW}), counts as (select count(*) as rows from loaded),
        told(call, target, ok, attempts, error) as (values
            (1, 'dev', true, 1, null), (1, 'qa', false, 2, 'AnalysisException'),
            (1, 'sand', true, 1, null), (1, 'prod', true, 1, null),
            (2, 'dev', true, 0, null), (2, 'qa', true, 1, null),
            (2, 'sand', true, 0, null), (2, 'prod', true, 0, null))
        select call, target, case when ok then rows else 0 end as rows, ok, attempts, error,
               p_partkey, p_retailprice
        from told, counts, loaded""",
    "ratecard_upsert": f"""
        with kept as ({_PARTS_NOW}),
        offered as (select 3 * c_custkey as p_partkey, c_name as p_name,
                           c_acctbal as p_retailprice from customer)
        select coalesce(k.p_partkey, n.p_partkey) as p_partkey,
               case when n.p_partkey is null then k.p_name else n.p_name end as p_name,
               case when n.p_partkey is null then k.p_retailprice else n.p_retailprice end
                   as p_retailprice,
               case when k.p_partkey is null then timestamp '2024-02-01'
                    else timestamp '2024-01-01' end as datecreatedutc,
               case when n.p_partkey is null then timestamp '2024-01-01'
                    else timestamp '2024-02-01' end as dateupdatedutc
        from kept k full join offered n on k.p_partkey = n.p_partkey""",
    "equi_lookup": """
        with marks(id, flag, amount) as (values (1, 'a', 1.5), (2, 'A', 2.5), (3, 'r', null)),
        first_marks as (
            select * from (select *, row_number() over (
                partition by lower(flag) order by id) as place from marks) where place = 1)
        select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity,
               case when f.flag is null then l_discount else f.amount::double end as kept,
               f.amount::double as overwritten, p.p_name as part_name, p.p_retailprice as price
        from lineitem
        left join first_marks f on lower(l_returnflag) = lower(f.flag)
        left join part p on l_partkey = 2 * p_partkey""",
    "band_lookup": """
        with bands(id, low, high, label) as (values
            (1, 0, 20000, 'small'), (2, 20000, 50000, 'middle'), (3, 15000, 30000, 'mixed'),
            (4, 60000, 90000, 'large'), (5, 60000, 90000, 'twin'))
        select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, label from (
            select l.*, label, row_number() over (partition by n order by high, id) as place
            from (select *, row_number() over () as n from lineitem) l
            left join bands on l_extendedprice between low and high)
        where place = 1""",
    "band_lookup_many": """
        with bands as (
            select o_totalprice as low, o_totalprice + (o_orderkey % 50) * 10 as high,
                   o_orderpriority as label
            from orders),
        lines as (select *, row_number() over () as n from lineitem),
        hits as (
            select n, min({'high': high, 'low': low, 'label': label}) as band
            from lines join bands on l_extendedprice >= low and l_extendedprice <= high
            group by n)
        select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
               band.low as low, band.label as label
        from lines left join hits using (n)""",
    "band_lookup_open": """
        with halves as (
            select *, (l_orderkey * 8 + l_linenumber) * 2 + half as id,
                   (l_orderkey + l_linenumber + half) % 6 as kind,
                   case half when 0 then l_extendedprice else l_extendedprice * 0.75::double end
                       as price
            from lineitem, (values (0), (1)) as t(half)),
        closed as (
            select id, price as low, price + l_partkey % 40 * 5 as high, l_suppkey
            from halves where kind > 1),
        below as (
            select price as high, min(id) as id, arg_min(l_suppkey, id) as l_suppkey
            from halves where kind = 0 group by price),
        above as (
            select low, min(first) over (order by low) as first from (
                select price as low, min({'id': id, 'low': price, 's': l_suppkey}) as first
                from halves where kind = 1 group by price)),
        prices as (select distinct l_extendedprice as price from lineitem),
        hits as (
            select p.price, min({'high': high, 'id': id, 'low': low, 's': l_suppkey}) as band
            from prices p join closed on p.price >= low and p.price <= high group by p.price
            union all
            select p.price, {'high': high, 'id': id, 'low': '-Infinity'::double, 's': l_suppkey}
            from prices p asof join below on p.price <= below.high
            union all
            select p.price, {'high': 'Infinity'::double, 'id': first.id, 'low': first.low,
                             's': first.s}
            from prices p asof join above on p.price >= above.low),
        firsts as (select price, min(band) as band from hits group by price)
        select l_orderkey, l_linenumber, l_extendedprice, band.low as low, band.high as high,
               band.s as supplier
        from lineitem left join firsts on l_extendedprice = firsts.price""",
    "keyword_indexes_many": """
        with words as (
            select case when o_orderkey % 50 > 0 then o_orderkey end as id,
                   cast(o_orderkey as varchar) as keyword, o_orderkey % 7 + 0.5::double as idx,
                   case when o_orderkey % 4 > 0 then o_orderkey % 5 * 0.25::double end as fragile
            from orders where o_orderkey % 3 = 0),
        shipments as (
            select case when p_partkey % 10 > 0 then p_partkey % 700 end as packagematchid,
                   p_partkey as n, p_name || ' ' || (p_partkey % 900 * 37) as title,
                   'size ' || (p_partkey * 611) as item1,
                   case when p_partkey % 3 > 0 and p_partkey % 2 > 0 then item1 end as item2
            from part),
        texts as (
            select distinct text from (
                select title as text from shipments union all select item1 from shipments)),
        met as (
            select text, string_agg(keyword, ' / ' order by id nulls first, keyword) as words,
                   max(idx) as diff, max(fragile) as frag
            from texts join words on contains(lower(text), lower(keyword)) group by text)
        select packagematchid, title, t.words as titlekeyword, coalesce(t.diff, 0) as titlediff,
               coalesce(t.frag, 0) as titlefrag, a.words as item1keyword,
               coalesce(a.diff, 0) as item1diff, coalesce(a.frag, 0) as item1frag,
               b.words as item2keyword, coalesce(b.diff, 0) as item2diff,
               coalesce(b.frag, 0) as item2frag
        from shipments
        left join met t on title = t.text
        left join met a on item1 = a.text
        left join met b on item2 = b.text""",
    "size_rating_seeds": """
        with seeds(size_no, surcharged, surchargep) as (values
            (0, 0.0::double, 0.0::double), (1, 0.0, 0.1), (2, 0.0, 0.18)),
        stored as (select cast(p_partkey - 1 as integer) as size_no, p_retailprice from part)
        select coalesce(t.size_no, s.size_no) as bb_rating,
               case when s.size_no is null then p_retailprice else surcharged end
                   as bb_surcharged,
               case when s.size_no is null then 0.5 else surchargep end as bb_surchargep,
               case when t.size_no is null then timestamp '2024-02-01'
                    else timestamp '2024-01-01' end as datecreatedutc,
               case when s.size_no is null then timestamp '2024-01-01'
                    else timestamp '2024-02-01' end as dateupdatedutc
        from stored t full join seeds s on t.size_no = s.size_no""",
}
BODIES["backtest_job"] = BODIES["evaluation_flags"]


def oracle_sql() -> dict[str, str]:
    return {name: statement(body.strip()) for name, body in BODIES.items()}

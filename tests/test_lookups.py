import random

import pytest
from pyspark.sql import functions as F

from haulrate import Limits
from haulrate.operators import segments
from haulrate.operators.lookups import band_lookup, equi_lookup, pair_band_lookup
from haulrate.sources.cards import Card


def _values(df, key, name):
    return {row[key]: row[name] for row in df.select(key, name).collect()}


def test_equal_keys_ignore_case_and_trailing_blanks_and_never_fan_out(spark, limits):
    card = spark.createDataFrame(
        [(2, "ring ", 2.0), (1, "RING", 1.0), (3, None, 3.0), (4, "nil", None)],
        "id int, word string, amount double",
    )
    rows = [(1, "Ring"), (2, "ring  "), (3, " ring"), (4, None), (5, "nil")]
    df = spark.createDataFrame(rows, "n int, text string")
    found = equi_lookup(df, Card(card, limits), [("text", "word")], ["amount"], "hit")
    assert found.columns == ["n", "text", "hit"]
    hits = _values(found, "n", "hit")
    assert len(hits) == found.count() == 5
    assert hits[1].amount == hits[2].amount == 1.0  # the lowest id
    assert hits[3] is None and hits[4] is None
    assert hits[5] is not None and hits[5].amount is None  # a hit on a NULL is no miss


def test_hot_key_of_a_lookup_keeps_every_row(spark, limits):
    df = spark.range(3000).select("id", F.when(F.col("id") % 3 > 0, "a").otherwise("b").alias("k"))
    card = spark.createDataFrame([(1, "a", 10)], "id int, key string, v int")
    found = equi_lookup(df, Card(card, limits), [("k", "key")], ["v"], "hit")
    assert found.count() == 3000
    assert found.where("hit is not null").count() == 2000


def test_bands_are_closed_and_the_lowest_upper_bound_wins(spark, limits):
    card = spark.createDataFrame(
        [
            (1, 0.0, 250.0, "a"),
            (2, 250.0, 1000.0, "b"),
            (3, 240.0, 260.0, "c"),
            (4, 240.0, 260.0, "d"),
            (5, 5000.0, 4000.0, "never"),
            (6, None, 9000.0, "open"),
            (7, 7000.0, 7000.0, "point"),
            (8, -1e9, -5.0, "wide"),
        ],
        "id int, lo double, hi double, label string",
    )
    values = [-1e9, -5.0, -4.9, 0.0, 239.9, 240.0, 250.0, 250.1, 260.0, 260.1, 1000.0, 1000.1]
    values += [4500.0, 7000.0, 7000.1, float("nan"), None]
    df = spark.createDataFrame(list(enumerate(values)), "n int, v double")
    found = band_lookup(df, Card(card, limits), "v", "lo", "hi", ["label"], "band")
    labels = [band and band.label for _, band in sorted(_values(found, "n", "band").items())]
    assert labels == (
        ["wide", "wide", None, "a", "a", "a", "a", "c", "c", "b", "b", None]
        + [None, "point", None, None, None]
    )


def test_an_empty_card_misses_everywhere(spark, limits):
    df = spark.createDataFrame([(1, 5.0)], "n int, v double")
    empty = spark.createDataFrame([], "id int, lo double, hi double, label string")
    found = band_lookup(df, Card(empty, limits), "v", "lo", "hi", ["label"], "band")
    assert found.collect()[0].band is None
    found = equi_lookup(df, Card(empty, limits), [("v", "lo")], ["label"], "row")
    assert found.collect()[0].row is None


def test_pair_bands_reach_ten_below_their_bound(spark, limits):
    card = spark.createDataFrame(
        [(1, "A", "B", 60, 9.0), (2, "A", "B", 50, 7.0), (3, "a", "b", 50, 8.0), (4, "A", "B", -5, 1.0)],
        "id int, o string, d string, top int, rate double",
    )
    values = [39.9, 40.0, 50.0, 50.1, 60.0, 60.1, -15.0, -5.0, -4.9, None]
    rows = [(i, "a", "b", v) for i, v in enumerate(values)] + [(99, "b", "a", 50.0)]
    df = spark.createDataFrame(rows, "n int, o string, d string, miles double")
    found = pair_band_lookup(
        df, Card(card, limits), [("o", "o"), ("d", "d")], "miles", "top", 10, ["rate"], "lane"
    )
    rates = [lane and lane.rate for _, lane in sorted(_values(found, "n", "lane").items())]
    assert rates == [None, 7.0, 7.0, 9.0, 9.0, None, 1.0, 1.0, None, None, None]


def test_ties_without_ids_and_open_ends_do_not_depend_on_the_size(spark, limits):
    inf = float("inf")
    bands = [
        (5.0, 10.0, 0.5),
        (0.0, 10.0, 0.1),
        (0.0, 10.0, 0.05),
        (12.0, inf, 2.0),
        (20.0, inf, 1.0),
        (-inf, -1.0, 3.0),
        (-inf, inf, 4.0),
        (1e300, 1.5e300, 6.0),
        (1e30, 1e30, 7.0),
    ]
    card = spark.createDataFrame(bands, "lo double, hi double, rate double")
    values = [7.0, 3.0, 10.0, 11.0, 15.0, 25.0, -5.0, 1.2e300, 1e30, inf, -inf, None]
    df = spark.createDataFrame(list(enumerate(values)), "n int, v double")
    found = band_lookup(df, Card(card, limits), "v", "lo", "hi", ["rate"], "band")
    rates = [band and band.rate for _, band in sorted(_values(found, "n", "band").items())]

    def first(value):
        inside = [(hi, lo, rate) for lo, hi, rate in bands if lo <= value <= hi]
        return min(inside)[2]

    assert rates == [None if value is None else first(value) for value in values]


def test_a_hot_key_is_split_and_only_its_part_of_the_side_is_copied(spark):
    """Adaptive execution measures the partitions: the plan that ran says so."""
    sizes = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
    for name, value in sizes.items():
        spark.conf.set(name, value)
    try:
        key = F.when(F.col("id") % 10 < 9, F.lit("hot")).otherwise(F.col("id").cast("string"))
        df = spark.range(60_000).repartition(16).select(key.alias("k"), F.rand(1).alias("v"))
        names = spark.range(60_000).select(F.col("id").cast("string").alias("key"))
        card = names.union(spark.sql("select 'hot'")).withColumn("x", F.length("key"))
        card = Card(card.withColumn("id", F.lit(1)), Limits(broadcast_rows=0))
        found = equi_lookup(df, card, [("k", "key")], ["x"], "hit")
        assert len(found.where("hit.x = length(k)").collect()) == 60_000
        found = found.select("k", "hit")
        found.collect()
        assert "skew=true" in found._jdf.queryExecution().executedPlan().toString()
    finally:
        for name in sizes:
            spark.conf.unset(name)


@pytest.mark.parametrize("seed", range(3))
def test_segments_agree_with_looking_at_every_band(spark, seed, monkeypatch):
    """Bounds that repeat, points, nested and open bands; cells and tree tiers of several sizes."""
    monkeypatch.setattr(segments, "CELL_BOUNDS", (1, 4, 32)[seed])
    monkeypatch.setattr(segments, "TIER", (2, 5, 10)[seed])
    rng, inf = random.Random(seed), float("inf")
    bands = []
    for k in range(400):
        low = rng.choice([float(rng.randrange(60)), rng.random() * 60])
        high = low + rng.choice([0, 0.5, rng.randrange(3), rng.random() * 40])
        low, high = rng.choice([(low, high)] * 4 + [(-inf, high), (low, inf), (None, high)])
        bands.append((rng.randrange(300), low, high, f"b{k}"))
    card = spark.createDataFrame(bands, "id int, lo double, hi double, label string")
    bounds = [b for band in bands for b in band[1:3] if b is not None]
    values = [*bounds, *(rng.random() * 110 - 5 for _ in range(300)), None, -inf, inf]
    df = spark.createDataFrame(list(enumerate(values)), "n int, v double").repartition(5)
    limits = Limits(literal_rows=0, broadcast_rows=(0, 200_000)[seed % 2])
    found = band_lookup(df, Card(card, limits), "v", "lo", "hi", ["label"], "band")
    labels = [band and band.label for _, band in sorted(_values(found, "n", "band").items())]

    def first(value):
        if value is None:
            return None
        order = [(hi, k, lo, label) for k, lo, hi, label in bands if lo is not None and lo <= value <= hi]
        return min(order)[3] if order else None

    assert labels == [first(value) for value in values]


def test_segments_hold_each_value_once_and_gather_no_lists(spark):
    """Open bands lie in every place, and yet no value meets two segments."""
    inf = float("inf")
    half = F.col("id") % 2 == 0
    card = spark.range(3000).select(
        "id",
        F.when(half, F.lit(-inf)).otherwise(F.col("id") * 1.0).alias("lo"),
        F.when(half, F.col("id") * 1.0).otherwise(F.lit(inf)).alias("hi"),
    )
    card = Card(card, Limits(literal_rows=0, broadcast_rows=0))
    df = spark.range(6000).select((F.col("id") / 2).alias("v"))
    found = band_lookup(df, card, "v", "lo", "hi", ["id"], "band")
    assert found.count() == 6000
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan and "NestedLoop" not in plan
    rows = card.prepared(("segments", "lo", "hi", "id"), None).rows
    assert rows.groupBy("cell").count().agg(F.max("count")).first()[0] <= 2 * segments.CELL_BOUNDS
    assert found.where("v >= 2998.5").select("band.id").distinct().collect()[0].id == 1


def test_work_above_the_cells_does_not_grow_with_the_bands(spark, monkeypatch):
    """20,000 bands over 80 bounds, half of them open: the tree gets a band per run of cells."""
    monkeypatch.setattr(segments, "CELL_BOUNDS", 8)
    given, tree = [], segments._tree
    monkeypatch.setattr(segments, "_tree", lambda bands, levels: given.append(bands.count()) or tree(bands, levels))
    low = (F.col("id") * 7 % 40).cast("double")
    card = spark.range(20_000).select(
        "id",
        F.when(F.col("id") % 4 == 0, F.lit(float("-inf"))).otherwise(low).alias("lo"),
        F.when(F.col("id") % 4 == 1, F.lit(float("inf"))).otherwise(low + F.col("id") % 9 * 5 + 0.5).alias("hi"),
    )
    df = spark.range(200).select((F.col("id") / 2).alias("v"))
    found = band_lookup(df, Card(card, Limits(literal_rows=0)), "v", "lo", "hi", ["id"], "band")
    bands = sorted((r.hi, r.id, r.lo) for r in card.collect())
    for row in found.collect():
        first = next((k for hi, k, lo in bands if lo <= row.v <= hi), None)
        assert (row.band and row.band.id) == first
    assert given[0] <= 11 * 11


def test_bands_up_to_nan_and_of_times(spark):
    limits = Limits(literal_rows=0)
    card = spark.sql("select 1D lo, double('nan') hi, 'a' label union all select double('nan'), double('nan'), 'b' union all select 2D, 3D, 'c'")
    df = spark.sql("select explode(array(0D, 1D, 2D, 4D, double('inf'), double('nan'))) v")
    found = band_lookup(df, Card(card, limits), "v", "lo", "hi", ["label"], "band")
    assert [r.label for r in found.orderBy("v").select("band.label").collect()] == [None, "a", "c", "a", "a", "a"]
    for kind in ("timestamp", "timestamp_ntz"):
        card = spark.sql("select '2024-01-05 10:00' lo, '2024-01-09 10:00' hi, 'a' label union all select '2024-01-01', '2024-01-05 12:00', 'b'")
        card = card.select(F.col("lo").cast(kind), F.col("hi").cast(kind), "label")
        df = spark.sql("select explode(array('2024-01-05 11:00', '2024-01-05 13:00', '2024-02-01')) v").select(F.col("v").cast(kind))
        found = band_lookup(df, Card(card, limits), "v", "lo", "hi", ["label"], "band")
        assert [r.label for r in found.orderBy("v").select("band.label").collect()] == ["b", "a", None]


def test_bands_of_dates_and_of_mixed_numbers(spark):
    limits = Limits(literal_rows=0)
    card = spark.sql("select date'2024-01-05' lo, date'2024-01-09' hi, 'a' label union all select date'2024-01-01', date'2024-01-05', 'b'")
    df = spark.sql("select explode(sequence(date'2024-01-01', date'2024-01-10')) v")
    found = band_lookup(df, Card(card, limits), "v", "lo", "hi", ["label"], "band")
    assert [r.label for r in found.orderBy("v").select("band.label").collect()] == ["b"] * 5 + ["a"] * 4 + [None]
    card = spark.sql("select 1 lo, 2.5D hi, 'a' label union all select 3, 4.0D, 'b'")
    df = spark.sql("select explode(array(cast(1 as decimal(9,2)), 2.5, 2.51, 4)) v")
    found = band_lookup(df, Card(card, limits), "v", "lo", "hi", ["label"], "band")
    assert [r.label for r in found.orderBy("v").select("band.label").collect()] == ["a", "a", None, "b"]

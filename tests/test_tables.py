"""Loads, upserts and the whole job."""

from datetime import date, datetime

import pytest

from haulrate import Limits
from haulrate.plans import backtest
from haulrate.sources.cards import Cards, conform
from haulrate.sources.facts import Facts, load_facts
from haulrate.sources.schemas import CARD_DDL, FACT_DDL, SPARE_CARD_DDL, UNREAD, schema_of
from haulrate.sources.seeds import SIZE_RATING_VALUES, size_ratings
from haulrate.sources.shared import shared_folder
from haulrate.sources.sync import Table, append, extract, fan_out, full_refresh, pivot_fuel
from haulrate.sources.upsert import upsert
from testbed import cards as card_rows
from testbed.catalog import Bench


def parquet(path):
    return Table(path.name, options={"path": str(path)})


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_every_declared_schema_parses(spark):
    for name in [*CARD_DDL, *SPARE_CARD_DDL, *FACT_DDL]:
        assert len(schema_of(name)) > 0


def test_conform_orders_and_casts_and_fills_the_tie_breaker(spark):
    given = spark.createDataFrame(
        [("7", "x", 1, None)], "SURCHARGEP string, spare string, minweight int, surcharged double"
    )
    out = conform(given, schema_of("weight_v6"))
    assert out.dtypes == [("minweight", "int"), ("surcharged", "double"), ("surchargep", "double"), ("id", "int")]
    assert rows(out) == [(1, None, 7.0, None)]


def test_conform_rejects_nulls_and_missing_keys(spark):
    schema = schema_of("bb_v6")
    amounts = "bb_surcharged double, bb_surchargep double, datecreatedutc timestamp, dateupdatedutc timestamp"
    with pytest.raises(ValueError, match="bb_rating"):
        conform(spark.createDataFrame([], amounts), schema)
    with pytest.raises(Exception, match="NULL in column bb_rating"):
        given = spark.createDataFrame([(None, 1.0, 1.0, None, None)], f"bb_rating int, {amounts}")
        conform(given, schema).collect()


@pytest.mark.parametrize("name", CARD_DDL)
def test_a_card_without_a_column_that_a_rule_reads_is_refused(spark, name):
    schema, unread = schema_of(name), {"id", *UNREAD.get(name, "").split()}
    whole = spark.createDataFrame([], schema)
    for field in schema:
        cards = Cards({name: whole.drop(field.name)})
        if field.name in unread and field.nullable:
            assert cards[name].df.columns == schema.names
        else:
            with pytest.raises(ValueError, match=field.name):
                cards[name]


def test_facts_without_a_column_or_with_a_package_twice_are_refused(spark, sf_dir, tmp_path):
    facts = Bench(spark, sf_dir).facts
    for name in FACT_DDL:
        getattr(facts, name).write.parquet(str(tmp_path / name))
    loaded = load_facts(spark, str(tmp_path))
    loaded.check_keys()
    twice = Facts(**{**vars(loaded), "listing": loaded.listing.union(loaded.listing)})
    with pytest.raises(ValueError, match="listing holds packageid"):
        twice.check_keys()
    loaded.tracking.drop("delivereddate").write.parquet(str(tmp_path / "less" / "tracking"))
    (tmp_path / "tracking").rename(tmp_path / "whole")
    (tmp_path / "less" / "tracking").rename(tmp_path / "tracking")
    with pytest.raises(ValueError, match="delivereddate"):
        load_facts(spark, str(tmp_path))


def test_fuel_pivot_keeps_dates_strictly_after_the_window_start(spark):
    as_of = datetime(2024, 1, 31, 12, 0)
    feed = spark.createDataFrame(
        [
            (datetime(2024, 1, 24, 12, 0), "Total Gasoline", 1.0),
            (datetime(2024, 1, 24, 12, 1), "Total Gasoline", 2.0),
            (datetime(2024, 1, 24, 12, 1), "Total Gasoline", 2.5),
            (datetime(2024, 1, 24, 12, 1), "No 2 Diesel", 3.0),
            (datetime(2024, 1, 30), "other", 9.0),
        ],
        "date timestamp_ntz, type string, ppg double",
    )
    assert rows(pivot_fuel(feed, as_of)) == [
        (datetime(2024, 1, 24, 12, 1), 2.5, 3.0),
        (datetime(2024, 1, 30), None, None),
    ]


def test_append_adds_and_refresh_replaces(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    target = parquet(tmp_path / "t")
    append(df, target)
    append(df, target)
    assert rows(extract(spark, target)) == [(1, "a"), (1, "a"), (2, "b"), (2, "b")]
    for _ in range(2):
        full_refresh(df, target)
        assert rows(extract(spark, target)) == [(1, "a"), (2, "b")]


def test_a_failing_target_is_skipped(spark, tmp_path):
    df = spark.createDataFrame([(1,), (2,)], "k int")
    (tmp_path / "file").write_text("in the way")
    broken = Table("broken", options={"path": str(tmp_path / "file" / "below")})
    targets = [parquet(tmp_path / "dev"), broken, parquet(tmp_path / "prod")]
    status = fan_out(df, targets)
    assert rows(status) == [("broken", 0, False), ("dev", 2, True), ("prod", 2, True)]
    assert rows(extract(spark, targets[2])) == [(1,), (2,)]


def test_shared_folder_is_the_sessions(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert shared_folder(spark, "x").startswith(root)


def test_upsert_updates_inserts_and_keeps(spark):
    then, now = datetime(2023, 1, 1), datetime(2024, 1, 1)
    schema = schema_of("bb_v6")
    target = spark.createDataFrame([(1, 5.0, 5.0, then, then), (9, 9.0, 9.0, then, then)], schema)
    source = size_ratings(spark)
    once = upsert(target, source, ["bb_rating"], SIZE_RATING_VALUES, now)
    expected = [
        (0, 0.0, 0.0, now, now),
        (1, 0.0, 0.1, then, now),
        (2, 0.0, 0.18, now, now),
        (9, 9.0, 9.0, then, then),
    ]
    assert once.schema.names == schema.names
    assert rows(once) == expected
    assert rows(upsert(once, source, ["bb_rating"], SIZE_RATING_VALUES, now)) == expected


def test_upsert_rejects_two_rows_for_one_target_row_only(spark):
    target = spark.createDataFrame([(1, 1.0), (None, 2.0)], "k int, v double")
    twice = spark.createDataFrame([(1, 5.0), (1, 6.0)], "k int, v double")
    with pytest.raises(ValueError, match="several source rows"):
        upsert(target, twice, ["k"], ["v"], datetime(2024, 1, 1))
    new = spark.createDataFrame([(7, 5.0), (7, 6.0), (None, 3.0)], "k int, v double")
    merged = upsert(target, new, ["k"], ["v"], datetime(2024, 1, 1)).collect()
    assert sorted((row.k or 0, row.v) for row in merged) == [(0, 2.0), (0, 3.0), (1, 1.0), (7, 5.0), (7, 6.0)]


def test_cards_are_measured_before_they_are_broadcast(spark):
    limits = Limits(broadcast_rows=100, literal_rows=10)
    cards = card_rows.load(spark, limits)
    assert cards["weight_v6"].small and len(cards["weight_v6"].literals) == 1
    assert cards["stateabb"].small and cards["stateabb"].literals is None
    assert not cards["calendar"].small and cards["calendar"].rows == 2588


def test_back_test_job(spark, sf_dir, tmp_path):
    bench = Bench(spark, sf_dir)
    facts: Facts = bench.facts
    for name in FACT_DDL:
        getattr(facts, name).write.parquet(str(tmp_path / "facts" / name))
    for name in CARD_DDL:
        bench.cards[name].df.write.parquet(str(tmp_path / "cards" / name))
    detail, summary = backtest.run(
        spark, str(tmp_path / "facts"), str(tmp_path / "cards"), str(tmp_path / "out"), bench.params
    )
    assert len(detail.columns) == 134
    expected = {r.evaluation: r.shipments for r in bench_summary(bench).collect()}
    assert {r.evaluation: r.shipments for r in summary.collect()} == expected
    assert sum(expected.values()) == detail.count() == detail.select("packagematchid").distinct().count()
    assert detail.where("toohigh + toolow + good < 1").count() == 0
    loaded = Cards.load(spark, str(tmp_path / "cards"))
    assert loaded["fuelprices"].df.schema["gas"].dataType.simpleString() == "decimal(19,4)"
    assert bench.params.as_of == date(2002, 1, 1)


def bench_summary(bench):
    from haulrate.operators.evaluate import evaluation_summary

    return evaluation_summary(bench.priced)


def test_one_lane_of_the_detail(spark, sf_dir):
    from haulrate.plans.pricing import detail

    bench = Bench(spark, sf_dir)
    lanes = detail(bench.priced, bench.params, omsa="msa 1", dmsa="MSA 2 ").select("omsa", "dmsa")
    assert {tuple(row) for row in lanes.collect()} == {("MSA 1", "MSA 2")}

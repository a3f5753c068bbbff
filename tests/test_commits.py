from datetime import date

import pytest
from pyspark.sql import functions as F

from haulrate.sources.commits import CommitLog, LedgerTable, VersionedTable, Window
from haulrate.sources.sync import Table, append, fan_out, full_refresh


def _days(spark, first, last, price=1.0):
    return spark.sql(f"select explode(sequence(date'{first}', date'{last}')) day, {price}D price")


def _window(after, until):
    return Window(date.fromisoformat(after), date.fromisoformat(until))


def test_a_record_is_written_once_and_whole(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path / "log"))
    assert log.records() == {}
    assert log.commit("b", {"n": 1}) and log.commit("a", {"text": "ünï\n日"})
    assert not log.commit("b", {"n": 2})
    assert log.records() == {"a": {"text": "ünï\n日"}, "b": {"n": 1}}
    (tmp_path / "log" / ".half").write_text('{"n":')  # what a lost run leaves
    assert list(log.records()) == ["a", "b"]


def test_a_load_that_runs_again_adds_nothing_twice(spark, tmp_path):
    table = LedgerTable(spark, str(tmp_path / "fuel"))
    with pytest.raises(FileNotFoundError):
        table.read()
    rows = _days(spark, "2024-01-01", "2024-01-31")
    assert table.append(rows, "day", _window("2024-01-01", "2024-01-08"))
    assert not table.append(rows, "day", _window("2024-01-01", "2024-01-08"))
    assert table.append(rows, "day", _window("2024-01-05", "2024-01-12"))
    assert table.append(rows, "day", _window("2024-01-02", "2024-01-04"))  # adds no day
    days = [r.day for r in table.read().orderBy("day").collect()]
    assert days == [date(2024, 1, d) for d in range(2, 13)]


def test_a_lost_load_is_not_read_and_runs_again(spark, tmp_path, monkeypatch):
    table = LedgerTable(spark, str(tmp_path / "fuel"))
    window = _window("2024-01-01", "2024-01-08")
    good = _days(spark, "2024-01-01", "2024-01-31")
    assert table.append(good, "day", _window("2023-12-31", "2024-01-01"))
    broken = good.withColumn("price", F.when(F.col("day") < "2024-01-07", 1.0).otherwise(F.raise_error(F.lit("x")).cast("double")))
    with pytest.raises(Exception, match="x"):
        table.append(broken, "day", window)
    with monkeypatch.context() as patch:
        patch.setattr(table.ledger.__class__, "commit", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            table.append(good, "day", window)
    assert table.read().count() == 1
    assert table.append(good, "day", window) and table.read().count() == 8


def test_of_runs_at_the_same_time_one_commits(spark, tmp_path):
    folder = str(tmp_path / "fuel")
    window, rows = _window("2024-01-01", "2024-01-08"), _days(spark, "2024-01-01", "2024-01-31")
    table, other = LedgerTable(spark, folder), LedgerTable(spark, folder)
    known = table.ledger.records

    def overtaken():
        seen = known()
        if not seen:
            other.append(rows, "day", window)  # ends while the first run is at work
        return seen

    table.ledger.records = overtaken
    assert not table.append(rows, "day", window)
    assert other.read().count() == 7


def test_readers_never_see_a_refresh_at_work(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "parts"))
    assert table.version() == 0
    with pytest.raises(FileNotFoundError):
        table.read()
    assert table.refresh(spark.range(3)) == 1
    early = table.read()
    with pytest.raises(Exception, match="gone"):
        table.refresh(spark.range(9).select(F.when(F.col("id") < 8, F.col("id")).otherwise(F.raise_error(F.lit("gone")).cast("long")).alias("id")))
    assert table.version() == 1 and table.read().count() == 3
    assert table.refresh(spark.range(5)) == 2
    assert early.count() == 3 and table.read().count() == 5 and table.read(1).count() == 3
    assert table.refresh(table.read().where("id > 2")) == 3  # a refresh may read the table itself
    assert table.retire(keep=2) == 1 and table.read(2).count() == 5
    with pytest.raises(Exception):
        early.count()


def test_one_failing_target_stops_no_other_and_is_retried_alone(spark, tmp_path):
    def parquet(name):
        return Table(name, options={"path": str(tmp_path / name)})

    rows = spark.range(10).withColumn("x", F.lit(1))
    calls = []

    def load(df, target):
        calls.append(target.name)
        if target.name == "b" and calls.count("b") < 3:
            raise OSError("away")
        append(df, target)

    targets = [Table("a", "text", {"path": str(tmp_path / "a")}), parquet("b"), parquet("c")]
    status = fan_out(rows, targets, load, attempts=2)
    assert [tuple(r) for r in status.collect()] == [("a", 0, False), ("b", 0, False), ("c", 10, True)]
    assert calls == ["a", "b", "c", "a", "b"]

    calls.clear()
    state = CommitLog(spark, str(tmp_path / "state"))
    first = fan_out(rows, targets[1:], load, state=state)
    assert [tuple(r) for r in first.collect()] == [("b", 0, False, 1, "OSError"), ("c", 10, True, 1, None)]
    calls.append("b")
    again = fan_out(spark.range(0).withColumn("x", F.lit(1)), targets[1:], load, state=state)
    assert [tuple(r) for r in again.collect()] == [("b", 10, True, 1, None), ("c", 10, True, 0, None)]
    assert spark.read.parquet(str(tmp_path / "b")).count() == 10
    assert spark.read.parquet(str(tmp_path / "c")).count() == 20  # once by each of the two runs


def test_a_fan_out_of_no_targets_and_of_no_rows(spark, tmp_path):
    assert fan_out(spark.range(0), []).count() == 0
    target = Table("a", options={"path": str(tmp_path / "a")})
    assert [tuple(r) for r in fan_out(spark.range(0), [target], full_refresh).collect()] == [("a", 0, True)]

import datetime as dt

import pytest
from pyspark.sql import functions as F

from samples import at, ticks, values
from tickloom.functions.bands import PriceBands
from tickloom.operators import maintenance
from tickloom.operators.cleaning import clean_ticks
from tickloom.sources import tables, versions

DAY = 86400
D1, D2, D3 = (dt.date(2024, 1, k) for k in (1, 2, 3))
ROWS = [("A", 1.0, 1.0, at(0)), ("B", 2.0, 1.0, at(5)), ("A", 3.0, 1.0, at(DAY)), ("007", 4.0, 1.0, at(DAY + 1)), ("A", 5.0, 1.0, at(2 * DAY))]
RAW = ["symbol", "price", "volume", "timestamp"]


def raw(rows):
    return sorted(values(rows.select(RAW)))


@pytest.fixture
def table(spark, folder):
    path = f"{folder}/t"
    assert versions.overwrite(ticks(spark, ROWS), path, "ingest_date", ["symbol"], ["event_time"]) == 1
    return path


def test_whole_table_and_its_types(spark, table):
    back = versions.read_version(spark, table)
    assert raw(back) == sorted(ROWS)
    assert dict(back.dtypes) == dict(ticks(spark, ROWS).dtypes)  # "007" stays text


def test_parts_are_replaced_and_earlier_versions_stay(spark, table):
    new = [("C", 9.0, 1.0, at(DAY + 7))]
    assert versions.replace_parts(ticks(spark, new), table, "ingest_date", [D2], ["symbol"]) == 2
    assert versions.replace_parts(ticks(spark, ROWS).limit(0), table, "ingest_date", [D1, D3], ["symbol"]) == 3
    assert raw(versions.read_version(spark, table)) == new
    assert raw(versions.read_version(spark, table, 2)) == sorted([*ROWS[:2], ROWS[4], *new])
    assert raw(versions.read_version(spark, table, 1)) == sorted(ROWS)
    assert versions.overwrite(ticks(spark, ROWS[:1]), table, "ingest_date", ["symbol"]) == 4
    assert raw(versions.read_version(spark, table)) == ROWS[:1]


def test_a_write_that_fails_half_way_leaves_the_old_day(spark, table):
    late = F.when(F.col("price") > 3, F.raise_error(F.lit("lost disk"))).otherwise(F.col("price"))
    broken = ticks(spark, ROWS).repartition(4).withColumn("price", late)
    with pytest.raises(Exception, match="lost disk"):
        versions.replace_parts(broken, table, "ingest_date", [D1, D2, D3], ["symbol"])
    assert raw(versions.read_version(spark, table)) == sorted(ROWS)
    assert versions.latest_version(spark, table) == 1


def test_a_job_that_dies_before_its_manifest_leaves_the_old_day(spark, table, monkeypatch):
    def die(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as patched:
        patched.setattr(versions, "_record", die)
        with pytest.raises(KeyboardInterrupt):
            versions.replace_parts(ticks(spark, ROWS[:1]), table, "ingest_date", [D1], ["symbol"])
    assert raw(versions.read_version(spark, table)) == sorted(ROWS)
    # its files are in nobody's way and can be removed
    versions.replace_parts(ticks(spark, ROWS[1:2]), table, "ingest_date", [D1], ["symbol"])
    assert raw(versions.read_version(spark, table)) == sorted(ROWS[1:])
    assert versions.vacuum(spark, table) == []  # too young
    assert len(versions.vacuum(spark, table, older_than=dt.timedelta(0))) == 1
    assert raw(versions.read_version(spark, table)) == sorted(ROWS[1:])


def test_vacuum_keeps_the_versions_asked_for(spark, table):
    for k in range(3):
        versions.overwrite(ticks(spark, ROWS[: k + 1]), table, "ingest_date")
    assert len(versions.vacuum(spark, table, keep=2, older_than=dt.timedelta(0))) == 2
    assert [len(raw(versions.read_version(spark, table, v))) for v in (3, 4)] == [2, 3]


def test_a_row_of_another_partition_is_refused(spark, table):
    with pytest.raises(Exception, match="not replaced"):
        versions.replace_parts(ticks(spark, ROWS), table, "ingest_date", [D1], ["symbol"])
    with pytest.raises(ValueError):
        versions.replace_parts(ticks(spark, ROWS), table, "ingest_date", [])
    assert raw(versions.read_version(spark, table)) == sorted(ROWS)


def test_partition_without_a_day(spark, table):
    junk = [("A", 1.0, 1.0, None)]
    versions.replace_parts(ticks(spark, junk), table, "ingest_date", [None, D1], ["symbol"])
    got = versions.read_version(spark, table)
    assert got.count() == 4 and got.filter("ingest_date IS NULL").count() == 1
    versions.replace_parts(ticks(spark, junk).limit(0), table, "ingest_date", [None], ["symbol"])
    assert raw(versions.read_version(spark, table)) == sorted(ROWS[2:])


def test_two_writers_that_meet(spark, table, monkeypatch):
    latest, meeting = versions.latest_version, []

    def slow(*args):
        seen = latest(*args)
        if not meeting:  # another writer commits in between
            meeting.append(1)
            versions.replace_parts(ticks(spark, [("X", 1.0, 1.0, at(0))]), table, "ingest_date", [D1])
        return seen

    outcomes = []
    with monkeypatch.context() as patched:
        patched.setattr(versions, "latest_version", slow)
        try:
            versions.replace_parts(ticks(spark, [("Y", 1.0, 1.0, at(0))]), table, "ingest_date", [D1])
            outcomes.append("second")
        except versions.VersionConflict:
            outcomes.append("conflict")
    day = [row.symbol for row in versions.read_version(spark, table).filter(F.col("ingest_date") == F.lit(D1)).collect()]
    assert day == (["X"] if outcomes == ["conflict"] else ["Y"])


def test_pruning(spark, table):
    from tickloom.plans.inspect import pushed_filters

    versions.replace_parts(ticks(spark, ROWS[2:3]), table, "ingest_date", [D2], ["symbol"])
    one = versions.read_version(spark, table).filter(F.col("ingest_date") == F.lit(D2))
    assert "ingest_date" in " ".join(pushed_filters(one)) and raw(one) == [ROWS[2]]


def test_no_versions(spark, folder):
    assert not versions.has_versions(spark, f"{folder}/none") and versions.latest_version(spark, f"{folder}/none") == 0
    assert versions.vacuum(spark, f"{folder}/none") == [] and versions.newest_notes(spark, f"{folder}/none") == {}
    with pytest.raises(ValueError):
        versions.read_version(spark, f"{folder}/none")


def test_replay_of_a_plain_table_that_fails(spark, folder, monkeypatch):
    bronze = tables.write_table(ticks(spark, ROWS), f"{folder}/bronze", ["ingest_date"])
    open_bands = PriceBands({})
    plain = tables.write_table(clean_ticks(bronze, open_bands), f"{folder}/silver", ["ingest_date", "symbol"])
    broken = lambda rows, *_: rows.withColumn("price", F.raise_error(F.lit("no")).cast("double"))
    with monkeypatch.context() as patched:
        patched.setattr(maintenance, "_clean", broken)
        with pytest.raises(Exception, match="no"):
            maintenance.replay_silver_day(spark, f"{folder}/bronze", f"{folder}/silver", D1, open_bands)
    assert raw(plain) == raw(versions.read_version(spark, f"{folder}/silver")) == sorted(ROWS)
    maintenance.replay_silver_day(spark, f"{folder}/bronze", f"{folder}/silver", D1, PriceBands({"A": 100.0}))
    assert raw(versions.read_version(spark, f"{folder}/silver")) == sorted(ROWS[1:])

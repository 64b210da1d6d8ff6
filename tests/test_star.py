import datetime as dt

import pytest
from pyspark.sql import functions as F

from samples import at, clock, ticks, values
from tickloom.operators import star
from tickloom.operators.lookup import measured_bytes
from tickloom.plans.inspect import plan_text, scanned_columns

DAY = 86400
ROWS = [
    ("BTCUSDT", 1.0, 10.0, at(0.2)), ("BTCUSDT", 2.0, 20.0, at(0.7)), ("ETHUSDT", 3.0, 40.0, at(0)),
    ("BTCUSDT", 4.0, 1.0, at(DAY)), ("ETHUSDT", 5.0, 2.0, at(DAY)),
]


@pytest.fixture
def written(spark, folder):
    return star.write_star(ticks(spark, ROWS), folder)


def test_dimensions(written):
    assert values(written["dim_time"], "time_key") == [
        (clock(0), 2024, 1, 1, 0, 0, 2), (clock(DAY), 2024, 1, 2, 0, 0, 3),
    ]
    assert values(written["dim_symbol"], "symbol_key") == [("BTCUSDT", "BTC", "USDT"), ("ETHUSDT", "ETH", "USDT")]
    assert values(written["dim_market"]) == [("BINANCE_SPOT", "Binance", "SPOT", "USD")]


def test_facts_keep_every_tick_and_are_split_by_day(spark, folder, written):
    facts = written["fact_ticks"]
    assert facts.columns == ["time_key", "symbol_key", "market_key", "price", "volume", "ingest_date"]
    assert facts.count() == len(ROWS)
    pruned = plan_text(facts.filter(F.col("ingest_date") == F.lit(dt.date(2024, 1, 2))))
    assert "ingest_date" in pruned.split("PartitionFilters:")[1].split("\n")[0]


def test_writing_again_replaces(spark, folder, written):
    again = star.write_star(ticks(spark, ROWS[:2]), folder)
    assert {name: rows.count() for name, rows in again.items()} == {
        "dim_time": 1, "dim_symbol": 1, "dim_market": 1, "fact_ticks": 2,
    }


def test_volume_by_asset(written):
    got = star.volume_by_asset(written["fact_ticks"], written["dim_symbol"])
    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    assert values(got) == [(d1, "ETH", 40.0, 1), (d1, "BTC", 30.0, 2), (d2, "ETH", 2.0, 1), (d2, "BTC", 1.0, 1)]


def test_facts_are_summed_before_the_join(written):
    rows = star.volume_by_asset(written["fact_ticks"], written["dim_symbol"])
    tree = plan_text(rows).split("\n\n")[0]
    join = tree.index("BroadcastHashJoin")
    assert "HashAggregate" in tree[join:]
    assert scanned_columns(rows)[0] == "symbol_key:string,volume:double"


def test_full_star_has_every_column_and_row(written):
    rows = star.full_star(*(written[n] for n in ("fact_ticks", "dim_time", "dim_symbol", "dim_market")))
    assert rows.count() == len(ROWS)
    wanted = {c for table in written.values() for c in table.columns}
    assert set(rows.columns) == wanted
    assert "SortMergeJoin" not in plan_text(rows)


def test_calendar_sums_agree_with_the_full_star(written):
    tables = [written[n] for n in ("fact_ticks", "dim_time", "dim_symbol", "dim_market")]
    labels = ["exchange", "venue_type", "settlement_currency", "base_asset", "quote_asset", "weekday", "hour"]
    plain = star.full_star(*tables).groupBy(*labels).agg(
        F.round(F.sum("volume"), 2).alias("total_volume"), F.count(F.lit(1)).alias("n_ticks")
    )
    for limit in (10**9, 0):
        assert values(star.volume_by_calendar(*tables, broadcast_bytes=limit)) == values(plain, *labels)


def test_a_long_calendar_moves_no_fact(spark, folder):
    seconds = [("BTCUSDT", 1.0, 1.0, at(7 * k)) for k in range(5000)]
    tables = star.write_star(ticks(spark, seconds), folder)
    full = [tables[n] for n in ("fact_ticks", "dim_time", "dim_symbol", "dim_market")]
    limit = 200_000
    assert measured_bytes(tables["dim_time"]) > limit
    rows = star.full_star(*full, broadcast_bytes=limit)
    tree = plan_text(rows).split("\n\n")[0]
    assert tree.count("BroadcastHashJoin") == 4 and "SortMergeJoin" not in tree
    plain = full[0].join(full[2], "symbol_key").join(full[3], "market_key").join(full[1], "time_key")
    columns = sorted(plain.columns)
    assert values(rows.select(*columns), "time_key") == values(plain.select(*columns), "time_key")


def test_the_stored_calendar_spares_the_time_dimension(spark, folder, written):
    calendar = star.read_calendar(spark, folder)
    rows = star.full_star(written["fact_ticks"], calendar, written["dim_symbol"], written["dim_market"])
    assert "dim_time" not in plan_text(rows) and "dim_day" in plan_text(rows)
    plain = star.full_star(*(written[n] for n in ("fact_ticks", "dim_time", "dim_symbol", "dim_market")))
    assert sorted(values(rows)) == sorted(values(plain))


def test_a_star_grows_by_its_new_keys(spark, folder):
    star.write_star(ticks(spark, ROWS[:3]), folder)
    files = {row[0] for row in star.read_star(spark, folder)["dim_time"].select(F.input_file_name()).distinct().collect()}
    later = [*ROWS[3:], ("SOLUSDT", 7.0, 1.0, at(2 * DAY)), ("SOLUSDT", 7.0, 1.0, None)]
    for _ in range(2):  # again, as after a failure
        grown = star.add_to_star(ticks(spark, later), folder)
        whole = star.write_star(ticks(spark, [*ROWS[:3], *later]), f"{folder}/whole")
        for name, rows in whole.items():
            assert sorted(values(grown[name].select(rows.columns)), key=str) == sorted(values(rows), key=str), name
        for name in ("days", "minutes"):
            tables = [getattr(star.read_calendar(spark, root), name) for root in (folder, f"{folder}/whole")]
            assert len({tuple(sorted(values(table), key=str)) for table in tables}) == 1
    kept = {row[0] for row in star.read_star(spark, folder)["dim_time"].select(F.input_file_name()).distinct().collect()}
    assert files <= kept  # what was known has not been written again


def test_only_keys_near_the_new_ones_are_read(spark, folder, written):
    rows = star.dim_time(ticks(spark, ROWS[3:]))
    star.append_new(rows, f"{folder}/dim_time", "time_key", ordered=True)
    assert spark.read.parquet(f"{folder}/dim_time").count() == 2
    star.append_new(rows.limit(0), f"{folder}/dim_time", "time_key", ordered=True)
    assert spark.read.parquet(f"{folder}/dim_time").count() == 2

import datetime as dt

import pytest
from pyspark.sql import functions as F

from samples import PUBLISHED, START, messages, ticks, values
from tickloom.functions.clock import calendar_parts, event_time
from tickloom.functions.pairs import split_pair
from tickloom.operators.cleaning import clean_ticks
from tickloom.operators.ticks import decode_messages, encode_messages, normalise_payloads
from tickloom.plans.inspect import plan_text
from tickloom.sources.schemas import TICK

FIELDS = ["symbol", "price", "volume", "timestamp"]


def test_messages_survive_a_round_trip(spark):
    sent = ticks(spark, PUBLISHED)
    carried = encode_messages(sent, F.lit("2026-04-23 10:28:40").cast("timestamp").alias("timestamp"))
    assert carried.dtypes[:2] == [("key", "binary"), ("value", "binary")]
    back = decode_messages(carried)
    assert sorted(values(back.select(FIELDS))) == sorted(PUBLISHED)
    assert back.columns == FIELDS + ["kafka_ts", "event_time", "ingest_date"]


def test_rows_in_memory_must_fit_the_tick_schema(spark):
    assert sorted(values(spark.createDataFrame(PUBLISHED, TICK))) == sorted(PUBLISHED)
    with pytest.raises(Exception, match="price"):
        spark.createDataFrame([("A", None, 1.0, START)], TICK).count()


def test_key_is_the_symbol(spark):
    keys = encode_messages(ticks(spark, PUBLISHED)).select(F.col("key").cast("string"))
    assert {row[0] for row in keys.collect()} == {row[0] for row in PUBLISHED}


def test_junk_becomes_nulls_and_no_row_is_lost(spark):
    texts = ["junk", None, "", "[]", '{"symbol":"C"}', '{"symbol":"B","price":"x","volume":2.0,"timestamp":1}']
    rows = values(decode_messages(messages(spark, texts)).select(FIELDS))
    assert len(rows) == len(texts)
    assert rows.count((None, None, None, None)) == 4
    assert ("C", None, None, None) in rows
    assert ("B", None, 2.0, 1) in rows


def test_junk_has_no_date_and_is_not_clean(spark):
    parsed = decode_messages(messages(spark, ["junk", PUBLISHED[0]]))
    assert parsed.filter("ingest_date IS NULL").count() == 1
    assert clean_ticks(parsed).count() == 1


def test_each_message_is_parsed_once(spark):
    plan = plan_text(clean_ticks(decode_messages(messages(spark, PUBLISHED))))
    assert plan.count("from_json") == 1


def test_event_time_drops_or_keeps_milliseconds(spark):
    row = (
        spark.createDataFrame([(1776940116613,)], "t BIGINT")
        .select(event_time(F.col("t")).alias("s"), event_time(F.col("t"), "millisecond").alias("ms"))
        .select(F.unix_micros("s"), F.unix_micros("ms"))
        .first()
    )
    assert tuple(row) == (1776940116000000, 1776940116613000)


def test_absurd_timestamps_do_not_stop_a_job(spark):
    rows = spark.createDataFrame([(2**63 - 1,), (-(2**63),), (None,), (0,)], "t BIGINT")
    for precision in ("second", "millisecond"):
        got = rows.select(F.unix_micros(event_time(F.col("t"), precision))).collect()
        assert [row[0] for row in got] == [None, None, None, 0]


def test_unknown_precision_is_refused(spark):
    with pytest.raises(ValueError):
        event_time(F.col("t"), "minute")


def test_ingest_date_follows_utc(spark):
    late = ticks(spark, [("A", 1.0, 1.0, START - 1), ("B", 1.0, 1.0, START)])
    assert values(late.select("ingest_date"), "symbol") == [
        (dt.date(2023, 12, 31),),
        (dt.date(2024, 1, 1),),
    ]


def test_weekday_counts_from_sunday(spark):
    days = spark.sql("SELECT timestamp'2024-01-07 23:59:00' AS t UNION ALL SELECT timestamp'2024-01-06 00:00:00'")
    got = days.select(*(c.alias(n) for n, c in calendar_parts(F.col("t")).items()))
    assert values(got, "day") == [(2024, 1, 6, 0, 0, 7), (2024, 1, 7, 23, 59, 1)]


def test_pair_split(spark):
    rows = spark.createDataFrame([("BTCUSDT",), ("AB",), ("ETHBTC",), (None,)], "s STRING")
    fixed, listed = split_pair(F.col("s")), split_pair(F.col("s"), ["BTC", "USDT"])
    got = rows.select(*fixed, *listed)
    assert values(got) == [
        ("BTC", "USDT", "BTC", "USDT"),
        ("", "B", "", "B"),
        ("ET", "HBTC", "ETH", "BTC"),
        (None, None, None, None),
    ]


def test_payloads_become_ticks(spark):
    texts = [
        '{"symbol":"BTCUSDT","lastPrice":"77379.31","volume":"18422.16","closeTime":1776940115002,"count":7}',
        '{"symbol":"ETHUSDT","lastPrice":"n/a","volume":"1","closeTime":5}',
        "not json",
    ]
    payloads = spark.createDataFrame([(text,) for text in texts], "payload STRING")
    got = normalise_payloads(payloads)
    assert got.dtypes == [("symbol", "string"), ("price", "double"), ("volume", "double"), ("timestamp", "bigint")]
    assert values(got) == [
        ("BTCUSDT", 77379.31, 18422.16, 1776940115002),
        ("ETHUSDT", None, 1.0, 5),
        (None, None, None, None),
    ]

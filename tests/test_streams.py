import subprocess
import sys

import pyarrow as pa
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from samples import PUBLISHED, arrive, at, clock, messages, stream, ticks, values
from tickloom.functions.bands import PriceBands
from tickloom.operators import windows
from tickloom.operators.cleaning import clean_ticks
from tickloom.operators.ticks import decode_messages
from tickloom.sources.tables import has_sink_log, read_if_ready
from tickloom.streaming import dedup, medallion, observe, runtime

OPEN = PriceBands({})
RAW = ["symbol", "price", "volume", "timestamp"]
GOLD = ["symbol", "window_start", "window_end", "avg_price", "n_ticks", "window_date"]


def run_layers(spark, root, layers=medallion.LAYERS, bands=OPEN, **kwargs):
    started = medallion.start_medallion(
        stream(spark, f"{root}/inbox"), root, bands, live=False, layers=layers, **kwargs
    )
    runtime.run_to_end(*started.values())
    return started


def gold(spark, root):
    return spark.read.parquet(medallion.GOLD.path(root))


def test_layers_hold_what_the_batch_transforms_give(spark, folder):
    sent = [("A", 2.0, 1.0, at(s)) for s in range(0, 400, 7)] + [("B", -1.0, 1.0, at(5)), "junk", None]
    arrive(spark, sent, f"{folder}/inbox")
    started = run_layers(spark, folder)
    assert set(started) == {"bronze", "silver", "gold"}
    bronze = spark.read.parquet(medallion.BRONZE.path(folder))
    silver = spark.read.parquet(medallion.SILVER.path(folder))
    assert bronze.count() == len(sent)
    assert bronze.columns == RAW + ["event_time", "ingest_date"]
    clean = clean_ticks(medallion.bronze_rows(messages(spark, sent)), OPEN)
    assert sorted(values(silver.select(RAW))) == sorted(values(clean.select(RAW)))
    expected = windows.closed_windows(windows.sliding_average(clean), clean)
    assert values(gold(spark, folder).select(GOLD), "window_start") == values(expected.select(GOLD), "window_start")


def test_partition_folders(spark, folder):
    arrive(spark, ["junk", *PUBLISHED], f"{folder}/inbox")
    run_layers(spark, folder)
    bronze = spark.read.parquet(medallion.BRONZE.path(folder)).select(F.input_file_name()).distinct()
    names = {row[0].split("/")[-2] for row in bronze.collect()}
    assert names == {"ingest_date=2026-04-23", "ingest_date=__HIVE_DEFAULT_PARTITION__"}
    silver = spark.read.parquet(medallion.SILVER.path(folder)).select(F.input_file_name()).distinct()
    assert {tuple(row[0].split("/")[-3:-1]) for row in silver.collect()} == {
        ("ingest_date=2026-04-23", f"symbol={row[0]}") for row in PUBLISHED
    }
    assert has_sink_log(spark, medallion.SILVER.path(folder))


def test_restart_reads_only_what_is_new(spark, folder):
    arrive(spark, PUBLISHED, f"{folder}/inbox")
    run_layers(spark, folder, [medallion.BRONZE])
    arrive(spark, [("A", 1.0, 1.0, at(0))], f"{folder}/inbox")
    second = run_layers(spark, folder, [medallion.BRONZE])["bronze"]
    assert [p["numInputRows"] for p in second.recentProgress] == [1]
    run_layers(spark, folder, [medallion.BRONZE])
    assert spark.read.parquet(medallion.BRONZE.path(folder)).count() == len(PUBLISHED) + 1


def test_restart_keeps_open_windows(spark, folder):
    arrive(spark, [("A", 1.0, 1.0, at(0)), ("A", 2.0, 1.0, at(61))], f"{folder}/inbox")
    run_layers(spark, folder, [medallion.GOLD])
    assert read_if_ready(spark, medallion.GOLD.path(folder)) is None  # no window is final yet
    arrive(spark, [("A", 4.0, 1.0, at(65)), ("A", 9.0, 1.0, at(1000))], f"{folder}/inbox")
    run_layers(spark, folder, [medallion.GOLD])
    row = gold(spark, folder).filter(F.col("window_start") == F.lit(clock(30))).first()
    assert (row.avg_price, row.n_ticks) == (3.0, 2)


def test_a_late_row_is_dropped_per_window(spark, folder):
    # The watermark is 00:08:00; the late row at 00:07:35 has windows ending 07:40 to 08:30.
    arrive(spark, [("A", 1.0, 1.0, at(600))], f"{folder}/inbox")
    run_layers(spark, folder, [medallion.GOLD])
    arrive(spark, [("A", 5.0, 1.0, at(455)), ("A", 5.0, 1.0, at(60))], f"{folder}/inbox")
    query = run_layers(spark, folder, [medallion.GOLD])["gold"]
    dropped = runtime.progress_table(spark, [query]).agg(F.sum("rows_dropped_by_watermark")).first()[0]
    assert dropped == 3 + 6
    arrive(spark, [("A", 1.0, 1.0, at(2000))], f"{folder}/inbox")
    run_layers(spark, folder, [medallion.GOLD])
    kept = gold(spark, folder).filter("avg_price = 5.0")
    assert [row.window_end for row in kept.orderBy("window_end").collect()] == [clock(490), clock(500), clock(510)]


def test_update_mode_ends_at_the_batch_result(spark, folder):
    batches = [[("A", 1.0, 1.0, at(0)), ("B", 1.0, 1.0, at(3))], [("A", 4.0, 1.0, at(5))]]
    for batch in batches:
        arrive(spark, batch, f"{folder}/inbox")
        rows = windows.sliding_average_stream(decode_messages(stream(spark, f"{folder}/inbox")))
        runtime.run_to_end(runtime.start_changes(rows, "u", f"{folder}/out", f"{folder}/check"))
    changes = spark.read.parquet(f"{folder}/out")
    assert changes.filter("symbol = 'B'").select("batch_id").distinct().count() == 1  # changed once
    latest = runtime.latest_changes(changes, ["symbol", "window_start", "window_end"])
    expected = windows.sliding_average(ticks(spark, sum(batches, [])))
    order = ("symbol", "window_start")
    assert values(latest.select(GOLD), *order) == values(expected.select(GOLD), *order)


def test_complete_mode_gives_the_whole_table(spark, folder):
    batches = [[("A", 1.0, 1.0, at(0)), ("B", 1.0, 1.0, at(3))], [("A", 4.0, 1.0, at(5))], [("C", 4.0, 1.0, at(5))]]
    for n, batch in enumerate(batches, 1):
        arrive(spark, batch, f"{folder}/inbox")
        rows = windows.running_stats(decode_messages(stream(spark, f"{folder}/inbox")))
        runtime.run_to_end(runtime.start_snapshots(rows, "s", f"{folder}/out", f"{folder}/check"))
        got = runtime.latest_snapshot(spark, f"{folder}/out")
        expected = windows.running_stats(ticks(spark, sum(batches[:n], [])))
        assert got.columns == expected.columns
        assert values(got, "symbol") == values(expected, "symbol")


def test_parquet_sink_refuses_complete_mode(spark, folder):
    arrive(spark, PUBLISHED, f"{folder}/inbox")
    rows = windows.running_stats(decode_messages(stream(spark, f"{folder}/inbox")))
    with pytest.raises(Exception, match="(?i)output mode"):
        rows.writeStream.format("parquet").outputMode("complete").option("path", f"{folder}/x").option(
            "checkpointLocation", f"{folder}/c"
        ).start()


def test_repeats_are_dropped_within_and_across_batches(spark, folder):
    a, b = ("A", 1.0, 1.0, at(0)), ("B", 2.0, 1.0, at(1))
    for batch in ([a, a, b], [a, b, ("A", 1.0, 1.0, at(2))]):
        arrive(spark, batch, f"{folder}/inbox")
        rows = dedup.drop_repeats_stream(medallion.bronze_rows(stream(spark, f"{folder}/inbox")))
        runtime.run_to_end(runtime.start_table(rows, "d", f"{folder}/out", f"{folder}/check"))
    got = spark.read.parquet(f"{folder}/out")
    assert got.columns == RAW + ["event_time", "ingest_date"]
    assert sorted(values(got.select(RAW))) == sorted([a, b, ("A", 1.0, 1.0, at(2))])


def test_layers_without_repeats(spark, folder):
    rows = [("A", float(s % 5 + 1), 1.0, at(s)) for s in range(0, 500, 7)]
    arrive(spark, rows * 2, f"{folder}/inbox")
    run_layers(spark, folder, once=True)
    assert spark.read.parquet(medallion.BRONZE.path(folder)).count() == 2 * len(rows)
    silver = spark.read.parquet(medallion.SILVER.path(folder))
    # a tick is held until event time is two minutes past its ten seconds
    assert sorted(values(silver.select(RAW))) == sorted(row for row in rows if row[3] // 10_000 * 10 + 130 <= rows[-1][3] // 1000)
    clean = ticks(spark, rows)
    # without repeats a window is final one window length later, so that no tick it could hold is lost
    expected = windows.closed_windows(windows.sliding_average(clean), clean, medallion.GOLD_MEMORY_SECONDS)
    assert values(gold(spark, folder).select(GOLD), "window_start") == values(expected.select(GOLD), "window_start")


def test_copies_are_merged_before_the_stateful_shuffle(spark, folder):
    arrive(spark, [("A", 1.0, 1.0, at(0))] * 5000 + [("B", 1.0, 1.0, at(0)), "junk", "junk"], f"{folder}/inbox")
    rows = dedup.drop_repeats_stream(medallion.bronze_rows(stream(spark, f"{folder}/inbox")))
    query = runtime.start_table(rows, "d", f"{folder}/out", f"{folder}/check")
    runtime.run_to_end(query)
    state = query.recentProgress[0]["stateOperators"][0]
    assert spark.read.parquet(f"{folder}/out").count() == 4  # junk has no key, so it repeats nothing
    assert state["customMetrics"]["numDroppedDuplicateRows"] == 0


def test_late_ticks_and_null_keys_survive_once(spark, folder):
    batches = [[("A", 1.0, 1.0, at(1000)), (None, 2.0, 1.0, at(1000))], [("A", 3.0, 1.0, at(10)), (None, 4.0, 1.0, None)], [("A", 5.0, 1.0, at(2000))]]
    for batch in batches:
        arrive(spark, batch, f"{folder}/inbox")
        run_layers(spark, folder, [medallion.SILVER], once=True)
    silver = spark.read.parquet(medallion.SILVER.path(folder))
    assert sorted(row.price for row in silver.collect()) == [1.0, 2.0, 3.0, 4.0]  # the last one is still held


def test_silver_with_hundreds_of_anchors(spark, folder):
    arrive(spark, [("S7", 100.0, 1.0, at(0)), ("S7", 900.0, 1.0, at(1)), ("X", 5.0, 1.0, at(2))], f"{folder}/inbox")
    anchors = spark.createDataFrame([(f"S{k}", 100.0) for k in range(400)], "symbol string, anchor_price double")
    rows = medallion.silver_rows(stream(spark, f"{folder}/inbox"), anchors=anchors)
    runtime.run_to_end(runtime.start_table(rows, "s", f"{folder}/out", f"{folder}/check"))
    assert sorted(row.price for row in spark.read.parquet(f"{folder}/out").collect()) == [5.0, 100.0]


def test_merging_needs_no_package_on_the_executors(folder):
    batch = pa.record_batch({"k": ["a", "b", "a", None, None], "n": [1, 2, 3, 4, 5]})
    with open(f"{folder}/fn", "wb") as out:
        out.write(cloudpickle.dumps((dedup.merge_copies(("k",)), batch)))
    code = (
        "import pickle, sys; fn, batch = pickle.load(open(sys.argv[1], 'rb'));"
        "print([b.column('n').to_pylist() for b in fn([batch])], 'tickloom' in sys.modules)"
    )
    done = subprocess.run(
        [sys.executable, "-c", code, f"{folder}/fn"], cwd=folder, capture_output=True, text=True, timeout=60
    )
    assert done.stdout.strip() == "[[1, 2, 4]] False", done.stderr


def test_live_queries_run_side_by_side_and_stop(spark, folder):
    arrive(spark, PUBLISHED, f"{folder}/inbox")
    started = medallion.start_medallion(stream(spark, f"{folder}/inbox"), folder)
    assert {q.name for q in spark.streams.active} == {"bronze_parquet", "silver_parquet", "gold_parquet"}
    for query in started.values():
        query.processAllAvailable()
    runtime.stop_all(started.values())
    assert not any(query.isActive for query in started.values())
    progress = runtime.progress_table(spark, started.values())
    assert progress.filter("input_rows = 5").select("query").distinct().count() == 3
    assert progress.filter("sources LIKE '%inbox%'").count() == progress.count()


def test_console(spark, folder):
    arrive(spark, PUBLISHED, f"{folder}/inbox")
    rows = windows.running_stats(decode_messages(stream(spark, f"{folder}/inbox")))
    query = runtime.start_console(rows, "console", f"{folder}/check", "complete", n_rows=3)
    runtime.run_to_end(query)
    assert query.recentProgress[0]["sink"]["description"].startswith("org.apache.spark.sql.execution.streaming")


def test_interval_trigger(spark, folder):
    arrive(spark, PUBLISHED, f"{folder}/inbox")
    query = runtime.start_console(
        decode_messages(stream(spark, f"{folder}/inbox")), "timed", f"{folder}/check", every="1 second"
    )
    query.processAllAvailable()
    assert query.isActive
    runtime.stop_all([query])


def test_files_per_trigger_make_batches(spark, folder):
    for s in range(3):
        arrive(spark, [("A", 1.0, 1.0, at(s))], f"{folder}/inbox")
    rows = medallion.bronze_rows(stream(spark, f"{folder}/inbox", maxFilesPerTrigger="1"))
    query = runtime.start_table(rows, "b", f"{folder}/out", f"{folder}/check")
    runtime.run_to_end(query)
    assert [p["numInputRows"] for p in query.recentProgress] == [1, 1, 1]


def test_state_is_on_rocksdb_with_the_asked_partitions(spark, folder):
    arrive(spark, [("A", 1.0, 1.0, at(0)), ("A", 1.0, 1.0, at(130))], f"{folder}/inbox")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    run_layers(spark, folder, [medallion.GOLD], state_partitions=3)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    checkpoint = medallion.GOLD.checkpoint_path(folder)
    operators = observe.state_operators(spark, checkpoint).collect()
    assert [row.numPartitions for row in operators] == [3]
    still_open = observe.open_windows(spark, checkpoint)
    assert {row.window_end for row in still_open.collect()} == {clock(s) for s in (20, 30, 40, 50, 60, 140, 150, 160, 170, 180, 190)}
    files = observe.checkpoint_files(spark, checkpoint)
    assert {"offsets", "commits", "state", "metadata"} <= {row.folder for row in files.collect()}
    assert files.filter("file = 'offsets/0'").first().bytes > 0
    by_url = observe.checkpoint_files(spark, f"file://{checkpoint}/")
    assert sorted(values(by_url)) == sorted(values(files))


def test_lag_with_a_fixed_now(spark):
    seen = decode_messages(messages(spark, [("A", 1.0, 1.0, at(0.9))], broker_time="2024-01-01 00:00:05.9"))
    assert observe.with_lag(seen, "2024-01-01 00:01:00.5").first().lag_seconds == 60
    split = observe.with_split_lag(seen, "2024-01-01 00:01:00.5")
    assert split.columns == ["symbol", "price", "kafka_ts", "now", "kafka_to_spark_s", "api_freshness_s"]
    assert tuple(split.first())[4:] == (55, 5)
    assert observe.with_lag(seen).first().lag_seconds > 0


def test_offset_span(spark):
    rows = messages(spark, PUBLISHED).unionByName(messages(spark, PUBLISHED[:2], topic="other"))
    assert values(observe.offset_span(rows)) == [("financial_data", 0, 0, 5, 5), ("other", 0, 0, 2, 2)]


def test_offsets_with_holes_and_repeats(spark):
    offsets = [0, 1, 1, 5, 9, 10, 10, 10, 11, 30, None]
    rows = spark.createDataFrame([("t", 0, o) for o in offsets] + [("t", 1, 7), (None, 0, 3), (None, 0, 5)], "topic STRING, partition INT, offset BIGINT")
    for size in (1, 4, 1000):
        assert values(observe.offset_report(rows, size)) == [
            (None, 0, 3, 6, 3, 2, 2, 0, 1, 1),
            ("t", 0, 0, 31, 31, 11, 7, 3, 24, 3),
            ("t", 1, 7, 8, 1, 1, 1, 0, 0, 0),
        ]
        assert values(observe.offset_gaps(rows, size), "topic", "partition", "first_missing") == [
            (None, 0, 4, 4), ("t", 0, 2, 4), ("t", 0, 6, 8), ("t", 0, 12, 29),
        ]
    nothing = observe.offset_report(rows.filter("offset IS NULL"))
    assert values(nothing) == [("t", 0, None, None, None, 1, 0, 0, 0, 0)]
    assert observe.offset_report(rows.limit(0)).count() == observe.offset_gaps(rows.limit(0)).count() == 0


def test_failed_query_raises(spark, folder):
    arrive(spark, PUBLISHED, f"{folder}/inbox")

    def fail(batch, batch_id):
        raise RuntimeError("boom")

    query = runtime.start_batches(
        decode_messages(stream(spark, f"{folder}/inbox")), "bad", f"{folder}/check", "append", fail
    )
    with pytest.raises(Exception, match="boom"):
        runtime.run_to_end(query)

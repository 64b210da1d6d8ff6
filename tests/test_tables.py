import datetime as dt
import uuid

import pyarrow.parquet as pq
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from samples import PUBLISHED, arrive, at, messages, stream, ticks, values
from tickloom.functions.bands import PriceBands
from tickloom.operators import maintenance, windows
from tickloom.operators.cleaning import clean_ticks
from tickloom.session import settings, work_folder
from tickloom.sources import catalog, tables, versions
from tickloom.sources.messages import broker_options, read_messages
from tickloom.streaming import medallion, runtime

DAY = 86400
D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
ROWS = [
    ("A", 1.0, 1.0, at(0)), ("A", 9.0, 1.0, at(60)), ("B", 2.0, 1.0, at(0)),
    ("A", 1.5, 1.0, at(DAY)), ("B", 9.0, 1.0, at(DAY + 30)),
]
WIDE, TIGHT = PriceBands({"A": 1.0, "B": 1.0}, 0.1, 10.0), PriceBands({"A": 1.0, "B": 1.0}, 0.5, 1.9)
RAW = ["symbol", "price", "volume", "timestamp"]


def files_of(rows):
    return rows.select(F.input_file_name()).distinct().count()


def test_not_ready_and_ready(spark, folder):
    assert tables.read_if_ready(spark, f"{folder}/none") is None
    spark.range(3).write.parquet(f"{folder}/t")
    assert tables.read_if_ready(spark, f"{folder}/t").count() == 3


def test_other_read_errors_surface(spark, folder):
    with pytest.raises(Exception) as caught:
        tables.read_if_ready(spark, "nosuchscheme://x/y")
    assert not isinstance(caught.value, AnalysisException) or caught.value.getCondition() not in tables.NOT_READY


def test_partition_values_keep_their_type(spark, folder):
    rows = ticks(spark, [("007", 1.0, 1.0, at(0))])
    back = tables.write_table(rows, f"{folder}/t", ["ingest_date", "symbol"])
    assert dict(back.dtypes) == dict(rows.dtypes)
    assert back.first().symbol == "007"


def test_empty_table_can_be_read_back(spark, folder):
    rows = ticks(spark, ROWS).limit(0)
    back = tables.write_table(rows, f"{folder}/t", ["ingest_date"])
    assert back.count() == 0 and dict(back.dtypes) == dict(rows.dtypes)


def test_pruning_by_partition_and_column(spark, folder):
    from tickloom.plans.inspect import pushed_filters, scanned_columns

    tables.write_table(ticks(spark, ROWS), f"{folder}/t", ["ingest_date", "symbol"])
    rows = tables.read_table(spark, f"{folder}/t")
    some = rows.filter((F.col("ingest_date") == F.lit(D1)) & (F.col("symbol") == "A") & (F.col("price") > 2)).select("price")
    assert scanned_columns(some) == ["price:double"]
    text = " ".join(pushed_filters(some))
    assert "ingest_date" in text and "symbol" in text and "GreaterThan(price,2.0)" in text
    assert some.count() == 1


def test_view(spark):
    assert tables.name_view(ticks(spark, ROWS), "some_ticks").count() == len(ROWS)
    assert spark.sql("SELECT max(price) FROM some_ticks").first()[0] == 9.0


def test_register_list_and_repair(spark, folder):
    database = "t" + uuid.uuid4().hex
    spark.sql(f"CREATE DATABASE {database} LOCATION '{folder}/db'")
    root = f"{folder}/la'ke"
    tables.write_table(ticks(spark, ROWS), f"{root}/bronze/ticks", ["ingest_date"])
    tables.write_table(ticks(spark, ROWS), f"{root}/gold_star/dim_time")
    for _ in range(2):
        outcome = catalog.register_tables(spark, root, database)
        assert outcome["bronze_ticks"] == outcome["dim_time"] == "registered"
        assert set(outcome.values()) == {"registered", "not ready"}
    listed = catalog.list_tables(spark, database).filter("NOT isTemporary")
    assert {row.tableName for row in listed.collect()} == {"bronze_ticks", "dim_time"}
    assert spark.table(f"{database}.bronze_ticks").count() == len(ROWS)
    assert not catalog.repair_partitions(spark, "dim_time", database)
    later = ticks(spark, [("A", 1.0, 1.0, at(5 * DAY))])
    later.write.mode("append").partitionBy("ingest_date").parquet(f"{root}/bronze/ticks")
    assert catalog.repair_partitions(spark, "bronze_ticks", database)
    spark.catalog.refreshTable(f"{database}.bronze_ticks")
    assert spark.table(f"{database}.bronze_ticks").count() == len(ROWS) + 1


def test_stream_layer_can_be_registered(spark, folder):
    database = "t" + uuid.uuid4().hex
    spark.sql(f"CREATE DATABASE {database} LOCATION '{folder}/db'")
    stream_silver(spark, folder, [PUBLISHED])
    assert catalog.register_tables(spark, folder, database)["silver_ticks"] == "registered"
    assert spark.table(f"{database}.silver_ticks").count() == len(PUBLISHED)


def stream_silver(spark, folder, batches):
    for batch in batches:
        arrive(spark, batch, f"{folder}/inbox")
        started = medallion.start_medallion(
            stream(spark, f"{folder}/inbox"), folder, PriceBands({}), live=False, layers=[medallion.SILVER]
        )
        runtime.run_to_end(*started.values())
    return medallion.SILVER.path(folder)


def test_compaction_gives_the_same_rows_in_fewer_files(spark, folder):
    silver = stream_silver(spark, folder, [[row] * 3 for row in ROWS] * 2)
    keys = list(medallion.SILVER.partition_by)
    small = spark.read.parquet(silver)
    merged = maintenance.compact(spark, silver, f"{folder}/merged", keys)
    assert sorted(values(merged.select(RAW))) == sorted(values(small.select(RAW)))
    assert files_of(small) == 10 and files_of(merged) == 4
    one_day = maintenance.compact(
        spark, silver, f"{folder}/day", keys, finished=F.col("ingest_date") < F.lit(D2)
    )
    assert {row.ingest_date for row in one_day.collect()} == {D1}


def test_compacted_files_are_in_time_order(spark, folder):
    rows = [(symbol, 1.0, 1.0, at((s * 37) % 101)) for s in range(101) for symbol in ("A", "B")]
    ticks(spark, rows).repartition(6).write.parquet(f"{folder}/in")
    out = maintenance.compact(
        spark, f"{folder}/in", f"{folder}/out", ["ingest_date", "symbol"], sort_by=["timestamp"]
    )
    files = {row[0] for row in out.select(F.input_file_name()).distinct().collect()}
    assert len(files) == 2
    for file in files:
        times = pq.ParquetFile(file.removeprefix("file://")).read(["timestamp"]).column(0).to_pylist()
        assert times == [at(s) for s in range(101)]


def test_compaction_splits_a_hot_partition(spark, folder):
    hot = spark.range(300_000).select(
        F.lit("A").alias("symbol"), F.rand(1).alias("price"), F.rand(2).alias("volume"), F.lit(at(0)).alias("timestamp"),
        F.lit(D1).alias("ingest_date"),
    )
    cold = hot.limit(10).withColumn("symbol", F.lit("B"))
    hot.unionByName(cold).repartition(8).write.parquet(f"{folder}/in")
    out = maintenance.compact(spark, f"{folder}/in", f"{folder}/out", ["ingest_date", "symbol"], file_bytes=1_000_000)
    assert files_of(out.filter("symbol = 'A'")) > 2
    assert out.count() == 300_010


def test_stream_folders_are_not_rewritten(spark, folder):
    silver = stream_silver(spark, folder, [ROWS])
    with pytest.raises(ValueError):
        tables.write_table(ticks(spark, ROWS), silver)
    with pytest.raises(ValueError):
        maintenance.compact(spark, silver, silver + "/", ["ingest_date"])
    with pytest.raises(ValueError):
        maintenance.replay_silver_day(spark, silver, silver, D1)


def test_silver_replay_removes_what_is_gone(spark, folder):
    bronze = tables.write_table(ticks(spark, ROWS), f"{folder}/bronze", ["ingest_date"])
    tables.write_table(clean_ticks(bronze, WIDE), f"{folder}/silver", ["ingest_date", "symbol"])
    maintenance.replay_silver_day(spark, f"{folder}/bronze", f"{folder}/silver", D2, TIGHT)
    got = versions.read_version(spark, f"{folder}/silver")
    # Symbol B has no clean tick left on the second day; the first day is as it was.
    assert sorted(values(got.select(RAW))) == sorted(ROWS[:4])
    none = PriceBands({"A": 100.0, "B": 100.0})
    maintenance.replay_silver_day(spark, f"{folder}/bronze", f"{folder}/silver", D2, none)
    assert sorted(values(versions.read_version(spark, f"{folder}/silver").select(RAW))) == sorted(ROWS[:3])


def test_gold_replay_reaches_over_midnight(spark, folder):
    rows = [("A", 1.0, 1.0, at(DAY - 5)), ("A", 3.0, 1.0, at(DAY + 5)), ("A", 8.0, 1.0, at(DAY + 5))]
    bronze = tables.write_table(ticks(spark, rows), f"{folder}/bronze", ["ingest_date"])
    gold = windows.sliding_average(clean_ticks(bronze, WIDE))
    tables.write_table(gold, f"{folder}/gold", ["window_date"])
    bands = PriceBands({"A": 1.0}, 0.5, 5.0)
    maintenance.replay_gold_day(spark, f"{folder}/bronze", f"{folder}/gold", D1, bands, final=False)
    got = versions.read_version(spark, f"{folder}/gold")
    fresh = windows.sliding_average(clean_ticks(bronze, bands))
    columns = ["window_start", "avg_price", "n_ticks"]
    for day, source in ((D1, fresh), (D2, gold)):
        same = F.col("window_date") == F.lit(day)
        assert values(got.filter(same).select(columns), "window_start") == values(source.filter(same).select(columns), "window_start")


def test_replay_reads_one_day_of_bronze(spark, folder):
    from tickloom.plans.inspect import pushed_filters

    tables.write_table(ticks(spark, ROWS), f"{folder}/bronze", ["ingest_date"])
    day = spark.read.parquet(f"{folder}/bronze").filter(F.col("ingest_date") == F.lit(D1))
    assert "ingest_date" in " ".join(pushed_filters(clean_ticks(day)))


def test_broker_options():
    assert broker_options("kafka:9092") == {
        "kafka.bootstrap.servers": "kafka:9092", "subscribe": "financial_data", "startingOffsets": "latest",
    }
    more = broker_options("k:1", "t", "earliest", min_partitions=64, max_per_trigger=10**6)
    assert more["minPartitions"] == "64" and more["maxOffsetsPerTrigger"] == "1000000"
    assert broker_options("k:1", starting='{"t":{"0":5}}')["startingOffsets"].startswith("{")
    with pytest.raises(ValueError):
        broker_options("k:1", starting="yesterday")


def test_file_messages_in_batch_and_as_a_stream(spark, folder):
    arrive(spark, PUBLISHED, f"{folder}/inbox")
    batch = read_messages(spark, "parquet", {}, f"{folder}/inbox", streaming=False)
    live = read_messages(spark, "parquet", {"maxFilesPerTrigger": "1"}, f"{folder}/inbox")
    assert not batch.isStreaming and live.isStreaming
    assert batch.columns == live.columns == messages(spark, PUBLISHED).columns
    assert batch.count() == len(PUBLISHED)


def test_settings_are_put_back(spark):
    key, fresh = "spark.sql.shuffle.partitions", "spark.sql.sources.bucketing.enabled"
    before = spark.conf.get(key)
    with pytest.raises(RuntimeError):
        with settings(spark, {key: "77", fresh: "false"}):
            assert spark.conf.get(key) == "77"
            raise RuntimeError
    assert spark.conf.get(key) == before
    assert spark.conf.get(fresh) == "true"


def test_work_folders_differ_and_follow_the_setting(spark):
    base = spark.conf.get("spark.checkpoint.dir", None)
    a, b = work_folder(spark, "x"), work_folder(spark, "x")
    assert a != b
    if base:
        assert a.startswith(base)


def test_only_newly_finished_days_are_compacted(spark, folder):
    def run(rows):
        arrive(spark, rows, f"{folder}/inbox")
        started = medallion.start_medallion(
            stream(spark, f"{folder}/inbox"), folder, PriceBands({}), live=False, layers=[medallion.SILVER, medallion.GOLD]
        )
        runtime.run_to_end(*started.values())
        return maintenance.compact_finished(
            spark, silver, target, medallion.GOLD.checkpoint_path(folder), "ingest_date", ["symbol"], ["event_time"]
        )

    silver, target = medallion.SILVER.path(folder), f"{folder}/compacted"
    rows = [("A", 1.0, 1.0, at(s)) for s in (0, 9, DAY, DAY + 60)]
    assert run(rows) == []  # the watermark is two minutes back, in the first day
    assert run([("A", 1.0, 1.0, at(DAY + 121))]) == [D1]
    assert files_of(versions.read_version(spark, target)) == 1
    assert run([("A", 1.0, 1.0, at(DAY + 200)), ("B", 2.0, 1.0, at(2 * DAY + 500))]) == [D2]
    assert versions.latest_version(spark, target) == 2
    # a late tick reaches a finished day: that day is read from the layer, then copied again
    sent = [*rows, ("A", 1.0, 1.0, at(DAY + 121)), ("A", 1.0, 1.0, at(DAY + 200)), ("B", 2.0, 1.0, at(2 * DAY + 500)), ("C", 3.0, 1.0, at(7))]
    arrive(spark, sent[-1:], f"{folder}/inbox")
    started = medallion.start_medallion(
        stream(spark, f"{folder}/inbox"), folder, PriceBands({}), live=False, layers=[medallion.SILVER]
    )
    runtime.run_to_end(*started.values())
    whole = maintenance.read_compacted(spark, silver, target, "ingest_date")
    assert sorted(values(whole.select(RAW))) == sorted(sent)
    assert run([("A", 1.0, 1.0, at(2 * DAY + 501))]) == [D1]
    compacted = versions.read_version(spark, target)
    assert sorted(values(compacted.select(RAW))) == sorted(row for row in sent if row[3] < at(2 * DAY))


def test_nothing_is_finished_without_a_watermark(spark, folder):
    silver = stream_silver(spark, folder, [ROWS])
    checkpoint = medallion.SILVER.checkpoint_path(folder)
    assert maintenance.compact_finished(spark, silver, f"{folder}/c", checkpoint, "ingest_date") == []
    assert maintenance.compact_finished(spark, silver, f"{folder}/c", f"{folder}/none", "ingest_date") == []
    assert sorted(values(maintenance.read_compacted(spark, silver, f"{folder}/c", "ingest_date").select(RAW))) == sorted(ROWS)

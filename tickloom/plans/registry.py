"""Every operator as a query over the ``events`` table: ``(spark, folder) -> DataFrame``.

Each query runs over the whole table. Those that need written layers or a stream write
below the shared working folder and return what they read back.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tickloom.functions.bands import PriceBands, anchor_price
from tickloom.operators import cleaning, maintenance, moments, olap, star, ticks, windows
from tickloom.session import pin_utc, work_folder
from tickloom.sources import catalog, events, tables, versions
from tickloom.streaming import dedup, medallion, observe, progress, reseed, runtime, settle, together

Query = Callable[[SparkSession, str], DataFrame]

NOW = "2024-02-01 00:00:00"
REPLAY_DAY = dt.date(2024, 1, 15)
TIGHT_BANDS = PriceBands(events.EVENT_BANDS.anchors, 0.5, 1.5)
HOUR, TEN_MINUTES, DAY = 3600, 600, 86_400
FILES_PER_BATCH = 10_000
STATE_PARTITIONS = 8
OFFSET_RANGE = 4_096


def _ticks(spark: SparkSession, folder: str) -> DataFrame:
    return events.event_ticks(events.read_events(spark, folder))


def _silver(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.clean_ticks(_ticks(spark, folder), events.EVENT_BANDS)


def _messages(spark: SparkSession, folder: str) -> DataFrame:
    return events.event_messages(events.read_events(spark, folder))


def _message_stream(spark: SparkSession, folder: str, files: int | None = None) -> DataFrame:
    return events.event_messages(events.stream_events(spark, folder, files))


def _gold(spark: SparkSession, folder: str) -> DataFrame:
    silver = _silver(spark, folder)
    return windows.closed_windows(windows.sliding_average(silver), silver)


def _rounded(rows: DataFrame, *names: str, digits: int = 6) -> DataFrame:
    """Averages of doubles depend on the order of summing in their last digits."""
    return rows.withColumns({name: F.round(name, digits) for name in names})


def _on_silver(question: Callable[[DataFrame], DataFrame], *rounded: str, digits: int = 6) -> Query:
    return lambda spark, folder: _rounded(question(_silver(spark, folder)), *rounded, digits=digits)


# --- messages and ticks -----------------------------------------------------------------


def ticks_normalise(spark: SparkSession, folder: str) -> DataFrame:
    payloads = events.event_payloads(events.read_events(spark, folder))
    return ticks.add_event_time(ticks.normalise_payloads(payloads))


def message_parse(spark: SparkSession, folder: str) -> DataFrame:
    return ticks.decode_messages(_messages(spark, folder))


def message_parse_ms(spark: SparkSession, folder: str) -> DataFrame:
    return ticks.decode_messages(_messages(spark, folder), "millisecond").select("symbol", "event_time")


def anchor_lookup(spark: SparkSession, folder: str) -> DataFrame:
    anchor = anchor_price(F.col("symbol"), events.EVENT_BANDS.anchors)
    return _ticks(spark, folder).select("symbol", "timestamp", "price", anchor.alias("anchor_price"))


def silver_by_anchor_table(spark: SparkSession, folder: str) -> DataFrame:
    anchors = spark.createDataFrame(
        list(events.EVENT_BANDS.anchors.items()), "symbol STRING, anchor_price DOUBLE"
    )
    return cleaning.clean_with_anchor_table(_ticks(spark, folder), anchors)


def dedup_ticks(spark: SparkSession, folder: str) -> DataFrame:
    sent = _ticks(spark, folder)
    return cleaning.drop_repeats(sent.unionByName(sent))


def latency_total(spark: SparkSession, folder: str) -> DataFrame:
    seen = observe.with_lag(message_parse(spark, folder), NOW)
    return seen.select("symbol", "price", "timestamp", "event_time", "now", "lag_seconds")


def latency_split(spark: SparkSession, folder: str) -> DataFrame:
    return observe.with_split_lag(message_parse(spark, folder), NOW)


def offset_span(spark: SparkSession, folder: str) -> DataFrame:
    return observe.offset_span(_messages(spark, folder))


def _with_repeats(spark: SparkSession, folder: str) -> DataFrame:
    """Every message, every fifth of them twice."""
    sent = _messages(spark, folder)
    return sent.unionByName(sent.filter("offset % 5 = 0"))


def offset_report(spark: SparkSession, folder: str) -> DataFrame:
    return observe.offset_report(_with_repeats(spark, folder), OFFSET_RANGE)


def offset_gaps(spark: SparkSession, folder: str) -> DataFrame:
    return observe.offset_gaps(_with_repeats(spark, folder), OFFSET_RANGE)


# --- layers, star schema and catalog ----------------------------------------------------


def layer_counts(spark: SparkSession, folder: str) -> DataFrame:
    return olap.layer_counts(
        {
            "bronze": _ticks(spark, folder),
            "silver": _silver(spark, folder),
            "gold": _gold(spark, folder),
        }
    )


def silver_table(spark: SparkSession, folder: str) -> DataFrame:
    path = work_folder(spark, "silver")
    return tables.write_table(_silver(spark, folder), path, ["ingest_date", "symbol"])


def dim_time(spark: SparkSession, folder: str) -> DataFrame:
    return tables.write_table(star.dim_time(_silver(spark, folder)), work_folder(spark, "dim_time"))


def dim_symbol(spark: SparkSession, folder: str) -> DataFrame:
    rows = star.dim_symbol(_silver(spark, folder))
    return tables.write_table(rows, work_folder(spark, "dim_symbol"))


def fact_ticks(spark: SparkSession, folder: str) -> DataFrame:
    rows = star.fact_ticks(_silver(spark, folder))
    return tables.write_table(rows, work_folder(spark, "fact_ticks"), ["ingest_date"], gather=False)


def star_volume(spark: SparkSession, folder: str) -> DataFrame:
    return star.volume_by_asset(star.fact_ticks(_silver(spark, folder)), dim_symbol(spark, folder))


def _star(spark: SparkSession, folder: str) -> list[DataFrame | star.Calendar]:
    """Written facts, calendar, symbols and markets."""
    root = work_folder(spark, "star")
    written = star.write_star(_silver(spark, folder), root)
    return [written["fact_ticks"], star.read_calendar(spark, root), written["dim_symbol"], written["dim_market"]]


def _star_in_two(spark: SparkSession, folder: str) -> str:
    """A star written for the days before one, to which that day and the later ones are added."""
    root, silver = work_folder(spark, "star-grown"), _silver(spark, folder)
    early = F.col("ingest_date") < F.lit(REPLAY_DAY)
    star.write_star(silver.filter(early), root)
    star.add_to_star(silver.filter(~early), root)
    return root


def star_grown(spark: SparkSession, folder: str) -> DataFrame:
    """The full star over facts and dimensions that were written in two steps."""
    root = _star_in_two(spark, folder)
    written = star.read_star(spark, root)
    calendar = star.read_calendar(spark, root)
    return star.full_star(written["fact_ticks"], calendar, written["dim_symbol"], written["dim_market"])


def dim_time_grown(spark: SparkSession, folder: str) -> DataFrame:
    """The time dimension of that star: no moment twice, none missing."""
    return star.read_star(spark, _star_in_two(spark, folder))["dim_time"]


def star_full(spark: SparkSession, folder: str) -> DataFrame:
    return star.full_star(*_star(spark, folder))


def star_calendar(spark: SparkSession, folder: str) -> DataFrame:
    return star.volume_by_calendar(*_star(spark, folder))


def silver_view(spark: SparkSession, folder: str) -> DataFrame:
    view = f"silver_ticks_{uuid.uuid4().hex}"
    tables.name_view(_silver(spark, folder), view)
    return spark.sql(
        "SELECT symbol, round(avg(price), 6) AS avg_price, count(*) AS n_ticks"
        f" FROM {view} GROUP BY symbol"
    )


def tables_listed(spark: SparkSession, folder: str) -> DataFrame:
    """Write all layers, register them, and count the rows SQL sees in each listed table."""
    root = work_folder(spark, "lake")
    silver = _silver(spark, folder)
    tables.write_table(_ticks(spark, folder), medallion.BRONZE.path(root), ["ingest_date"], gather=False)
    tables.write_table(silver, medallion.SILVER.path(root), ["ingest_date", "symbol"])
    tables.write_table(_gold(spark, folder), medallion.GOLD.path(root), ["window_date"])
    star.write_star(silver, f"{root}/gold_star")
    database = "lake_" + root.rsplit("-", 1)[-1]
    spark.sql(f"CREATE DATABASE {database} LOCATION '{root}/database'")
    catalog.register_tables(spark, root, database)
    listed = [row.tableName for row in catalog.list_tables(spark, database).collect() if not row.isTemporary]
    return olap.layer_counts({name: spark.table(f"{database}.{name}") for name in listed})


def compaction(spark: SparkSession, folder: str) -> DataFrame:
    """A streamed silver layer, compacted into a sibling folder."""
    layer = medallion.SILVER
    root = _streamed(spark, folder, layer)
    return maintenance.compact(
        spark, layer.path(root), f"{root}/compacted", layer.partition_by, sort_by=[layer.time_column]
    )


def compaction_finished(spark: SparkSession, folder: str) -> DataFrame:
    """The days of silver before one day, compacted; its later days may still be written."""
    layer, root = medallion.SILVER, work_folder(spark, "finished")
    silver = tables.write_table(_silver(spark, folder), layer.path(root), layer.partition_by, gather=False)
    return maintenance.compact(
        spark,
        layer.path(root),
        f"{root}/compacted",
        layer.partition_by,
        F.col("ingest_date") < F.lit(REPLAY_DAY),
        schema=silver.schema,
        sort_by=[layer.time_column],
    )


def star_sql(spark: SparkSession, folder: str) -> DataFrame:
    """Volume per day and base asset, asked in SQL of registered tables by their names."""
    root = work_folder(spark, "star-sql")
    star.write_star(_silver(spark, folder), f"{root}/gold_star")
    database = f"star_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{root}/database'")
    try:
        catalog.register_tables(spark, root, database)
        answer = spark.sql(
            "SELECT ingest_date, base_asset, round(sum(volume), 2) AS total_volume, count(*) AS n_ticks"
            f" FROM {database}.fact_ticks JOIN {database}.dim_symbol USING (symbol_key)"
            " GROUP BY ingest_date, base_asset"
        )
        return tables.write_table(answer, f"{root}/answer")
    finally:  # the tables are external, so this drops their names only
        spark.sql(f"DROP DATABASE {database} CASCADE")


def replay_day(spark: SparkSession, folder: str) -> DataFrame:
    """Silver with one day filtered again under tighter bands."""
    root = work_folder(spark, "replay")
    bronze, silver = f"{root}/bronze", f"{root}/silver"
    layer = tables.write_table(_ticks(spark, folder), bronze, ["ingest_date"], gather=False)
    tables.write_table(
        cleaning.clean_ticks(layer, events.EVENT_BANDS), silver, ["ingest_date", "symbol"]
    )
    maintenance.replay_silver_day(spark, bronze, silver, REPLAY_DAY, TIGHT_BANDS)
    return versions.read_version(spark, silver)


def replay_versions(spark: SparkSession, folder: str) -> DataFrame:
    """Ticks per day in each version of a table: written, one day replayed, all days with other bands."""
    root = work_folder(spark, "versions")
    bronze, silver = f"{root}/bronze", f"{root}/silver"
    layer = tables.write_table(_ticks(spark, folder), bronze, ["ingest_date"], gather=False)
    versions.overwrite(cleaning.clean_ticks(layer, events.EVENT_BANDS), silver, "ingest_date", ["symbol"], ["event_time"])
    maintenance.replay_silver_day(spark, bronze, silver, REPLAY_DAY, TIGHT_BANDS)
    versions.overwrite(cleaning.clean_ticks(layer, TIGHT_BANDS), silver, "ingest_date", ["symbol"], ["event_time"])
    counts = [
        versions.read_version(spark, silver, version)
        .groupBy("ingest_date")
        .agg(F.count(F.lit(1)).alias("n_ticks"))
        .withColumn("version", F.lit(version).cast("long"))
        for version in range(1, versions.latest_version(spark, silver) + 1)
    ]
    return reduce(DataFrame.unionByName, counts)


def replay_gold_day(spark: SparkSession, folder: str) -> DataFrame:
    """Sliding averages with the windows of one day computed again under tighter bands."""
    root = work_folder(spark, "replay-gold")
    bronze, gold = f"{root}/bronze", f"{root}/gold"
    layer = tables.write_table(_ticks(spark, folder), bronze, ["ingest_date"], gather=False)
    silver = cleaning.clean_ticks(layer, events.EVENT_BANDS)
    tables.write_table(windows.sliding_average(silver), gold, ["window_date"])
    maintenance.replay_gold_day(spark, bronze, gold, REPLAY_DAY, TIGHT_BANDS)
    return _rounded(versions.read_version(spark, gold), "avg_price")


# --- streams ----------------------------------------------------------------------------


def _streamed(
    spark: SparkSession, folder: str, *layers: medallion.Layer, state_partitions: int | None = None
) -> str:
    """Run layers over the whole table as a stream; returns the lake root."""
    root = work_folder(spark, "stream")
    files = None if medallion.GOLD in layers else FILES_PER_BATCH
    started = medallion.start_medallion(
        _message_stream(spark, folder, files),
        root,
        events.EVENT_BANDS,
        live=False,
        state_partitions=state_partitions,
        layers=layers,
    )
    runtime.run_to_end(*started.values())
    return root


def _layer_stream(layer: medallion.Layer, *rounded: str) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        root = _streamed(spark, folder, layer)
        return _rounded(tables.read_table(spark, layer.path(root)), *rounded)

    return query


def _silver_stream(spark: SparkSession, folder: str, files: int | None = None) -> DataFrame:
    return medallion.silver_rows(_message_stream(spark, folder, files), events.EVENT_BANDS)


def running_stats(spark: SparkSession, folder: str) -> DataFrame:
    """Complete mode: totals per symbol, written whole after every batch."""
    root = work_folder(spark, "running")
    totals = windows.running_stats(_silver_stream(spark, folder, FILES_PER_BATCH))
    runtime.run_to_end(
        runtime.start_snapshots(totals, "running_stats", f"{root}/out", f"{root}/checkpoint")
    )
    return _rounded(runtime.latest_snapshot(spark, f"{root}/out"), "avg_price")


def sliding_update(spark: SparkSession, folder: str) -> DataFrame:
    """Update mode: the last version of every window."""
    root = work_folder(spark, "update")
    rows = windows.sliding_average_stream(_silver_stream(spark, folder))
    runtime.run_to_end(
        runtime.start_changes(rows, "sliding_update", f"{root}/out", f"{root}/checkpoint")
    )
    changes = tables.read_table(spark, f"{root}/out")
    latest = runtime.latest_changes(changes, ["symbol", "window_start", "window_end"])
    return _rounded(latest, "avg_price")


def dedup_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Every message sent twice, repeats dropped on the stream."""
    root = work_folder(spark, "dedup")
    sent = medallion.bronze_rows(
        _message_stream(spark, folder).unionByName(_message_stream(spark, folder))
    )
    once = dedup.drop_repeats_stream(sent)
    runtime.run_to_end(
        runtime.start_table(once, "dedup", f"{root}/out", f"{root}/checkpoint")
    )
    return tables.read_table(spark, f"{root}/out")


def dedup_settled(spark: SparkSession, folder: str) -> DataFrame:
    """Copies that disagree, in two runs: the lowest that came in time is kept, as in batch."""
    root = work_folder(spark, "settled")
    earlier, later = _halves(spark, folder)
    for arrived in (earlier, later.unionByName(earlier.withColumn("value", F.col("value") - 1))):
        arrived.write.mode("append").parquet(f"{root}/inbox")
        inbox = spark.readStream.schema(arrived.schema).parquet(f"{root}/inbox")
        sent = medallion.bronze_rows(events.event_messages(inbox))
        once = settle.settle_repeats_stream(sent, DAY, 3 * DAY, HOUR, salts=1)
        runtime.run_to_end(runtime.start_table(once, "settled", f"{root}/out", f"{root}/checkpoint"))
    return tables.read_table(spark, f"{root}/out")


def _halves(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """The table in two arrivals: before and from the middle of its time span."""
    rows = events.read_events(spark, folder)
    first, last = rows.agg(F.min("ts"), F.max("ts")).first()
    middle = F.lit((first + (last - first) // 2).isoformat(" ")).cast("timestamp_ntz")
    return rows.filter(F.col("ts") < middle), rows.filter(F.col("ts") >= middle)


def _in_two_runs(
    spark: SparkSession, layer: medallion.Layer, arrivals: tuple[DataFrame, DataFrame]
) -> DataFrame:
    """Run a layer, stop, let more files arrive, and resume from the checkpoint."""
    root = work_folder(spark, "resume")
    for rows in arrivals:
        rows.write.mode("append").parquet(f"{root}/inbox")
        arrived = spark.readStream.schema(rows.schema).parquet(f"{root}/inbox")
        started = medallion.start_medallion(
            events.event_messages(arrived), root, events.EVENT_BANDS, live=False, layers=[layer]
        )
        runtime.run_to_end(*started.values())
    return tables.read_table(spark, layer.path(root))


def restart_resume(spark: SparkSession, folder: str) -> DataFrame:
    """Silver from two runs on one checkpoint: nothing lost, nothing twice."""
    return _in_two_runs(spark, medallion.SILVER, _halves(spark, folder))


def restart_gold(spark: SparkSession, folder: str) -> DataFrame:
    """Gold from two runs: windows open at the stop are kept in the state."""
    return _rounded(_in_two_runs(spark, medallion.GOLD, _halves(spark, folder)), "avg_price")


def restart_partitions(spark: SparkSession, folder: str) -> DataFrame:
    """Gold from a run with 4 state partitions and one with 16 that goes on from its open windows."""
    root = work_folder(spark, "repartitioned")
    earlier, later = _halves(spark, folder)
    first = medallion.start_medallion(
        _arrived(spark, earlier, f"{root}/first"), root, events.EVENT_BANDS, live=False, state_partitions=4, layers=[medallion.GOLD]
    )
    runtime.run_to_end(*first.values())
    reseed.export_open_windows(spark, medallion.GOLD.checkpoint_path(root), f"{root}/seeds")
    second = reseed.start_seeded_gold(
        _arrived(spark, later, f"{root}/second"), f"{root}/seeds", f"{root}/gold", f"{root}/checkpoint", events.EVENT_BANDS, state_partitions=16
    )
    runtime.run_to_end(second)
    both = tables.read_table(spark, medallion.GOLD.path(root)).unionByName(tables.read_table(spark, f"{root}/gold"))
    return _rounded(both, "avg_price")


def _arrived(spark: SparkSession, rows: DataFrame, inbox: str) -> DataFrame:
    """Rows written to a folder of their own, as a stream of messages."""
    rows.write.parquet(inbox)
    return events.event_messages(spark.readStream.schema(rows.schema).parquet(inbox))


def late_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Gold when the older half arrives last: only its still open windows take it in."""
    earlier, later = _halves(spark, folder)
    return _rounded(_in_two_runs(spark, medallion.GOLD, (later, earlier)), "avg_price")


def open_windows(spark: SparkSession, folder: str) -> DataFrame:
    """Windows a gold query still holds when the stream pauses."""
    root = _streamed(spark, folder, medallion.GOLD)
    return observe.open_windows(spark, medallion.GOLD.checkpoint_path(root))


def _run_layers(spark: SparkSession, root: str, arrived: DataFrame, *layers: medallion.Layer) -> list[StreamingQuery]:
    """Let ``arrived`` come in as messages and run layers on their checkpoints until all is read."""
    arrived.write.mode("append").parquet(f"{root}/inbox")
    inbox = spark.readStream.schema(arrived.schema).parquet(f"{root}/inbox")
    started = medallion.start_medallion(
        events.event_messages(inbox), root, events.EVENT_BANDS, live=False, layers=layers
    )
    runtime.run_to_end(*started.values())
    return list(started.values())


def progress_table(spark: SparkSession, folder: str) -> DataFrame:
    """Rows that each of three queries has read over two runs, from the log of their progress."""
    root = work_folder(spark, "progress")
    with progress.progress_log(spark, f"{root}/progress") as log:
        for arrived in _halves(spark, folder):
            log.complete(_run_layers(spark, root, arrived, *medallion.LAYERS))
    totals = progress.query_totals(progress.read_progress(spark, f"{root}/progress"))
    return totals.select("query", "runs", "input_rows")


def compaction_ledger(spark: SparkSession, folder: str) -> DataFrame:
    """Silver compacted after each of two runs: which commit copied each finished day, and its ticks."""
    layer, root = medallion.SILVER, work_folder(spark, "ledger")
    path, target, (column, *inner) = layer.path(root), f"{root}/compacted", layer.partition_by
    for arrived in _halves(spark, folder):
        _run_layers(spark, root, arrived, layer, medallion.GOLD)
        checkpoint = medallion.GOLD.checkpoint_path(root)
        maintenance.compact_finished(spark, path, target, checkpoint, column, inner, [layer.time_column])
    commits = versions.manifest(spark, target).select("version", F.col("part").cast("date").alias(column))
    days = versions.read_version(spark, target).groupBy(column).agg(F.count(F.lit(1)).alias("n_ticks"))
    return commits.join(days, column).select(column, "version", "n_ticks")


def compaction_read(spark: SparkSession, folder: str) -> DataFrame:
    """All of silver, its finished days from the compacted table and the others from the layer."""
    layer, root = medallion.SILVER, work_folder(spark, "compacted")
    path, target, (column, *inner) = layer.path(root), f"{root}/compacted", layer.partition_by
    earlier, later = _halves(spark, folder)
    _run_layers(spark, root, earlier, layer, medallion.GOLD)
    maintenance.compact_finished(
        spark, path, target, medallion.GOLD.checkpoint_path(root), column, inner, [layer.time_column]
    )
    _run_layers(spark, root, later, layer)
    return maintenance.read_compacted(spark, path, target, column)


def _together(spark: SparkSession, arrivals: tuple[DataFrame, DataFrame]) -> str:
    """Run the query that writes all tables from one parse over two arrivals; returns the root."""
    root = work_folder(spark, "together")
    for arrived in arrivals:
        arrived.write.mode("append").parquet(f"{root}/inbox")
        inbox = spark.readStream.schema(arrived.schema).parquet(f"{root}/inbox")
        runtime.run_to_end(together.start_together(events.event_messages(inbox), root, events.EVENT_BANDS))
    return root


def together_layers(spark: SparkSession, folder: str) -> DataFrame:
    """Silver from two runs of the query that writes all tables."""
    root = _together(spark, _halves(spark, folder))
    return together.read_together(spark, root, "silver").drop("batch_id")


def late_side_table(spark: SparkSession, folder: str) -> DataFrame:
    """All clean ticks when the older half arrives last: the late ones from their table, the others without them."""
    earlier, later = _halves(spark, folder)
    root = _together(spark, (later, earlier))
    late = together.read_together(spark, root, "late").select("*", F.lit(True).alias("late"))
    rest = together.in_time(spark, root).select("*", F.lit(False).alias("late"))
    return rest.unionByName(late.drop("watermark")).drop("batch_id")


def _on_moments(question: Callable[[DataFrame], DataFrame], *rounded: str) -> Query:
    """A question asked of moments that two runs have written."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        root = _together(spark, _halves(spark, folder))
        return _rounded(question(together.read_together(spark, root, "moments")), *rounded)

    return query


def checkpoint_inventory(spark: SparkSession, folder: str) -> DataFrame:
    """Batches that a gold checkpoint has planned and committed, and the partitions of its state."""
    root = _streamed(spark, folder, medallion.GOLD, state_partitions=STATE_PARTITIONS)
    checkpoint = medallion.GOLD.checkpoint_path(root)
    files = observe.checkpoint_files(spark, checkpoint)
    batches = files.filter("folder IN ('offsets', 'commits') AND file RLIKE '/[0-9]+$' AND bytes > 0")
    state = observe.state_operators(spark, checkpoint).select(
        F.lit("state").alias("folder"), F.col("numPartitions").cast("long").alias("n")
    )
    return batches.groupBy("folder").agg(F.count(F.lit(1)).alias("n")).unionByName(state)


QUERIES: dict[str, Query] = {
    "ticks_normalise": ticks_normalise,
    "message_parse": message_parse,
    "message_parse_ms": message_parse_ms,
    "anchor_lookup": anchor_lookup,
    "silver_clean": _silver,
    "silver_by_anchor_table": silver_by_anchor_table,
    "silver_table": silver_table,
    "silver_view": silver_view,
    "dedup_ticks": dedup_ticks,
    "daily_average": _on_silver(olap.daily_average),
    "volatility": _on_silver(olap.volatility),
    "most_volatile": _on_silver(olap.most_volatile),
    "peak_hours": _on_silver(olap.peak_hours),
    "rollup_volume": _on_silver(olap.rollup_volume),
    "cube_volume": _on_silver(olap.cube_volume),
    "symbol_check": _on_silver(olap.symbol_check, "avg_price"),
    "layer_counts": layer_counts,
    "gold_preview": lambda spark, folder: _rounded(
        olap.first_rows(_gold(spark, folder), 10, "window_start", "symbol"), "avg_price"
    ),
    "dim_time": dim_time,
    "dim_symbol": dim_symbol,
    "fact_ticks": fact_ticks,
    "star_volume": star_volume,
    "star_full": star_full,
    "star_grown": star_grown,
    "dim_time_grown": dim_time_grown,
    "star_calendar": star_calendar,
    "sliding_average": _on_silver(windows.sliding_average, "avg_price"),
    "sliding_average_hour": _on_silver(
        lambda rows: windows.sliding_average(rows, HOUR, TEN_MINUTES), "avg_price", digits=8
    ),
    "sliding_average_uneven": _on_silver(
        lambda rows: windows.sliding_average(rows, 50, 20), "avg_price"
    ),
    "price_by_minute": _on_silver(windows.price_series, "avg_price"),
    "volume_by_5min": _on_silver(windows.volume_series),
    "gold_chart": lambda spark, folder: _rounded(
        windows.average_series(_gold(spark, folder)), "avg_price"
    ),
    "latency_total": latency_total,
    "latency_split": latency_split,
    "offset_span": offset_span,
    "offset_report": offset_report,
    "offset_gaps": offset_gaps,
    "tables_listed": tables_listed,
    "compaction": compaction,
    "compaction_finished": compaction_finished,
    "star_sql": star_sql,
    "replay_day": replay_day,
    "replay_gold_day": replay_gold_day,
    "replay_versions": replay_versions,
    "compaction_ledger": compaction_ledger,
    "compaction_read": compaction_read,
    "bronze_stream": _layer_stream(medallion.BRONZE),
    "silver_stream": _layer_stream(medallion.SILVER),
    "gold_stream": _layer_stream(medallion.GOLD, "avg_price"),
    "running_stats": running_stats,
    "sliding_update": sliding_update,
    "dedup_stream": dedup_stream,
    "dedup_settled": dedup_settled,
    "restart_resume": restart_resume,
    "restart_gold": restart_gold,
    "restart_partitions": restart_partitions,
    "late_rows": late_rows,
    "open_windows": open_windows,
    "progress_table": progress_table,
    "checkpoint_inventory": checkpoint_inventory,
    "together_layers": together_layers,
    "late_side_table": late_side_table,
    "moments_daily": _on_moments(moments.daily_average),
    "moments_volatility": _on_moments(moments.volatility),
    "moments_rollup": _on_moments(moments.rollup_volume),
    "moments_price_by_minute": _on_moments(moments.price_series, "avg_price"),
}


def in_utc(query: Query) -> Query:
    """The session belongs to the caller, so every query pins the zone itself."""

    def pinned(spark: SparkSession, folder: str) -> DataFrame:
        pin_utc(spark)
        return query(spark, folder)

    return pinned

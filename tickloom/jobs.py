"""Runnable jobs: ``spark-submit --packages <kafka connector> -m tickloom.jobs <job> ...`` or
``python -m tickloom.jobs <job> ...``.

Streaming jobs read Kafka (``--servers``) or a folder of message files (``--inbox``).
"""

from __future__ import annotations

import argparse
import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tickloom.functions.bands import LOWER_RATIO, UPPER_RATIO, PriceBands
from tickloom.operators import maintenance, moments, olap, star, windows
from tickloom.operators.cleaning import clean_ticks
from tickloom.operators.ticks import decode_messages, encode_messages, normalise_payloads
from tickloom.session import build_session
from tickloom.sources import catalog, tables
from tickloom.sources.messages import TOPIC, broker_options, read_messages, write_messages
from tickloom.streaming import medallion, observe, progress, runtime, together


def _messages(spark: SparkSession, args: argparse.Namespace, streaming: bool = True) -> DataFrame:
    if args.inbox:
        return read_messages(spark, "parquet", {}, args.inbox, streaming)
    # A batch read cannot start at the live end of a topic.
    starting = args.starting if streaming else "earliest"
    options = broker_options(args.servers, args.topic, starting, args.min_partitions, args.max_per_trigger)
    return read_messages(spark, "kafka", options, streaming=streaming)


def _anchors(spark: SparkSession, args: argparse.Namespace) -> DataFrame | None:
    """The anchor table, for more symbols than have anchors in the code."""
    return spark.read.parquet(args.anchors).select("symbol", "anchor_price") if args.anchors else None


def _run(spark: SparkSession, root: str, start: Callable[[], Sequence[StreamingQuery]], live: bool) -> None:
    """Run until one query ends or the user interrupts, or to the end of what is there.

    Progress is logged below ``root``; what is printed covers earlier runs too.
    """
    with progress.progress_log(spark, f"{root}/progress") as log:
        queries = start()
        try:
            if live:
                spark.streams.awaitAnyTermination()
            else:
                runtime.run_to_end(*queries)
        except KeyboardInterrupt:
            pass
        finally:
            runtime.stop_all(queries)
            log.complete(queries)
    progress.query_totals(progress.read_progress(spark, f"{root}/progress")).orderBy("query").show(truncate=False)


def publish(spark: SparkSession, args: argparse.Namespace) -> None:
    """Turn files of API answers, one JSON text per line, into messages."""
    payloads = spark.read.text(args.payloads).withColumnRenamed("value", "payload")
    rows = normalise_payloads(payloads)
    named = rows.filter("symbol IS NOT NULL")
    print(f"skipped {rows.count() - named.count()} lines that are no answers")
    write_messages(encode_messages(named), args.servers, args.topic)


def layers(spark: SparkSession, args: argparse.Namespace) -> None:
    """Write bronze, silver and gold."""

    def start() -> list[StreamingQuery]:
        started = medallion.start_medallion(
            _messages(spark, args),
            args.root,
            live=not args.drain,
            state_partitions=args.state_partitions,
            once=args.once,
            anchors=_anchors(spark, args),
        )
        return list(started.values())

    _run(spark, args.root, start, not args.drain)


def gather(spark: SparkSession, args: argparse.Namespace) -> None:
    """Write bronze, silver, late ticks and moments with one parse, and answer from the moments."""

    def start() -> list[StreamingQuery]:
        every = None if args.drain else "20 seconds"
        return [together.start_together(_messages(spark, args), args.root, anchors=_anchors(spark, args), every=every)]

    _run(spark, args.root, start, not args.drain)
    kept = together.read_together(spark, args.root, "moments")
    for question in (moments.volatility, moments.rollup_volume):
        print(question.__name__)
        question(kept).show(50, truncate=False)


def console(spark: SparkSession, args: argparse.Namespace) -> None:
    """Print clean ticks, changed windows and running totals."""
    clean = clean_ticks(decode_messages(_messages(spark, args)))
    views = (
        ("clean_console", clean, "append", "10 seconds", 5),
        ("moving_avg_console", windows.sliding_average_stream(clean).drop("window_date"), "update", "15 seconds", 20),
        ("per_symbol_console", windows.running_stats(clean), "complete", "15 seconds", 20),
    )

    def start() -> list[StreamingQuery]:
        return [
            runtime.start_console(
                rows, name, f"{args.root}/console/{name}", mode, None if args.drain else every, shown
            )
            for name, rows, mode, every, shown in views
        ]

    _run(spark, args.root, start, not args.drain)


def latency(spark: SparkSession, args: argparse.Namespace) -> None:
    """Print how old ticks are when they are read."""
    seen = observe.with_split_lag(decode_messages(_messages(spark, args)))
    every = None if args.drain else "5 seconds"

    def start() -> list[StreamingQuery]:
        return [runtime.start_console(seen, "lag", f"{args.root}/console/lag", "append", every, 5)]

    _run(spark, args.root, start, not args.drain)


def offsets(spark: SparkSession, args: argparse.Namespace) -> None:
    """Print what each topic partition holds, and the offsets that are missing in it."""
    messages = _messages(spark, args, streaming=False)
    observe.offset_report(messages).show(truncate=False)
    observe.offset_gaps(messages).orderBy("topic", "partition", "first_missing").show(truncate=False)


def status(spark: SparkSession, args: argparse.Namespace) -> None:
    """Print row counts of the layers that are ready, and a sample of each."""
    ready = {layer.name: tables.read_if_ready(spark, layer.path(args.root)) for layer in medallion.LAYERS}
    if not any(rows is not None for rows in ready.values()):
        print("no layer is ready")
        return
    olap.layer_counts(ready).show()
    for name, rows in ready.items():
        if rows is None:
            print(f"{name} is not ready yet")
        elif name == "gold":
            olap.first_rows(rows, 10, "window_start", "symbol").show(truncate=False)
        else:
            rows.show(5, truncate=False)


def analyse(spark: SparkSession, args: argparse.Namespace) -> None:
    """Print the answers to the business questions on silver."""
    silver = tables.read_table(spark, medallion.SILVER.path(args.root))
    for question, shown in (
        (olap.daily_average, 50),
        (olap.volatility, 20),
        (olap.peak_hours, 24),
        (olap.rollup_volume, 50),
        (olap.cube_volume, 50),
    ):
        print(question.__name__)
        question(silver).show(shown, truncate=False)


def build_star(spark: SparkSession, args: argparse.Namespace) -> None:
    """Write the star schema from silver and print volume per asset."""
    silver = tables.read_table(spark, medallion.SILVER.path(args.root))
    written = star.write_star(silver, f"{args.root}/gold_star")
    olap.layer_counts(written).show()
    star.volume_by_asset(written["fact_ticks"], written["dim_symbol"]).show(truncate=False)


def register(spark: SparkSession, args: argparse.Namespace) -> None:
    """Register the written tables and list them."""
    for name, outcome in catalog.register_tables(spark, args.root, args.database).items():
        print(f"{name}: {outcome}")
    catalog.list_tables(spark, args.database).show(truncate=False)


def compact(spark: SparkSession, args: argparse.Namespace) -> None:
    """Copy a layer, its days before ``--before``, or its newly ``--finished`` days, into larger files at ``--target``."""
    layer = {layer.name: layer for layer in medallion.LAYERS}[args.layer]
    if args.finished:
        column, *inner = layer.partition_by
        days = maintenance.compact_finished(
            spark, layer.path(args.root), args.target, medallion.GOLD.checkpoint_path(args.root), column, inner, [layer.time_column]
        )
        print(f"compacted {', '.join(map(str, days)) or 'no day'}")
        return
    finished = F.col(layer.partition_by[0]) < F.lit(args.before) if args.before else None
    maintenance.compact(
        spark, layer.path(args.root), args.target, layer.partition_by, finished, sort_by=[layer.time_column]
    )


def replay(spark: SparkSession, args: argparse.Namespace) -> None:
    """Compute a day of silver or gold again, into the batch-owned table at ``--target``."""
    redo = {"silver": maintenance.replay_silver_day, "gold": maintenance.replay_gold_day}[args.layer]
    bands = PriceBands(lower=args.lower_ratio, upper=args.upper_ratio)
    redo(spark, medallion.BRONZE.path(args.root), args.target, args.day, bands, once=args.once, anchors=_anchors(spark, args))


STREAMS = {"layers": layers, "together": gather, "console": console, "latency": latency, "offsets": offsets}
ON_LAKE = {"status": status, "analyse": analyse, "star": build_star}


def parser() -> argparse.ArgumentParser:
    root = argparse.ArgumentParser(prog="tickloom.jobs", description=__doc__)
    root.add_argument("--master", help="only for local runs; a cluster sets it")
    jobs = root.add_subparsers(dest="job", required=True)

    def add(name: str, run, lake: bool = True) -> argparse.ArgumentParser:
        job = jobs.add_parser(name, help=run.__doc__)
        job.set_defaults(run=run)
        if lake:
            job.add_argument("--root", required=True, help="folder of the lake")
        return job

    def add_topic(job: argparse.ArgumentParser) -> None:
        job.add_argument("--servers", default="kafka:9092")
        job.add_argument("--topic", default=TOPIC)

    for name, run in STREAMS.items():
        job = add(name, run)
        add_topic(job)
        job.add_argument("--inbox", help="folder of message files, instead of Kafka")
        job.add_argument("--starting", default="latest")
        job.add_argument("--min-partitions", type=int)
        job.add_argument("--max-per-trigger", type=int)
        job.add_argument("--drain", action="store_true", help="process what is there and stop")
    layers_job = jobs.choices["layers"]
    layers_job.add_argument("--state-partitions", type=int)
    layers_job.add_argument("--once", action="store_true", help="drop repeated ticks")
    for name, run in ON_LAKE.items():
        add(name, run)
    for job in (layers_job, jobs.choices["together"]):
        job.add_argument("--anchors", help="Parquet table of symbol and anchor_price")
    add("register", register).add_argument("--database")
    job = add("publish", publish, lake=False)
    add_topic(job)
    job.add_argument("--payloads", required=True)
    for name, run, choices in (
        ("compact", compact, [layer.name for layer in medallion.LAYERS]),
        ("replay", replay, ["silver", "gold"]),
    ):
        job = add(name, run)
        job.add_argument("--layer", choices=choices, required=True)
        job.add_argument("--target", required=True)
    jobs.choices["compact"].add_argument("--before", type=dt.date.fromisoformat, help="only days before this one")
    jobs.choices["compact"].add_argument(
        "--finished", action="store_true", help="only days that gold is done with and that are not copied yet"
    )
    job.add_argument("--anchors", help="Parquet table of symbol and anchor_price")
    job.add_argument("--day", type=dt.date.fromisoformat, required=True)
    job.add_argument("--once", action="store_true", help="drop repeated ticks, as the layer does")
    job.add_argument("--lower-ratio", type=float, default=LOWER_RATIO)
    job.add_argument("--upper-ratio", type=float, default=UPPER_RATIO)
    return root


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> None:
    args = parser().parse_args(argv)
    args.run(spark or build_session(f"tickloom-{args.job}", args.master), args)


if __name__ == "__main__":
    main()

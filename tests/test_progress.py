import json

import pytest
from pyspark.sql import functions as F

from samples import arrive, at, stream
from tickloom.functions.bands import PriceBands
from tickloom.operators.ticks import decode_messages
from tickloom.session import settings
from tickloom.sources import versions
from tickloom.streaming import medallion, progress, runtime


def run(spark, folder, name="b", files="1"):
    rows = decode_messages(stream(spark, f"{folder}/inbox", maxFilesPerTrigger=files))
    query = runtime.start_table(rows, name, f"{folder}/{name}", f"{folder}/check-{name}")
    runtime.run_to_end(query)
    return query


def send(spark, folder, batches, rows=2):
    for k in range(batches):
        arrive(spark, [("A", 1.0, 1.0, at(k))] * rows, f"{folder}/inbox")


def reports(query):
    return [progress.progress_row(json.loads(report.json)) for report in query.recentProgress]


def totals(spark, path):
    return {row.query: (row.runs, row.batches, row.input_rows) for row in progress.query_totals(progress.read_progress(spark, path)).collect()}


def test_more_batches_than_a_session_keeps_over_two_runs(spark, folder):
    path = f"{folder}/progress"
    with settings(spark, {"spark.sql.streaming.numRecentProgressUpdates": "3"}):
        with progress.progress_log(spark, path) as log:
            send(spark, folder, 5)
            first = run(spark, folder)
            log.complete([first])
            assert len(first.recentProgress) <= 3
            assert totals(spark, path) == {"b": (1, 5, 10)}
        send(spark, folder, 2)
        with progress.progress_log(spark, path) as log:  # another session
            log.complete([run(spark, folder)])
    assert totals(spark, path) == {"b": (2, 7, 14)}
    table = progress.read_progress(spark, path)
    assert table.columns == [part.split()[0] for part in progress.PROGRESS.split(",")]
    assert table.select("run_id", "batch_id").distinct().count() == table.count() == 7
    assert table.filter("sources LIKE '%inbox%' AND trigger_ms >= 0").count() == 7


def test_reports_written_twice_count_once(spark, folder):
    path = f"{folder}/progress"
    send(spark, folder, 2)
    with progress.progress_log(spark, path) as log:
        query = run(spark, folder)
        log.complete([query])
        log.add(reports(query))
    assert totals(spark, path) == {"b": (1, 2, 4)}


def test_reports_that_never_came_are_added(spark, folder):
    path = f"{folder}/progress"
    send(spark, folder, 2)
    query = run(spark, folder)  # nobody listened
    log = progress.ProgressLog(spark, path)
    log.complete([query], seconds=0)
    assert totals(spark, path) == {"b": (1, 2, 4)}


def test_reports_wait_until_they_can_be_written(spark, folder, capsys):
    path = f"{folder}/progress"
    log = progress.ProgressLog(spark, path)
    send(spark, folder, 2)
    rows = reports(run(spark, folder))
    log.path = "nosuchscheme://x"
    log.add(rows[:1])
    assert "waits" in capsys.readouterr().out and len(log.waiting) == 1
    log.path = path
    log.add(rows[1:])
    assert not log.waiting and totals(spark, path) == {"b": (1, 2, 4)}


@pytest.mark.parametrize("died", [False, True])
def test_reports_are_merged(spark, folder, monkeypatch, died):
    path = f"{folder}/progress"
    send(spark, folder, 5)
    if died:  # the merged table is written, the single files stay
        monkeypatch.setattr(progress.ProgressLog, "merge", lambda self, whole=progress.ProgressLog.merge: merge_and_die(self))
    with progress.progress_log(spark, path, merge_files=3) as log:
        log.complete([run(spark, folder), run(spark, folder, "c")])
    assert totals(spark, path) == {"b": (1, 5, 10), "c": (1, 5, 10)}
    assert versions.latest_version(spark, f"{path}/merged") == 3
    single = spark.read.schema(progress.PROGRESS).parquet(f"{path}/reports/*").count()
    assert single == (10 if died else 1)


def merge_and_die(log):
    known = progress.read_progress(log.spark, log.path)
    versions.overwrite(known, f"{log.path}/merged", "query")


def test_a_batch_that_ran_again_counts_as_it_last_ran(spark):
    blank = dict.fromkeys(name.split()[0] for name in progress.PROGRESS.split(","))
    rows = [
        {**blank, "query": "q", "query_id": "i", "run_id": run, "batch_id": batch, "started": f"2024-01-01T00:00:0{k}.000Z", "input_rows": n, "rows_dropped_by_watermark": d}
        for k, (run, batch, n, d) in enumerate([("r1", 0, 5, 0), ("r1", 1, 7, 1), ("r2", 1, 7, 2), ("r2", 2, 1, 0)])
    ]
    table = spark.createDataFrame([tuple(row.values()) for row in rows], progress.PROGRESS)
    assert tuple(progress.query_totals(table).first()) == ("q", 2, 3, 13, 2)


def test_dropped_rows_are_kept_over_runs(spark, folder):
    path = f"{folder}/progress"
    with progress.progress_log(spark, path) as log:
        for batch in ([("A", 1.0, 1.0, at(600))], [("A", 5.0, 1.0, at(455)), ("A", 5.0, 1.0, at(60))]):
            arrive(spark, batch, f"{folder}/inbox")
            started = medallion.start_medallion(
                stream(spark, f"{folder}/inbox"), folder, PriceBands({}), live=False, layers=[medallion.GOLD]
            )
            runtime.run_to_end(*started.values())
            log.complete(started.values())
    table = progress.read_progress(spark, path)
    assert table.agg(F.sum("rows_dropped_by_watermark")).first()[0] == 3 + 6

import math

import pytest
from pyspark.sql import functions as F

from samples import arrive, at, clock, stream, ticks, values
from tickloom.functions.bands import PriceBands
from tickloom.operators import moments, olap, windows
from tickloom.operators.cleaning import clean_ticks
from tickloom.streaming import medallion, runtime, together

OPEN = PriceBands({})
RAW = ["symbol", "price", "volume", "timestamp"]


def run(spark, folder, rows=None, **options):
    if rows is not None:
        arrive(spark, rows, f"{folder}/inbox")
    query = together.start_together(stream(spark, f"{folder}/inbox"), f"{folder}/lake", OPEN, **options)
    runtime.run_to_end(query)
    return query


def read(spark, folder, table):
    return together.read_together(spark, f"{folder}/lake", table)


def raw(rows):
    return sorted(values(rows.select(RAW)), key=str)


FIRST = [("A", 2.0, 1.0, at(s)) for s in range(0, 400, 7)] + [("B", -1.0, 1.0, at(5)), ("007", 3.0, 1.0, at(6)), "junk", None]
SECOND = [("A", 5.0, 1.0, at(100)), ("A", 6.0, 1.0, at(279)), ("A", 7.0, 1.0, at(280)), ("B", 8.0, 2.0, at(500)), ("C", 1.0, 1.0, None)]


def test_tables_of_two_runs_equal_those_of_batch(spark, folder):
    run(spark, folder, FIRST)
    run(spark, folder, SECOND)
    bronze, silver = read(spark, folder, "bronze"), read(spark, folder, "silver")
    whole = medallion.bronze_rows(spark.read.parquet(f"{folder}/inbox"))
    assert raw(bronze) == raw(whole) and raw(silver) == raw(clean_ticks(whole, OPEN))
    assert set(bronze.columns) == {*RAW, "event_time", "ingest_date", "batch_id"}
    # the watermark of the second batch is two minutes before 00:06:39
    assert raw(read(spark, folder, "late")) == [("A", 5.0, 1.0, at(100))]
    assert read(spark, folder, "late").first().watermark == clock(279)
    assert raw(together.in_time(spark, f"{folder}/lake").unionByName(read(spark, folder, "late").drop("watermark"))) == raw(silver)


def test_the_source_is_scanned_once(spark, folder):
    query = run(spark, folder, FIRST)
    # a second scan would count the rows again
    assert [report["numInputRows"] for report in query.recentProgress] == [len(FIRST)]


@pytest.mark.parametrize("lost", ["silver", "moments", "batches"])
def test_a_batch_that_dies_half_way_counts_once(spark, folder, monkeypatch, lost):
    run(spark, folder, FIRST)
    before = {table: raw(read(spark, folder, table)) for table in ("bronze", "silver")}

    def dying(rows, path, *args):
        if f"/{lost}/" in path:
            raise RuntimeError("lost disk")
        return kept(rows, path, *args)

    kept = together.overwrite_folder
    with monkeypatch.context() as patched:
        if lost == "batches":  # all tables are written, the commit is not
            patched.setattr(together.F, "current_timestamp", lambda: F.raise_error(F.lit("lost disk")).cast("timestamp"))
        else:
            patched.setattr(together, "overwrite_folder", dying)
        with pytest.raises(Exception, match="lost disk"):
            run(spark, folder, SECOND)
    assert {table: raw(read(spark, folder, table)) for table in before} == before
    run(spark, folder)
    whole = medallion.bronze_rows(spark.read.parquet(f"{folder}/inbox"))
    assert raw(read(spark, folder, "bronze")) == raw(whole)
    assert raw(read(spark, folder, "silver")) == raw(clean_ticks(whole, OPEN))
    assert read(spark, folder, "moments").agg(F.sum("n_ticks")).first()[0] == clean_ticks(whole, OPEN).count()


def test_a_batch_that_was_whole_is_left(spark, folder):
    run(spark, folder, FIRST)
    files = {row[0] for row in read(spark, folder, "bronze").select(F.input_file_name()).distinct().collect()}
    batch = ticks(spark, [("X", 1.0, 1.0, at(0))])
    assert together.committed_batches(spark, f"{folder}/lake").count() == 1
    # as after a crash between the commit of the tables and that of the query
    together.write_batch(batch, 7, f"{folder}/other", None, OPEN)
    assert {row[0] for row in read(spark, folder, "bronze").select(F.input_file_name()).distinct().collect()} == files
    assert together.read_together(spark, f"{folder}/other", "late").count() == 0


def test_nothing_yet(spark, folder):
    for table in together.TABLES:
        assert read(spark, folder, table).count() == 0
    assert together.in_time(spark, f"{folder}/lake").count() == 0


def test_an_anchor_table(spark, folder):
    anchors = spark.createDataFrame([(f"S{k}", 100.0) for k in range(400)], "symbol string, anchor_price double")
    run(spark, folder, [("S7", 100.0, 1.0, at(0)), ("S7", 900.0, 1.0, at(1)), ("X", 5.0, 1.0, at(2))], anchors=anchors)
    assert sorted(row.price for row in read(spark, folder, "silver").collect()) == [5.0, 100.0]


# --- moments ----------------------------------------------------------------------------

ROWS = [("A", 77000.0 + (k % 13) / 100, float(k % 5), at(k * 11)) for k in range(900)]
ROWS += [("B", 2.0, 1.0, at(9)), ("C", None, 1.0, at(5)), ("C", None, None, at(90)), ("D", 1.0, 1.0, None), ("D", 4.0, 1.0, at(86_400 * 3))]


def same(got, expected, *order):
    assert got.columns == expected.columns
    for one, other in zip(values(got, *order), values(expected, *order), strict=True):
        assert all(x == y or (isinstance(x, float) and math.isclose(x, y, rel_tol=1e-12, abs_tol=1e-6)) for x, y in zip(one, other)), (one, other)


@pytest.fixture
def kept(spark, folder):
    """Moments of a few batches, some of which share minutes."""
    for k in range(3):
        part = ticks(spark, ROWS[k::3])
        moments.tick_moments(part).write.mode("append").parquet(f"{folder}/moments")
    return spark.read.parquet(f"{folder}/moments")


def test_questions_from_moments(spark, kept):
    whole = ticks(spark, ROWS)
    for name, order in (
        ("daily_average", ("ingest_date", "symbol")), ("volatility", ("symbol",)), ("peak_hours", ("hour_utc",)),
        ("rollup_volume", ("level", "ingest_date", "symbol")), ("cube_volume", ("level", "ingest_date", "symbol")),
    ):
        same(getattr(moments, name)(kept), getattr(olap, name)(whole), *order)
    same(moments.price_series(kept), windows.price_series(whole), "window_start", "symbol")
    same(moments.price_series(kept, 600), windows.price_series(whole, 600), "window_start", "symbol")
    same(moments.volume_series(kept), windows.volume_series(whole), "window_start", "symbol")
    same(moments.running_stats(kept), windows.running_stats(whole), "symbol")
    with pytest.raises(ValueError):
        moments.price_series(kept, 90)


def test_merging_everything(spark, kept):
    one = moments.merge_moments(kept, []).first()
    prices = [row[1] for row in ROWS if row[1] is not None]
    mean = math.fsum(prices) / len(prices)
    assert (one.n_ticks, one.n_prices, one.min_price, one.max_price) == (len(ROWS), len(prices), 1.0, 77000.12)
    assert math.isclose(one.m2, math.fsum((p - mean) ** 2 for p in prices), rel_tol=1e-9)


def test_large_prices_with_small_differences_keep_their_digits(spark):
    rows = [("A", 1e9 + k % 3, 1.0, at(k * 60)) for k in range(300)]
    spread = moments.volatility(moments.tick_moments(ticks(spark, rows))).first().stddev_price
    assert spread == round(math.sqrt(200 / 299), 6)


def test_no_moments(spark):
    none = moments.tick_moments(ticks(spark, ROWS).limit(0))
    assert moments.volatility(none).count() == moments.price_series(none).count() == 0
    assert moments.merge_moments(none, []).first().n_ticks is None

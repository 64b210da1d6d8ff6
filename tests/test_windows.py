import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from samples import at, clock, ticks, values
from tickloom.operators import windows
from tickloom.plans.inspect import plan_text, scanned_columns, shuffles

ORDER = ("symbol", "window_start")


def test_a_tick_is_in_six_windows(spark):
    got = windows.sliding_average(ticks(spark, [("A", 5.0, 1.0, at(75))]))
    assert values(got.select("window_start", "window_end", "avg_price", "n_ticks"), "window_start") == [
        (clock(s), clock(s + 60), 5.0, 1) for s in (20, 30, 40, 50, 60, 70)
    ]


def test_window_ends_are_exclusive(spark):
    got = windows.sliding_average(ticks(spark, [("A", 5.0, 1.0, at(60))]))
    assert [row.window_start for row in got.orderBy("window_start").collect()][0] == clock(10)


def test_window_date_is_that_of_the_start(spark):
    got = windows.sliding_average(ticks(spark, [("A", 5.0, 1.0, at(5))]))
    assert {str(row[0]) for row in got.select("window_date").collect()} == {"2023-12-31", "2024-01-01"}


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.tuples(st.sampled_from("AB"), st.integers(1, 1000), st.integers(0, 400)),
        min_size=1, max_size=40,
    )
)
def test_panes_agree_with_direct_windows(spark, raw):
    rows = ticks(spark, [(s, p / 100, 1.0, at(t)) for s, p, t in raw])
    panes = windows.sliding_average(rows).withColumn("avg_price", F.round("avg_price", 9))
    direct = windows.sliding_average_stream(rows, lateness=None).withColumn("avg_price", F.round("avg_price", 9))
    assert panes.columns == direct.columns
    assert values(panes, *ORDER) == values(direct, *ORDER)
    assert panes.agg(F.sum("n_ticks")).first()[0] == 6 * len(raw)


def test_rows_without_time_are_in_no_window(spark):
    rows = ticks(spark, [("A", 5.0, 1.0, None), ("A", 5.0, 1.0, at(1))])
    assert windows.sliding_average(rows).agg(F.sum("n_ticks")).first()[0] == 6


@pytest.mark.parametrize("size, slide", [(60, 7), (50, 20), (45, 45), (10, 9)])
def test_any_slide_up_to_the_size(spark, size, slide):
    rows = ticks(spark, [("A", 5.0 + s, 1.0, at(s)) for s in (0, 1, 19, 20, 44, 45, 59, 60, 131)])
    panes = windows.sliding_average(rows, size, slide).withColumn("avg_price", F.round("avg_price", 9))
    direct = windows.sliding_average_stream(rows, size, slide, None)
    direct = direct.withColumn("avg_price", F.round("avg_price", 9))
    assert values(panes, *ORDER) == values(direct, *ORDER)


def test_slide_is_not_longer_than_the_window(spark):
    with pytest.raises(ValueError):
        windows.sliding_average(ticks(spark, [("A", 5.0, 1.0, at(1))]), 60, 61)


def test_closed_windows_end_by_the_watermark(spark):
    rows = ticks(spark, [("A", 5.0, 1.0, at(0)), ("A", 5.0, 1.0, at(170))])
    got = windows.closed_windows(windows.sliding_average(rows), rows)
    assert max(row.window_end for row in got.collect()) == clock(50)
    assert got.count() == 5


def test_running_stats(spark):
    rows = [("A", 1.0, 10.0, at(0)), ("A", 4.0, 5.0, at(1)), ("B", 2.0, 1.0, at(0))]
    assert values(windows.running_stats(ticks(spark, rows)), "symbol") == [
        ("A", 1.0, 4.0, 2.5, 15.0, 2), ("B", 2.0, 2.0, 2.0, 1.0, 1),
    ]


def test_chart_series(spark):
    rows = ticks(spark, [("A", 1.0, 10.0, at(0)), ("A", 3.0, 5.0, at(59)), ("A", 7.0, 1.0, at(60))])
    assert values(windows.price_series(rows), "window_start") == [(clock(0), "A", 2.0), (clock(60), "A", 7.0)]
    assert values(windows.volume_series(rows)) == [(clock(0), "A", 16.0)]
    gold = windows.sliding_average(rows)
    series = windows.average_series(gold)
    assert series.columns == ["window_start", "symbol", "avg_price"]
    assert series.count() == gold.count()
    assert shuffles(series) == 2  # panes and windows, none for the chart


def test_windows_read_three_columns_and_combine_first(spark, folder):
    ticks(spark, [("A", 5.0, 1.0, at(1))]).write.parquet(f"{folder}/t")
    rows = windows.sliding_average(spark.read.parquet(f"{folder}/t"))
    assert scanned_columns(rows) == ["symbol:string,price:double,event_time:timestamp"]
    plan = plan_text(rows)
    assert "partial_sum(price" in plan
    assert plan.index("Generate") < plan.index("Scan parquet")  # spread after the panes are summed

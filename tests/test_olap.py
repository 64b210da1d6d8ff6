import datetime as dt

import pytest
from pyspark.sql import functions as F

from samples import at, ticks, values
from tickloom.operators import olap
from tickloom.plans.inspect import plan_text, scanned_columns

DAY = 86400
D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
ROWS = [
    ("A", 1.0, 10.0, at(0)), ("A", 3.0, 20.0, at(3600)), ("A", 2.0, 5.0, at(DAY)),
    ("B", 5.0, 1.0, at(0)), ("B", 5.0, 1.0, at(DAY)), ("C", 9.0, 4.0, at(DAY + 3600)),
]


@pytest.fixture
def rows(spark):
    return ticks(spark, ROWS)


def test_daily_average_in_order(rows):
    assert values(olap.daily_average(rows)) == [
        (D1, "A", 2.0, 2), (D1, "B", 5.0, 1), (D2, "A", 2.0, 1), (D2, "B", 5.0, 1), (D2, "C", 9.0, 1),
    ]


def test_volatility_ranks_wildest_first_and_single_ticks_last(rows):
    assert values(olap.volatility(rows)) == [
        ("A", 2.0, 1.0, 50.0, 3), ("B", 5.0, 0.0, 0.0, 2), ("C", 9.0, None, None, 1),
    ]
    assert values(olap.most_volatile(rows)) == [("A", 2.0, 1.0, 50.0, 3)]


def test_mean_of_zero_gives_no_coefficient(spark):
    rows = ticks(spark, [("A", -1.0, 1.0, at(0)), ("A", 1.0, 1.0, at(1))])
    assert olap.volatility(rows).first().cv_pct is None


def test_peak_hours_by_volume_then_hour(spark, rows):
    assert values(olap.peak_hours(rows)) == [(1, 2, 24.0), (0, 4, 17.0)]
    tied = ticks(spark, [("A", 1.0, 1.0, at(7200)), ("A", 1.0, 1.0, at(3600))])
    assert [row.hour_utc for row in olap.peak_hours(tied).collect()] == [1, 2]


def test_rollup_levels_and_order(rows):
    assert values(olap.rollup_volume(rows)) == [
        (D1, "A", 30.0, 2, 0), (D1, "B", 1.0, 1, 0), (D1, None, 31.0, 3, 1),
        (D2, "A", 5.0, 1, 0), (D2, "B", 1.0, 1, 0), (D2, "C", 4.0, 1, 0), (D2, None, 10.0, 3, 1),
        (None, None, 41.0, 6, 3),
    ]


def test_cube_holds_the_rollup_and_symbol_totals(rows):
    cube, roll = olap.cube_volume(rows), olap.rollup_volume(rows)
    assert roll.exceptAll(cube).isEmpty()
    assert values(cube.filter("level = 2").select("symbol", "total_volume")) == [("A", 35.0), ("B", 2.0), ("C", 4.0)]
    for level in range(4):
        assert cube.filter(F.col("level") == level).agg(F.sum("total_volume")).first()[0] == 41.0


def test_level_tells_a_null_key_from_a_subtotal(spark):
    rows = ticks(spark, [("A", 1.0, 2.0, at(0)), (None, 1.0, 3.0, at(0))])
    got = values(olap.rollup_volume(rows).filter("ingest_date IS NOT NULL AND symbol IS NULL"))
    assert got == [(D1, None, 3.0, 1, 0), (D1, None, 5.0, 2, 1)]


def test_subtotals_of_nothing_count_zero(spark, rows):
    nothing = rows.filter("price > 100")
    assert values(olap.rollup_volume(nothing)) == values(
        nothing.rollup("ingest_date", "symbol").agg(
            F.round(F.sum("volume"), 2), F.count(F.lit(1)), F.grouping_id()
        )
    )


def test_subtotals_expand_after_a_first_sum(spark, folder, rows):
    rows.write.parquet(f"{folder}/t")
    cube = olap.cube_volume(spark.read.parquet(f"{folder}/t"))
    plan = plan_text(cube)
    assert plan.index("Expand") < plan.index("Scan parquet")
    tree = plan.split("\n\n")[0]
    assert tree[tree.index("Expand"):].count("HashAggregate") == 2
    assert scanned_columns(cube) == ["symbol:string,volume:double,ingest_date:date"]


def test_symbol_check(rows):
    assert values(olap.symbol_check(rows)) == [("A", 2.0, 3), ("B", 5.0, 2), ("C", 9.0, 1)]


def test_layer_counts_leave_out_missing_layers(rows):
    got = olap.layer_counts({"bronze": rows, "silver": rows.limit(2), "gold": None})
    assert values(got, "layer") == [("bronze", 6), ("silver", 2)]
    with pytest.raises(ValueError):
        olap.layer_counts({"gold": None})


def test_first_rows_need_no_full_sort(rows):
    top = olap.first_rows(rows, 2, F.col("price").desc())
    assert [row.price for row in top.collect()] == [9.0, 5.0]
    assert "TakeOrderedAndProject" in plan_text(top)

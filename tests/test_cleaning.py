import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from samples import START, ticks, values
from tickloom.functions.bands import PriceBands, anchor_price
from tickloom.operators.cleaning import clean_ticks, clean_with_anchor_table, drop_repeats
from tickloom.operators.lookup import lookup_join, measured_bytes
from tickloom.plans.inspect import plan_text, pushed_filters

BANDS = PriceBands({"AAAUSDT": 100.0}, 0.3, 3.0)
ROWS = [
    ("AAAUSDT", 100.0 * 0.3, 1.0, START),  # on the lower bound
    ("AAAUSDT", 29.99, 1.0, START),
    ("AAAUSDT", 300.0, 0.0, START),  # on the upper bound, volume zero
    ("AAAUSDT", 300.01, 1.0, START),
    ("NEWUSDT", 1e9, 1.0, START),  # no anchor
    ("NEWUSDT", 0.0, 1.0, START),
    ("NEWUSDT", 1.0, -0.1, START),
    ("NEWUSDT", None, 1.0, START),
    ("NEWUSDT", 1.0, None, START),
    (None, 5.0, 1.0, START),
]
KEPT = {("AAAUSDT", 30.0), ("AAAUSDT", 300.0), ("NEWUSDT", 1e9), (None, 5.0)}


def test_outlier_filter(spark):
    kept = clean_ticks(ticks(spark, ROWS), BANDS)
    assert set(values(kept.select("symbol", "price"))) == KEPT
    assert kept.columns == ticks(spark, ROWS).columns


def test_filter_is_idempotent(spark):
    once = clean_ticks(ticks(spark, ROWS), BANDS)
    assert clean_ticks(once, BANDS).exceptAll(once).isEmpty()
    assert clean_ticks(once, BANDS).count() == once.count()


def test_market_bands_by_default(spark):
    rows = [("SOLUSDT", 180.0, 1.0, START), ("SOLUSDT", 256.0, 1.0, START), ("ADAUSDT", 0.55, 1.0, START)]
    assert values(clean_ticks(ticks(spark, rows)).select("price"), "price") == [(0.55,), (180.0,)]


def test_unknown_symbol_has_no_anchor(spark):
    got = ticks(spark, ROWS).select(anchor_price(F.col("symbol"), BANDS.anchors))
    assert [row[0] for row in got.collect()] == [100.0] * 4 + [None] * 6
    assert ticks(spark, ROWS).select(anchor_price(F.col("symbol"), {})).distinct().count() == 1


def test_too_many_inline_anchors_are_refused():
    with pytest.raises(ValueError):
        PriceBands({f"S{n}": 1.0 for n in range(101)})


@pytest.mark.parametrize("limit,strategy", [(10**9, "BroadcastHashJoin"), (0, "SortMergeJoin")])
def test_anchor_table_gives_the_same_rows(spark, limit, strategy):
    anchors = spark.createDataFrame([("AAAUSDT", 100.0)], "symbol STRING, anchor_price DOUBLE")
    with_limit = clean_with_anchor_table(ticks(spark, ROWS), anchors, broadcast_bytes=limit)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert strategy in plan_text(with_limit)
        assert set(values(with_limit.select("symbol", "price"))) == KEPT
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_salted_lookup_equals_plain_join(spark):
    facts = spark.range(3000).select((F.col("id") % 7).alias("k"), F.lit(1).alias("v")).repartition(8)
    hot = facts.unionByName(spark.range(2000).select(F.lit(3).cast("bigint").alias("k"), F.lit(1).alias("v")))
    lookup = spark.range(5).select(F.col("id").alias("k"), F.concat(F.lit("n"), "id").alias("name"))
    for how in ("inner", "left"):
        plain = hot.join(lookup, "k", how)
        salted = lookup_join(hot, lookup, ["k"], how, broadcast_bytes=0, salts=4)
        assert salted.columns == plain.columns
        assert salted.count() == plain.count()
        assert salted.exceptAll(plain).isEmpty()
    with pytest.raises(ValueError):
        lookup_join(hot, lookup, ["k"], "full")


def test_lookup_size_grows_with_text(spark):
    short = spark.createDataFrame([("a", 1)], "s STRING, n INT")
    long = spark.createDataFrame([("a" * 1000, 1)], "s STRING, n INT")
    assert measured_bytes(long) - measured_bytes(short) == 999
    assert measured_bytes(short.limit(0)) == 0


def test_repeats_are_dropped(spark):
    rows = [
        ("A", 2.0, 9.0, START), ("A", 2.0, 9.0, START),  # the same message twice
        ("A", 1.0, 5.0, START + 1), ("A", 1.0, 4.0, START + 1), ("A", 3.0, 1.0, START + 1),
        ("B", 2.0, 9.0, START),
    ]
    got = drop_repeats(ticks(spark, rows))
    assert got.columns == ticks(spark, rows).columns
    assert values(got.select("symbol", "price", "volume", "timestamp"), "symbol", "timestamp") == [
        ("A", 2.0, 9.0, START), ("A", 1.0, 4.0, START + 1), ("B", 2.0, 9.0, START),
    ]


def test_repeats_are_merged_before_the_shuffle(spark):
    plan = plan_text(drop_repeats(ticks(spark, ROWS)))
    assert plan.count("partial_min") >= 1


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.tuples(
            st.sampled_from(["AAAUSDT", "NEWUSDT"]),
            st.floats(-10, 1000), st.floats(-1, 10), st.just(START),
        ),
        min_size=1, max_size=30,
    )
)
def test_filter_agrees_with_plain_python(spark, rows):
    def keep(row):
        symbol, price, volume, _ = row
        return price > 0 and volume >= 0 and (symbol != "AAAUSDT" or 100.0 * 0.3 <= price <= 100.0 * 3.0)

    got = clean_ticks(ticks(spark, rows), BANDS).select("symbol", "price", "volume", "timestamp")
    assert sorted(values(got)) == sorted(row for row in rows if keep(row))


def test_price_filter_reaches_the_file(spark, folder):
    ticks(spark, [(s, p, v, t) for s, p, v, t in ROWS]).write.parquet(f"{folder}/t")
    pushed = pushed_filters(clean_ticks(spark.read.parquet(f"{folder}/t"), BANDS))
    assert any("GreaterThan(price,0.0)" in text and "GreaterThanOrEqual(volume,0.0)" in text for text in pushed)


def test_ticks_without_a_whole_key_repeat_nothing(spark):
    rows = [("A", 1.0, 1.0, None), ("A", 1.0, 1.0, None), (None, 2.0, 1.0, 5), (None, 2.0, 1.0, 5), ("A", 1.0, 1.0, 5), ("A", 1.0, 1.0, 5)]
    sent = spark.createDataFrame(rows, "symbol string, price double, volume double, timestamp long")
    assert drop_repeats(sent).count() == 5

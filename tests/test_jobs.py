import pytest

from samples import PUBLISHED, arrive, at
from tickloom import jobs
from tickloom.sources import versions
from tickloom.streaming import medallion, together


@pytest.fixture
def lake(spark, folder):
    rows = [("BTCUSDT", 77000.0, 1.0, at(s)) for s in range(0, 400, 20)]
    arrive(spark, [*PUBLISHED, *rows, *rows, "junk"], f"{folder}/inbox")

    def run(job, *arguments):
        jobs.main([job, "--root", folder, *arguments], spark)

    run.folder, run.inbox = folder, ["--inbox", f"{folder}/inbox", "--drain"]
    return run


def test_layers_then_reports(spark, lake, capfd):
    lake("status")
    assert "no layer is ready" in capfd.readouterr().out
    lake("layers", *lake.inbox, "--once", "--state-partitions", "2")
    assert spark.read.parquet(medallion.BRONZE.path(lake.folder)).count() == 46
    # the published five are the latest and wait for two more minutes of event time
    assert spark.read.parquet(medallion.SILVER.path(lake.folder)).count() == 20
    lake("status")
    out = capfd.readouterr().out
    assert "|bronze|    46|" in out and "|silver|    20|" in out
    lake("analyse")
    out = capfd.readouterr().out
    assert "peak_hours" in out and "cv_pct" in out
    lake("star")
    assert "|dim_symbol|     1|" in capfd.readouterr().out
    lake("compact", "--layer", "silver", "--target", f"{lake.folder}/merged")
    for before, n_rows in (("2024-01-02", 20), ("2024-01-01", 0)):  # the published five are later
        lake("compact", "--layer", "silver", "--target", f"{lake.folder}/{before}", "--before", before)
        assert spark.read.schema("price DOUBLE").parquet(f"{lake.folder}/{before}").count() == n_rows
    lake("compact", "--layer", "silver", "--target", f"{lake.folder}/finished", "--finished")
    assert "compacted 2024-01-01\n" in capfd.readouterr().out
    lake("compact", "--layer", "silver", "--target", f"{lake.folder}/finished", "--finished")
    assert "compacted no day" in capfd.readouterr().out
    lake("replay", "--layer", "silver", "--target", f"{lake.folder}/merged", "--day", "2024-01-01")
    assert versions.read_version(spark, f"{lake.folder}/merged").count() == 40  # bronze keeps the repeats
    lake("replay", "--layer", "silver", "--target", f"{lake.folder}/merged", "--day", "2024-01-01", "--once")
    assert versions.read_version(spark, f"{lake.folder}/merged").count() == 20  # as the layer was written


def test_console_latency_and_offsets(lake, capfd):
    lake("console", *lake.inbox)
    lake("latency", *lake.inbox)
    lake("offsets", *lake.inbox)
    out = capfd.readouterr().out
    for query in ("clean_console", "moving_avg_console", "per_symbol_console", "lag"):
        assert f"|{query}" in out
    assert "|financial_data|0        |0           |46         |46  |" in out


def test_all_tables_from_one_parse(spark, lake, capfd):
    for _ in range(2):  # the second run finds nothing new
        lake("together", *lake.inbox)
    out = capfd.readouterr().out
    assert "|together|1   |1      |46        |" in out and "cv_pct" in out
    assert together.read_together(spark, lake.folder, "silver").count() == 45


def test_an_anchor_table(spark, lake):
    anchors = spark.createDataFrame([("BTCUSDT", 1.0), *((f"S{k}", 1.0) for k in range(300))], "symbol string, anchor_price double")
    anchors.write.parquet(f"{lake.folder}/anchors")
    lake("layers", *lake.inbox, "--anchors", f"{lake.folder}/anchors")
    # of the published five, Bitcoin is far from this anchor and the others have none
    assert spark.read.parquet(medallion.SILVER.path(lake.folder)).count() == 4
    replayed = ["--layer", "silver", "--target", f"{lake.folder}/day", "--day", "2024-01-01"]
    lake("replay", *replayed)
    assert versions.read_version(spark, f"{lake.folder}/day").count() == 40
    lake("replay", *replayed, "--anchors", f"{lake.folder}/anchors")
    assert versions.read_version(spark, f"{lake.folder}/day").count() == 0


def test_arguments():
    parse = jobs.parser().parse_args
    args = parse(["layers", "--root", "r", "--servers", "a:1", "--max-per-trigger", "5"])
    assert (args.servers, args.topic, args.starting, args.max_per_trigger) == ("a:1", "financial_data", "latest", 5)
    assert parse(["publish", "--payloads", "p"]).run is jobs.publish
    with pytest.raises(SystemExit):
        parse(["replay", "--root", "r", "--layer", "bronze", "--target", "t", "--day", "2024-01-01"])

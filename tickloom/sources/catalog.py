"""External tables over the written layers."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from tickloom.sources.tables import read_if_ready

# Table names and their folders below the lake root.
TABLE_PATHS = {
    "bronze_ticks": "bronze/ticks",
    "silver_ticks": "silver/ticks",
    "gold_moving_avg": "gold/moving_avg",
    "fact_ticks": "gold_star/fact_ticks",
    "dim_time": "gold_star/dim_time",
    "dim_symbol": "gold_star/dim_symbol",
    "dim_market": "gold_star/dim_market",
}


def _quoted(*parts: str | None) -> str:
    return ".".join("`" + part.replace("`", "``") + "`" for part in parts if part)


def register_tables(
    spark: SparkSession,
    root: str,
    database: str | None = None,
    paths: Mapping[str, str] = TABLE_PATHS,
) -> dict[str, str]:
    """Register every table whose folder has files; repeating the call changes nothing.

    Returns ``{table: "registered" | "not ready"}``. Folders that hold nothing yet are
    reported, because creating a table over them fails.
    """
    outcome = {}
    for name, folder in paths.items():
        location = f"{root}/{folder}"
        if read_if_ready(spark, location) is None:
            outcome[name] = "not ready"
            continue
        literal = location.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {_quoted(database, name)} USING parquet LOCATION '{literal}'"
        )
        repair_partitions(spark, name, database)
        outcome[name] = "registered"
    return outcome


def repair_partitions(spark: SparkSession, name: str, database: str | None = None) -> bool:
    """Make new partition folders visible; False when the table has no partitions."""
    table = _quoted(database, name)
    if not any(column.isPartition for column in spark.catalog.listColumns(table)):
        return False
    spark.sql(f"MSCK REPAIR TABLE {table}")
    return True


def list_tables(spark: SparkSession, database: str | None = None) -> DataFrame:
    """The catalog's tables, one row each."""
    return spark.sql("SHOW TABLES" + (f" IN {_quoted(database)}" if database else ""))

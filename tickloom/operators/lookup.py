"""Joining a large table with a table that has one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_BYTES = 64 * 1024 * 1024
SALTS = 16
# Room for the row header and the hash table's own slots.
ROW_OVERHEAD = 32


def measured_bytes(rows: DataFrame) -> int:
    """The in-memory size of a table, measured by one aggregate over it."""
    width = F.lit(ROW_OVERHEAD)
    for name, kind in rows.dtypes:
        if kind in ("string", "binary"):
            width = width + F.coalesce(F.octet_length(name), F.lit(0))
        width = width + 8
    return rows.agg(F.sum(width.cast("bigint"))).first()[0] or 0


def lookup_join(
    facts: DataFrame,
    lookup: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    broadcast_bytes: int = BROADCAST_BYTES,
    salts: int = SALTS,
) -> DataFrame:
    """Join ``facts`` with a lookup table, ``how`` being ``inner`` or ``left``.

    The lookup is measured first (give a written table, not a long computation). Up to
    ``broadcast_bytes`` it is broadcast and the facts do not move. Beyond that both sides
    are shuffled, with every lookup row repeated per salt and the facts salted by the input
    partition they come from. That number is the same when a task is run again, and it
    splits a hot key even if its rows are exact copies.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"how must be inner or left, not {how!r}")
    if measured_bytes(lookup) <= broadcast_bytes:
        return facts.join(F.broadcast(lookup), list(on), how)
    salted = facts.withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
    repeated = lookup.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(repeated, [*on, "_salt"], how).drop("_salt")

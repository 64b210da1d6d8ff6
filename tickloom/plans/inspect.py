"""Looking at query plans."""

from __future__ import annotations

import io
import re
from contextlib import redirect_stdout

from pyspark.sql import DataFrame


def plan_text(rows: DataFrame) -> str:
    """The physical plan as ``explain("formatted")`` prints it."""
    printed = io.StringIO()
    with redirect_stdout(printed):
        rows.explain("formatted")
    return printed.getvalue()


def shuffles(rows: DataFrame) -> int:
    """Number of shuffles in the plan before adaptive execution changes it."""
    tree = plan_text(rows).split("\n\n")[0]
    return len(re.findall(r"\bExchange \(", tree))


def scanned_columns(rows: DataFrame) -> list[str]:
    """The columns each file scan reads, as Spark prints them."""
    return re.findall(r"ReadSchema: struct<(.*)>", plan_text(rows))


def pushed_filters(rows: DataFrame) -> list[str]:
    """The predicates handed to each file scan, on columns and on partitions."""
    return re.findall(r"(?:PushedFilters|PartitionFilters): \[(.*)\]", plan_text(rows))

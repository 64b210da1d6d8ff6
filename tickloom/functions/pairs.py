"""Splitting a trading pair such as ``BTCUSDT`` into base and quote asset."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

QUOTE_WIDTH = 4


def split_pair(symbol: Column, quotes: Iterable[str] = ()) -> tuple[Column, Column]:
    """Return ``(base, quote)``.

    The quote asset is the last four characters, unless the symbol ends with one of
    ``quotes``; then the longest such ending wins.
    """
    width = F.lit(QUOTE_WIDTH)
    for ending in sorted(quotes, key=len):
        width = F.when(symbol.endswith(ending), F.lit(len(ending))).otherwise(width)
    size = F.length(symbol)
    base = F.substring(symbol, F.lit(1), size - width)
    quote = F.substring(symbol, size - width + 1, width)
    return base, quote

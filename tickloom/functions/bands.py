"""Plausible price bands around a per-symbol anchor price."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

# Rough mid prices and the band around them, used only to spot outliers.
MARKET_ANCHORS = {
    "BTCUSDT": 77000.0,
    "ETHUSDT": 2300.0,
    "SOLUSDT": 85.0,
    "BNBUSDT": 630.0,
    "ADAUSDT": 0.25,
}
LOWER_RATIO = 0.3
UPPER_RATIO = 3.0

# Above this many symbols a CASE expression gets slow; pass the anchors as a table instead.
MAX_INLINE_ANCHORS = 100


@dataclass(frozen=True)
class PriceBands:
    """Anchor prices and the accepted ratios around them, both bounds inclusive."""

    anchors: Mapping[str, float] = field(default_factory=lambda: dict(MARKET_ANCHORS))
    lower: float = LOWER_RATIO
    upper: float = UPPER_RATIO

    def __post_init__(self) -> None:
        if len(self.anchors) > MAX_INLINE_ANCHORS:
            raise ValueError(
                f"{len(self.anchors)} anchors; above {MAX_INLINE_ANCHORS} use an anchor table"
            )


def anchor_price(symbol: Column, anchors: Mapping[str, float]) -> Column:
    """The anchor of a symbol, NULL when there is none."""
    if not anchors:
        return F.lit(None).cast("double")
    return _by_symbol(symbol, {name: F.lit(float(price)) for name, price in anchors.items()})


def _by_symbol(symbol: Column, values: Mapping[str, Column]) -> Column:
    (first, value), *others = values.items()
    branches = F.when(symbol == first, value)
    for name, value in others:
        branches = branches.when(symbol == name, value)
    return branches


def inside_band(symbol: Column, price: Column, bands: PriceBands) -> Column:
    """:func:`near_anchor` with ready-made bounds, so that a symbol is looked up once per tick."""
    if not bands.anchors:
        return F.lit(True)
    verdicts = {
        name: price.between(float(anchor) * bands.lower, float(anchor) * bands.upper)
        for name, anchor in bands.anchors.items()
    }
    return _by_symbol(symbol, verdicts).otherwise(True)


def tradable(price: Column, volume: Column) -> Column:
    """Price above zero and volume not negative; NULL in either means no."""
    return (price > 0) & (volume >= 0)


def near_anchor(price: Column, anchor: Column, lower: float, upper: float) -> Column:
    """Inside the band; a symbol without anchor is not judged."""
    return anchor.isNull() | price.between(anchor * F.lit(lower), anchor * F.lit(upper))

"""Classification of readings against bands and thresholds."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from wardline.schemas import ALERT_THRESHOLD, TREND_LABELS, Band


def outside(value: Column, band: Band) -> Column:
    """Strictly below the lower or strictly above the upper bound."""
    sides = []
    if band.low is not None:
        sides.append(value < F.lit(band.low))
    if band.high is not None:
        sides.append(value > F.lit(band.high))
    return reduce(lambda a, b: a | b, sides, F.lit(False)) if sides else F.lit(False)


def abnormal_flag(item: Column, value: Column, bands: Iterable[Band], ids: Iterable) -> Column:
    """1 where the reading lies outside its item's band, 0 otherwise or for unknown items."""
    hits = [(item == F.lit(i)) & outside(value, b) for i, b in zip(ids, bands)]
    return F.when(reduce(lambda a, b: a | b, hits, F.lit(False)), 1).otherwise(0)


def alert_colour(value: Column, threshold: float = ALERT_THRESHOLD, base: str = "green") -> Column:
    """Red at or above the threshold; a missing value keeps the base colour."""
    return F.when(value >= F.lit(threshold), "red").otherwise(base)


def caption(name: Column, labels: Mapping[str, str] = TREND_LABELS) -> Column:
    """Display label of a vital, or its own name where there is none."""
    pairs = [F.lit(x) for pair in labels.items() for x in pair]
    return F.coalesce(F.create_map(*pairs)[name], name)

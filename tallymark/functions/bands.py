"""Bucketing a number into labelled bands, and two-way relabelling."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F


class Bands(NamedTuple):
    edges: Sequence[float]
    labels: Sequence[str]
    closed: str = "right"
    minimum: float | None = None


# The two age scales in use.
FOUR_BANDS = Bands((18, 35, 50), ("0-18", "18-35", "35-50", "50+"), "right", 0)
FIVE_BANDS = Bands((18, 31, 41, 51), ("Under 18", "18-30", "31-40", "41-50", "51+"), "left")


def bucketize(
    value: Column,
    edges: Sequence[float],
    labels: Sequence[str],
    closed: str = "right",
    minimum: float | None = None,
) -> Column:
    """Label of the band that holds `value`; null for null and for values under `minimum`.

    `closed="right"` puts an edge in the band below it, `"left"` in the band above it.
    """
    if len(labels) != len(edges) + 1:
        raise ValueError("one more label than edges is needed")
    if closed not in ("right", "left"):
        raise ValueError("closed must be 'right' or 'left'")
    band = F.when(value < F.lit(minimum), F.lit(None)) if minimum is not None else F
    for edge, label in zip(edges, labels):
        band = band.when(value <= edge if closed == "right" else value < edge, F.lit(label))
    return band.when(value.isNotNull(), F.lit(labels[-1]))


def relabel(value: Column, match: str = "M", hit: str = "Male", other: str = "Female") -> Column:
    """`hit` where the value equals `match`, `other` for anything else, nulls included."""
    return F.when(value == match, F.lit(hit)).otherwise(F.lit(other))

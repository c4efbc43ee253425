"""Masks of depth, alpha and coverage as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

OPAQUE = 254.5  # an alpha below this still lets land show


def complete_rgb(r: Column, g: Column, b: Column) -> Column:
    return r.isNotNull() & g.isNotNull() & b.isNotNull()


def ocean(depth: Column, nodata: float = -32767.0, fade: float = -50.0) -> Column:
    return (depth > nodata + 0.1) & (depth < fade)


def fill_allowed(alpha: Column, covered: Column, nodata: float | None = None) -> Column:
    open_ = (alpha < OPAQUE) & covered
    return open_ if nodata is None else open_ & (alpha != nodata)


def discovery(value: Column, has_alpha: bool, nodata: float | None = None, fade: float = -50.0) -> Column:
    """Whether land may be found at a cell, by its alpha or else by its depth."""
    if has_alpha:
        return (value < OPAQUE) & (value != nodata) if nodata is not None else value < OPAQUE
    return ~F.isnan(value) & (value > (nodata if nodata is not None else -32767.0) + 0.1) & (value >= fade)


def drop_positive(value: Column, above: float = 0.001) -> Column:
    """Depths only: land becomes null."""
    return F.when(~(value > above), value)


def alpha(valid: Column, ocean_alpha: Column | None = None, allowed: Column | None = None, covered: Column | None = None, filled: Column | None = None) -> Column:
    """The alpha of a land pixel: by its validity, by where land is allowed, or against the ocean's alpha."""
    if ocean_alpha is None:
        out = valid.cast("int") * 255
    elif allowed is not None:
        out = allowed.cast("int") * 255
    else:
        out = F.least(F.greatest(255 - ocean_alpha, F.lit(0)), F.lit(255)).cast("int")
    if filled is not None:
        out = F.when(filled, F.lit(255)).otherwise(out)
    return out if covered is None else F.when(covered, out).otherwise(F.lit(0))


def has_enough_land(percent: Column, threshold: float) -> Column:
    """A threshold of 100 or more always holds, 0 or less never, an unknown share always."""
    if threshold >= 100:
        return F.lit(True)
    if threshold <= 0:
        return F.lit(False)
    return F.coalesce(percent >= threshold, F.lit(True))

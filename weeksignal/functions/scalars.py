"""Small numeric and structural helpers as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

QUADRANTS = ("Trending Everywhere", "Social Hype", "Academic Focus", "Emerging")


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def half_even(c, digits: int) -> Column:
    return F.bround(_col(c), digits)


def clip(c, low=None, high=None) -> Column:
    """Clamp to the given bounds; NULL stays NULL."""
    value = _col(c)
    out = value
    if low is not None:
        out = F.greatest(out, low if isinstance(low, Column) else F.lit(low))
    if high is not None:
        out = F.least(out, high if isinstance(high, Column) else F.lit(high))
    return F.when(value.isNotNull(), out)


def is_finite(x: Column) -> Column:
    return ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))


def bubble_size(burst) -> Column:
    return clip(burst, low=0.0) * 22 + 12


def quadrant(academic, social) -> Column:
    """Which half of each normalised axis a topic lies in."""
    a, s = _col(academic) >= 0.5, _col(social) >= 0.5
    return (
        F.when(a & s, QUADRANTS[0])
        .when(s, QUADRANTS[1])
        .when(a, QUADRANTS[2])
        .otherwise(QUADRANTS[3])
    )


def json_text(c, path: str, default: str = "") -> Column:
    """A JSON field as text, with a default for a missing field or JSON null."""
    return F.coalesce(F.get_json_object(_col(c), path), F.lit(default))


def safe_ratio(numerator, denominator) -> Column:
    """Quotient, 0 where the denominator is 0."""
    num, den = _col(numerator).cast("double"), _col(denominator).cast("double")
    return F.when(den == 0, F.lit(0.0)).otherwise(num / den)

"""Numeric helpers that pin down rounding and division semantics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_even(c: Column, scale: int) -> Column:
    """Round to ``scale`` decimals, ties to even, on the binary double value.

    This is the rounding of the model-side figures: scale up by ``10**scale``,
    round to the nearest integer with ties to even (``rint``), scale back. It
    differs from ``F.round`` (HALF_UP on the decimal rendering) and from
    ``F.bround`` (HALF_EVEN on the decimal rendering) only for values whose
    scaled double sits on a tie, e.g. 0.125 → 0.12 here, 0.13 with ``round``.
    """
    factor = float(10**scale)
    return F.rint(c * F.lit(factor)) / F.lit(factor)


def safe_ratio(num: Column, den: Column, otherwise: float | None = 0.0) -> Column:
    """``num / den`` when ``den > 0``, else ``otherwise`` (ANSI-safe: no division by zero)."""
    return F.when(den > 0, num / den).otherwise(F.lit(otherwise))


def pct(part: Column, total: Column, scale: int = 1) -> Column:
    """Share of the total in percent, rounded ties-to-even to ``scale`` decimals."""
    return round_half_even(F.try_divide(part * F.lit(100.0), total), scale)


#: From this size on, values are added as doubles.
WIDE = 1e19


def exact_sum(c: Column, as_double: bool = True) -> Column:
    """Sum of a double column that does not depend on the order of addition.

    Each value is taken at its shortest decimal form with up to 18 decimals, so
    sums have no binary rounding before the end. Infinite sums, and values of
    1e19 and beyond, which such decimals can't hold, are added as doubles. NaN
    counts as NULL. With ``as_double=False`` the result is the decimal sum, for
    adding up partial sums (the caller then looks after values beyond ``WIDE``).
    """
    clean = F.nanvl(c.cast("double"), F.lit(None).cast("double"))
    total = F.sum(clean.try_cast("decimal(38,18)"))
    if not as_double:
        return total
    return F.when(F.max(F.abs(clean)) >= WIDE, F.sum(clean)).otherwise(total.cast("double"))


def scaled_sum(c: Column, scale: int) -> Column:
    """Exact sum, in units of ``10**-scale``, of values already rounded to ``scale`` decimals."""
    return F.sum(F.round(c * F.lit(float(10**scale))).cast("decimal(38,0)"))


def units_to_double(c: Column, scale: int) -> Column:
    return c.cast("double") / F.lit(float(10**scale))

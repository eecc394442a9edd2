"""Column cleaning as one projection of built-in expressions.

Each raw numeric column has a ``ColumnClean`` spec; ``clean_columns`` turns
the specs into a single ``withColumns`` so Catalyst sees plain expressions
inside whole-stage codegen (no Python UDF).
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import STRIP_PATTERN


@dataclass(frozen=True)
class ColumnClean:
    """How one raw string column becomes a number.

    strip          remove double quotes and all whitespace first
    decimal_comma  read ``,`` as the decimal separator
    target         ``double`` or ``int`` (an ``int`` truncates the parsed double)
    scale          round HALF_UP to this many decimals (``double`` only)
    """

    name: str
    strip: bool = False
    decimal_comma: bool = False
    target: str = "double"
    scale: int | None = None


# The silver cleaning of the sales columns. Note the asymmetries, which decide
# results: sales and quantity are stripped but keep a comma (``1,234`` fails to
# parse); profit and shipping cost are cast without any cleaning.
SALES_CLEANING = (
    ColumnClean("sales", strip=True, target="int"),
    ColumnClean("quantity", strip=True, target="int"),
    ColumnClean("discount", strip=True, decimal_comma=True),
    ColumnClean("margem_lucro", strip=True, decimal_comma=True, scale=4),
    ColumnClean("profit", scale=2),
    ColumnClean("shipping_cost", scale=2),
)


def strip_quotes_and_space(c: Column) -> Column:
    return F.regexp_replace(c, STRIP_PATTERN, "")


def decimal_comma_to_dot(c: Column) -> Column:
    return F.regexp_replace(c, ",", ".")


def safe_double(c: Column) -> Column:
    """String to double; text that is not a number becomes NULL."""
    return c.try_cast("double")


def truncate_to_int(c: Column) -> Column:
    """Double to int by truncation toward zero; out-of-range becomes NULL.

    ``try_cast`` (not ``cast``) so that an ANSI session yields NULL instead of
    failing the job on a value such as 99999999999.
    """
    return c.try_cast("int")


def clean_expr(spec: ColumnClean) -> Column:
    c = F.col(spec.name)
    if spec.strip:
        c = strip_quotes_and_space(c)
    if spec.decimal_comma:
        c = decimal_comma_to_dot(c)
    c = safe_double(c)
    if spec.target == "int":
        return truncate_to_int(c)
    if spec.target != "double":
        raise ValueError(f"unsupported target {spec.target!r} for {spec.name}")
    if spec.scale is not None:
        c = F.round(c, spec.scale)
    return c


def clean_columns(df: DataFrame, specs: Iterable[ColumnClean] = SALES_CLEANING) -> DataFrame:
    """Replace each raw column in place by its typed, cleaned value."""
    return df.withColumns({s.name: clean_expr(s) for s in specs})

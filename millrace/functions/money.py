"""Exact money arithmetic on ``double`` columns.

Amounts become whole cents. Their sum is kept as two ``bigint`` sums, of the
high and the low bits, which is as cheap as adding integers, cannot overflow at
any realistic number of rows, and does not depend on the order of the rows.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, WindowSpec
from pyspark.sql import functions as F

CENT = Decimal("0.01")
LOW_BITS = 20


#: Below this many cents a double tells which whole cent is nearest, unless it lies near a half.
CERTAIN = 1e14


def cents(col: Column | str) -> Column:
    """The amount in cents as ``bigint``, as a cast to decimal(18,2) gives it.

    An amount out of range, infinite or not a number fails the job. Amounts near half a
    cent, whose rounding hangs on the decimal digits, take the cast itself; for all others
    the nearest whole cent is the same and much cheaper.
    """
    amount = F.col(col) if isinstance(col, str) else col
    hundred = amount.cast("double") * 100
    near = (F.abs(hundred) < CERTAIN) & (F.abs(hundred - F.rint(hundred)) < 0.25)
    checked = F.coalesce(
        amount.cast("decimal(18,2)"), F.raise_error(F.lit("amount out of range")).cast("decimal(18,2)")
    )
    exact = (checked * 100).cast("bigint")
    return F.when(amount.isNull(), None).when(near, F.rint(hundred).cast("bigint")).otherwise(exact)


def net_units(price: Column | str, discount: Column | str) -> Column:
    """``price * (1 - discount)``, both taken to two places, in hundredths of a cent."""
    return cents(price) * (100 - cents(discount))


def halves(whole: Column) -> tuple[Column, Column]:
    """High and low part of a whole number; the sums of both make up the sum."""
    return F.shiftright(whole, LOW_BITS), whole.bitwiseAND(F.lit(2**LOW_BITS - 1).cast("bigint"))


def from_halves(high: Column, low: Column) -> Column:
    """The whole number, as a decimal, whose summed parts are given."""
    return high.cast("decimal(20,0)") * F.lit(Decimal(2**LOW_BITS)) + low.cast("decimal(20,0)")


def summands(col: Column | str, scale: int | None) -> tuple[Column, Column]:
    """Two columns whose sums make up the sum of ``col``: money has a scale of 2, other values None."""
    if scale == 2:
        return halves(cents(col))
    if scale is not None:
        raise ValueError(f"money has two places, other values no scale: {scale}")
    value = F.col(col) if isinstance(col, str) else col
    return value, F.when(value.isNotNull(), F.lit(0))


def from_sums(high: Column, low: Column, scale: int | None) -> Column:
    return from_halves(high, low) * F.lit(CENT) if scale == 2 else high + low


def total(col: Column | str, over: WindowSpec | None = None, scale: int | None = 2) -> Column:
    """Sum of an amount, also over a window.

    Money (``scale`` 2) is added up exactly and comes out as a decimal with two places; with no
    scale the values are added up as they are.
    """
    sums = [F.sum(part) for part in summands(col, scale)]
    return from_sums(*[s.over(over) if over is not None else s for s in sums], scale)

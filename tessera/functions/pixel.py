"""Element-wise pixel expressions. All take and return columns, and stay inside generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def invert(v: Column, top: int = 255) -> Column:
    """Complement of an unsigned integer pixel."""
    return F.lit(top) - v


def negate(v: Column) -> Column:
    """Complement of a float pixel."""
    return -v


def wrap(v: Column, bits: int = 16) -> Column:
    """Unsigned wrap-around, as a fixed-width store shows it; Spark has no unsigned types."""
    return F.pmod(v.cast("bigint"), F.lit(1 << bits))


def as_signed(v: Column, bits: int = 16) -> Column:
    """The same bits read as a signed number."""
    u = wrap(v, bits)
    return F.when(u >= 1 << (bits - 1), u - (1 << bits)).otherwise(u)


def unit(v: Column, top: int = 255) -> Column:
    """Integer range to 0..1."""
    return v / F.lit(float(top))


def log2p1(v: Column) -> Column:
    return F.log2(v + F.lit(1.0))


def nan_to_zero(v: Column) -> Column:
    return F.nanvl(v, F.lit(0.0))


def clip_scale(v: Column, low: Column, high: Column, top: int = 255) -> Column:
    """Linear rescale of low..high to 0..top, clipped and cut to an integer; a flat range gives 0."""
    share = (v - low) / (high - low)
    return F.when(high > low, F.floor(F.least(F.greatest(share, F.lit(0.0)), F.lit(1.0)) * top)).otherwise(F.lit(0)).cast("int")


def flag(condition: Column, on: int = 255) -> Column:
    return F.when(condition, F.lit(on)).otherwise(F.lit(0))

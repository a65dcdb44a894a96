"""Exact money arithmetic on whole cents."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from cashtide.schemas import MONEY, TOTAL_CENTS

_LOW_BITS = 16


def wide_sum(cents: Column) -> Column:
    """Sum of LONG cents that cannot overflow, as DECIMAL.

    A DECIMAL sum leaves the fast hash-aggregate buffers (measured six times slower here).
    Two LONG sums, of the high part and of the low 16 bits, stay in them and are joined once
    per group.  The low part is safe for 2^47 rows in a group.
    """
    high = F.sum(F.shiftright(cents, _LOW_BITS)).cast("decimal(20,0)")
    low = F.sum(cents.bitwiseAND(F.lit((1 << _LOW_BITS) - 1).cast("long"))).cast("decimal(20,0)")
    scale = F.lit(1 << _LOW_BITS).cast("decimal(6,0)")
    return (high * scale + low).cast(TOTAL_CENTS)


def inbound(amount: Column = None, direction: Column = None) -> Column:
    """Amount of a CREDIT, 0 otherwise."""
    amount = F.col("amount_cents") if amount is None else amount
    direction = F.col("direction") if direction is None else direction
    return F.when(direction == "CREDIT", amount).otherwise(F.lit(0).cast("long"))


def outbound(amount: Column = None, direction: Column = None) -> Column:
    """Amount of anything that is not a CREDIT, 0 otherwise."""
    amount = F.col("amount_cents") if amount is None else amount
    direction = F.col("direction") if direction is None else direction
    return F.when(direction == "CREDIT", F.lit(0).cast("long")).otherwise(amount)


def to_money(cents: Column) -> Column:
    """Cents to the DECIMAL(20,2) of stored tables and messages."""
    return (cents.cast(TOTAL_CENTS) * F.lit("0.01").cast("decimal(3,2)")).cast(MONEY)


def to_double(cents: Column) -> Column:
    """Cents to DOUBLE: one correctly rounded division."""
    return cents.cast("double") / F.lit(100.0)


def to_cents(amount: Column) -> Column:
    """Amount (number or numeric text) to whole cents; NULL when it is not a finite number."""
    value = amount.try_cast("double")
    fits = F.abs(value) < F.lit(9.0e16)
    return F.when(fits, F.round(value * 100).cast("long"))

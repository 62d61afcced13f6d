"""64-bit integers as text and as wire bytes."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_long(text: Column, strict: bool = False) -> Column:
    """The bigint a decimal text stands for, or null where it is not one; if ``strict``, such a text fails the query.

    Only an optional sign and digits count, with no blanks around them; the
    cast alone would trim. Values beyond 64 bits are null too.
    """
    number = F.when(text.rlike(r"\A[+-]?[0-9]+\z"), text.try_cast("bigint"))
    if not strict:
        return number
    failed = F.raise_error(F.concat(F.lit("not a 64-bit number: "), text)).cast("bigint")
    return F.when(text.isNull() | number.isNotNull(), number).otherwise(failed)


def wrapping_minus(count: Column, number: Column) -> Column:
    """A count less any bigint, wrapping around at 64 bits instead of failing.

    Only numbers near the lower end can leave the range, so the detour over
    decimals is taken for those alone.
    """
    exact = count.cast("decimal(20,0)") - number.cast("decimal(20,0)")
    wrapped = F.when(exact >= F.lit(Decimal(2**63)), exact - F.lit(Decimal(2**64))).otherwise(exact)
    return F.when(number > -(2**62), count - number).otherwise(wrapped.cast("bigint"))


def long_to_wire(number: Column) -> Column:
    """A bigint as eight big-endian bytes."""
    return F.to_binary(F.lpad(F.hex(number), 16, "0"), F.lit("hex"))


def long_from_wire(data: Column) -> Column:
    """The bigint held in eight big-endian bytes."""
    return F.conv(F.hex(data), 16, -10).cast("bigint")

"""Column helpers: presence, rounding and text shapes that behave alike on every engine."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def present(c: Column) -> Column:
    """Neither null nor blank: the one rule for "has a value" (missing, null and '' are alike)."""
    return c.isNotNull() & (F.trim(c) != "")


def filled(c: Column) -> Column:
    """1 where a text is present, else 0; for sums."""
    return F.when(present(c), 1).otherwise(0)


def rounded(c: Column, places: int) -> Column:
    """Half-up by floor(x * 10^k + 0.5) / 10^k, which gives the same bits everywhere."""
    k = float(10**places)
    return F.floor(c * k + 0.5) / k


def cents(c: Column) -> Column:
    return rounded(c, 2)


def let(value: Column, use) -> Column:
    """``use`` of a value that is made once per row."""
    return F.element_at(F.transform(F.array(value), use), 1)


def hours_between(later: Column, earlier: Column) -> Column:
    return (F.unix_micros(later) - F.unix_micros(earlier)) / 3.6e9


def shard_of(hex_id: Column, shards: int) -> Column:
    """The last four hex digits modulo the number of shards."""
    return F.conv(F.right(hex_id, F.lit(4)), 16, 10).cast("long") % shards

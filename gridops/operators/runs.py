"""Runs of hours without sorting: a day's hours are bits of one integer.

A day of a point or region is packed by a bit aggregate (a hash aggregate that combines
map-side), and runs are read off by bit arithmetic, so no window sorts the rows.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def bit(hour: str) -> Column:
    return F.expr(f"shiftleft(1L, cast({hour} as int))")


def packed(hour: str, when: Column | None = None) -> Column:
    """Aggregate: the hours (where ``when`` holds) as one integer; none is 0."""
    one = bit(hour) if when is None else F.when(when, bit(hour))
    return F.coalesce(F.bit_or(one), F.lit(0).cast("long"))


def rank(mask: str, hour: str) -> Column:
    """How many hours of ``mask`` there are up to ``hour``, itself included."""
    return F.expr(f"bit_count({mask} & (shiftleft(2L, cast({hour} as int)) - 1))").cast("long")


def upward(mask: str, hour: str) -> Column:
    """Length of the run of ``mask`` that goes on from ``hour``, itself included."""
    rest = f"shiftright({mask}, cast({hour} as int))"
    return F.expr(f"bit_count({rest} & ~({rest} + 1))").cast("long")


def length(mask: str, hour: str) -> Column:
    """Length of the run of ``mask`` that ``hour``, one of its hours, lies in."""
    missing = f"(~{mask} & (shiftleft(1L, cast({hour} as int)) - 1))"
    before = F.expr(f"{hour} - if({missing} = 0, 0, length(bin({missing})))")
    return before.cast("long") + upward(mask, hour)


def starts(mask: str, hours: int = 24) -> Column:
    """The first hours of all runs, as an array."""
    first = f"{mask} & ~shiftleft({mask}, 1)"
    return F.expr(f"filter(sequence(0L, {hours - 1}L), h -> getbit({first}, cast(h as int)) = 1)")

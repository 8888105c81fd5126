"""Column expressions over whole texts, evaluated in the JVM."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerflow.llm.common import BLANKS

_BLANK_RUN = r"[\x20\x09-\x0D]+"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once a row, however often (and
    inside whatever lambda) ``use`` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def words(text: Column) -> Column:
    """The runs of characters other than ASCII blanks; none for a null."""
    bare = F.trim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, _BLANK_RUN))


def runs(items: Column, size: int, of: Callable[..., Column]) -> Column:
    """``of(items[i], ..., items[i + size - 1])`` for every i."""

    def windows(x: Column) -> Column:
        last = F.size(x) - size
        at = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
        return F.transform(at, lambda i: of(*(F.get(x, i + k) for k in range(size))))

    return let(items, windows)


def adjacent_sum(positions: Column, width: int) -> Column:
    """Length of the union of ``[p, p + width)`` over ascending positions."""
    gap = F.transform(positions, lambda p, i: F.coalesce(F.least(F.get(positions, i + 1) - p, F.lit(width)), F.lit(width)))
    return F.aggregate(gap, F.lit(0), lambda a, b: a + b)

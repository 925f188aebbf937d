"""Ranges: intervals with open, closed or missing ends, on the driver and as column expressions."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import terms as V


@dataclass(frozen=True)
class Range:
    """From ``min`` to ``max``; None is unbounded. ``eq_min`` and ``eq_max`` close the ends."""

    min: Any = None
    eq_min: bool = False
    max: Any = None
    eq_max: bool = False

    @classmethod
    def of(cls, kind: str, value: Any) -> Range:
        """The range that a relation type and its value describe; types without a comparator are unbounded. In-between takes a (min, max) pair."""
        if kind == V.EQUAL:
            return cls(value, True, value, True)
        if kind == V.LESS:
            return cls(max=value)
        if kind == V.LESS_EQUAL:
            return cls(max=value, eq_max=True)
        if kind == V.GREATER:
            return cls(min=value)
        if kind == V.GREATER_EQUAL:
            return cls(min=value, eq_min=True)
        if kind == V.BETWEEN:
            return cls(value[0], True, value[1], False)
        return cls()

    def meet(self, other: Range) -> Range:
        """The intersection; of equal ends the open one is tighter."""
        low, eq_low = self.min, self.eq_min
        if other.min is not None and (low is None or other.min > low or (other.min == low and not other.eq_min)):
            low, eq_low = other.min, other.eq_min
        high, eq_high = self.max, self.eq_max
        if other.max is not None and (high is None or other.max < high or (other.max == high and not other.eq_max)):
            high, eq_high = other.max, other.eq_max
        return Range(low, eq_low, high, eq_high)

    def contains(self, value: Any) -> bool:
        """True unless the value lies beyond an end."""
        if self.min is not None and (value < self.min or (value == self.min and not self.eq_min)):
            return False
        return not (self.max is not None and (value > self.max or (value == self.max and not self.eq_max)))

    def overlaps(self, other: Range) -> bool:
        """True if some value may lie in both."""

        def apart(high, eq_high, low, eq_low) -> bool:
            return high is not None and low is not None and (high < low or (high == low and not (eq_high and eq_low)))

        return not (apart(self.max, self.eq_max, other.min, other.eq_min) or apart(other.max, other.eq_max, self.min, self.eq_min))

    def __str__(self) -> str:
        low = "" if self.min is None else f"{self.min} {'<=' if self.eq_min else '<'} "
        high = "" if self.max is None else f" {'<=' if self.eq_max else '<'} {self.max}"
        return f"{low}x{high}"

    def holds(self, value: Column, lit=F.lit) -> Column:
        """``contains`` of a column, as comparisons that reach the scan; null for a null value."""
        made = None
        if self.min is not None and self.min == self.max and self.eq_min and self.eq_max:
            return value == lit(self.min)
        if self.min is not None:
            made = value >= lit(self.min) if self.eq_min else value > lit(self.min)
        if self.max is not None:
            high = value <= lit(self.max) if self.eq_max else value < lit(self.max)
            made = high if made is None else made & high
        return F.lit(True) if made is None else made

    def meets(self, low: Column, high: Column, low_closed: Column | bool = True, high_closed: Column | bool = False, lit=F.lit) -> Column:
        """``overlaps`` with a range in columns; null ends are unbounded."""
        c = lambda x: x if isinstance(x, Column) else F.lit(x)
        made = F.lit(True)
        if self.max is not None:
            made = made & F.coalesce((low < lit(self.max)) | ((low == lit(self.max)) & F.lit(self.eq_max) & c(low_closed)), F.lit(True))
        if self.min is not None:
            made = made & F.coalesce((high > lit(self.min)) | ((high == lit(self.min)) & F.lit(self.eq_min) & c(high_closed)), F.lit(True))
        return made

"""Conditions: a small tree that filters members, prunes links and bounds how many members pass.

A tree is used three ways. ``column`` is a predicate over rows; ``allows`` and
``prune`` say whether a link's ranges may lead to a member that passes; ``apply``
filters a DataFrame, including limits on the count. A value that is missing or
can't be read in its domain fails a comparison; with ``compat`` it passes, and
with ``strict`` a missing one is an error.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field, replace
from datetime import datetime, timezone
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import partial_dates, paths, scalars
from ..functions import terms as V
from .bounds import Range

Resolve = Callable[[paths.Path], Column]


def literal(value: Any) -> Column:
    """A literal; datetimes become UTC timestamps without zone."""
    if isinstance(value, datetime):
        value = value.astimezone(timezone.utc).replace(tzinfo=None) if value.tzinfo else value
        return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")
    return F.lit(value)


def instant_of(text: str) -> datetime | None:
    """An ISO date or dateTime as a UTC datetime; None if it is none. Without a zone it is UTC."""
    try:
        found = datetime.fromisoformat(text.replace("Z", "+00:00") if text.endswith("Z") else text)
    except ValueError:
        return None
    return found if found.tzinfo else found.replace(tzinfo=timezone.utc)


@dataclass(frozen=True)
class Condition:
    """What all conditions have in common; as it stands, it lets everything pass."""

    def column(self, resolve: Resolve, strict: bool = False, compat: bool = False) -> Column:
        return F.lit(True)

    def allows(self, path: str, found: Range | None) -> bool:
        """Whether a link whose values of ``path`` lie in ``found`` (None: the link has no value) may lead to members that pass."""
        return True

    def prune(self, path: Column, low: Column, high: Column, low_closed: Column, high_closed: Column, bounded: Column) -> Column:
        """``allows`` over columns of links."""
        return F.lit(True)

    def fingerprint(self) -> str:
        return "true"

    @property
    def counts(self) -> bool:
        """Whether there is a limit in the tree."""
        return False

    def full(self, emitted: int) -> bool:
        """Whether no further member can pass, after so many."""
        return False

    def spent(self, emitted: int) -> Condition:
        """What is left of the condition after so many members in earlier polls or runs; limits that are reset with each poll stay."""
        return self

    def apply(self, df: DataFrame, resolve: Resolve, arrival: str | None = None, poll: str | None = None, **how) -> DataFrame:
        """The rows that pass. Limits take rows in the order of the column ``arrival``, anew for each value of ``poll`` where they are reset."""
        if not self.counts:
            return df.where(self.column(resolve, **how))
        if arrival is None:
            raise ValueError("a limit needs a column that orders arrivals")
        parts = self.parts if isinstance(self, And) else (self,)
        plain = [p for p in parts if not p.counts]
        for p in plain:
            df = df.where(p.column(resolve, **how))
        for p in parts:
            if isinstance(p, MaxCount):
                df = p.limit(df, arrival, poll)
            elif p.counts:
                df = _mixed(p, df, resolve, arrival, poll, how)
        return df

    def __and__(self, other: Condition) -> Condition:
        return And((self, other))

    def __or__(self, other: Condition) -> Condition:
        return Or((self, other))


Empty = Condition


@dataclass(frozen=True)
class Leaf(Condition):
    """A comparison of the first value of a path. ``kind`` is a relation type, ``domain`` how values are compared."""

    path: paths.Path
    kind: str
    value: str
    domain: str = "string"
    zone: str = partial_dates.DEFAULT_ZONE
    compat_zone: bool = False
    range: Range = field(init=False)

    def __post_init__(self) -> None:
        if self.domain not in scalars.DOMAINS:
            raise ValueError(f"a comparison domain is one of {', '.join(scalars.DOMAINS)}, not {self.domain!r}")
        object.__setattr__(self, "range", Range.of(self.kind, self._parsed()))

    def _parsed(self) -> Any:
        if self.kind == V.BETWEEN:
            for name in partial_dates.DATATYPES:
                found = partial_dates.parse(self.value, name, self.zone, self.compat_zone)
                if found != (None, None):
                    return found
            return None, None
        if self.domain == "date":
            return instant_of(self.value)
        if self.domain == "integer":
            return int(float(self.value))
        if self.domain in ("float", "number"):
            return float(self.value)
        return self.value

    def column(self, resolve: Resolve, strict: bool = False, compat: bool = False) -> Column:
        value = resolve(self.path)
        between = self.kind == V.BETWEEN and self.domain == "string"
        made = self.range.holds(scalars.instant(value) if between else value, literal)
        if strict:
            return F.when(value.isNull(), F.raise_error(F.lit(f"a member has no value of {self.path}")).cast("boolean")).otherwise(F.coalesce(made, F.lit(False)))
        # a filter drops null as it drops false; only under compat must null pass
        return F.coalesce(made, F.lit(True)) if compat else made

    def allows(self, path: str, found: Range | None) -> bool:
        return path != str(self.path) or (found is not None and self.range.overlaps(found))

    def prune(self, path, low, high, low_closed, high_closed, bounded) -> Column:
        return F.when(path != str(self.path), True).when(~bounded, False).otherwise(self.range.meets(low, high, low_closed, high_closed, literal))

    def fingerprint(self) -> str:
        return f"{self.path} {self.domain} {self.range}"


@dataclass(frozen=True)
class _Many(Condition):
    parts: tuple[Condition, ...]

    @property
    def counts(self) -> bool:
        return any(p.counts for p in self.parts)

    def fingerprint(self) -> str:
        return "(" + f" {self.word} ".join(p.fingerprint() for p in self.parts) + ")"

    def spent(self, emitted: int) -> Condition:
        return replace(self, parts=tuple(p.spent(emitted) for p in self.parts))


@dataclass(frozen=True)
class And(_Many):
    word = "and"

    def column(self, resolve: Resolve, **how) -> Column:
        made = F.lit(True)
        for i, p in enumerate(self.parts):
            made = p.column(resolve, **how) if not i else made & p.column(resolve, **how)
        return made

    def allows(self, path: str, found: Range | None) -> bool:
        return all([p.allows(path, found) for p in self.parts])

    def prune(self, *link: Column) -> Column:
        made = F.lit(True)
        for p in self.parts:
            made = made & p.prune(*link)
        return made

    def full(self, emitted: int) -> bool:
        return any(p.full(emitted) for p in self.parts)


@dataclass(frozen=True)
class Or(_Many):
    word = "or"

    def column(self, resolve: Resolve, **how) -> Column:
        made = F.lit(False)
        for i, p in enumerate(self.parts):
            made = p.column(resolve, **how) if not i else made | p.column(resolve, **how)
        return made

    def allows(self, path: str, found: Range | None) -> bool:
        return any([p.allows(path, found) for p in self.parts])

    def prune(self, *link: Column) -> Column:
        made = F.lit(False)
        for p in self.parts:
            made = made | p.prune(*link)
        return made

    def full(self, emitted: int) -> bool:
        return bool(self.parts) and all(p.full(emitted) for p in self.parts)


@dataclass(frozen=True)
class MaxCount(Condition):
    """At most ``count`` members, in the order of arrival; ``reset_on_poll`` starts anew with each poll."""

    count: int
    reset_on_poll: bool = False

    @property
    def counts(self) -> bool:
        return True

    def full(self, emitted: int) -> bool:
        return emitted >= self.count

    def spent(self, emitted: int) -> Condition:
        return self if self.reset_on_poll else replace(self, count=max(0, self.count - emitted))

    def allows(self, path: str, found: Range | None) -> bool:
        return self.count > 0

    def prune(self, path, low, high, low_closed, high_closed, bounded) -> Column:
        return F.lit(self.count > 0)

    def limit(self, df: DataFrame, arrival: str, poll: str | None = None) -> DataFrame:
        if self.reset_on_poll and poll:
            place = F.row_number().over(Window.partitionBy(poll).orderBy(arrival))
            return df.withColumn("__place", place).where(F.col("__place") <= self.count).drop("__place")
        return df.orderBy(arrival).limit(self.count)

    def fingerprint(self) -> str:
        return f"at most {self.count}{' a poll' if self.reset_on_poll else ''}"


def _mixed(cond: Condition, df: DataFrame, resolve: Resolve, arrival: str, poll: str | None, how: dict) -> DataFrame:
    """Limits below an Or: a branch with one passes its first rows, found by the arrival of the last that fits: one row, which is broadcast, or one a poll, which the engine joins as it sees fit."""

    def column(c: Condition, base: DataFrame) -> Column:
        nonlocal df
        if not c.counts:
            return F.coalesce(c.column(resolve, **how), F.lit(False))
        if isinstance(c, MaxCount):
            name = f"__upto{len(df.columns)}"
            if c.reset_on_poll and poll:
                last = c.limit(base, arrival, poll).groupBy(F.col(poll).alias("__poll")).agg(F.max(arrival).alias(name))
                df = df.join(last, F.col(poll).eqNullSafe(F.col("__poll")), "left").drop("__poll")
            else:
                df = df.join(F.broadcast(c.limit(base, arrival).agg(F.max(arrival).alias(name))))
            return F.coalesce(F.col(arrival) <= F.col(name), F.lit(False))
        if isinstance(c, And):
            made = F.lit(True)
            for p in c.parts:
                if not p.counts:
                    made = made & F.coalesce(p.column(resolve, **how), F.lit(False))
            inner = base.where(made)
            for p in c.parts:
                if p.counts:
                    made = made & column(p, inner)
            return made
        made = F.lit(False)
        for p in c.parts:
            made = made | column(p, base)
        return made

    keep, base = df.columns, df
    passed = column(cond, base)
    return df.where(passed).select(*keep)


def window(timestamp: paths.Path | None, before: str | datetime | None = None, after: str | datetime | None = None, rest: Condition | None = None) -> Condition:
    """``rest`` and, exclusively, before and after points in time of the stream's timestamp path, which must then be known."""
    text = lambda x: x.isoformat() if isinstance(x, datetime) else x
    leaves = [(V.LESS, before), (V.GREATER, after)]
    if any(v is not None for _, v in leaves) and timestamp is None:
        raise ValueError("before and after need a stream with a timestamp path")
    made = [Leaf(timestamp, k, text(v), "date") for k, v in leaves if v is not None]
    if not made:
        return rest or Empty()
    own = made[0] if len(made) == 1 else And(tuple(made))
    return own if rest is None or type(rest) is Condition else And((rest, own))


def over_columns(columns: Mapping[str, str | Column]) -> Resolve:
    """Resolves plain predicates to typed columns of a table, by IRI or name."""

    def resolve(path: paths.Path) -> Column:
        found = columns[path.parts[0]]
        return F.col(found) if isinstance(found, str) else found

    return resolve


def over_quads(domains: Callable[[paths.Path], str] | None = None, quads: str = "quads", member: str = "member_id") -> Callable[[Leaf], Column]:
    """Resolves paths to the lexical form of their first value in a member's quads."""

    def resolve(path: paths.Path) -> Column:
        start = F.struct(F.lit(V.IRI).alias("type"), F.col(member).alias("value"), F.lit(None).cast("string").alias("datatype"), F.lit(None).cast("string").alias("lang"))
        return F.get(paths.values(path, F.col(quads), start), F.lit(0))["value"]

    return resolve


def typed(cond: Condition) -> Condition:
    """The tree with leaves that read lexical values in their domain."""
    if isinstance(cond, Leaf):
        return _Lexical(cond.path, cond.kind, cond.value, cond.domain, cond.zone, cond.compat_zone)
    if isinstance(cond, _Many):
        return replace(cond, parts=tuple(typed(p) for p in cond.parts))
    return cond


@dataclass(frozen=True)
class _Lexical(Leaf):
    def column(self, resolve: Resolve, **how) -> Column:
        domain = "date" if self.kind == V.BETWEEN else self.domain
        own = Leaf(self.path, self.kind, self.value, domain, self.zone, self.compat_zone)
        return own.column(lambda path: scalars.in_domain(resolve(path), domain), **how)

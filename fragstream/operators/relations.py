"""Links between fragments: their ranges merged by target and path, pruned by a condition, and ordered for fetching."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import partial_dates
from ..functions import terms as V
from . import ordering
from .bounds import Range
from .conditions import Condition, instant_of

#: One row a link: ``low`` and ``high`` are its value as a bound, in UTC without a zone.
LINK = "source string, node string, type string, path string, value string, datatype string"


def bounds_of(links: DataFrame, zone: str = "Z") -> DataFrame:
    """Adds ``low``, ``high``, ``low_closed``, ``high_closed`` and ``bounded`` to links whose values are instants or partial dates.

    Types without a comparator, and values that can't be read, bound nothing.
    """
    point = F.to_timestamp_ntz(F.date_format(F.col("value").try_cast("timestamp"), "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.lit("yyyy-MM-dd HH:mm:ss.SSSSSS"))
    name = F.regexp_extract(F.coalesce("datatype", F.lit("")), r"([^#/]*)$", 1)
    of = F.when(F.col("type") == V.BETWEEN, F.when(name == "gYear", partial_dates.interval(F.col("value"), "gYear", zone)).when(name == "gYearMonth", partial_dates.interval(F.col("value"), "gYearMonth", zone)).when(name == "date", partial_dates.interval(F.col("value"), "date", zone)).otherwise(partial_dates.interval(F.col("value"), "string", zone)))
    links = links.withColumn("__of", of).withColumn("__at", point)  # evaluated once, read twice
    point, part, until = F.col("__at"), F.col("__of.min"), F.col("__of.max")
    kind = F.col("type")
    low = F.when(kind.isin(V.EQUAL, V.GREATER, V.GREATER_EQUAL), point).when(kind == V.BETWEEN, part)
    high = F.when(kind.isin(V.EQUAL, V.LESS, V.LESS_EQUAL), point).when(kind == V.BETWEEN, until)
    made = links.withColumns({"low": low, "high": high, "low_closed": kind.isin(V.EQUAL, V.GREATER_EQUAL, V.BETWEEN), "high_closed": kind.isin(V.EQUAL, V.LESS_EQUAL), "bounded": F.col("value").isNotNull()})
    return made.drop("__of", "__at")


def merged(links: DataFrame, keys: tuple[str, ...] = ("source", "node", "path")) -> DataFrame:
    """One row by ``keys``: the intersection of all bounds (of equal ends the open one is tighter)."""
    # an open lower end is tighter than a closed one at the same place, so it sorts last; an open upper end sorts first
    low = F.max(F.when(F.col("low").isNotNull(), F.struct("low", (~F.col("low_closed")).alias("open"))))
    high = F.min(F.when(F.col("high").isNotNull(), F.struct("high", F.col("high_closed").alias("closed"))))
    made = links.groupBy(*keys).agg(low.alias("l"), high.alias("h"), F.bool_or("bounded").alias("bounded"), F.first("type").alias("type"))
    return made.select(*keys, "type", F.col("l.low").alias("low"), F.col("h.high").alias("high"), F.coalesce(~F.col("l.open"), F.lit(False)).alias("low_closed"), F.coalesce("h.closed", F.lit(False)).alias("high_closed"), "bounded")


def pruned(ranges: DataFrame, condition: Condition) -> DataFrame:
    """(source, node, allowed): a link is allowed if the condition accepts each of its path ranges; plain links are."""
    ok = condition.prune(F.coalesce("path", F.lit("")), F.col("low"), F.col("high"), F.col("low_closed"), F.col("high_closed"), F.col("bounded"))
    return ranges.groupBy("source", "node").agg(F.bool_and(F.coalesce(ok, F.lit(True))).alias("allowed"))


def priority(ranges: DataFrame, path: str, descending: bool = False) -> DataFrame:
    """(source, node, important, value): what the order of fetching needs of each link.

    Important links have a bound in the direction of the order on the timestamp
    path: the least lower bound when ascending, the greatest upper one when
    descending. All others come first.
    """
    bound = F.col("high") if descending else F.col("low")
    own = F.when(F.col("path") == path, bound)
    best = F.max(own) if descending else F.min(own)
    return ranges.groupBy("source", "node").agg(best.alias("value")).withColumn("important", F.col("value").isNotNull())


def frontier(pages: DataFrame, important: str, value: str, *ties: str, descending: bool = False) -> DataFrame:
    """Adds ``fetch_seq``: unimportant pages first, then by value."""
    return ordering.sequence(pages, F.col(important), F.desc(value) if descending else F.asc(value), *ties, name="fetch_seq")


# ---- on the driver, for the crawl


@dataclass(frozen=True)
class Link:
    source: str
    node: str
    type: str = V.PLAIN
    path: str | None = None
    values: tuple[tuple[str, str | None], ...] = ()


def value_of(text: str, datatype: str | None) -> Any:
    """A link's value in the domain of its datatype; None if it can't be read."""
    name = (datatype or "").removeprefix(V.XSD)
    try:
        if name == "dateTime":
            return instant_of(text)
        if name == "integer":
            return int(text)
        if name in ("decimal", "float", "double"):
            return float(text)
    except ValueError:
        return None
    return text


def range_of(link: Link, zone: str = partial_dates.DEFAULT_ZONE) -> Range | None:
    """The range a link's values describe; None if it has none."""
    if not link.values:
        return None
    made = Range()
    for text, datatype in link.values:
        if link.type == V.BETWEEN:
            name = (datatype or "").removeprefix(V.XSD)
            pair = partial_dates.parse(text, name if name in ("gYear", "gYearMonth", "date") else "string", zone)
            made = made.meet(Range(pair[0], pair[0] is not None, pair[1], False))
        elif (value := value_of(text, datatype)) is not None:
            made = made.meet(Range.of(link.type, value))
    return made


def allowed(links: Iterable[Link], condition: Condition, zone: str = partial_dates.DEFAULT_ZONE) -> bool:
    """Whether the links to one node, all together, may lead to members that pass."""
    by_path: dict[str, Range | None] = {}
    for x in links:
        if x.path is None:
            continue
        found, before = range_of(x, zone), by_path.get(x.path)
        try:
            by_path[x.path] = found if before is None else before if found is None else before.meet(found)
        except TypeError:  # values of different domains bound nothing together
            by_path[x.path] = Range()
    out = []
    for path, found in by_path.items():
        try:
            out.append(condition.allows(path, found))
        except TypeError:
            out.append(True)
    return all(out)


@dataclass(frozen=True)
class Step:
    """A link as the order of fetching sees it."""

    important: bool
    value: Any = None


def step_of(links: Iterable[Link], path: str | None, descending: bool = False) -> Step:
    """Important if some bound on the timestamp path points in the direction of the order; malformed links are plain."""
    found = []
    for x in links:
        if path is not None and x.path == path and x.type != V.EQUAL and (r := range_of(x, "Z")) is not None:
            found += [v for v in [r.max if descending else r.min] if v is not None]
    return Step(True, reduce(max if descending else min, found)) if found else Step(False)


class Chain:
    """The path of links to a page, compacted: at most one important value, and whether a plain link follows it."""

    def __init__(self, steps: tuple[Step, ...] = (), descending: bool | None = False):
        self.steps, self.descending = steps, descending

    def push(self, step: Step) -> Chain:
        """An important step absorbs plain ones before it; of two important ones the later in order stays (the smaller without an order)."""
        if not self.steps:
            return Chain((step,), self.descending)
        *head, last = self.steps
        if step.important and last.important:
            pick = min if self.descending in (None, True) else max
            return Chain((*head, Step(True, pick(last.value, step.value))), self.descending)
        if not last.important:
            if head and step.important:
                return Chain(tuple(head), self.descending).push(step)
            return Chain((*head, step), self.descending)
        return Chain((*self.steps, step), self.descending)

    @property
    def value(self) -> Any:
        """The value of the important step, None without one."""
        return next((s.value for s in self.steps if s.important), None)

    @property
    def key(self) -> tuple:
        """Sorts chains: plain ones first, then by value in the direction of the order."""
        if self.value is None:
            return (0,)
        v = self.value.timestamp() if hasattr(self.value, "timestamp") else self.value
        return (1, -v if self.descending else v)

    def before(self, other: Chain) -> bool:
        """Whether this chain comes before another by its value: such a link leads backwards."""
        return self.value is not None and other.value is not None and (self.value > other.value if self.descending else self.value < other.value)

"""Partial dates as half-open intervals: years, months, days, hours, minutes and seconds, with a time zone.

``interval`` builds native expressions over a column of lexical values;
``parse`` gives the same interval of one value on the driver, for pruning links.
A zone suffix follows XSD: ``+01:00`` means an hour before UTC. ``AoE`` ("anywhere on
earth") widens the interval by twelve hours on either side. With ``compat`` an
offset is added instead of subtracted. What is no partial date gives nulls, which
bound nothing.
"""

from __future__ import annotations

import re
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

ZONE = r"(Z|AoE|[+-]\d{2}:\d{2})?"
#: By unit: the lexical form.
FORMS = {
    "year": r"^(-?\d{4})" + ZONE + "$",
    "month": r"^(-?\d{4}-\d{2})" + ZONE + "$",
    "day": r"^(-?\d{4}-\d{2}-\d{2})" + ZONE + "$",
    "hour": r"^(-?\d{4}-\d{2}-\d{2}T\d{2})" + ZONE + "$",
    "minute": r"^(-?\d{4}-\d{2}-\d{2}T\d{2}:\d{2})" + ZONE + "$",
    "second": r"^(-?\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2})(?:\.\d+)?" + ZONE + "$",
}
#: What completes each form to a whole timestamp.
_TAIL = {"year": "-01-01T00:00:00", "month": "-01T00:00:00", "day": "T00:00:00", "hour": ":00:00", "minute": ":00", "second": ""}
DATATYPES = {"gYear": ("year",), "gYearMonth": ("month",), "date": ("day",), "dateTime": ("second",), "string": ("hour", "minute", "second")}
DEFAULT_ZONE = "AoE"


def check_zone(zone: str) -> str:
    """A default time zone: AoE, Z or an offset."""
    if not re.fullmatch(r"AoE|Z|[+-]\d{2}:\d{2}", zone):
        raise ValueError(f"a default time zone is AoE, Z or an offset such as +01:00, not {zone!r}")
    return zone


def interval(value: Column, datatype: str = "string", zone: str = DEFAULT_ZONE, compat: bool = False) -> Column:
    """Struct (min, max) of timestamps without zone, in UTC, half-open; null ends if the value has another form."""
    check_zone(zone)
    low, high = F.lit(None).cast("timestamp_ntz"), F.lit(None).cast("timestamp_ntz")
    for unit in DATATYPES[datatype]:
        form = FORMS[unit]
        fits = value.rlike(form)
        start = F.concat(F.regexp_extract(value, form, 1), F.lit(_TAIL[unit])).try_cast("timestamp_ntz")
        suffix = F.regexp_extract(value, form, 2)
        suffix = F.when(suffix == "", F.lit(zone)).otherwise(suffix)
        sign = F.when(F.substring(suffix, 1, 1) == "-", 1).otherwise(-1) * (-1 if compat else 1)
        minutes = F.substring(suffix, 2, 2).try_cast("int") * 60 + F.substring(suffix, 5, 2).try_cast("int")
        shift = F.when(suffix.isin("Z", "AoE"), 0).otherwise(sign * minutes)
        wide = F.when(suffix == "AoE", 12).otherwise(0)
        length = {"year": (1, 0, 0), "month": (0, 1, 0), "day": (0, 0, 86400), "hour": (0, 0, 3600), "minute": (0, 0, 60), "second": (0, 0, 1)}[unit]
        end = start + F.make_interval(years=F.lit(length[0]), months=F.lit(length[1]), secs=F.lit(length[2]))
        low = F.when(fits, start + F.make_interval(mins=shift, hours=-wide)).otherwise(low)
        high = F.when(fits, end + F.make_interval(mins=shift, hours=wide)).otherwise(high)
    return F.struct(low.alias("min"), high.alias("max"))


def parse(value: str, datatype: str = "string", zone: str = DEFAULT_ZONE, compat: bool = False) -> tuple[datetime | None, datetime | None]:
    """The interval of one value, as UTC datetimes; (None, None) if it has another form."""
    check_zone(zone)
    for unit in DATATYPES.get(datatype, ()):
        m = re.fullmatch(FORMS[unit][1:-1], value)
        if not m:
            continue
        try:
            start = datetime.fromisoformat(m[1] + _TAIL[unit]).replace(tzinfo=timezone.utc)
        except ValueError:
            return None, None
        if unit == "year":
            end = start.replace(year=start.year + 1)
        elif unit == "month":
            end = start.replace(year=start.year + start.month // 12, month=start.month % 12 + 1)
        else:
            end = start + timedelta(**{f"{unit}s": 1})
        suffix = m[2] or zone
        if suffix == "AoE":
            return start - timedelta(hours=12), end + timedelta(hours=12)
        if suffix != "Z":
            shift = timedelta(hours=int(suffix[1:3]), minutes=int(suffix[4:6])) * (1 if (suffix[0] == "-") != compat else -1)
            return start + shift, end + shift
        return start, end
    return None, None

"""Scalar functions of the stream's comparison domains, as native expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Comparison domains by the names that condition files use.
DOMAINS = ("string", "date", "integer", "float", "number")


def leading_integer(value: Column) -> Column:
    """The integer a text begins with; null without one."""
    return F.regexp_extract(value, r"^\s*([+-]?\d+)", 1).try_cast("bigint")


def leading_float(value: Column) -> Column:
    """The decimal number a text begins with; null without one."""
    return F.regexp_extract(value, r"^\s*([+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?)", 1).try_cast("double")


def instant(value: Column) -> Column:
    """The instant of an ISO date or dateTime, in UTC without a zone; null if it is none."""
    return F.to_timestamp_ntz(F.date_format(value.try_cast("timestamp"), "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.lit("yyyy-MM-dd HH:mm:ss.SSSSSS"))


def in_domain(value: Column, domain: str) -> Column:
    """A lexical value in a comparison domain."""
    if domain == "date":
        return instant(value)
    if domain == "integer":
        return leading_integer(value)
    if domain in ("float", "number"):
        return leading_float(value)
    if domain != "string":
        raise ValueError(f"a comparison domain is one of {', '.join(DOMAINS)}, not {domain!r}")
    return value


def iso(value: Column) -> Column:
    """A timestamp as ISO text in UTC with milliseconds."""
    return F.date_format(value, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def origin(url: Column) -> Column:
    """Scheme, host and port of a URL."""
    return F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]+)", 1)


def host(url: Column) -> Column:
    return F.try_parse_url(url, F.lit("HOST"))


def is_remote(url: str) -> bool:
    """True for http(s) addresses; anything else is a local path."""
    return url.startswith(("http://", "https://"))


def remote(url: Column) -> Column:
    """``is_remote`` of a column."""
    return F.startswith(url, F.lit("http://")) | F.startswith(url, F.lit("https://"))


def cache_directives(header: Column) -> Column:
    """Map of the directives of a Cache-Control header; those without a value map to an empty string."""
    parts = F.filter(F.transform(F.split(F.coalesce(header, F.lit("")), ","), lambda x: F.lower(F.trim(x))), lambda x: x != "")
    entries = F.transform(parts, lambda x: F.struct(F.trim(F.split_part(x, F.lit("="), F.lit(1))).alias("key"), F.trim(F.split_part(x, F.lit("="), F.lit(2))).alias("value")))
    return F.map_from_entries(F.array_distinct(entries))

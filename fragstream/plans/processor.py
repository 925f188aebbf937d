"""A replication as a step of a pipeline: configured by named options or by RDF, writing members as text to a channel."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from ..functions import rdf
from ..functions import terms as V
from ..sources import sinks
from . import condition_files
from .config import Config, Fetch
from .discovery import Index
from .replicate import Replication, pulled

#: Option names of a pipeline, and the options they set here.
NAMES = {
    "url": "url", "before": "before", "after": "after", "ordered": "ordered", "follow": "polling", "pollInterval": "poll_interval_ms", "interval": "poll_interval_ms",
    "shapeFile": "shape_file", "noShape": "no_shape", "savePath": "state_path", "loose": "loose", "urlIsView": "url_is_view", "materialize": "materialize",
    "lastVersionOnly": "last_version_only", "startFresh": "start_fresh", "defaultTimezone": "default_timezone",
}
OTHERS = ("output", "conditionFile", "fetch", "fetchConfig", "streamId", "sdsify")
#: Predicates of retries, and the options they set.
RETRY = {"code": "codes", "maxRetry": "maxRetries"}


def fetch_of(options: Mapping[str, Any]) -> Fetch:
    """``{"auth": {"auth": "user:password", "host"}, "concurrent", "retry": {"codes", "maxRetries"}, "safe"}``; without a host, credentials are for that of the stream.

    Retries are also known by their names in RDF, ``code`` and ``maxRetry``; other
    names are an error.
    """
    auth, retry = options.get("auth") or {}, {RETRY.get(k, k): v for k, v in (options.get("retry") or {}).items()}
    if unknown := (set(options) - {"auth", "concurrent", "retry", "safe"}) | (set(auth) - {"auth", "host", "type"}) | (set(retry) - set(RETRY.values())):
        raise ValueError(f"unknown options of fetching: {', '.join(sorted(unknown))}")
    user, _, password = str(auth.get("auth", "")).partition(":")
    codes = retry.get("codes", Fetch.codes)
    return Fetch(
        codes=tuple(codes if isinstance(codes, (list, tuple)) else [codes]),
        max_retries=int(retry.get("maxRetries", Fetch.max_retries)),
        safe=bool(options.get("safe", False)),
        username=user or None,
        password=password or None,
        auth_host=auth.get("host"),
        concurrent=int(options.get("concurrent", Fetch.concurrent)),
    )


def config_of(options: Mapping[str, Any]) -> Config:
    """The configuration that options of a pipeline describe; unknown names are an error."""
    if unknown := set(options) - set(NAMES) - set(OTHERS):
        raise ValueError(f"unknown options: {', '.join(sorted(unknown))}")
    if not options.get("url"):
        raise ValueError("a url is needed")
    fetch = fetch_of(options.get("fetch") or options.get("fetchConfig") or {})
    made = {NAMES[k]: v for k, v in options.items() if k in NAMES and v is not None}
    if options.get("conditionFile"):
        made["condition"] = condition_files.load(options["conditionFile"], made.get("default_timezone", "AoE"))
    return Config.of(**made, fetch=fetch, concurrent_fetches=fetch.concurrent)


def options_in(text: str, base: str, vocabulary: str, subject: str | None = None) -> dict[str, Any]:
    """The options that a resource of a Turtle text has under a vocabulary; nested resources become nested options, repeated values lists."""
    index = Index(rdf.parse(text, base))
    if subject is None:
        subjects = [s for s, _ in index.pairs(vocabulary + "url")]
        if len(subjects) != 1:
            raise ValueError(f"one resource with a url is expected, there are {len(subjects)}")
        node = subjects[0]
    else:
        node = (V.IRI, subject, None, None)

    def value(t: rdf.Term) -> Any:
        if t[:2] in index.by and (t[0] == V.BLANK or any(p.startswith(vocabulary) for p in index.by[t[:2]])):
            return read(t)
        kind = (t[2] or "").removeprefix(V.XSD)
        return t[1] in ("true", "1") if kind == "boolean" else int(t[1]) if kind == "integer" else t[1]

    def read(t: rdf.Term) -> dict[str, Any]:
        out = {}
        for predicate, found in index.by.get(t[:2], {}).items():
            if predicate.startswith(vocabulary):
                values = [value(x) for x in found]
                out[predicate.removeprefix(vocabulary)] = values if len(values) > 1 else values[0]
        return out

    return read(node)


class Processor:
    """Writes each member as N-Quads text, wrapped for its stream if asked; ends with the crawl, or with the last poll."""

    def __init__(self, spark: SparkSession, options: Mapping[str, Any]):
        self.run = Replication(spark, config_of(options))
        self.wrap, self.stream = bool(options.get("sdsify", False)), options.get("streamId")

    def _texts(self, members: DataFrame) -> DataFrame:
        if self.wrap:
            members = sinks.enveloped(members, self.stream or self.run.info.stream or self.run.config.url)
        return sinks.text(members)

    def produce(self, write: Callable[[str], Any], polls: int | None = None) -> int:
        """Writes all members to a channel; returns how many. ``write`` may return False to end early, before the state is saved."""
        count = 0

        def sink(members: DataFrame, poll: int = 0) -> None:
            nonlocal count
            for row in pulled(self._texts(members)):
                if write(row[0]) is False:
                    raise Cancelled
                count += 1

        try:
            if self.run.config.polling:
                self.run.follow(sink, polls)
            else:
                self.run.run(sink)
        except Cancelled:
            pass
        return count


class Cancelled(Exception):
    """The reader of a channel wants no more."""

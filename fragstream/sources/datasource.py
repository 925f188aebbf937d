"""``spark.read.format("fragments")`` and ``spark.readStream.format("fragments")``: members of a stream as a data source.

The driver follows links, pruned by filters on ``timestamp`` that Spark pushes
down, and hands the pages on to tasks, which assemble members; pages beyond a
bound are fetched again there. For a stream that is too large for a driver to
follow there is ``plans.replicate``. The stream reader polls: an offset counts
polls and carries which pages are settled.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import replace
from datetime import datetime, timezone

from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual

from ..functions import paths, rdf
from ..functions import terms as V
from ..operators import conditions
from ..plans.config import Config, Fetch
from ..plans.discovery import Index, Info, Shape, discover
from .http import Document, Fetcher, FetchError
from .pages import followed, links_of

SCHEMA = "member_id string, timestamp timestamp, is_version_of string, type string, page_url string, text string"
_PUSHED = {GreaterThan: V.GREATER, GreaterThanOrEqual: V.GREATER_EQUAL, LessThan: V.LESS, LessThanOrEqual: V.LESS_EQUAL}


#: Texts of pages that were fetched for their links go along to the tasks, up to so many characters; beyond, tasks fetch pages again.
CARRIED = 32 << 20


class Pages(InputPartition):
    """Some pages, with their texts as far as they are carried, and what a task must know of the stream."""

    def __init__(self, urls: tuple[str, ...], info: Info | None = None, texts: dict[str, Document] | None = None):
        self.urls, self.info, self.texts = urls, info, texts or {}


def assembled(quads: list[rdf.Quad], member: str, others: set[str], shape: Shape | None) -> list[rdf.Quad]:
    """The quads of one member on one page: named graph, description and nested objects."""
    by: dict[tuple, list[rdf.Quad]] = {}
    for q in quads:
        if q[3][1] != V.INGESTION:
            by.setdefault(q[0][:2], []).append(q)
    out, seen, todo = [], set(), [(V.IRI, member)]
    while todo:
        node = todo.pop()
        if node in seen:
            continue
        seen.add(node)
        for q in by.get(node, ()):
            out.append(q)
            if q[2][0] == V.BLANK or (q[2][0] == V.IRI and shape and q[1] in shape.nested and q[2][1] not in others):
                todo.append(q[2][:2])
    return list(dict.fromkeys(out + [q for q in quads if q[3][1] == member]))


def within(when: datetime | None, before: str | None, after: str | None) -> bool:
    """Whether an instant lies strictly between two; an unknown one does only if neither is asked for."""
    low, high = conditions.instant_of(after or ""), conditions.instant_of(before or "")
    return when is not None and (low is None or when > low) and (high is None or when < high) if after or before else True


def rows_of(page: Document, info: Info, config: Config) -> Iterator[tuple]:
    """Rows of the members of one page that lie in the window of time asked for."""
    loose = config.loose
    quads = rdf.parse(page.text, page.url)
    ids = list(dict.fromkeys(o[1] for s, p, o, _ in quads if p == V.TREE + "member" and (loose or info.stream in (None, s[1]))))
    for m in ids:
        own = assembled(quads, m, set(ids) - {m}, info.shape)
        if not own:
            continue
        first = lambda p: next(iter(paths.walk(p, own, (V.IRI, m, None, None)) if p else ()), (None, None))[1]  # noqa: B023,E731
        when = conditions.instant_of(first(info.timestamp) or "")
        if not within(when, config.before, config.after):
            continue
        yield (m, when, first(info.version_of), first(paths.iri(V.TYPE)), page.url, rdf.write(own))


class _Crawler:
    """What both readers share."""

    def __init__(self, options: dict[str, str]):
        flag = lambda k: options.get(k.lower(), "false").lower() == "true"
        self.config = Config(url=options["url"], url_is_view=flag("urlIsView"), loose=flag("loose"), no_shape=flag("noShape"), shape_file=options.get("shapefile"), before=options.get("before"), after=options.get("after"), default_timezone=options.get("defaulttimezone", "AoE"), fetch=Fetch(max_retries=int(options.get("maxretries", "5"))))
        for name in ("before", "after"):
            if (text := getattr(self.config, name)) is not None and conditions.instant_of(text) is None:
                raise ValueError(f"{name} is no date or dateTime: {text!r}")
        self.batch = int(options.get("pagesperpartition", "8"))
        self.condition: conditions.Condition | None = None
        self.info: Info | None = None
        self.texts: dict[str, Document] = {}

    def plan(self) -> None:
        if self.info is None:
            self.info = discover(self.config, Fetcher(self.config.fetch))
            self.condition = conditions.window(self.info.timestamp, self.config.before, self.config.after, self.condition)

    def crawl(self, start: list[str], settled: set[str]) -> dict[str, bool]:
        """Pages by address, with whether they are immutable, in the order they were found."""
        self.plan()
        fetcher, todo, found = Fetcher(self.config.fetch), list(start), {}
        self.texts, room = {}, CARRIED
        while todo := [u for u in dict.fromkeys(todo) if u not in settled and u not in found]:
            ahead: list[str] = []
            for url, page in zip(todo, fetcher.all(todo), strict=True):
                if isinstance(page, OSError):
                    raise FetchError(str(page))
                found[url] = page.immutable
                room -= len(page.text)
                if room >= 0:
                    self.texts[url] = page
                ahead += [n.partition("#")[0] for n in followed(links_of(Index(rdf.parse(page.text, page.url)).quads, page.url, self.config.loose), self.condition, self.config.timezone)]
            todo = ahead
        return found

    def parts(self, urls: list[str]) -> list[Pages]:
        """Partitions of ``batch`` pages, of more if there were else more partitions than fetches from one origin are allowed: each task fetches one page after the other."""
        info = replace(self.info, root=None)
        size = max(self.batch, -(-len(urls) // max(1, self.config.fetch.concurrent)))
        groups = [tuple(urls[i : i + size]) for i in range(0, len(urls), size)]
        return [Pages(g, info, {u: self.texts[u] for u in g if u in self.texts}) for g in groups]

    def read(self, partition: Pages) -> Iterator[tuple]:
        fetcher = Fetcher(self.config.fetch)
        for url in partition.urls:
            yield from rows_of(partition.texts.get(url) or fetcher.get(url), partition.info, self.config)


class _Batch(DataSourceReader):
    def __init__(self, crawler: _Crawler):
        self.crawler = crawler
        self.bounds: list[tuple[str, str]] = []

    def pushFilters(self, filters):
        """Notes bounds of the timestamp for pruning; Spark filters rows again, as pruning is inexact."""
        for f in filters:
            kind = _PUSHED.get(type(f))
            if kind and f.attribute == ("timestamp",) and isinstance(f.value, datetime):
                value = f.value if f.value.tzinfo else f.value.replace(tzinfo=timezone.utc)
                self.bounds.append((kind, value.isoformat()))
            yield f

    def partitions(self):
        c = self.crawler
        c.info = discover(c.config, Fetcher(c.config.fetch))
        leaves = tuple(conditions.Leaf(c.info.timestamp, k, v, "date") for k, v in self.bounds) if c.info.timestamp else ()
        c.condition = conditions.window(c.info.timestamp, c.config.before, c.config.after, conditions.And(leaves) if leaves else None)
        return c.parts(list(c.crawl([c.info.view], set()))) or [Pages(())]

    def read(self, partition):
        return self.crawler.read(partition)


class _Stream(DataSourceStreamReader):
    def __init__(self, crawler: _Crawler):
        self.crawler = crawler
        self.planned: dict[str, list[str]] = {}

    def initialOffset(self) -> dict:
        return {"poll": 0, "settled": "[]", "mutable": "[]", "batch": "[]"}

    def latestOffset(self) -> dict:
        last = getattr(self, "last", None) or self.initialOffset()
        settled, mutable = set(json.loads(last["settled"])), json.loads(last["mutable"])
        self.crawler.plan()
        found = self.crawler.crawl(mutable or [self.crawler.info.view], settled)
        settled |= {u for u, immutable in found.items() if immutable}
        changing = list(dict.fromkeys([*mutable, *(u for u, immutable in found.items() if not immutable)]))
        self.last = {"poll": last["poll"] + 1, "settled": json.dumps(sorted(settled)), "mutable": json.dumps([u for u in changing if u not in settled]), "batch": json.dumps(list(found))}
        return self.last

    def partitions(self, start: dict, end: dict):
        self.last = end
        self.crawler.plan()
        return self.crawler.parts(json.loads(end["batch"])) or [Pages(())]

    def read(self, partition):
        return self.crawler.read(partition)

    def commit(self, end: dict) -> None:
        self.last = end


class FragmentSource(DataSource):
    """Options: url, urlIsView, loose, noShape, shapeFile, before, after, defaultTimezone, maxRetries, pagesPerPartition."""

    @classmethod
    def name(cls) -> str:
        return "fragments"

    def schema(self) -> str:
        return SCHEMA

    def _crawler(self) -> _Crawler:
        return _Crawler({k.lower(): v for k, v in self.options.items()})

    def reader(self, schema):
        return _Batch(self._crawler())

    def streamReader(self, schema):
        return _Stream(self._crawler())


def register(spark) -> None:
    """Makes the source known to a session, and lets filters reach it."""
    from ..shipping import ship

    ship(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(FragmentSource)

"""A replication as one query: scan, prune, drop what was emitted, assemble, filter, order, keep the latest, rename, emit.

The order of these steps is part of the meaning: the latest version is the
latest among members that pass the filter, and a limit counts members as they
arrive, before they are ordered.
"""

from __future__ import annotations

import logging
import threading
from collections.abc import Callable, Iterator
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import conditions, members, ordering, versions
from ..shared import checkpoint
from ..sources import pages as page_source
from ..sources import sinks
from ..sources.http import Fetcher
from . import crawl
from .config import Config
from .discovery import Info, discover
from .state import State


log = logging.getLogger("fragstream.replicate")

#: What handlers can listen to: the stream's info, pages of a crawl, pages that may change, the number of a poll, an exception.
EVENTS = ("description", "fragment", "mutable", "poll", "error")


class Closed(Exception):
    """The replication was closed while it ran."""


class _Guard:
    """Tells handlers of an error; a close is none."""

    def __init__(self, run: Replication):
        self.run = run

    def __enter__(self) -> None:
        pass

    def __exit__(self, kind, error, _) -> bool:
        if isinstance(error, Closed):
            log.info("closed")
            return True
        if error is not None and not isinstance(error, (KeyboardInterrupt, GeneratorExit)):
            self.run._emit("error", error)
        return False


class Replication:
    """One stream under one configuration. ``pause``, ``unpause`` and ``close`` may be called from other threads."""

    def __init__(self, spark: SparkSession, config: Config):
        self.spark, self.config = spark, config
        self.fetcher = Fetcher(replace(config.fetch, concurrent=config.concurrent_fetches))
        self.state = State(spark, config.state_path, config.start_fresh) if config.state_path else None
        self.info: Info | None = None
        self.condition: conditions.Condition | None = None
        self.fragment_count = self.member_count = 0
        self._pages: DataFrame | None = None
        self._fresh: DataFrame | None = None
        self._handlers: dict[str, list[Callable]] = {}
        self._closing, self._open = threading.Event(), threading.Event()
        self._open.set()

    def on(self, event: str, handler: Callable) -> Replication:
        """Calls a handler on one of ``EVENTS``."""
        if event not in EVENTS:
            raise ValueError(f"an event is one of {', '.join(EVENTS)}, not {event!r}")
        self._handlers.setdefault(event, []).append(handler)
        return self

    def pause(self) -> None:
        """Holds the crawl after the level, or the poll, that is under way."""
        self._open.clear()

    def unpause(self) -> None:
        self._open.set()

    def close(self) -> None:
        """Ends ``run`` and ``follow`` after the level that is under way; what was emitted and saved stays so, and a new run goes on from there."""
        self._closing.set()
        self._open.set()

    def __enter__(self) -> Replication:
        return self

    def __exit__(self, *_) -> None:
        self.close()

    def _gate(self, pages: int = 0) -> None:
        """Where a pause holds and a close takes effect."""
        if pages:
            log.info("%d fragments, %d members", pages, self.member_count)
        self._open.wait()
        if self._closing.is_set():
            raise Closed

    def _emit(self, event: str, *what) -> None:
        for f in self._handlers.get(event, ()):
            f(*what)

    # ---- planning

    def analyse(self) -> Info:
        """Reads the root, and settles paths, shape and condition."""
        if self.info is None:
            self.info = discover(self.config, self.fetcher)
            self.fragment_count = 1
            if self.config.ordered != "none" and self.info.timestamp is None:
                raise ValueError("an order needs a stream with a timestamp path")
            self.condition = conditions.window(self.info.timestamp, self.config.before, self.config.after, self.config.condition)
            if self.state:
                self.state.check(self.condition.fingerprint())
            self._emit("description", self.info)
        return self.info

    @property
    def order(self) -> str:
        """Keeping the latest version only makes the order descending, unless the time is unknown."""
        if self.config.last_version_only:
            return "descending" if self.info.timestamp else "none"
        return self.config.ordered

    def _left(self) -> conditions.Condition:
        """The condition, less what earlier polls and runs have taken of its limits."""
        prior = self.state.emitted().count() if self.state and self.condition.counts else 0
        return self.condition.spent(prior)

    def _start(self) -> tuple[DataFrame, DataFrame | None]:
        """(addresses to begin with, pages that need no fetch)."""
        start = self.spark.createDataFrame([(self.info.view,)], "target string")
        if not self.state:
            return start, None
        if self.config.refetch_mutable:
            start = start.union(self.state.mutable()).distinct()
        return start, self.state.immutable()

    def pages(self) -> DataFrame:
        """The pages of one crawl, fetched."""
        if self._pages is None:
            info = self.analyse()
            start, skip = self._start()
            if info.dump:
                self._pages = checkpoint(page_source.scan(start, self.config, conditions.Condition()).withColumn("wave", F.lit(0)))
            else:
                left = self._left()
                enough = (lambda pages: left.full(self._passing(pages, left).count())) if left.counts else None
                self._pages = crawl.waves(start, self.config, left, skip, path=self.state.crawl if self.state else None, enough=enough, between=self._gate)
                self.fragment_count += self._pages.count()
            self._emit("fragment", self._pages)
            self._emit("mutable", self._pages.where("not immutable").select("page_url"))
        return self._pages

    # ---- the query

    def extracted(self, pages: DataFrame | None = None) -> DataFrame:
        """New members with their quads and envelope, once each, and ``wave``, the level at which they were found."""
        info, pages = self.analyse(), self.pages() if pages is None else pages
        quads = page_source.exploded(pages)
        found = members.listed(quads, None if self.config.loose or info.dump else info.stream)
        found = found.join(pages.select(F.col("page_url").alias("__p"), "wave").distinct(), F.col("page_url") == F.col("__p"))
        found = found.groupBy("member_id").agg(F.min(F.struct("wave", "page_url")).alias("at")).select("at.page_url", "member_id", "at.wave")
        if self.state:
            found = ordering.not_emitted(found, self.state.emitted())
        shape = info.shape.nested if info.shape else ()
        listed = found.select("page_url", "member_id")
        if shape and not info.dump:
            quads = quads.unionByName(self._out_of_band(quads, listed, shape))
        got = members.described(quads, listed, shape, self.config.only_default_graph)
        got = members.enveloped(got, info.timestamp, info.version_of, members.ingested(quads))
        return got.join(found.select(F.col("member_id").alias("__m"), "wave"), F.col("member_id") == F.col("__m")).drop("__m")

    def _passing(self, pages: DataFrame, left: conditions.Condition) -> DataFrame:
        """New members on some pages that pass; limits take them in the order of levels, pages and ids."""
        got = self.extracted(pages)
        how = {"strict": self.config.strict, "compat": self.config.compat}
        if not left.counts:
            return conditions.typed(left).apply(got, conditions.over_quads(), **how)
        got = got.withColumn("__arrival", F.struct("wave", "page_url", "member_id"))
        return conditions.typed(left).apply(got, conditions.over_quads(), "__arrival", **how).drop("__arrival")

    def _out_of_band(self, quads: DataFrame, found: DataFrame, shape: tuple[str, ...]) -> DataFrame:
        """Quads of nested objects that their page does not describe, fetched once each."""
        inner = quads.where(F.col("p").isin(list(shape)) & (F.col("o.type") == "iri")).select("page_url", F.col("s.value").alias("m"), F.col("o.value").alias("iri"))
        inner = inner.join(found.select(F.col("page_url").alias("__p"), "member_id"), (F.col("page_url") == F.col("__p")) & (F.col("m") == F.col("member_id")), "left_semi").select("page_url", "iri").distinct()
        known = quads.select(F.col("page_url").alias("__p"), F.col("s.value").alias("__s")).distinct()
        missing = checkpoint(inner.join(known, (F.col("page_url") == F.col("__p")) & (F.col("iri") == F.col("__s")), "left_anti"))
        empty = quads.limit(0)
        if missing.isEmpty():
            return empty
        documents = missing.select(F.regexp_extract("iri", "^([^#]*)", 1).alias("target")).where("target like 'http%'").distinct()
        got = checkpoint(page_source.scan(documents.repartition(max(1, self.config.concurrent_fetches)), self.config, conditions.Condition()))
        got = got.where("error is null").select(F.col("target").alias("__d"), F.explode("quads").alias("q"))
        return missing.join(got, F.regexp_extract("iri", "^([^#]*)", 1) == F.col("__d")).select("page_url", "q.*").distinct()

    def emitted_now(self) -> DataFrame:
        """New members that pass the condition, before order and renaming; remembered for ``commit``."""
        if self._fresh is None:
            self._fresh = checkpoint(self._passing(self.pages(), self._left()))
        return self._fresh

    def members(self) -> DataFrame:
        """The members of this run as they are emitted, in order if one is asked for."""
        return self._shaped(self.emitted_now())

    def _shaped(self, got: DataFrame) -> DataFrame:
        """Members that pass as they are emitted: latest versions, among those of earlier polls and runs too, in order, renamed."""
        if self.config.last_version_only:
            got = versions.last_version_only(got)
            if self.state:
                got = versions.not_older(got, self.state.latest())
        if self.order != "none":
            got = ordering.ordered(got, self.order)
        if self.config.materialize and self.info.version_of is not None:
            got = versions.materialize(got, self.info.version_of.parts[0])
        return got.select("member_id", "quads", "timestamp", "is_version_of", "type", "created", "page_url")

    def commit(self) -> None:
        """Saves what this run has emitted and seen, where there is a state."""
        got = self.emitted_now()
        self.member_count += got.count()
        if self.state:
            self._save(got)
            self.state.append("pages", self.pages().select("page_url", "immutable"))
            self._pages = checkpoint(self._pages.drop("quads"))  # the crawl's table goes
            self.state.crawled()

    def _save(self, got: DataFrame) -> None:
        self.state.append("emitted", got.select("member_id"))
        if self.config.last_version_only:
            self.state.append("latest", versions.newest(got))

    # ---- running

    def run(self, sink: Callable[[DataFrame], None]) -> None:
        """Emits one crawl to a sink, then saves the state."""
        with _Guard(self):
            self._gate()
            sink(self.members())
            self.commit()

    def run_early(self, sink: Callable[[DataFrame], None], pages_a_step: int = crawl.LOCAL_PAGES) -> None:
        """Emits one ordered crawl in several parts, each in order and none before an earlier one: a member leaves as soon as nothing to come can be before it.

        Pages are fetched in the order of what may be found behind them, and after
        each step the members inside the marker go to the sink; with a state they
        are saved then. Limits, latest versions and dumps need the whole crawl and
        come at its end.
        """
        info = self.analyse()
        if self.order == "none":
            raise ValueError("early emission needs an order")
        if info.dump or self.config.last_version_only or self.condition.counts:
            return self.run(sink)
        with _Guard(self):
            self._gate()
            descending = self.order == "descending"
            start, skip = self._start()
            known = {r[0] for r in skip.collect()} if skip is not None else set()
            held = checkpoint(self._passing(self.spark.createDataFrame([], page_source.CRAWLED), self.condition))
            seen = checkpoint(held.select("member_id"))
            fetched, kept = 0, None
            for rows, marker in crawl.in_order([r[0] for r in start.collect() if r[0] not in known], self.config, self.condition, str(info.timestamp), descending, pages_a_step):
                some = self.spark.createDataFrame(rows, page_source.CRAWLED)
                fetched += len(rows)
                self.fragment_count += len(rows)
                fresh = ordering.not_emitted(self._passing(some, self.condition), seen)
                held = checkpoint(held.unionByName(fresh))
                seen = checkpoint(seen.union(held.select("member_id")).distinct())
                ready = held if marker is None else held.limit(0) if marker == () else ordering.inside_marker(held, conditions.literal(marker), descending=descending)
                ready = checkpoint(ready)
                if not ready.isEmpty():
                    sink(self._shaped(ready))
                    self.member_count += ready.count()
                    if self.state:
                        self._save(ready)
                    held = checkpoint(ordering.not_emitted(held, ready.select("member_id")))
                kept = some.select("page_url", "immutable") if kept is None else checkpoint(kept.unionByName(some.select("page_url", "immutable")))
                if self.state and marker is None:
                    self.state.append("pages", kept)
                self._emit("fragment", some)
                self._emit("mutable", some.where("not immutable").select("page_url"))
                self._gate(fetched)

    def follow(self, sink: Callable[[DataFrame, int], None], polls: int | None = None, sleep: Callable[[float], None] | None = None) -> None:
        """Emits crawl after crawl: pages that may change, and what they newly link to, are fetched again after each interval.

        Members come once, whatever the number of polls; each poll is ordered in
        itself, and members that arrive late are emitted late, not dropped, unless
        only latest versions are asked for and a later one has left already. Limits
        count over all polls and runs of the state; those that are reset start anew
        with each poll. Needs a state. Ends after ``polls``, or by ``close``.
        """
        if not self.state:
            raise ValueError("following needs a state path")
        poll = 0
        with _Guard(self):
            while True:
                self._gate()
                if poll:
                    self._emit("poll", poll)
                    self.config = replace(self.config, refetch_mutable=True)
                    self._pages = self._fresh = None
                sink(self.members(), poll)
                self.commit()
                poll += 1
                if polls is not None and poll >= polls:
                    return
                (sleep or self._closing.wait)(self.config.poll_interval_ms / 1000)

    def envelope(self, stream: str) -> DataFrame:
        return sinks.enveloped(self.members(), stream)


def replicate(spark: SparkSession, url: str, **options) -> Replication:
    """A replication of the stream at ``url``; options are those of ``Config``."""
    return Replication(spark, Config.of(url=url, **options))


def pulled(members_: DataFrame) -> Iterator:
    """Members one by one, as the reader asks for them."""
    return members_.toLocalIterator(prefetchPartitions=False)

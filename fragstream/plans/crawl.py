"""Following links: the one imperative part, a job for each level of the graph, or fetches of the driver while levels are small."""

from __future__ import annotations

import heapq
import logging
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import relations
from ..operators.conditions import Condition
from ..shared import checkpoint, file_system, shared_dir
from ..sources import pages
from ..sources.http import FetchError
from .config import Config

log = logging.getLogger("fragstream.crawl")

#: Levels of up to so many pages are fetched by the driver, which saves a job; larger ones by tasks.
LOCAL_PAGES = 64
#: Addresses that the driver remembers as seen; beyond, they are looked up in the crawl's table.
KNOWN = 500_000


def reachable(edges: DataFrame, root, most_levels: int | None = None) -> DataFrame:
    """(node, depth): nodes that links (src, dst) lead to from ``root``, each at the level it is found first; cycles end."""
    out = edges.sparkSession.createDataFrame([], f"node {edges.schema['dst'].dataType.simpleString()}, depth int")
    frontier, depth = edges.where(F.col("src") == root).select(F.col("dst").alias("node")).distinct(), 1
    while most_levels is None or depth <= most_levels:
        seen = out.select(F.col("node").alias("__n"))
        level = checkpoint(frontier.join(seen, F.col("node") == F.col("__n"), "left_anti").where(F.col("node") != root).select("node", F.lit(depth).alias("depth")))
        if level.isEmpty():
            break
        out = out.unionByName(level)
        frontier, depth = level.join(edges, F.col("node") == F.col("src")).select(F.col("dst").alias("node")).distinct(), depth + 1
    return out


class Crawl:
    """The pages of a crawl: a table in a folder, to which each wave is added, so that a crawl that broke off goes on where it was.

    While a crawl is small and no folder was asked for, its pages are held by the
    driver, as the fetches were made there.
    """

    def __init__(self, spark: SparkSession, path: str | None = None):
        self.spark, self.kept = spark, path is not None
        self.path = path or f"{shared_dir(spark)}/crawl-{uuid.uuid4().hex}"
        fs, make = file_system(spark, self.path)
        self.written = fs.exists(make(self.path))
        self.held: list[tuple] = []

    def pages(self) -> DataFrame:
        """All pages so far; those that could not be had are not among them, and are fetched again if the crawl goes on."""
        held = self.spark.createDataFrame(self.held, pages.CRAWLED)
        if not self.written:
            return held
        out = self.spark.read.schema(pages.CRAWLED).parquet(self.path).where("error is null")
        return out.unionByName(held) if self.held else out

    def flush(self) -> None:
        if self.held:
            self.add(self.spark.createDataFrame(self.held, pages.CRAWLED).coalesce(1))
            self.held = []

    def add(self, wave: DataFrame) -> None:
        wave.write.mode("append").parquet(self.path)
        self.written = True

    def seen(self) -> DataFrame:
        """(__t) of the addresses that were asked for or arrived at."""
        got = self.pages()
        return got.select(F.col("target").alias("__t")).union(got.select(F.col("page_url").alias("__t"))).distinct()


def _addresses(nodes: DataFrame) -> DataFrame:
    return nodes.select(F.regexp_extract("target", "^([^#]*)", 1).alias("target")).distinct()


def waves(start: DataFrame, config: Config, condition: Condition, skip: DataFrame | None = None, local_pages: int = LOCAL_PAGES, path: str | None = None, enough: Callable[[DataFrame], bool] | None = None, between: Callable[[int], None] | None = None) -> DataFrame:
    """All pages that allowed links lead to from the addresses in ``start``, each fetched once.

    A level of few pages is fetched by the driver; of a larger one each page is
    fetched, parsed and its links pruned in a task, and the level is added to the
    crawl's table, so that a lost executor fetches nothing again that is done and
    the plan does not grow with the levels. ``skip`` has pages that need no
    fetch. With a ``path`` the table stays there, and what is in it already is not
    fetched again. ``enough`` may end the crawl after a level by the pages so far;
    ``between`` is called after each level with the number of pages. A page that
    can't be had is an error.
    """
    spark = start.sparkSession
    crawl = Crawl(spark, path)
    skip = skip.select(F.col(skip.columns[0]).alias("__t")) if skip is not None else None
    todo = _addresses(start.select(F.col(start.columns[0]).alias("target")))
    count = wave = 0
    if crawl.written:
        before = crawl.pages()
        count = before.count()
        last = spark.read.schema(pages.CRAWLED).parquet(crawl.path).agg(F.max("wave")).first()[0]  # of failed pages too
        wave = (last if last is not None else -1) + 1
        todo = _addresses(todo.union(before.select(F.explode("nodes").alias("target"))))
        todo = todo.join(crawl.seen(), F.col("target") == F.col("__t"), "left_anti")
        log.info("going on with a crawl of %d pages", count)
    known: set[str] | None = None
    if count <= KNOWN:
        side = crawl.seen() if crawl.written else None
        side = side if skip is None else skip if side is None else side.union(skip)
        rows = side.limit(KNOWN + 1).collect() if side is not None else []
        known = {r[0] for r in rows} if len(rows) <= KNOWN else None

    def fresh(nodes: DataFrame) -> DataFrame:
        out = _addresses(nodes)
        for side in (crawl.seen(), skip):
            if side is not None:
                out = out.join(side, F.col("target") == F.col("__t"), "left_anti")
        return out

    todo = fresh(todo) if known is None or skip is not None else todo
    while True:
        if isinstance(todo, DataFrame):
            # a large level stays a table; a small one comes to the driver
            some = [r[0] for r in todo.limit(local_pages + 1).collect()]
        else:
            some = todo
        if not some:
            break
        if len(some) <= local_pages:
            rows = [(*r, wave) for r in pages.fetched(some, config, condition)]
            crawl.held += [r for r in rows if r[6] is None]
            bad = next((r[6] for r in rows if r[6] is not None), None)
            ahead = list(dict.fromkeys(n.partition("#")[0] for r in rows for n in r[5]))
            if known is not None:
                known |= {x for r in rows for x in r[:2]}
                todo = [u for u in ahead if u not in known]
                known = known if len(known) <= KNOWN else None
            count += len(rows)
            if bad is not None or crawl.kept or len(crawl.held) >= local_pages or known is None:
                crawl.flush() if bad is None or crawl.kept else None
            if bad is not None:
                raise FetchError(bad)
            if known is None:
                todo = fresh(spark.createDataFrame([(u,) for u in ahead], "target string"))
        else:
            crawl.flush()
            frontier = todo if isinstance(todo, DataFrame) else spark.createDataFrame([(u,) for u in todo], "target string")
            crawl.add(pages.scan(frontier, config, condition).withColumn("wave", F.lit(wave)))
            own = spark.read.schema(pages.CRAWLED).parquet(crawl.path).where(F.col("wave") == wave)
            bad = own.where("error is not null").select("error").first()
            if bad is not None:
                raise FetchError(bad[0])
            n = own.count()
            count += n
            if known is not None:
                known = known | {x for r in own.select("target", "page_url").collect() for x in r} if len(known) + 2 * n <= KNOWN else None
            todo = fresh(own.select(F.explode("nodes").alias("target")))
        wave += 1
        if between is not None:
            between(count)
        if enough is not None and enough(crawl.pages()):
            break
    return crawl.pages()


def in_order(start: list[str], config: Config, condition: Condition, path: str | None, descending: bool, step: int = LOCAL_PAGES) -> Iterator[tuple[list[tuple], object]]:
    """(rows of pages, marker) again and again: pages in the order of the least value that may be found behind them.

    Of the links to a page the bound in the direction of the order counts, along
    the path of links that leads there (``relations.Chain``); links without one
    come first. The marker is the bound of the most urgent page still to come:
    no member before it can follow; None if there is no page any more, and all
    may go; the tuple () if a page without a bound is to come, and none may. A
    link that leads back before its own page's bound is not followed. Addresses
    and bounds of pages to come are held by the driver.
    """
    heap = [(relations.Chain((), descending).key, i, u, relations.Chain((), descending)) for i, u in enumerate(dict.fromkeys(start))]
    heapq.heapify(heap)
    number, wave, done = len(heap), 0, set()
    while heap:
        now, first = [], heap[0][0]
        while heap and len(now) < step and heap[0][0][0] == first[0]:  # pages with and without a bound are not mixed
            _, _, url, chain = heapq.heappop(heap)
            if url not in done:
                done.add(url)
                now.append((url, chain))
        rows = pages.fetched([u for u, _ in now], config, condition)
        if bad := next((r[6] for r in rows if r[6] is not None), None):
            raise FetchError(bad)
        for (_, chain), r in zip(now, rows, strict=True):
            done.add(r[1])
            for node, links in pages.links_by_node(r[4], r[1], config.loose).items():
                url = node.partition("#")[0]
                if node not in r[5] or url in done:
                    continue
                to = chain.push(relations.step_of(links, path, descending))
                if to.before(chain):
                    log.error("%s links back to %s, before its own place in the order; the link is ignored", r[1], node)
                    continue
                heapq.heappush(heap, (to.key, number, url, to))
                number += 1
        while heap and heap[0][2] in done:
            heapq.heappop(heap)
        yield [(*r, wave) for r in rows], (None if not heap else () if heap[0][3].value is None else heap[0][3].value)
        wave += 1

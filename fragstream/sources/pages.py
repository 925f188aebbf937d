"""Scanning pages: fetched and parsed where the tasks run, a row a page, links pruned on the spot."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import replace

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import paths, rdf
from ..functions import terms as V
from ..operators import relations
from ..operators.conditions import Condition
from ..plans.config import Config
from ..shipping import ship
from .http import ACCEPT, ACCEPT_METADATA, Document, Fetcher

_TERM = "struct<type:string,value:string,datatype:string,lang:string>"
QUADS = f"array<struct<s:{_TERM},p:string,o:{_TERM},g:{_TERM}>>"
SCHEMA = f"target string, page_url string, immutable boolean, max_age int, quads {QUADS}, nodes array<string>, error string"
#: Pages of a crawl: ``wave`` is the level at which a page was fetched.
CRAWLED = SCHEMA + ", wave int"


def links_of(quads: list[rdf.Quad], page: str, loose: bool = False) -> list[relations.Link]:
    """The links of a page, or of any subject when ``loose``: a missing type is a plain relation, a link without a node is none."""
    by: dict[tuple, dict[str, list]] = {}
    for s, p, o, _ in quads:
        by.setdefault(s[:2], {}).setdefault(p, []).append(o)
    find = lambda node, p: by.get(node[:2], {}).get(p, [])
    out = []
    for s, p, o, _ in quads:
        if p != V.TREE + "relation" or not (loose or s[1] == page):
            continue
        kind, path = find(o, V.TYPE), find(o, V.TREE + "path")
        try:
            where = str(paths.from_quads(path[0], find)) if path else None
        except ValueError:
            where = None
        values = tuple((v[1], v[2]) for v in find(o, V.TREE + "value"))
        out += [relations.Link(page, n[1], kind[0][1] if kind else V.PLAIN, where, values) for n in find(o, V.TREE + "node")]
    return out


def links_by_node(quads: list[dict], page: str, loose: bool = False) -> dict[str, list[relations.Link]]:
    """The links of a fetched page, by the address they lead to; quads are as rows of pages hold them."""
    term = lambda t: (t["type"], t["value"], t["datatype"], t["lang"])
    by: dict[str, list[relations.Link]] = {}
    for x in links_of([(term(q["s"]), q["p"], term(q["o"]), term(q["g"])) for q in quads], page, loose):
        by.setdefault(x.node, []).append(x)
    return by


def followed(links: list[relations.Link], condition: Condition, zone: str) -> list[str]:
    """Nodes that the condition lets a reader follow, each once, in the order of the page."""
    by: dict[str, list[relations.Link]] = {}
    for x in links:
        by.setdefault(x.node, []).append(x)
    return [node for node, own in by.items() if relations.allowed(own, condition, zone)]


def _row(target: str, found: Document | OSError, config: Config, condition: Condition) -> tuple:
    if not isinstance(found, Document):
        return (target, target, False, None, [], [], str(found))
    try:
        quads = rdf.parse(found.text, found.url, f"{zlib.crc32(found.url.encode()):08x}.")
    except rdf.RdfError as e:
        return (target, found.url, False, None, [], [], f"{found.url}: {e}")
    nodes = followed(links_of(quads, found.url, config.loose), condition, config.timezone)
    named = [(dict(zip(("type", "value", "datatype", "lang"), s, strict=True)), p, dict(zip(("type", "value", "datatype", "lang"), o, strict=True)), dict(zip(("type", "value", "datatype", "lang"), g, strict=True))) for s, p, o, g in quads]
    return (target, found.url, found.immutable, found.max_age, [dict(zip("spog", q, strict=True)) for q in named], nodes, None)


def fetched(targets: list[str], config: Config, condition: Condition) -> list[tuple]:
    """Rows of a few pages, fetched by the caller."""
    found = Fetcher(replace(config.fetch, concurrent=config.concurrent_fetches)).all(targets, ACCEPT_METADATA if config.include_metadata else ACCEPT)
    return [_row(u, d, config, condition) for u, d in zip(targets, found, strict=True)]


def scan(targets: DataFrame, config: Config, condition: Condition) -> DataFrame:
    """A row for each distinct address in the first column of ``targets``.

    The addresses are dealt over as many tasks as there may be fetches at a time,
    and each task fetches one page after the other: so the limit by origin holds
    over all tasks.
    """
    ship(targets.sparkSession)
    accept = ACCEPT_METADATA if config.include_metadata else ACCEPT
    targets = targets.repartition(max(1, config.concurrent_fetches))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fetcher = Fetcher(replace(config.fetch, concurrent=1))
        for frame in frames:
            urls = list(frame.iloc[:, 0])
            for a in range(0, len(urls), 64):  # bounds what a task holds
                some = urls[a : a + 64]
                rows = [_row(u, d, config, condition) for u, d in zip(some, fetcher.all(some, accept), strict=True)]
                yield pd.DataFrame(rows, columns=["target", "page_url", "immutable", "max_age", "quads", "nodes", "error"]).astype({"max_age": "Int32"})

    return targets.mapInPandas(run, SCHEMA)


def exploded(pages: DataFrame) -> DataFrame:
    """(page_url, s, p, o, g): the quads of pages."""
    return pages.select("page_url", F.explode("quads").alias("q")).select("page_url", "q.*")

"""What the root page says of its stream: the view, the stream, its paths and its shape."""

from __future__ import annotations

import logging
from dataclasses import dataclass, field

from ..functions import paths, rdf
from ..functions import terms as V
from ..sources.http import ACCEPT, ACCEPT_METADATA, Document, Fetcher, FetchError
from .config import Config

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Shape:
    """An extraction template: predicates whose objects belong to a member, and those a node must have."""

    nested: tuple[str, ...] = ()
    required: tuple[str, ...] = ()


@dataclass(frozen=True)
class Info:
    """The stream and how to read its members."""

    view: str
    stream: str | None
    timestamp: paths.Path | None = None
    version_of: paths.Path | None = None
    shape: Shape | None = None
    dump: bool = False
    root: Document | None = field(default=None, repr=False)


class Index:
    """Quads by subject and predicate."""

    def __init__(self, quads: list[rdf.Quad]):
        self.quads = quads
        self.by: dict[tuple, dict[str, list[rdf.Term]]] = {}
        for s, p, o, _ in quads:
            self.by.setdefault(s[:2], {}).setdefault(p, []).append(o)

    def find(self, node: rdf.Term, predicate: str) -> list[rdf.Term]:
        return self.by.get(node[:2], {}).get(predicate, [])

    def pairs(self, predicate: str) -> list[tuple[rdf.Term, rdf.Term]]:
        return [(s, o) for s, p, o, _ in self.quads if p == predicate]


def main_shape(index: Index) -> rdf.Term:
    """The only node shape that no other shape uses."""
    used = {o[:2] for _, _, o, _ in index.quads}
    found = list({s[:2]: s for s, o in index.pairs(V.TYPE) if o[1] == V.SHACL + "NodeShape" and s[:2] not in used}.values())
    if len(found) != 1:
        raise ValueError(f"one main shape is expected, there are {len(found)}")
    return found[0]


def shape_of(index: Index, node: rdf.Term) -> Shape:
    """The template of a shape: nested shapes are followed, cycles end."""
    nested: list[str] = []
    required: list[str] = []
    seen, todo = set(), [(node, 0)]
    while todo:
        shape, depth = todo.pop(0)
        if shape[:2] in seen:
            continue
        seen.add(shape[:2])
        for prop in index.find(shape, V.SHACL + "property"):
            path = index.find(prop, V.SHACL + "path")
            if not path or path[0][0] != V.IRI:
                continue
            least = index.find(prop, V.SHACL + "minCount")
            if not depth and least and least[0][1].strip("+").isdigit() and int(least[0][1]) > 0:
                (deep if depth else required).append(path[0][1])
            for inner in index.find(prop, V.SHACL + "node"):
                nested.append(path[0][1])
                todo.append((inner, depth + 1))
    return Shape(tuple(dict.fromkeys(nested)), tuple(dict.fromkeys(required)))


def load(fetcher: Fetcher, url: str, accept: str = ACCEPT) -> tuple[Document, Index]:
    found = fetcher.get(url, accept)
    return found, Index(rdf.parse(found.text, found.url))


def discover(config: Config, fetcher: Fetcher) -> Info:
    """Reads the root, and the view or the stream's own document where the root leaves something open."""
    accept = ACCEPT_METADATA if config.include_metadata else ACCEPT
    try:
        root, index = load(fetcher, config.url, accept)
    except rdf.RdfError as e:
        raise FetchError(f"{config.url}: {e}") from e
    dump = not config.url.startswith("http")
    views = index.pairs(V.TREE + "view")
    streams = [s for s, o in index.pairs(V.TYPE) if o[1] == V.STREAM + "EventStream"]
    stream = views[0][0][1] if views else streams[0][1] if streams else None
    if config.url_is_view or dump:
        view = root.url
    elif views:
        view = views[0][1][1]
    else:
        raise ValueError(f"no view found at {config.url}")
    found = _parts(index, stream, config, fetcher)
    if not dump and any(v is None for v in found[:2] + ((found[2],) if not (config.no_shape or config.shape_file) else ())):
        other = (stream or view) if config.url_is_view else view
        try:
            more = _parts(load(fetcher, other, accept)[1], None, config, fetcher)
            found = tuple(a if a is not None else b for a, b in zip(found, more, strict=True))
        except (OSError, ValueError) as e:
            log.warning("no more is known of the stream: %s", e)
    timestamp, version_of, shape = found
    if config.shape_file:
        try:
            given = load(fetcher, config.shape_file)[1]
        except OSError as e:
            raise FetchError(f"the shape can't be read: {e}") from e
        shape = shape_of(given, main_shape(given))
    return Info(view, stream, timestamp, version_of, None if config.no_shape else shape, dump, root)


def _parts(index: Index, stream: str | None, config: Config, fetcher: Fetcher) -> tuple[paths.Path | None, paths.Path | None, Shape | None]:
    """(timestamp path, version path, shape) of a stream, or of any subject."""

    def first(predicate: str) -> rdf.Term | None:
        own = [o for s, o in index.pairs(predicate) if stream is None or s[1] == stream]
        if len({o[:2] for o in own}) > 1:
            log.warning("several values of %s; the first is taken", predicate)
        return own[0] if own else None

    time, version, shape = first(V.STREAM + "timestampPath"), first(V.STREAM + "versionOfPath"), first(V.TREE + "shape")
    made = None
    if shape is not None and not config.no_shape and not config.shape_file:
        if shape[0] == V.IRI and shape[:2] not in index.by:
            try:
                index = Index([*index.quads, *load(fetcher, shape[1])[1].quads])
            except (OSError, ValueError) as e:
                log.warning("the shape can't be read: %s", e)
        made = shape_of(index, shape)
    as_path = lambda t: paths.from_quads(t, index.find) if t is not None else None
    return as_path(time), as_path(version), made

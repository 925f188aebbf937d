"""Conditions written in Turtle: comparisons, conjunctions, disjunctions and limits as described resources."""

from __future__ import annotations

from pathlib import Path as FilePath

from ..functions import partial_dates, paths, rdf
from ..functions import terms as V
from ..operators.conditions import And, Condition, Leaf, MaxCount, Or
from .discovery import Index

C = V.CONDITIONS


def parse(text: str, base: str, zone: str = partial_dates.DEFAULT_ZONE) -> Condition:
    """The condition that the resource ``base`` describes, or else the only one that no other uses."""
    index = Index(rdf.parse(text, base))
    top: rdf.Term = (V.IRI, base, None, None)
    if top[:2] not in index.by:
        used = {o[:2] for _, _, o, _ in index.quads}
        found = [s for s, o in index.pairs(V.TYPE) if o[1].startswith(C) and s[:2] not in used]
        if len(found) != 1:
            raise ValueError("one condition is expected in the file")
        top = found[0]
    return _of(index, top, zone)


def load(path: str, zone: str = partial_dates.DEFAULT_ZONE) -> Condition:
    """The condition of a file, which may call itself ``<>``."""
    where = FilePath(path)
    return parse(where.read_text(encoding="utf-8"), where.resolve().as_uri(), zone)


def _of(index: Index, node: rdf.Term, zone: str) -> Condition:
    kinds = {t[1].removeprefix(C) for t in index.find(node, V.TYPE)}
    one = lambda predicate: next(iter(index.find(node, predicate)), None)
    for kind, word, make in (("And", "and", And), ("Or", "or", Or)):
        if kind in kinds:
            items = index.find(node, C + word)
            if not items:
                raise ValueError(f"{kind} needs at least one condition")
            return make(tuple(_of(index, x, zone) for x in items))
    if "MaxCount" in kinds:
        count, reset = one(C + "val"), one(C + "reset")
        if count is None:
            raise ValueError("a limit needs a value")
        return MaxCount(int(count[1]), reset is not None and reset[1] in ("true", "1"))
    kind, path, value = one(V.TREE + "relationType"), one(V.TREE + "path"), one(V.TREE + "value")
    if "Condition" not in kinds or kind is None or path is None or value is None:
        raise ValueError("a comparison needs a relation type, a path and a value")
    domain = one(V.TREE + "compareType")
    return Leaf(paths.from_quads(path, index.find), kind[1], value[1], domain[1] if domain else "string", zone)

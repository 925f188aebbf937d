"""Property paths: parsed from RDF, written in one canonical form, and evaluated over a member's quads."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import terms as V


@dataclass(frozen=True)
class Path:
    """``kind`` is iri, inverse, sequence, alternative, optional, any or some; ``parts`` are paths, or the IRI of an iri."""

    kind: str
    parts: tuple

    def __str__(self) -> str:
        if self.kind == "iri":
            return f"<{self.parts[0]}>"
        inner = [str(p) if p.kind in ("iri", "inverse") else f"({p})" for p in self.parts]
        return {"inverse": "^" + inner[0], "sequence": "/".join(inner), "alternative": "|".join(inner), "optional": inner[0] + "?", "any": inner[0] + "*", "some": inner[0] + "+"}[self.kind]


def iri(value: str) -> Path:
    return Path("iri", (value,))


def sequence(*parts: Path) -> Path:
    return parts[0] if len(parts) == 1 else Path("sequence", parts)


def inverse(part: Path) -> Path:
    return Path("inverse", (part,))


def from_quads(node: tuple, find: Callable[[tuple, str], list[tuple]]) -> Path:
    """The path that a node describes; ``find(subject, predicate)`` gives objects. Terms are (type, value, datatype, lang)."""
    if node[0] == V.IRI:
        return iri(node[1])
    if find(node, V.FIRST):
        return sequence(*(from_quads(x, find) for x in rdf_list(node, find)))
    for predicate, kind in (("inversePath", "inverse"), ("zeroOrMorePath", "any"), ("oneOrMorePath", "some"), ("zeroOrOnePath", "optional")):
        if inner := find(node, V.SHACL + predicate):
            return Path(kind, (from_quads(inner[0], find),))
    if inner := find(node, V.SHACL + "alternativePath"):
        return Path("alternative", tuple(from_quads(x, find) for x in rdf_list(inner[0], find)))
    raise ValueError(f"no property path: {node[1]}")


def rdf_list(node: tuple, find: Callable[[tuple, str], list[tuple]]) -> list[tuple]:
    """The members of an RDF list."""
    out = []
    while node[1] != V.NIL:
        first, rest = find(node, V.FIRST), find(node, V.REST)
        if not first or not rest:
            break
        out.append(first[0])
        node = rest[0]
    return out


def values(path: Path, quads: Column, start: Column) -> Column:
    """Array of the terms that a path leads to from the term ``start``, in the order of the quads; native expressions only.

    Repeated paths are followed as many steps as there are quads: a step that
    finds nothing new is followed by none that does. Each step starts from what
    the one before has found alone, and compares no more than one key a quad.
    """
    return _step(path, quads, _scanned(quads), F.array(start))


#: Gives, for a predicate and whether it is inverse, what leads from an array of terms to that of their objects or subjects.
Find = Callable[[str, bool], Callable[[Column], Column]]


def _step(path: Path, quads: Column, find: Find, now: Column) -> Column:
    if path.kind == "iri":
        return find(path.parts[0], False)(now)
    if path.kind == "inverse" and path.parts[0].kind == "iri":
        return find(path.parts[0].parts[0], True)(now)
    if path.kind == "inverse":
        return _step(_turned(path.parts[0]), quads, find, now)
    if path.kind == "sequence":
        for p in path.parts:
            now = _step(p, quads, find, now)
        return now
    if path.kind == "alternative":
        return F.concat(*(_step(p, quads, find, now) for p in path.parts))
    first = _step(path.parts[0], quads, find, now)
    if path.kind == "optional":
        return F.array_distinct(F.concat(now, first))
    reached = F.array_distinct(now if path.kind == "any" else first)
    leaves = sorted(_leaves(path))
    return _let(_index(leaves, quads), lambda index: _followed(path.parts[0], quads, _indexed(leaves, index), reached))


def _followed(path: Path, quads: Column, find: Find, reached: Column) -> Column:
    """``reached`` and all that steps of the path lead to from there; ``fresh`` is what the last step has found and no step has started from."""
    both = lambda at: F.flatten(F.array(at["found"], at["fresh"]))
    state = lambda found, fresh: F.struct(found.alias("found"), fresh.alias("fresh"))
    new = lambda at: F.array_except(F.array_except(_step(path, quads, find, at["fresh"]), at["found"]), at["fresh"])
    grown = lambda at, _: F.when(F.size(at["fresh"]) > 0, state(both(at), new(at))).otherwise(at)
    return F.aggregate(quads, state(F.slice(reached, 1, 0), reached), grown, both)


def _scanned(quads: Column) -> Find:
    def find(predicate: str, back: bool) -> Callable[[Column], Column]:
        a, b = ("o", "s") if back else ("s", "o")
        return lambda now: F.flatten(F.transform(now, lambda t: F.transform(F.filter(quads, lambda q: (q["p"] == predicate) & _same(q[a], t)), lambda q: q[b])))

    return find


def _index(leaves: list[tuple[str, bool]], quads: Column) -> Column:
    """For each predicate and direction, its quads as the key of the term at one end and the term at the other."""

    def ends(predicate: str, back: bool) -> Column:
        a, b = ("o", "s") if back else ("s", "o")
        return F.transform(F.filter(quads, lambda q: q["p"] == predicate), lambda q: F.struct(_key(q[a]).alias("key"), q[b].alias("to")))

    return F.struct(*(ends(*leaf).alias(f"leaf{i}") for i, leaf in enumerate(leaves)))


def _indexed(leaves: list[tuple[str, bool]], index: Column) -> Find:
    def find(predicate: str, back: bool) -> Callable[[Column], Column]:
        own = index[f"leaf{leaves.index((predicate, back))}"]
        return lambda now: F.flatten(F.transform(F.transform(now, _key), lambda k: F.filter(own, lambda e: e["key"] == k)["to"]))

    return find


def _leaves(path: Path, back: bool = False) -> set[tuple[str, bool]]:
    """The predicates that a path takes, and whether it takes them from object to subject."""
    if path.kind == "iri":
        return {(path.parts[0], back)}
    return set().union(*(_leaves(p, back != (path.kind == "inverse")) for p in path.parts))


def _turned(path: Path) -> Path:
    """The inverse of a path that is more than an IRI, by inverses of its parts."""
    if path.kind == "inverse":
        return path.parts[0]
    parts = tuple(inverse(p) for p in path.parts)
    return Path(path.kind, parts[::-1] if path.kind == "sequence" else parts)


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value that is made once, however often ``then`` uses it."""
    return F.transform(F.array(value), then)[0]


def _key(t: Column) -> Column:
    return F.concat(t["type"], F.lit(" "), t["value"])


def _same(a: Column, b: Column) -> Column:
    return (a["value"] == b["value"]) & (a["type"] == b["type"])


def walk(path: Path, quads: Iterable[tuple], start: tuple) -> list[tuple]:
    """``values`` on the driver: quads are (s, p, o, g) of term tuples."""
    quads = list(quads)
    step = {"iri": lambda n: [q[2] for q in quads if q[0][:2] == n[:2] and q[1] == path.parts[0]]}
    if path.kind == "iri":
        return step["iri"](start)
    if path.kind == "inverse":
        return [q[0] for q in quads if q[2][:2] == start[:2] and q[1] == path.parts[0].parts[0]]
    if path.kind == "sequence":
        now = [start]
        for p in path.parts:
            now = [y for x in now for y in walk(p, quads, x)]
        return now
    if path.kind == "alternative":
        return [y for p in path.parts for y in walk(p, quads, start)]
    out, now = [start] if path.kind in ("optional", "any") else [], [start]
    while now := [y for x in now for y in walk(path.parts[0], quads, x) if y not in out]:
        out += dict.fromkeys(now)
        if path.kind == "optional":
            break
    return out

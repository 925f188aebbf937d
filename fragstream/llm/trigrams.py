"""Boolean trigram queries from regular expressions, for an index that narrows down what a regex must be run on.

The query of a regex is a disjunction of conjunctions of trigrams, over
lower-cased text: any text with a match holds all trigrams of at least one
conjunction. A regex from which no trigram follows has no query and must be run
on every text.
"""

from __future__ import annotations

import re._constants as op
import re._parser as parser

#: A longer list of exact strings, or of conjunctions, is given up for a weaker query: a superset of texts, so nothing is lost.
MOST_STRINGS, MOST_CONJUNCTIONS, MOST_CLASS = 48, 64, 8

Query = frozenset[frozenset[str]]
ANY: Query = frozenset([frozenset()])


def _simple(query: Query) -> Query:
    """Without conjunctions that another one contains."""
    return frozenset(c for c in query if not any(d < c for d in query))


def _and(a: Query, b: Query) -> Query:
    made = _simple(frozenset(x | y for x in a for y in b))
    return made if len(made) <= MOST_CONJUNCTIONS else min(a, b, key=len)


def _or(a: Query, b: Query) -> Query:
    made = _simple(a | b)
    return made if len(made) <= MOST_CONJUNCTIONS else ANY


def _of_strings(strings: frozenset[str]) -> Query:
    return _simple(frozenset(frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings))


def _class(items: list) -> frozenset[str] | None:
    """The characters of a small class, lower-cased; None for a large or negated one."""
    found: set[str] = set()
    for kind, value in items:
        if kind is op.LITERAL:
            found.add(chr(value).lower())
        elif kind is op.RANGE and value[1] - value[0] < MOST_CLASS:
            found |= {chr(x).lower() for x in range(value[0], value[1] + 1)}
        else:
            return None
    return frozenset(found) if len(found) <= MOST_CLASS else None


def _walk(items) -> tuple[frozenset[str] | None, Query]:
    """(exact strings of a sequence, if few; the query of the sequence)."""
    run: frozenset[str] = frozenset([""])
    query, exact = ANY, True
    for kind, value in items:
        strings, own = None, ANY
        if kind is op.LITERAL:
            strings = frozenset([chr(value).lower()])
        elif kind is op.IN:
            strings = _class(value)
        elif kind is op.SUBPATTERN:
            strings, own = _walk(value[3])
        elif kind is op.BRANCH:
            parts = [_walk(x) for x in value[1]]
            if all(s is not None for s, _ in parts) and len(joined := frozenset().union(*(s for s, _ in parts))) <= MOST_STRINGS:
                strings = joined
            else:
                own = frozenset()
                for s, q in parts:
                    own = _or(own, q if s is None else _of_strings(s))
        elif kind in (op.MAX_REPEAT, op.MIN_REPEAT, op.POSSESSIVE_REPEAT):
            low, high, inner = value
            s, q = _walk(inner)
            if s is not None and (low, high) in ((0, 1), (1, 1)):
                strings = s | {""} if low == 0 else s
            elif low:
                own = q if s is None else _of_strings(s)
        elif kind is op.AT:
            continue
        if strings is not None and len(longer := frozenset(a + b for a in run for b in strings)) <= MOST_STRINGS:
            run = longer
            continue
        query, exact = _and(query, _of_strings(run)), False
        run = strings if strings is not None else frozenset([""])
        query = _and(query, own)
    return (run, ANY) if exact else (None, _and(query, _of_strings(run)))


def trigram_query(regex: str) -> Query | None:
    """The query of a regex; None if it has no mandatory trigram."""
    strings, query = _walk(parser.parse(regex))
    query = _simple(query if strings is None else _of_strings(strings))
    return None if frozenset() in query else query

"""Reading and writing RDF text: Turtle, TriG, N-Triples and N-Quads share one grammar here.

Terms are tuples (type, value, datatype, lang), quads are (s, p, o, g) with the
predicate as a plain IRI: the shapes of the Spark types in ``terms``.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator
from urllib.parse import urljoin

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import terms as V

Term = tuple[str, str, str | None, str | None]
Quad = tuple[Term, str, Term, Term]
GRAPH: Term = (V.DEFAULT, "", None, None)

_TOKEN = re.compile(
    r"""(?P<skip>(?:\s+|\#[^\n]*)+)
      |(?P<iri><[^<>"{}|^`\\\x00-\x20]*(?:\\[uU][0-9A-Fa-f]+[^<>"{}|^`\\\x00-\x20]*)*>)
      |(?P<long>\"\"\"(?:\"{0,2}(?:[^"\\]|\\.))*\"\"\"|'''(?:'{0,2}(?:[^'\\]|\\.))*''')
      |(?P<string>"(?:[^"\\\n\r]|\\.)*"|'(?:[^'\\\n\r]|\\.)*')
      |(?P<directive>@prefix\b|@base\b|(?i:PREFIX|BASE|GRAPH)(?=[\s<{]))
      |(?P<lang>@[A-Za-z]+(?:-[A-Za-z0-9]+)*)
      |(?P<type>\^\^)
      |(?P<number>[+-]?(?:\d+\.?\d*[eE][+-]?\d+|\.\d+[eE][+-]?\d+|\d*\.\d+|\d+)(?![\w:]))
      |(?P<blank>_:[\w\u00B7][\w\u00B7.-]*)
      |(?P<name>(?:[^\W\d_][\w\u00B7.-]*)?:(?:[\w:\u00B7%.-]|\\[_~.\-!$&'()*+,;=/?\#@%])*)
      |(?P<word>a\b|true\b|false\b)
      |(?P<mark>[.;,\[\](){}])""",
    re.X | re.S,
)
_ESCAPE = re.compile(r"\\(?:u([0-9A-Fa-f]{4})|U([0-9A-Fa-f]{8})|(.))", re.S)
_PLAIN = {"t": "\t", "b": "\b", "n": "\n", "r": "\r", "f": "\f"}


class RdfError(ValueError):
    """The text is no RDF that can be read."""


def _unescape(text: str) -> str:
    return _ESCAPE.sub(lambda m: chr(int(m[1] or m[2], 16)) if m[1] or m[2] else _PLAIN.get(m[3], m[3]), text) if "\\" in text else text


class _Reader:
    def __init__(self, text: str, base: str, scope: str):
        self.base, self.scope = base, scope
        self.prefixes: dict[str, str] = {}
        self.quads: list[Quad] = []
        self.graph = GRAPH
        self.fresh = itertools.count()
        self.tokens = list(self._split(text))
        self.at = 0

    def _split(self, text: str) -> Iterator[tuple[str, str]]:
        at = 0
        while at < len(text):
            m = _TOKEN.match(text, at)
            if not m:
                raise RdfError(f"can't read {text[at : at + 40]!r} at {at}")
            kind, value, at = m.lastgroup, m[0], m.end()
            if kind in ("name", "blank"):
                while value.endswith("."):  # a dot at the end ends the statement
                    value, at = value[:-1], at - 1
            if kind != "skip":
                yield kind, value

    def peek(self) -> tuple[str, str]:
        return self.tokens[self.at] if self.at < len(self.tokens) else ("end", "")

    def next(self) -> tuple[str, str]:
        token = self.peek()
        self.at += 1
        return token

    def expect(self, mark: str) -> None:
        kind, value = self.next()
        if value != mark or kind not in ("mark", "type"):
            raise RdfError(f"{mark!r} is expected, not {value!r}")

    def iri(self, kind: str, value: str) -> str:
        if kind == "iri":
            found = _unescape(value[1:-1])
            return found if re.match(r"[A-Za-z][A-Za-z0-9+.-]*:", found) or not self.base else urljoin(self.base, found) if found else self.base
        prefix, _, local = value.partition(":")
        if prefix not in self.prefixes:
            raise RdfError(f"unknown prefix {prefix!r}")
        return self.prefixes[prefix] + re.sub(r"\\(.)", r"\1", local)

    def blank(self, label: str | None = None) -> Term:
        return (V.BLANK, f"{self.scope}{label if label is not None else f'.{next(self.fresh)}'}", None, None)

    def document(self) -> list[Quad]:
        while self.peek()[0] != "end":
            kind, value = self.peek()
            if kind == "directive" and value.upper() != "GRAPH":
                self.directive()
            elif value == "{":
                self.block(GRAPH)
            else:
                if kind == "directive":
                    self.next()
                start = self.at
                if self.peek()[0] in ("iri", "name", "blank") and self.at + 1 < len(self.tokens) and self.tokens[self.at + 1][1] == "{":
                    self.block(self.term())
                else:
                    self.at = start
                    self.statement()
                    if self.peek()[1] == ".":
                        self.next()
                    else:
                        raise RdfError(f"'.' is expected, not {self.peek()[1]!r}")
        return self.quads

    def directive(self) -> None:
        word = self.next()[1]
        if word.lower().endswith("prefix"):
            name = self.next()[1]
            self.prefixes[name.rstrip(":") if name != ":" else ""] = self.iri(*self.next())
        else:
            self.base = self.iri(*self.next())
        if word.startswith("@"):
            self.expect(".")

    def block(self, graph: Term) -> None:
        self.expect("{")
        before, self.graph = self.graph, graph
        while self.peek()[1] != "}":
            self.statement()
            if self.peek()[1] == ".":
                self.next()
        self.next()
        self.graph = before

    def statement(self) -> None:
        only = self.peek()[1] == "["
        subject = self.term()
        if only and self.peek()[1] in (".", "}"):
            return
        self.predicates(subject)

    def predicates(self, subject: Term) -> None:
        while True:
            kind, value = self.next()
            predicate = V.TYPE if (kind, value) == ("word", "a") else self.iri(kind, value) if kind in ("iri", "name") else None
            if predicate is None:
                raise RdfError(f"a predicate is expected, not {value!r}")
            while True:
                o = self.term()
                graph = self.graph
                if self.peek()[0] in ("iri", "blank", "name") and self.graph == GRAPH and self.at + 1 < len(self.tokens) and self.tokens[self.at + 1][1] == ".":
                    graph = self.term()  # the fourth term of N-Quads
                self.quads.append((subject, predicate, o, graph))
                if self.peek()[1] != ",":
                    break
                self.next()
            if self.peek()[1] != ";":
                return
            while self.peek()[1] == ";":
                self.next()
            if self.peek()[1] in (".", "]", "}"):
                return

    def term(self) -> Term:
        kind, value = self.next()
        if kind in ("iri", "name"):
            return (V.IRI, self.iri(kind, value), None, None)
        if kind == "blank":
            return self.blank(value[2:])
        if kind in ("string", "long"):
            text = _unescape(value[3:-3] if kind == "long" else value[1:-1])
            follows = self.peek()[0]
            if follows == "lang":
                return (V.LITERAL, text, V.LANG_STRING, self.next()[1][1:].lower())
            if follows == "type":
                self.next()
                return (V.LITERAL, text, self.iri(*self.next()), None)
            return (V.LITERAL, text, V.STRING, None)
        if kind == "number":
            name = "double" if "e" in value.lower() else "decimal" if "." in value else "integer"
            return (V.LITERAL, value, V.XSD + name, None)
        if kind == "word" and value != "a":
            return (V.LITERAL, value, V.XSD + "boolean", None)
        if value == "[":
            node = self.blank()
            if self.peek()[1] != "]":
                self.predicates(node)
            self.expect("]")
            return node
        if value == "(":
            return self.list()
        raise RdfError(f"a term is expected, not {value!r}")

    def list(self) -> Term:
        items = []
        while self.peek()[1] != ")":
            items.append(self.term())
        self.next()
        nodes = [self.blank() for _ in items] + [(V.IRI, V.NIL, None, None)]
        for node, item, rest in zip(nodes, items, nodes[1:], strict=False):
            self.quads += [(node, V.FIRST, item, self.graph), (node, V.REST, rest, self.graph)]
        return nodes[0]


def parse(text: str, base: str = "", scope: str = "") -> list[Quad]:
    """The quads of a text. ``scope`` keeps the blank nodes of different texts apart."""
    return _Reader(text, base, scope).document()


def _quoted(text: str) -> str:
    return '"' + text.replace("\\", "\\\\").replace('"', '\\"').replace("\n", "\\n").replace("\r", "\\r") + '"'


def write_term(t: Term) -> str:
    if t[0] == V.IRI:
        return f"<{t[1]}>"
    if t[0] == V.BLANK:
        return "_:" + re.sub(r"[^A-Za-z0-9]", "x", t[1]) if not t[1].isalnum() else f"_:{t[1]}"
    tail = f"@{t[3]}" if t[3] else "" if t[2] in (None, V.STRING) else f"^^<{t[2]}>"
    return _quoted(t[1]) + tail


def write(quads: list[Quad]) -> str:
    """N-Quads text, a line a quad."""
    return "".join(f"{write_term(s)} <{p}> {write_term(o)}{'' if g[0] == V.DEFAULT else ' ' + write_term(g)} .\n" for s, p, o, g in quads)


def nquads(quads: Column) -> Column:
    """N-Quads text of an array of quads, as native expressions."""

    def term(t: Column) -> Column:
        text = F.replace(F.replace(F.replace(F.replace(t["value"], F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit("\n"), F.lit("\\n")), F.lit("\r"), F.lit("\\r"))
        tail = F.when(t["lang"].isNotNull(), F.concat(F.lit("@"), t["lang"])).when(t["datatype"].isNull() | (t["datatype"] == V.STRING), "").otherwise(F.concat(F.lit("^^<"), t["datatype"], F.lit(">")))
        blank = F.concat(F.lit("_:"), F.regexp_replace(t["value"], "[^A-Za-z0-9]", "x"))
        return F.when(t["type"] == V.IRI, F.concat(F.lit("<"), t["value"], F.lit(">"))).when(t["type"] == V.BLANK, blank).otherwise(F.concat(F.lit('"'), text, F.lit('"'), tail))

    def line(q: Column) -> Column:
        graph = F.when(q["g"]["type"] == V.DEFAULT, "").otherwise(F.concat(F.lit(" "), term(q["g"])))
        return F.concat(term(q["s"]), F.lit(" <"), q["p"], F.lit("> "), term(q["o"]), graph, F.lit(" .\n"))

    return F.array_join(F.transform(quads, line), "")

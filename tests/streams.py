"""Small streams, built as Turtle pages for the test server."""

PREFIXES = """@prefix tree: <https://w3id.org/tree#> . @prefix ldes: <https://w3id.org/ldes#> . @prefix ex: <http://example.org/ns#> .
@prefix xsd: <http://www.w3.org/2001/XMLSchema#> . @prefix sh: <http://www.w3.org/ns/shacl#> . @prefix dct: <http://purl.org/dc/terms/> .
"""
SHAPE = """<BASE/shape> a sh:NodeShape ; sh:targetClass ex:Thing ;
  sh:property [ sh:path ex:label ; sh:minCount 1 ], [ sh:path ex:part ; sh:node <BASE/inner> ] .
<BASE/inner> a sh:NodeShape ; sh:targetClass ex:Part ; sh:property [ sh:path ex:inner ; sh:minCount 1 ] .
"""


def stream(view, shape=True):
    return PREFIXES + f"""<BASE/stream> a ldes:EventStream ; ldes:timestampPath ex:at ; ldes:versionOfPath ex:of ; tree:view <BASE{view}>{' ; tree:shape <BASE/shape>' if shape else ''} .
""" + (SHAPE if shape else "")  # fmt: skip


def member(entity, version, at, part=True):
    """A version of an entity with a label and, on the page, a part that only the shape reaches."""
    m = f"<BASE/things/{entity}#{version}>"
    return f"""<BASE/stream> tree:member {m} .
{m} a ex:Thing ; ex:of <BASE/things/{entity}> ; ex:at "{at}"^^xsd:dateTime ; ex:label "{entity} {version}" ; ex:part <BASE/parts/{entity}> .
""" + (f'<BASE/parts/{entity}> a ex:Part ; ex:inner "in {entity}" .\n' if part else "")  # fmt: skip


def relation(page, node, kind="Relation", value=None, path="ex:at", datatype="xsd:dateTime"):
    bound = f' ; tree:path {path} ; tree:value "{value}"^^{datatype}' if value is not None else ""
    return f"<BASE{page}> tree:relation [ a tree:{kind} ; tree:node <BASE{node}>{bound} ] .\n"


def plain(site):
    """root -> /0 -> /1 -> /2, each later than the one before: 6 entities with two versions each, 3 + 3 + 6 members; /0 and /1 never change."""
    d = "2024-07-14T"
    root = stream("/0")
    p0 = PREFIXES + "".join(member(f"e{i}", 0, f"{d}08:{20 * (i - 1):02}:00Z") for i in (1, 2, 3)) + relation("/0", "/1", "GreaterThanOrEqualToRelation", d + "09:00:00Z")
    p1 = PREFIXES + "".join(member(f"e{i}", 0, f"{d}09:{20 * (i - 4):02}:00Z") for i in (4, 5, 6)) + relation("/1", "/2", "GreaterThanOrEqualToRelation", d + "10:00:00Z") + relation("/1", "/0", "LessThanRelation", d + "09:00:00Z")
    p2 = PREFIXES + "".join(member(f"e{i}", 1, f"{d}10:{10 * (i - 1):02}:00Z") for i in range(1, 7)) + relation("/2", "/1", "LessThanRelation", d + "10:00:00Z")
    site.put("/root", root)
    site.put("/0", p0, True)
    site.put("/1", p1, True)
    site.put("/2", p2)
    return site.base + "/root"


def calendar(site):
    """The view is the root: /2025 -> /2025-01 -> one page a day, bounded on both sides; days never change."""
    site.put("/2025", stream("/2025") + relation("/2025", "/2025-01", "GreaterThanOrEqualToRelation", "2025-01-01T00:00:00Z") + relation("/2025", "/2025-01", "LessThanRelation", "2025-02-01T00:00:00Z"))
    days = ""
    for i in (1, 2):
        days += relation("/2025-01", f"/2025-01-0{i}", "GreaterThanOrEqualToRelation", f"2025-01-0{i}T00:00:00Z") + relation("/2025-01", f"/2025-01-0{i}", "LessThanRelation", f"2025-01-0{i + 1}T00:00:00Z")
        site.put(f"/2025-01-0{i}", PREFIXES + "".join(member(f"c{k}", i, f"2025-01-0{i}T{8 + k:02}:00:00Z") for k in (1, 2, 3)), True)
    site.put("/2025-01", PREFIXES + days)
    return site.base + "/2025"


def between(site):
    """In-between links by month, day and hour."""
    site.put("/root", stream("/y"))
    site.put("/y", PREFIXES + relation("/y", "/m9", "InBetweenRelation", "2024-09", datatype="xsd:gYearMonth") + relation("/y", "/m10", "InBetweenRelation", "2024-10", datatype="xsd:gYearMonth"))
    site.put("/m9", PREFIXES + relation("/m9", "/d25", "InBetweenRelation", "2024-09-25", datatype="xsd:date") + relation("/m9", "/d26", "InBetweenRelation", "2024-09-26", datatype="xsd:date"))
    site.put("/m10", PREFIXES + "".join(member(f"b{k}", 5, f"2024-10-2{k}T10:00:00Z") for k in (1, 2, 3)))
    site.put("/d25", PREFIXES + "".join(member(f"b{k}", 1, f"2024-09-25T0{k}:00:00Z") for k in (1, 2, 3)))
    site.put("/d26", PREFIXES + relation("/d26", "/h9", "InBetweenRelation", "2024-09-26T09", datatype="xsd:string") + relation("/d26", "/h10", "InBetweenRelation", "2024-09-26T10", datatype="xsd:string"))
    site.put("/h9", PREFIXES + "".join(member(f"b{k}", 2, f"2024-09-26T09:{10 * k}:00Z") for k in (1, 2, 3)))
    site.put("/h10", PREFIXES + "".join(member(f"b{k}", v, f"2024-09-26T10:{10 * k + v}:00Z") for k in (1, 2, 3) for v in (3, 4)))
    return site.base + "/root"


def linked(site):
    """Newest page first, plain links, parts only out of band: 9 members."""
    site.put("/root", stream("/n0") + "")
    at = {"/n0": "11", "/n1": "10", "/n2": "09"}
    for i, page in enumerate(at):
        nxt = relation(page, f"/n{i + 1}") if i < 2 else ""
        site.put(page, PREFIXES + "".join(member(f"l{k}", 2 - i, f"2024-07-14T{at[page]}:{k}0:00Z", part=False) for k in (1, 2, 3)) + nxt, page == "/n2")
    for k in (1, 2, 3):
        site.put(f"/parts/l{k}", PREFIXES + f'<BASE/parts/l{k}> a ex:Part ; ex:inner "out of band {k}" .')
    return site.base + "/root"

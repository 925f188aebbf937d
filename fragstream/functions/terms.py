"""Kinds of terms, and the vocabulary that describes streams."""

from __future__ import annotations

IRI, BLANK, LITERAL, DEFAULT = "iri", "blank", "literal", "default"

# Public vocabularies.
RDF = "http://www.w3.org/1999/02/22-rdf-syntax-ns#"
XSD = "http://www.w3.org/2001/XMLSchema#"
TREE = "https://w3id.org/tree#"
STREAM = "https://w3id.org/ldes#"
DCT = "http://purl.org/dc/terms/"
SHACL = "http://www.w3.org/ns/shacl#"
SDS = "https://w3id.org/sds#"
CONDITIONS = "http://vocab.deri.ie/csp#"

TYPE, FIRST, REST, NIL = RDF + "type", RDF + "first", RDF + "rest", RDF + "nil"
LANG_STRING, STRING = RDF + "langString", XSD + "string"
INGESTION = STREAM + "IngestionMetadata"
DESCRIPTION_GRAPH = SDS + "DataDescription"
EQUAL, LESS, LESS_EQUAL, GREATER, GREATER_EQUAL, BETWEEN, PLAIN = (
    TREE + x for x in ("EqualToRelation", "LessThanRelation", "LessThanOrEqualToRelation", "GreaterThanRelation", "GreaterThanOrEqualToRelation", "InBetweenRelation", "Relation")
)

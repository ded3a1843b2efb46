"""Data model: the triples frame, vocabulary IRIs and graph configuration.

A graph is a DataFrame with the six columns of ``TRIPLE_COLUMNS``. Identity is all
six columns; set semantics come from one ``dropDuplicates`` at the end of a job.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Standard vocabulary IRIs (W3C RDF/RDFS/OWL/XSD, VoID, DCMI terms,
# OGC GeoSPARQL and Simple Features), as published by their owners.
RDF = "http://www.w3.org/1999/02/22-rdf-syntax-ns#"
RDFS = "http://www.w3.org/2000/01/rdf-schema#"
OWL = "http://www.w3.org/2002/07/owl#"
XSD = "http://www.w3.org/2001/XMLSchema#"
VOID = "http://rdfs.org/ns/void#"
DCTERMS = "http://purl.org/dc/terms/"
GEO = "http://www.opengis.net/ont/geosparql#"
SF = "http://www.opengis.net/ont/sf#"
ISO639 = "http://id.loc.gov/vocabulary/iso639-1/"

RDF_TYPE = RDF + "type"
RDFS_LABEL = RDFS + "label"
RDFS_COMMENT = RDFS + "comment"
RDFS_DOMAIN = RDFS + "domain"
RDFS_RANGE = RDFS + "range"
RDFS_SUBCLASSOF = RDFS + "subClassOf"
RDFS_SUBPROPERTYOF = RDFS + "subPropertyOf"
OWL_CLASS = OWL + "Class"
OWL_ONTOLOGY = OWL + "Ontology"
OWL_OBJECTPROPERTY = OWL + "ObjectProperty"
OWL_DATATYPEPROPERTY = OWL + "DatatypeProperty"
VOID_DATASET = VOID + "Dataset"
VOID_TRIPLES = VOID + "triples"
XSD_ANYTYPE = XSD + "anyType"
XSD_STRING = XSD + "string"
XSD_INTEGER = XSD + "integer"
XSD_DOUBLE = XSD + "double"
XSD_DATETIME = XSD + "dateTime"
XSD_DECIMAL = XSD + "decimal"
XSD_BOOLEAN = XSD + "boolean"
XSD_DATE = XSD + "date"
XSD_NONNEGATIVEINTEGER = XSD + "nonNegativeInteger"
GEO_FEATURE = GEO + "Feature"
GEO_HASGEOMETRY = GEO + "hasGeometry"
GEO_ASWKT = GEO + "asWKT"
GEO_WKTLITERAL = GEO + "wktLiteral"

DEFAULT_LANG = "nl"

KIND_IRI = "iri"
KIND_LITERAL = "literal"
KIND_BNODE = "bnode"

TRIPLE_COLUMNS = ["s", "p", "o", "o_kind", "o_datatype", "o_lang"]

TRIPLE_SCHEMA = T.StructType(
    [
        T.StructField("s", T.StringType(), False),
        T.StructField("p", T.StringType(), False),
        T.StructField("o", T.StringType(), False),
        T.StructField("o_kind", T.StringType(), False),
        T.StructField("o_datatype", T.StringType(), True),
        T.StructField("o_lang", T.StringType(), True),
    ]
)

DEFAULT_BASE = "http://example.org/linked_data/"


@dataclass(frozen=True)
class GraphConfig:
    """Namespaces of one source database.

    Instance IRIs live in ``<base><db>/``; classes and properties in
    ``<base>schema/<db>/``.
    """

    db: str
    base: str = DEFAULT_BASE
    label_lang: str = DEFAULT_LANG

    @property
    def data_ns(self) -> str:
        return f"{self.base}{self.db}/"

    @property
    def schema_ns(self) -> str:
        return f"{self.base}schema/{self.db}/"


@dataclass(frozen=True)
class HeaderText:
    """Descriptive header values of a graph (T14). All of it is configuration."""

    creator: str = "http://example.org/agents/Publisher"
    rights_holder: str = "http://example.org/agents/Owner"
    subject: str = "http://example.org/topics/Asset_management"
    language: str = ISO639 + "nl"
    title: str = "Linked Data Project - {db}"
    description_nl: str = "Triples van deze {kind}, afgeleid uit tabellen."
    description_en: str = "Triples of this {kind}, derived from tables."

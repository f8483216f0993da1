"""Schemas and static dimensions of a coded element directory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

REPRESENTATION = "struct<raw string, charset string, min_length int, max_length int>"
ELEMENT = f"tag int, name string, description string, representation {REPRESENTATION}, change_tag string, status string, old_name string, business_term string, notes string, bridges string, provenance struct<page int>"
REVIEW = "page int, tag int, field string, raw_fragments array<string>, issue string, confidence string"
WORDS = "page int, word_no int, text string, x double, y double"
ZONE = "struct<line_from int, line_to int, pos_from int, pos_to int, format string>"

# Fixed values of the published directory.
CHANGE_TAGS = ["add", "cnd", "cndr", "cnr", "cdr", "cn", "cr", "cd", "u", "x"]
LEGEND_TAGS = ["add", "cn", "cnd", "cnr", "cndr", "x", "u"]
STATUSES = ["active", "retired"]
CHARSETS = ["a", "an", "n"]
CONFIDENCES = ["high", "medium", "low"]
SCHEMES = ["Inland Waterways B/L", "CIMP", "UNLK", "UNSM", "EDIFACT", "ODETTE", "SWIFT", "SAD", "MAR", "AWB", "CMR", "CIM", "ICC", "INV", "ISO", "B/L"]
CATEGORIES = [
    (1, "4.2.1", "1000-1699", "documentation, references"),
    (2, "4.2.2", "2000-2699", "Dates, times, periods of time"),
    (3, "4.2.3", "3000-3699", "Parties, addresses, places, countries"),
    (4, "4.2.4", "4000-4699", "Clauses, conditions, terms, instructions"),
    (5, "4.2.5", "5000-5699", "Amounts, charges, percentages"),
    (6, "4.2.6", "6000-6699", "Measure identifiers, quantities (other than monetary)"),
    (7, "4.2.7", "7000-7699", "Goods and articles: descriptions and identifiers"),
    (8, "4.2.8", "8000-8699", "Transport modes, means and equipments"),
    (9, "4.2.9", "9000-9699", "Other data elements (Customs, etc.)"),
]
INTERVALS = [("tag", 60.0, 100.0), ("uid", 100.0, 130.0), ("name", 130.0, 263.0), ("description", 263.0, 516.0), ("representation", 516.0, 552.0), ("old_name", 552.0, 611.0), ("business_term", 611.0, 655.8), ("notes", 655.8, 704.0), ("bridges", 704.0, 1e9)]
#: Elements whose parse is exported for other implementations, and the order of the groups of terms.
FIXTURE_TAGS = [1002, 1004, 1082, 1128, 1188, 2025, 5010]
GROUPS = ["classes", "dataset-level", "element-level", "category-level", "vocabulary definitions"]
#: The public prefixes; the directory's own, ``utd``, stands for a namespace that the caller names.
PREFIXES = [
    ("schema", "https://schema.org/"), ("dct", "http://purl.org/dc/terms/"), ("skos", "http://www.w3.org/2004/02/skos/core#"), ("rdfs", "http://www.w3.org/2000/01/rdf-schema#"),
    ("owl", "http://www.w3.org/2002/07/owl#"), ("rdf", "http://www.w3.org/1999/02/22-rdf-syntax-ns#"), ("xsd", "http://www.w3.org/2001/XMLSchema#"),
]
#: Classes and their comments.
CLASSES = [
    ("TradeDataElement", "A data element of the Trade Data Elements Directory: a named, defined unit of trade information with a tag and a representation."),
    ("Representation", "The character representation of a data element: charset, length bounds, and the printed notation."),
    ("Bridge", "A location of a data element on a document scheme of an aligned trade document system (UNLK, SAD, MAR, CIMP, …)."),
    ("UnlkZone", "A line and character-position span locating an element on the UN layout key."),
    ("Category", "One of the nine ordered tag ranges into which the directory groups its data elements."),
    ("CategoryScheme", "The ordered scheme of the nine tag-range categories."),
]
#: Term, group, IRI, domain, comment.
TERMS = [
    ("TradeDataElement", "classes", "utd:TradeDataElement", None, None),
    ("Representation", "classes", "utd:Representation", None, None),
    ("Bridge", "classes", "utd:Bridge", None, None),
    ("UnlkZone", "classes", "utd:UnlkZone", None, None),
    ("Category", "classes", "utd:Category", None, None),
    ("CategoryScheme", "classes", "utd:CategoryScheme", None, None),
    ("Dataset", "classes", "schema:Dataset", None, None),
    ("DataDownload", "classes", "schema:DataDownload", None, None),
    ("name", "dataset-level", "schema:name", None, None),
    ("description", "dataset-level", "schema:description", None, None),
    ("isPartOf", "dataset-level", "schema:isPartOf", None, None),
    ("isBasedOn", "dataset-level", "schema:isBasedOn", None, None),
    ("distribution", "dataset-level", "schema:distribution", None, None),
    ("encodingFormat", "dataset-level", "schema:encodingFormat", None, None),
    ("source", "dataset-level", "dct:source", None, None),
    ("elementCount", "dataset-level", "utd:elementCount", None, "The number of member elements."),
    ("tag", "element-level", "utd:tag", "TradeDataElement", "The four-digit unique identifier of the data element."),
    ("representation", "element-level", "utd:representation", "TradeDataElement", "The character representation as a structured node: printed form, charset, length bounds."),
    ("printedForm", "element-level", "utd:printedForm", "Representation", "The printed representation notation, e.g. an..35."),
    ("charset", "element-level", "utd:charset", "Representation", "The character class of the representation: a, an or n."),
    ("minLength", "element-level", "utd:minLength", "Representation", "Minimum number of characters in a value."),
    ("maxLength", "element-level", "utd:maxLength", "Representation", "Maximum number of characters in a value."),
    ("changeTag", "element-level", "utd:changeTag", "TradeDataElement", "The printed change indicator against the 1993 edition."),
    ("status", "element-level", "utd:status", "TradeDataElement", "active or retired, per the printed change indicator."),
    ("altLabel", "element-level", "skos:altLabel", None, None),
    ("replacedBy", "element-level", "utd:replacedBy", "TradeDataElement", "The element to use instead, per the printed pointer on retired entries."),
    ("bridges", "element-level", "utd:bridges", "TradeDataElement", "Printed locations on aligned trade documents (UNLK, SAD, CIMP, CIM, MAR)."),
    ("bridge", "element-level", "utd:bridge", "TradeDataElement", "One parsed location on a document scheme, with its zones when the scheme is the UN layout key."),
    ("scheme", "element-level", "utd:scheme", "Bridge", "The document scheme the bridge locates the element on (UNLK, SAD, MAR, CIMP, …)."),
    ("detail", "element-level", "utd:detail", "Bridge", "The bridge detail as printed."),
    ("zone", "element-level", "utd:zone", "Bridge", "A line and character-position span on the UN layout key."),
    ("lineFrom", "element-level", "utd:lineFrom", "UnlkZone", "First line of the span on the UN layout key."),
    ("lineTo", "element-level", "utd:lineTo", "UnlkZone", "Last line of the span on the UN layout key."),
    ("posFrom", "element-level", "utd:posFrom", "UnlkZone", "First character position of the span."),
    ("posTo", "element-level", "utd:posTo", "UnlkZone", "Last character position of the span."),
    ("fieldFormat", "element-level", "utd:fieldFormat", "UnlkZone", "The interchange format token of the field, e.g. an..17."),
    ("sourcePage", "element-level", "utd:sourcePage", "TradeDataElement", "Page of the source publication the entry appears on."),
    ("category", "element-level", "utd:category", "TradeDataElement", "The tag-range category the element belongs to."),
    ("tagRange", "category-level", "utd:tagRange", "Category", "The tag interval of the category, e.g. 1000-1699."),
    ("position", "category-level", "schema:position", None, None),
    ("member", "category-level", "skos:member", None, None),
    ("inScheme", "category-level", "skos:inScheme", None, None),
    ("label", "vocabulary definitions", "rdfs:label", None, None),
    ("comment", "vocabulary definitions", "rdfs:comment", None, None),
    ("domain", "vocabulary definitions", "rdfs:domain", None, None),
    ("range", "vocabulary definitions", "rdfs:range", None, None),
    ("subClassOf", "vocabulary definitions", "rdfs:subClassOf", None, None),
]


def categories(spark: SparkSession) -> DataFrame:
    """Nine rows: k, section, range, label."""
    return spark.createDataFrame(CATEGORIES, "k int, section string, range string, label string")


def prefixes(spark: SparkSession, namespace: str) -> DataFrame:
    """ord, prefix, iri: the directory's own namespace first."""
    return spark.createDataFrame([(i, *x) for i, x in enumerate([("utd", namespace), *PREFIXES])], "ord int, prefix string, iri string")


def classes(spark: SparkSession) -> DataFrame:
    """ord, term, comment."""
    return spark.createDataFrame([(i, *x) for i, x in enumerate(CLASSES)], "ord int, term string, comment string")


def terms(spark: SparkSession) -> DataFrame:
    """ord, term, group, iri, domain, comment."""
    return spark.createDataFrame([(i, *x) for i, x in enumerate(TERMS)], "ord int, term string, group string, iri string, domain string, comment string")


def intervals(spark: SparkSession) -> DataFrame:
    """Nine rows: column, lo, hi, half-open."""
    return spark.createDataFrame(INTERVALS, "column string, lo double, hi double")

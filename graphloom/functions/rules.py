"""Rule and namespace decoding (L12, L13, L14) as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Rule term ``model:db.table/property``. The dot is escaped, and table and property
# may hold digits and ``_`` (property names such as ``c_nationkey``); a table may be a
# ``?guess?``.
RULE_PATTERN = r"^([a-z]*):([A-Za-z0-9_-]*)\.(\??[A-Za-z0-9_]*\??)(?:/)?([A-Za-z0-9_]*)$"


def decode_rule(term: Column) -> Column:
    """``struct(model, db, tbl, prop)``; null when the term does not match."""
    ok = term.rlike(RULE_PATTERN)
    parts = F.struct(
        *[F.regexp_extract(term, RULE_PATTERN, i).alias(n) for i, n in enumerate(["model", "db", "tbl", "prop"], 1)]
    )
    return F.when(ok, parts)


# Concept-rule key patterns, one style per source. ``{db}`` and
# ``{table}`` are filled in; the first group is the property (or referenced table),
# the second the referenced id.
CONCEPT_STYLES = {
    "versioned": (r"^{db}-\d\.\d+-{table}-(\w*)$", r"^{db}-\d\.\d+-(\w*)-(\d+)$"),
    "levelled": (r"^{db}-niv\d---{table}-(\w*)--code-$", r"^{db}-(\w*)-(\d+)$"),
}


def decode_concept_property(key: Column, db: Column, table: Column, style: str = "versioned") -> Column:
    """Property name out of a dashed concept-rule key, null on no match."""
    template = CONCEPT_STYLES[style][0]
    pat = F.replace(F.replace(F.lit(template), F.lit("{db}"), db), F.lit("{table}"), F.lower(table))
    return F.when(F.regexp(key, pat), F.element_at(F.regexp_extract_all(key, pat, F.lit(1)), 1))


def decode_concept_subtype(type_id: Column, db: Column, style: str = "versioned") -> Column:
    """``struct(tbl, id)`` out of a subtype key, null on no match."""
    template = CONCEPT_STYLES[style][1]
    pat = F.replace(F.lit(template), F.lit("{db}"), db)
    return F.when(
        F.regexp(type_id, pat),
        F.struct(F.element_at(F.regexp_extract_all(type_id, pat, F.lit(1)), 1).alias("tbl"),
                 F.element_at(F.regexp_extract_all(type_id, pat, F.lit(2)), 1).alias("id")),
    )


# Namespace forms: ``.../linked_data/<db>/`` (data) and ``.../linked_data/schema/<db>/``.
# The source name may hold letters, digits, ``_`` and ``-``; it is never cut.
NS_PATTERN = r"^(.*/linked_data/)(schema/)?([A-Za-z0-9_-]*)/?$"


def source_of(ns: Column) -> Column:
    """``struct(base, is_schema, db)`` of a namespace IRI; null if it does not match."""
    ok = ns.rlike(NS_PATTERN)
    return F.when(
        ok,
        F.struct(
            F.regexp_extract(ns, NS_PATTERN, 1).alias("base"),
            (F.regexp_extract(ns, NS_PATTERN, 2) != "").alias("is_schema"),
            F.regexp_extract(ns, NS_PATTERN, 3).alias("db"),
        ),
    )


def schema_ns_of(ns: Column) -> Column:
    """Data namespace -> schema namespace ``<base>schema/<db>/``."""
    s = source_of(ns)
    return F.when(s["db"] != "", F.concat(s["base"], F.lit("schema/"), s["db"], F.lit("/")))

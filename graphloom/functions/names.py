"""Name rules for classes, relations, attributes and layers.

Each rule is a Column expression so it runs over whole catalogue or rule tables.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_BIG = 1 << 30


def _upper_first(w: Column) -> Column:
    return F.concat(F.upper(F.substring(w, 1, 1)), F.substring(w, 2, _BIG))


def title_case(s: Column) -> Column:
    """Python ``str.title``: upper after any non-letter, lower elsewhere."""
    runs = F.regexp_extract_all(F.lower(s), F.lit(r"(\p{L}+|[^\p{L}]+)"), 1)
    return F.array_join(F.transform(runs, _upper_first), "")


def _plain_class_name(name: Column, strip_table_prefix: Column | bool) -> Column:
    words = F.filter(F.split(name, "_"), lambda w: w != "")
    drop = F.lit(strip_table_prefix) if isinstance(strip_table_prefix, bool) else strip_table_prefix
    words = F.when(drop & F.element_at(words, 1).isin("tbl", "ktbl"), F.slice(words, 2, _BIG)).otherwise(words)
    return F.array_join(F.transform(words, _upper_first), "")


def class_name(table: Column, strip_table_prefix: Column | bool = False) -> Column:
    """L2: class name of a table.

    ``_a_b`` -> ``AB``; with the prefix rule ``tbl_beheer_object`` -> ``BeheerObject``;
    a guess ``?a/b?`` maps each alternative and keeps the marks.
    """
    guess = table.startswith("?") & table.endswith("?") & (F.length(table) >= 2)
    inner = F.when(guess, F.substring(table, F.lit(2), F.length(table) - 2)).otherwise(table)
    alternatives = F.concat(
        F.lit("?"),
        F.array_join(F.transform(F.split(inner, "/"), lambda n: _plain_class_name(n, strip_table_prefix)), "/"),
        F.lit("?"),
    )
    return F.when(guess & inner.contains("/"), alternatives).otherwise(_plain_class_name(inner, strip_table_prefix))


def relation_name(column: Column) -> Column:
    """L3: lower; drop suffix ``_id`` else ``id``; drop one leading ``_``."""
    low = F.lower(column)
    cut = (
        F.when(low.endswith("_id"), F.substring(low, F.lit(1), F.length(low) - 3))
        .when(low.endswith("id"), F.substring(low, F.lit(1), F.length(low) - 2))
        .otherwise(low)
    )
    return F.regexp_replace(cut, "^_", "")


def attribute_name(column: Column) -> Column:
    """L4 (tables): lower case."""
    return F.lower(column)


def layer_attribute_name(field: Column) -> Column:
    """L4 (layers): ``_`` -> ``-`` and lower case."""
    return F.lower(F.replace(field, F.lit("_"), F.lit("-")))


def layer_class_name(layer: Column) -> Column:
    """Drop the first character (geometry letter), then title case."""
    return title_case(F.substring(layer, 2, _BIG))


def concept_class_name(table: Column, source_prefix_len: int = 4) -> Column:
    """Drop a source prefix of ``source_prefix_len`` chars plus ``tbl_``/``ktbl_``, then L2."""
    rest = F.substring(table, source_prefix_len + 1, _BIG)
    rest = F.regexp_replace(rest, "^k?tbl_", "")
    return class_name(rest)


def property_iri(ns: Column | str, cls: Column, prop: Column) -> Column:
    """``ns + class.lower() + '_' + property.lower()``."""
    ns_c = ns if isinstance(ns, Column) else F.lit(ns)
    return F.concat(ns_c, F.lower(cls), F.lit("_"), F.lower(prop))


def xref_property_iri(ns: Column | str, src_cls: Column, tgt_cls: Column, tgt_field: Column) -> Column:
    """L7, cross-reference form: appends ``-`` + L3(target field) unless the field is empty."""
    base = property_iri(ns, src_cls, tgt_cls)
    return F.when(F.coalesce(tgt_field, F.lit("")) == "", base).otherwise(
        F.concat(base, F.lit("-"), relation_name(tgt_field))
    )

"""Row -> triple projections.

A row becomes several triples through one ``inline(array(struct, ...))`` per scan:
no per-column union, no Python per row. Null objects are dropped after the inline (F5).
"""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from graphloom import model as M
from graphloom.functions.hashing import mint_iri
from graphloom.functions.lexical import lexical
from graphloom.mapping import TableMap
from graphloom.session import values

def _null() -> Column:
    return F.lit(None).cast("string")


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


# ---- T17: generic constructors (struct columns of the triples schema) -------------------


def iri_triple(s, p, o) -> Column:
    """Link to an IRI object."""
    return F.struct(_c(s).alias("s"), _c(p).alias("p"), _c(o).alias("o"),
                    F.lit(M.KIND_IRI).alias("o_kind"), _null().alias("o_datatype"), _null().alias("o_lang"))


def typed_triple(s, p, lex, datatype) -> Column:
    """Typed literal object."""
    return F.struct(_c(s).alias("s"), _c(p).alias("p"), _c(lex).alias("o"),
                    F.lit(M.KIND_LITERAL).alias("o_kind"), _c(datatype).alias("o_datatype"), _null().alias("o_lang"))


def lang_triple(s, p, text, lang=M.DEFAULT_LANG) -> Column:
    """Language-tagged literal object."""
    return F.struct(_c(s).alias("s"), _c(p).alias("p"), _c(text).alias("o"),
                    F.lit(M.KIND_LITERAL).alias("o_kind"), _null().alias("o_datatype"), _c(lang).alias("o_lang"))


def type_of(s, cls) -> Column:
    return iri_triple(s, M.RDF_TYPE, cls)


def label_of(s, text, lang=M.DEFAULT_LANG) -> Column:
    return lang_triple(s, M.RDFS_LABEL, text, lang)


def comment_of(s, text, lang=M.DEFAULT_LANG) -> Column:
    return lang_triple(s, M.RDFS_COMMENT, text, lang)


def domain_of(s, cls) -> Column:
    return iri_triple(s, M.RDFS_DOMAIN, cls)


def range_of(s, cls) -> Column:
    return iri_triple(s, M.RDFS_RANGE, cls)


def subclass_of(s, cls) -> Column:
    return iri_triple(s, M.RDFS_SUBCLASSOF, cls)


def subproperty_of(s, prop) -> Column:
    return iri_triple(s, M.RDFS_SUBPROPERTYOF, prop)


def emit(df: DataFrame, structs: list[Column]) -> DataFrame:
    """Project every row to ``len(structs)`` triples; triples with a null s/p/o are dropped."""
    out = df.select(F.inline(F.array(*structs)))
    return out.where(F.col("s").isNotNull() & F.col("p").isNotNull() & F.col("o").isNotNull())


def empty_triples(spark) -> DataFrame:
    return values(spark, [], M.TRIPLE_SCHEMA)


# ---- T1-T6: instances of one mapped table ----------------------------------------------


def key_column(df: DataFrame, tm: TableMap) -> Column:
    """The identifier: a column name, or an SQL expression naming a derived key."""
    if tm.identifier in df.columns:
        return F.col(tm.identifier)
    return F.expr(tm.identifier)


def key_text(df: DataFrame, key: Column, tm: TableMap) -> Column:
    """``str(key)`` of the identifier (text keys are not stripped)."""
    if tm.identifier in df.columns:
        dtype = df.schema[tm.identifier].dataType
        if dtype.simpleString() == "string":
            return key
        return lexical(key, dtype)
    return key.cast("string")


def link_text(col: str, dtype: T.DataType) -> Column:
    """``str(value)`` of a foreign key, by the rule of ``key_text``: text is not stripped, so
    a link target is the very IRI of the row it names."""
    return F.col(col) if dtype.simpleString() == "string" else lexical(F.col(col), dtype)


def rejected_columns(df: DataFrame, tm: TableMap) -> list[tuple[str, str, str]]:
    """(table, column, reason) of every included column that cannot give triples: it is not
    in the table, or its values are nested and have no lexical form."""
    wanted = [a.col for a in tm.included_attrs()] + [r.col for r in tm.included_rels()]
    missing = [(tm.tbl, c, "missing") for c in dict.fromkeys(wanted) if c not in df.columns]
    nested = [(tm.tbl, c, "nested") for c in dict.fromkeys(wanted) if c in df.columns and _nested(df.schema[c].dataType)]
    return missing + nested


def _check(df: DataFrame, tm: TableMap) -> None:
    """A missing column fails the job; a nested one is named in a warning."""
    rejected = rejected_columns(df, tm)
    missing = [c for _, c, why in rejected if why == "missing"]
    if missing:
        raise ValueError(f"mapped columns are not in table {tm.tbl}: {', '.join(missing)}")
    for _, c, _ in rejected:
        warnings.warn(f"column {c} of table {tm.tbl} is nested and gives no triples", stacklevel=3)


def instance_iri(cfg: M.GraphConfig, cls: str | Column, key_txt: Column) -> Column:
    """T1."""
    return mint_iri(cfg.data_ns, cls, key_txt)


def attr_predicate(cfg: M.GraphConfig, classname: str, prop: str) -> str:
    """L7 for instance attributes and relations (both names lower-cased, Q5)."""
    return f"{cfg.schema_ns}{classname.lower()}_{prop.lower()}"


def inverse_predicate(cfg: M.GraphConfig, target_class: str, classname: str) -> str:
    return f"{cfg.schema_ns}{target_class.lower()}_inv_{classname.lower()}"


def _nested(dtype) -> bool:
    return isinstance(dtype, (T.ArrayType, T.MapType, T.StructType))


def instance_structs(df: DataFrame, tm: TableMap, cfg: M.GraphConfig,
                     attributes: bool = True, relations: bool = True,
                     header: bool = True) -> tuple[DataFrame, list[Column]]:
    """T2-T6 for the rows of ``tm``'s table: returns the frame with the key text, subject
    IRI and link-target IRIs bound as columns (each hashed once per row, not once per
    triple) and the struct list that references them."""
    key = key_column(df, tm)
    df = df.withColumn("_k", key_text(df, key, tm))
    df = df.withColumn("_s", instance_iri(cfg, tm.classname, F.col("_k")))
    s, ktxt = F.col("_s"), F.col("_k")
    cls_iri = cfg.schema_ns + tm.classname
    structs = []
    if header:
        structs += [
            type_of(s, cls_iri),                                                                   # T2
            label_of(s, F.concat(F.lit(tm.classname + " "), ktxt), cfg.label_lang),               # T3
        ]
    if attributes:
        for a in tm.included_attrs():                                                          # T4
            if _nested(df.schema[a.col].dataType):
                continue  # no lexical form: see ``rejected_columns``
            lex = lexical(F.col(a.col), df.schema[a.col].dataType)
            structs.append(typed_triple(s, attr_predicate(cfg, tm.classname, a.property), lex, a.datatype))
    if relations:
        for i, r in enumerate(tm.included_rels()):                                             # T5, T6
            df = df.withColumn(f"_t{i}", instance_iri(cfg, r.target_class, link_text(r.col, df.schema[r.col].dataType)))
            tgt = F.col(f"_t{i}")
            structs.append(iri_triple(s, attr_predicate(cfg, tm.classname, r.property), tgt))
            structs.append(iri_triple(tgt, inverse_predicate(cfg, r.target_class, tm.classname), s))
    return df, structs


def needed_columns(df: DataFrame, tm: TableMap, attributes: bool = True, relations: bool = True) -> list[str]:
    """Column pruning list (F11): identifier inputs, included attributes and relations."""
    cols = []
    if tm.identifier in df.columns:
        cols.append(tm.identifier)
    else:
        cols += list(df.columns)  # derived key: the expression decides which inputs it reads
    if attributes:
        cols += [a.col for a in tm.included_attrs() if a.col in df.columns]
    if relations:
        cols += [r.col for r in tm.included_rels() if r.col in df.columns]
    return list(dict.fromkeys(cols))


def instance_triples(df: DataFrame, tm: TableMap, cfg: M.GraphConfig,
                     attributes: bool = True, relations: bool = True, header: bool = True) -> DataFrame:
    """T1-T6 over every row of ``df`` whose identifier is not null."""
    if tm.identifier is None:
        return empty_triples(df.sparkSession)
    _check(df, tm)
    df = df.select(*needed_columns(df, tm, attributes, relations))
    df = df.where(key_column(df, tm).isNotNull())
    df, structs = instance_structs(df, tm, cfg, attributes, relations, header)
    return emit(df, structs)

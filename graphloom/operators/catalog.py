"""Catalogue joins and aggregates.

Every function takes catalogue DataFrames for any number of tables at once: a reference
query that takes one table name becomes one join over all tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from graphloom import model as M
from graphloom.functions.names import class_name


def filter_tables(tables: DataFrame, allow_prefixes=None, deny_prefixes=None) -> DataFrame:
    """base tables only, then an allow-list or deny-list of name prefixes."""
    out = tables.where(F.col("table_type") == "BASE TABLE")
    if allow_prefixes:
        cond = F.lit(False)
        for p in allow_prefixes:
            cond = cond | F.col("table_name").startswith(p)
        out = out.where(cond)
    if deny_prefixes:
        for p in deny_prefixes:
            out = out.where(~F.col("table_name").startswith(p))
    return out


def filter_layers(layers: DataFrame, pattern: str = "[a-z][A-Z][a-z]*", name_col: str = "layer") -> DataFrame:
    """the layer name must fully match ``pattern``."""
    return layers.where(F.col(name_col).rlike(f"^(?:{pattern})$"))


def drop_technical(columns: DataFrame, names=("TimeStamp",)) -> DataFrame:
    """drop named technical columns."""
    return columns.where(~F.col("column_name").isin(list(names)))


def table_info(columns: DataFrame, types: DataFrame | None = None) -> DataFrame:
    """(table_name, column_name, data_type); with a type table, a two-key join on
    (system type id, user type id) names the type."""
    if types is None:
        return columns.select("table_name", "column_name", "data_type")
    return columns.join(types, ["system_type_id", "user_type_id"]).select(
        "table_name", "column_name", F.col("type_name").alias("data_type")
    )


def foreign_keys(fk: DataFrame) -> DataFrame:
    """(table_name, column_name, referenced_table, referenced_column)."""
    return fk.select(
        "table_name", "column_name", F.col("ref_table").alias("referenced_table"),
        F.col("ref_column").alias("referenced_column"),
    )


def inverse_foreign_keys(fk: DataFrame) -> DataFrame:
    """Who references each table: (parent_table, parent_column, foreign_table, foreign_column, key_name)."""
    return fk.select(
        F.col("ref_table").alias("parent_table"),
        F.col("ref_column").alias("parent_column"),
        F.col("table_name").alias("foreign_table"),
        F.col("column_name").alias("foreign_column"),
        F.concat_ws("_", F.lit("FK"), "table_name", "column_name").alias("key_name"),
    )


# ---- the same over raw system tables, with their own keys ---------------------------------
#
# tables (object_id, name), columns (object_id, column_id, name, system_type_id, user_type_id),
# types (system_type_id, user_type_id, name), constraints (object_id, name), key_columns
# (constraint_id, position, parent_id, parent_column_id, referenced_id, referenced_column_id).
# Two tables of one name (in two schemas) stay two, since all joins go by id.


def _columns_by_id(tables: DataFrame, columns: DataFrame, side: str) -> DataFrame:
    """(``side``_id, ``side``_column_id, ``side``_table, ``side``_column)."""
    named = tables.select(F.col("object_id").alias(f"{side}_id"), F.col("name").alias(f"{side}_table"))
    own = columns.select(F.col("object_id").alias(f"{side}_id"), F.col("column_id").alias(f"{side}_column_id"), F.col("name").alias(f"{side}_column"))
    return own.join(named, f"{side}_id")


def described_columns(tables: DataFrame, columns: DataFrame, types: DataFrame) -> DataFrame:
    """(object_id, table_name, column_name, data_type); a type is found by both of its ids, so
    an alias type is told from its base type. Columns without a known type are left out."""
    names = types.select("system_type_id", "user_type_id", F.col("name").alias("data_type"))
    own = columns.select("object_id", "system_type_id", "user_type_id", F.col("name").alias("column_name"))
    found = own.join(names, ["system_type_id", "user_type_id"]).join(tables.select("object_id", F.col("name").alias("table_name")), "object_id")
    return found.select("object_id", "table_name", "column_name", "data_type")


def key_links(tables: DataFrame, columns: DataFrame, key_columns: DataFrame) -> DataFrame:
    """(constraint_id, position, table_name, column_name, referenced_table, referenced_column):
    every column pair of every foreign key, those of composite keys in order."""
    parent, referenced = _columns_by_id(tables, columns, "parent"), _columns_by_id(tables, columns, "referenced")
    found = key_columns.join(parent, ["parent_id", "parent_column_id"]).join(referenced, ["referenced_id", "referenced_column_id"])
    return found.select("constraint_id", "position", F.col("parent_table").alias("table_name"), F.col("parent_column").alias("column_name"),
                        "referenced_table", "referenced_column")


def inverse_key_links(tables: DataFrame, columns: DataFrame, constraints: DataFrame, key_columns: DataFrame) -> DataFrame:
    """(key_name, foreign_table, foreign_column, parent_table, parent_column): who references
    each table, under the constraint's own name. A composite key is shown by its first pair."""
    first = key_links(tables, columns, key_columns.where(F.col("position") == 1))
    names = constraints.select(F.col("object_id").alias("constraint_id"), F.col("name").alias("key_name"))
    return first.join(names, "constraint_id").select(
        "key_name", F.col("table_name").alias("foreign_table"), F.col("column_name").alias("foreign_column"),
        F.col("referenced_table").alias("parent_table"), F.col("referenced_column").alias("parent_column"))


def foreign_keys_of(tables: DataFrame, columns: DataFrame, key_columns: DataFrame) -> DataFrame:
    """The key export that the mapping inference reads, from the raw tables."""
    links = key_links(tables, columns, key_columns)
    return links.select("table_name", "column_name", F.col("referenced_table").alias("ref_table"), F.col("referenced_column").alias("ref_column"),
                        F.row_number().over(Window.orderBy("constraint_id", "position")).alias("pos"))  # catalogue-sized


def identifier_of(columns: DataFrame, pk: DataFrame, id_column: str = "id") -> DataFrame:
    """A3: single-column primary key, else a column named ``id``, else null (composite -> none).

    ``unique_key`` is true only for a declared single-column primary key: the database
    guarantees one row per key, so triples of different rows cannot coincide.
    """
    single = pk.groupBy("table_name").agg(
        F.count(F.lit(1)).alias("n_keys"), F.min("column_name").alias("pk_col")
    )
    has_id = (
        columns.where(F.col("column_name") == id_column)
        .select("table_name", F.lit(id_column).alias("id_col"))
        .distinct()
    )
    tables = columns.select("table_name").distinct()
    return (
        tables.join(single, "table_name", "left")
        .join(has_id, "table_name", "left")
        .select(
            "table_name",
            F.coalesce(F.when(F.col("n_keys") == 1, F.col("pk_col")), F.col("id_col")).alias("identifier"),
            F.coalesce(F.col("n_keys") == 1, F.lit(False)).alias("unique_key"),
        )
    )


def list_columns(columns: DataFrame, pk: DataFrame, fk: DataFrame, keys: bool = True,
                 drop_primary: bool = False) -> DataFrame:
    """Columns of each table; with ``keys=False`` foreign-key columns are removed.

    The primary key stays unless ``drop_primary`` (the key is also an attribute, Q3).
    """
    if keys:
        return columns
    out = columns.join(fk.select("table_name", "column_name"), ["table_name", "column_name"], "left_anti")
    if drop_primary:
        single = pk.groupBy("table_name").agg(F.count(F.lit(1)).alias("n"), F.min("column_name").alias("column_name"))
        out = out.join(single.where("n = 1").select("table_name", "column_name"), ["table_name", "column_name"],
                       "left_anti")
    return out


def as_xsd(columns: DataFrame, datatypes: DataFrame, type_col: str = "data_type") -> DataFrame:
    """Source type -> XSD IRI by left join, default ``xsd:anyType``.

    A source type listed under several XSD types takes the smallest IRI (deterministic).
    """
    lookup = datatypes.groupBy("source_type").agg(F.min("xsd").alias("xsd"))
    return columns.join(lookup, columns[type_col] == lookup["source_type"], "left").select(
        *[columns[c] for c in columns.columns], F.coalesce(lookup["xsd"], F.lit(M.XSD_ANYTYPE)).alias("datatype")
    )


def guess_table(relations: DataFrame, table_names: list[str], threshold: float = 2.5,
                strip_table_prefix: bool = False) -> DataFrame:
    """A4 + J15: guess the target table of each relation name by edit distance.

    ``table_names`` is the catalogue's table list in listing order (metadata, one entry per
    table); it is held as a literal array, so each relation row scores itself against every
    candidate with array functions: no join and no shuffle. Candidates are lower-cased
    class names. The minimum distance wins; several at the minimum -> ``?a/b?`` (unsure,
    in table order); ``(mean - min) / pstdev < threshold`` -> ``?a?`` (unsure); zero spread
    -> unsure (Q14). Output: (rel, target_table, unsure, z).
    """
    names = F.array(*[F.lit(n) for n in table_names])
    cands = F.transform(names, lambda n: F.struct(
        n.alias("table_name"), F.lower(class_name(n, strip_table_prefix)).alias("cn")))
    scored = relations.select("rel").distinct().select(
        "rel", F.transform(cands, lambda c: F.struct(c["table_name"].alias("table_name"),
                                                     F.levenshtein(F.col("rel"), c["cn"]).alias("d"))).alias("ds"))
    d = F.transform(F.col("ds"), lambda x: x["d"].cast("double"))
    n = F.size(F.col("ds")).cast("double")
    dmin = F.array_min(d)
    mean = F.aggregate(d, F.lit(0.0), lambda acc, x: acc + x) / n
    var = F.aggregate(d, F.lit(0.0), lambda acc, x: acc + (x - mean) * (x - mean)) / n
    sd = F.sqrt(var)
    best = F.transform(F.filter(F.col("ds"), lambda x: x["d"].cast("double") == dmin), lambda x: x["table_name"])
    stats = scored.select("rel", best.alias("best"), dmin.alias("dmin"), mean.alias("dmean"), sd.alias("dsd"))
    tie = F.size(F.col("best")) > 1
    z = F.when(F.col("dsd") > 0, (F.col("dmean") - F.col("dmin")) / F.col("dsd"))
    unsure_z = z.isNull() | (z < threshold)
    first = F.element_at(F.col("best"), 1)
    target = (
        F.when(tie, F.concat(F.lit("?"), F.array_join(F.col("best"), "/"), F.lit("?")))
        .when(unsure_z, F.concat(F.lit("?"), first, F.lit("?")))
        .otherwise(first)
    )
    return stats.select("rel", target.alias("target_table"), (tie | unsure_z).alias("unsure"), z.alias("z"))


def database_pairs(rules: DataFrame) -> DataFrame:
    """A5: distinct (source db, target db) with a non-empty target db; rules carry decoded terms."""
    return (
        rules.where(F.col("tgt").isNotNull() & (F.col("tgt.db") != ""))
        .select(F.col("db").alias("src_db"), F.col("tgt.db").alias("tgt_db"))
        .distinct()
    )


def is_guess(c: Column) -> Column:
    return c.startswith("?") & c.endswith("?")

"""Graph patterns over triples frames (J4-J9) and the concept dictionary.

Patterns are equi-joins on subject or object columns after a predicate filter, so a
graph stored partitioned by predicate reads only the predicates a pattern names. Rule
tables are inline relations, which Spark broadcasts by their known size; data sides shuffle on the join key (AQE splits
skewed keys).
"""

from __future__ import annotations

from math import prod

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphloom import model as M
from graphloom.operators.filters import non_empty
from graphloom.session import values


def subjects_of(graph: DataFrame, cls) -> DataFrame:
    """Subjects typed ``cls`` (one column ``s``), distinct."""
    c = cls if isinstance(cls, Column) else F.lit(cls)
    return graph.where((F.col("p") == M.RDF_TYPE) & (F.col("o") == c)).select("s").distinct()


def codes_of(graph: DataFrame, cls: str, attr: str) -> DataFrame:
    """Distinct attribute values (``code``) of the subjects of a class that have it."""
    typed = subjects_of(graph, cls)
    vals = graph.where(F.col("p") == attr).select("s", F.col("o").alias("code"))
    return vals.join(typed, "s", "left_semi").select("code").distinct()


HUB = 100_000  # values of one property from which a subject's values are spread
_BUCKETS = 256  # hash buckets of subjects that are counted for each property


def hubs(graph: DataFrame, props: list[str], least: int = HUB) -> list[tuple[str, str, int]]:
    """(property, subject, number of values) of the subjects that have very many: ``least``, or a
    thousandth of all values if that is more, so there are a thousand at most.

    Subjects are first counted by hash bucket; only subjects of heavy buckets, which are few, are
    counted one by one.
    """
    own = graph.where(F.col("p").isin(sorted(set(props)))).select("p", "s", F.pmod(F.xxhash64("s"), F.lit(_BUCKETS)).alias("b"))
    counts = own.groupBy("p", "b").agg(F.count(F.lit(1)).alias("n")).collect()  # _BUCKETS rows a property at most
    least = max(least, sum(r.n for r in counts) // 1000)
    heavy = [(r.p, r.b) for r in counts if r.n >= least]
    if not heavy:
        return []
    some = own.join(values(graph.sparkSession, heavy, "p string, b bigint"), ["p", "b"], "left_semi")
    return [tuple(r) for r in some.groupBy("p", "s").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least).collect()]


def _grid(rules: list[tuple[int, str, list[str]]], found: list[tuple[str, str, int]], least: int) -> list[tuple]:
    """(rule_id, var, s, slices, stride, cells) for every variable of a rule and hub subject: the
    values of a variable are cut into slices, and a cell has one slice of each variable."""
    of = {(p, s): n for p, s, n in found}
    out = []
    for rule_id, _, props in rules:
        for s in sorted({s for p, s in of if p in props}):
            cuts = [max(1, -(-of.get((p, s), 0) // least)) for p in props]
            strides = [prod(cuts[:var]) for var in range(len(cuts))]
            whole = [(-1, 1, 1)]  # the type is in every cell
            out += [(rule_id, var, s, slices, stride, prod(cuts)) for var, slices, stride in [*zip(range(len(cuts)), cuts, strides, strict=True), *whole]]
    return out


def stars(graph: DataFrame, rules: list[tuple[int, str, list[str]]], least: int = HUB) -> DataFrame:
    """J5 + A2 for all rules (rule_id, class, properties) at once: (rule_id, s, v0, v1, ...), one row
    for every combination of values of a subject of the class that has all the properties.

    One scan and one shuffle whatever the number of rules: triples meet the rules by predicate,
    type triples as one more variable; each subject's values are gathered as sets by variable
    and multiplied. The values of a hub subject are cut into slices of about ``least``, every
    combination of slices is gathered by itself, so no task holds more of them than that.
    """
    spark = graph.sparkSession
    width = max((len(props) for _, _, props in rules), default=0)
    wanted = [(i, var, p, None) for i, _, props in rules for var, p in enumerate(props)] + [(i, -1, M.RDF_TYPE, cls) for i, cls, _ in rules]
    wide = [(i, len(props)) for i, _, props in rules]
    named = values(spark, wanted, "rule_id int, var int, p string, cls string")
    grid = _grid(rules, hubs(graph, [p for _, _, props in rules for p in props], least), least)
    met = graph.where(F.col("p").isin(sorted({w[2] for w in wanted}))).select(F.col("p").alias("_p"), "s", "o").join(named, F.col("_p") == F.col("p"))
    met = met.where(F.col("cls").isNull() | (F.col("cls") == F.col("o"))).select("rule_id", "var", "s", "o")
    cell = F.lit(0)
    if grid:
        cells = values(spark, grid, "_r int, _v int, _s string, slices int, stride int, cells int")
        met = met.join(cells, (F.col("rule_id") == F.col("_r")) & (F.col("var") == F.col("_v")) & (F.col("s") == F.col("_s")), "left")
        mine = lambda c: F.floor(c / F.col("stride")) % F.col("slices") == F.pmod(F.xxhash64("o"), F.col("slices"))
        cell = F.explode(F.coalesce(F.filter(F.sequence(F.lit(0), F.col("cells") - 1), mine), F.array(F.lit(0))))
    sets = met.select("rule_id", "s", "var", "o", cell.alias("cell")).groupBy("rule_id", "s", "cell").agg(F.collect_set(F.struct("var", "o")).alias("held"))
    of = lambda var: F.transform(F.filter("held", lambda x: x["var"] == var), lambda x: x["o"])
    out = sets.join(values(spark, wide, "_r int, n_vars int"), F.col("rule_id") == F.col("_r")).where(F.exists("held", lambda x: x["var"] == -1))
    out = out.select("rule_id", "s", "n_vars", *[of(i).alias(f"a{i}") for i in range(width)])
    for i in range(width):
        out = out.where((F.col("n_vars") <= i) | (F.size(f"a{i}") > 0))
    for i in range(width):
        one = F.when(F.col("n_vars") > i, F.col(f"a{i}")).otherwise(F.array(F.lit(None).cast("string")))
        out = out.select("rule_id", "s", "n_vars", *[f"a{j}" for j in range(i + 1, width)], *[f"v{j}" for j in range(i)], F.explode(one).alias(f"v{i}"))
    return out.select("rule_id", "s", *[f"v{i}" for i in range(width)])


def star(graph: DataFrame, cls: str, props: list[tuple[str, str]], least: int = HUB) -> DataFrame:
    """J5 + A2: subjects of ``cls`` having all of ``props`` [(var, predicate)].

    One row per combination of values (multi-valued properties multiply), distinct;
    columns ``s`` and one string column per variable (the lexical value). A variable may be
    called anything; one that repeats ``s`` or an earlier variable (in any case) gets ``_2``,
    ``_3``, ... appended.
    """
    names = ["s"]
    for var, _ in props:
        taken, name, n = {x.lower() for x in names}, var, 1
        while name.lower() in taken:
            n += 1
            name = f"{var}_{n}"
        names.append(name)
    return stars(graph, [(0, cls, [p for _, p in props])], least).drop("rule_id").toDF(*names)


def pairs(graph: DataFrame, cls: str, prop: str) -> DataFrame:
    """Distinct (s, value term) of a class and one property; value kept as o/o_datatype/o_lang."""
    typed = subjects_of(graph, cls)
    vals = graph.where(F.col("p") == prop).select("s", "o", "o_kind", "o_datatype", "o_lang")
    return vals.join(typed, "s", "left_semi").distinct()


def link(src_graph: DataFrame, tgt_graph: DataFrame, rules: DataFrame) -> DataFrame:
    """For every rule (src_class, src_prop, tgt_prop, rel IRIs), link each source subject
    to every target subject whose ``tgt_prop`` object equals the source's ``src_prop`` object
    (same lexical form, datatype and language). Empty values are skipped (F15).
    All rules run as one join. Type triples are first cut to
    the rule classes; the relation's IRI joins the links at the end, so it is not shuffled with
    every value. The caller's set operation (X1) removes repeated links.
    """
    r = rules.select("rule_id", "src_class", "src_prop", "tgt_prop")
    src_vals = src_graph.where(non_empty(F.col("o"))).join(r, src_graph["p"] == r["src_prop"]).select(
        "rule_id", "src_class", "s", "o", "o_kind", "o_datatype", "o_lang"
    )
    classes = rules.select(F.col("src_class").alias("_c")).distinct()
    typed = src_graph.where(F.col("p") == M.RDF_TYPE).join(classes, F.col("o") == F.col("_c"), "left_semi").select(
        "s", F.col("o").alias("src_class"))
    src = src_vals.join(typed, ["s", "src_class"], "left_semi")
    tgt = tgt_graph.join(r.select("rule_id", "tgt_prop"), tgt_graph["p"] == F.col("tgt_prop")).select(
        "rule_id", F.col("s").alias("t"), "o", "o_kind", "o_datatype", "o_lang"
    )
    cond = (
        (src["rule_id"] == tgt["rule_id"]) & (src["o"] == tgt["o"]) & (src["o_kind"] == tgt["o_kind"])
        & src["o_datatype"].eqNullSafe(tgt["o_datatype"]) & src["o_lang"].eqNullSafe(tgt["o_lang"])
    )
    rels = rules.select(F.col("rule_id").alias("_r"), "rel")
    return src.join(tgt, cond).select(src["rule_id"], src["s"], tgt["t"]).join(rels, F.col("rule_id") == F.col("_r")).select(
        F.col("s"), F.col("rel").alias("p"), F.col("t").alias("o"),
        F.lit(M.KIND_IRI).alias("o_kind"), F.lit(None).cast("string").alias("o_datatype"),
        F.lit(None).cast("string").alias("o_lang"),
    )


def chain(graph: DataFrame, rules: DataFrame) -> DataFrame:
    """Instance -rel-> target -id-> value, for every rule (src_class, src_prop, ref_prop)
    at once; distinct (rule_key, s, value)."""
    r = rules.select("rule_key", "src_class", "src_prop", "ref_prop")
    classes = rules.select(F.col("src_class").alias("_c")).distinct()
    typed = graph.where(F.col("p") == M.RDF_TYPE).join(classes, F.col("o") == F.col("_c"), "left_semi").select(
        "s", F.col("o").alias("src_class"))
    hop1 = graph.join(r, graph["p"] == r["src_prop"]).select("rule_key", "src_class", "ref_prop", "s",
                                                              F.col("o").alias("target"))
    hop1 = hop1.join(typed, ["s", "src_class"], "left_semi")
    ref_props = r.select(F.col("ref_prop").alias("_rp")).distinct()
    ids = graph.join(ref_props, graph["p"] == F.col("_rp")).select(
        F.col("s").alias("target"), F.col("p").alias("ref_prop"), F.col("o").alias("value"))
    return hop1.join(ids, ["target", "ref_prop"]).select("rule_key", "s", "value").distinct()


def concept_map(rules: DataFrame) -> DataFrame:
    """Rows (rule_key, tbl, rule_pos, concept, relation, subtypes array<struct<pos, tbl, id>>)
    -> per (rule_key, id) the concept of the last rule (then last subtype); per rule_key the
    referenced table of its last subtype. Empty ids and undecodable subtypes are skipped;
    rules without subtypes are ignored (Q19). Output (rule_key, ref_table, id, concept)."""
    exploded = rules.where(F.size("subtypes") > 0).select(
        "rule_key", "rule_pos", "concept", F.explode("subtypes").alias("st")
    ).select("rule_key", "rule_pos", "concept", F.col("st.pos").alias("st_pos"), F.col("st.tbl").alias("ref_table"),
             F.col("st.id").alias("id")).where(F.col("ref_table").isNotNull())  # undecodable subtypes skipped
    order = F.struct("rule_pos", "st_pos")
    last_tbl = exploded.groupBy("rule_key").agg(F.max_by("ref_table", order).alias("ref_table"))
    by_id = exploded.where(non_empty(F.col("id"))).groupBy("rule_key", "id").agg(
        F.max_by("concept", order).alias("concept")
    )
    return by_id.join(last_tbl, "rule_key").select("rule_key", "ref_table", "id", "concept")


def align(chained: DataFrame, cmap: DataFrame, ns: str) -> DataFrame:
    """(rule_key, id) -> concept lookup in the dictionary; emit ``rdf:type``. Ids that
    are whole numbers are compared as numbers (``02`` is 2)."""
    number = lambda c: F.regexp_replace(F.trim(c), r"^0+(?=[0-9]+$)", "")
    hit = chained.join(cmap.select("rule_key", "id", "concept"),
                       (chained["rule_key"] == cmap["rule_key"]) & (number(chained["value"]) == number(cmap["id"])))
    return hit.select(
        chained["s"].alias("s"), F.lit(M.RDF_TYPE).alias("p"), F.concat(F.lit(ns), F.col("concept")).alias("o"),
        F.lit(M.KIND_IRI).alias("o_kind"), F.lit(None).cast("string").alias("o_datatype"),
        F.lit(None).cast("string").alias("o_lang"),
    ).distinct()

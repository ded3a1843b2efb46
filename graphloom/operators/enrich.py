"""Enrichment branches (T13) and template filling.

A rule's target is a nested template ``{head, property, type, tail}`` whose depth is known
from the configuration, so the branch is unrolled at plan time into one ``inline`` per
binding row: level k's node IRI is ``ns + 'r' + sha1(node_{k-1} + head_k)``.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphloom.functions.hashing import node_hash
from graphloom.operators.triples import emit, iri_triple, type_of, typed_triple

VAR = re.compile(r"\[\w*\]")

# Datatype fragments whose template is filled as text.
TEXT_FRAGMENTS = ("ID", "string", "time", "wktLiteral")


def fill_template(template: str, datatype: str, values: dict[str, Column]) -> Column:
    """Replace each ``[var]`` by its value; for a non-text datatype the raw value of the
    first variable (Q17). A datatype without ``#`` counts as text. ``values`` maps the
    variable text (``[x]``) to a string column; a missing variable makes the result null."""
    found = VAR.findall(template)
    frag = datatype.rsplit("#", 1)[1] if "#" in datatype else "string"
    if not found:
        return F.lit(template)
    if frag not in TEXT_FRAGMENTS:
        return values.get(found[0], F.lit(None).cast("string"))
    parts: list[Column] = []
    pos = 0
    for m in VAR.finditer(template):
        if m.start() > pos:
            parts.append(F.lit(template[pos:m.start()]))
        parts.append(values.get(m.group(0), F.lit(None).cast("string")))
        pos = m.end()
    if pos < len(template):
        parts.append(F.lit(template[pos:]))
    return F.concat(*parts)


def branch_structs(parent: Column, target: dict, ns: str, values: dict[str, Column]
                   ) -> tuple[list[tuple[str, Column]], list[Column]]:
    """The (type, link) triples of every level of a nested template under ``parent``.

    Returns the node IRIs to bind as columns (level k hashes level k-1's column, so each
    node is hashed once per row) and the structs that reference them."""
    binds: list[tuple[str, Column]] = []
    structs: list[Column] = []
    level = target
    while True:
        head, prop = level["head"], level["property"]
        tail = level["tail"]
        if isinstance(tail, str) and level.get("type") != "URIRef":
            lex = fill_template(tail, head, values)
            structs.append(typed_triple(parent, prop, lex, head))
            return binds, structs
        name = f"_n{len(binds)}"
        binds.append((name, F.concat(F.lit(ns), node_hash(parent, F.lit(head)))))
        node = F.col(name)
        structs.append(type_of(node, head))
        structs.append(iri_triple(parent, prop, node))
        if isinstance(tail, str):  # class-node leaf: its tail text is ignored (Q29)
            return binds, structs
        parent, level = node, tail


def enrich(bindings: DataFrame, target: dict, ns: str, variables: list[str]) -> DataFrame:
    """T13 over a bindings frame (s, <var>...): every row yields its whole branch."""
    values = {f"[{v}]": F.col(v) for v in variables}
    binds, structs = branch_structs(F.col("s"), target, ns, values)
    for name, expr in binds:
        bindings = bindings.withColumn(name, expr)
    return emit(bindings, structs)


def enrich_all(bindings: DataFrame, targets: dict[int, tuple[dict, dict[str, Column]]], ns: str) -> DataFrame:
    """T13 over the bindings (rule_id, s, v0, ...) of many rules: each row yields the branch of its
    own rule. ``targets``: rule_id -> (template, its variables as columns)."""
    rule = F.col("rule_id")
    by_rule = {i: branch_structs(F.col("s"), target, ns, own) for i, (target, own) in sorted(targets.items())}
    for level in range(max(len(binds) for binds, _ in by_rule.values())):
        nodes = [F.when(rule == i, binds[level][1]) for i, (binds, _) in by_rule.items() if len(binds) > level]
        bindings = bindings.withColumn(f"_n{level}", F.coalesce(*nodes))
    branches = F.coalesce(*[F.when(rule == i, F.array(*structs)) for i, (_, structs) in by_rule.items()])
    out = bindings.select(F.inline(branches))
    return out.where(F.col("s").isNotNull() & F.col("p").isNotNull() & F.col("o").isNotNull())

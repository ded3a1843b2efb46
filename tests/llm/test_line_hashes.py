"""Lines whose 64-bit hash another line shares are known by a second hash, the same in both places."""

from pyspark.sql import functions as F

from graphloom.llm.lines import _node, line_classes, line_hash


def test_second_hash_keeps_links(docs_of):
    one, two, three = "a first line of text here", "a first lime of text here", "something else altogether, unlike"
    clash = frozenset({_node(one, frozenset())})
    docs = docs_of([(1, one), (2, f"{two}\n{three}")])
    lines = docs.select(F.explode(F.split("text", "\n")).alias("line"))
    by_spark = {r["line"]: r["h"] for r in lines.select("line", line_hash(F.col("line"), clash).alias("h")).collect()}
    assert by_spark == {x: _node(x, clash) for x in (one, two, three)} and by_spark[one] not in clash
    found = line_classes(docs, clash).collect()
    assert {r["node"] for r in found} == {by_spark[one], by_spark[two]} and len({r["component"] for r in found}) == 1

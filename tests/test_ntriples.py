"""The N-Triples and N-Quads grammar (S7): terms, escapes, blanks, comments, rejects; files."""

import pytest
from pyspark.sql import functions as F

from graphloom import model as M
from graphloom.sources import ntriples as NT

GOOD = [
    # blanks and comments
    ("<http://a>\t<http://p>\t<http://o>\t.", ("http://a", "http://p", "http://o", "iri", None, None)),
    ("<http://a><http://p><http://o>.", ("http://a", "http://p", "http://o", "iri", None, None)),
    ("  <http://a> <http://p> _:b.c . # a note . with <x> \"y\"", ("http://a", "http://p", "_:b.c", "bnode", None, None)),
    ("_:a<http://p>_:b.", ("_:a", "http://p", "_:b", "bnode", None, None)),
    ('_:é1 <http://p> "x"@en-GB.#', ("_:é1", "http://p", "x", "literal", None, "en-GB")),
    ('<http://a> <http://p> "x" .', ("http://a", "http://p", "x", "literal", None, None)),
    ('<http://a> <http://p> "" .', ("http://a", "http://p", "", "literal", None, None)),
    ('<http://a> <http://p> "1"^^<http://t#x> .', ("http://a", "http://p", "1", "literal", "http://t#x", None)),
    # text that looks like the end of a line, quotes, tags
    (r'<http://a> <http://p> "say \"x\" . <y>"@nl .', ("http://a", "http://p", 'say "x" . <y>', "literal", None, "nl")),
    (r'<http://a> <http://p> "a # b" . # "c" .', ("http://a", "http://p", "a # b", "literal", None, None)),
    # escapes
    (r'<http://a> <http://p> "\t\b\n\r\f\"\'\\" .', ("http://a", "http://p", "\t\b\n\r\f\"'\\", "literal", None, None)),
    (r'<http://a> <http://p> "\\n\\\\u0041\\" .', ("http://a", "http://p", "\\n\\\\u0041\\", "literal", None, None)),
    (r'<http://a> <http://p> "v\u00e9\U0001F600\uFEFF\U0000FEFFz" .', ("http://a", "http://p", "vé\U0001F600\uFEFF\uFEFFz", "literal", None, None)),
    (r'<http://a> <http://p> "\uD83D\uDE00!" .', ("http://a", "http://p", "\U0001F600!", "literal", None, None)),
    (r'<http://a> <http://p> "a\u0000b" .', ("http://a", "http://p", "a\x00b", "literal", None, None)),
    (r'<http://a\u0020b> <http://\U0001F600> <http://o/\u00e9> .', ("http://a b", "http://\U0001F600", "http://o/é", "iri", None, None)),
    (r'<http://a> <http://p> "x"^^<http://t/\u0020> .', ("http://a", "http://p", "x", "literal", "http://t/ ", None)),
    ("<> <p> <> .", ("", "p", "", "iri", None, None)),
]
BAD = [
    '<http://a> <http://p> "un\\qk" .', '<http://a> <http://p> "x"^^<http://t x> .', "<http://a b> <http://p> <http://o> .",
    r'<http://a> <http://p> "\uD83D" .', r'<http://a> <http://p> "\uDE00\uD83D" .', r'<http://a> <http://p> "\U0000D83D" .', r'<http://a> <http://p> "\U00110000" .',
    r'<http://a> <http://p> "\u00e" .', '<http://a> <http://p> "a"b" .', '<http://a> <http://p> "a', '<http://a> <http://p> "a"', "<http://a> <http://p> .",
    '"x" <http://p> <http://o> .', "<http://a> _:p <http://o> .", "<http://a> <http://p> <http://o> . <http://b>", '<http://a> <http://p> "x"@ .', '<http://a> <http://p> "x"@e_n .',
    "<http://a> <http://p> <http://o> <http://g> .", "_: <http://p> <http://o> .", "_:-a <http://p> <http://o> .", r"<http://a\n> <http://p> <http://o> .",
    '<http://a> <http://p> "a\nb" .', "\n1\n2\n3\n4\n5\n6\n7", "<http://a> <http://p> <http://o> ..",
]


def _lines(spark, texts):
    return spark.createDataFrame([(t,) for t in texts], "value string").coalesce(1)


def test_valid_lines(spark):
    triples, rejects = NT.parse_lines(_lines(spark, [line for line, _ in GOOD] + ["", "  ", "# note", "\t# note"]))
    assert rejects.collect() == []
    got = [tuple(r) for r in triples.collect()]
    assert got == [want for _, want in GOOD]


def test_lines_outside_the_grammar_are_rejected_or_fail(spark):
    triples, rejects = NT.parse_lines(_lines(spark, BAD))
    assert triples.collect() == [] and [r["line"] for r in rejects.collect()] == BAD
    for line in BAD[:4]:
        with pytest.raises(Exception, match="line is not in the format"):
            NT.parse_lines(_lines(spark, [line]), fail=True)[0].collect()


def test_quads(spark):
    lines = ['<http://a> <http://p> "x"@en <http://g> .', "<http://a><http://p>_:b_:g.", "<http://a> <http://p> <http://o> .", '<http://a> <http://p> "x" "g" .']
    triples, rejects = NT.parse_lines(_lines(spark, lines), with_graph=True)
    assert [(r.o, r.g) for r in triples.collect()] == [("x", "http://g"), ("_:b_:g", None), ("http://o", None)]
    assert [r["line"] for r in rejects.collect()] == lines[3:]


def test_very_long_literals_and_many_escapes(spark):
    text = ("y" * 99 + '\\"\u00e9\n') * 20_000
    g = spark.createDataFrame([("http://a", "http://p", text, "literal", None, None), ("http://b", "http://p", "\x08\x0c'" + text, "literal", "http://t/<>", None)], M.TRIPLE_SCHEMA)
    lines = NT.to_lines(g)
    back, rejects = NT.parse_lines(lines)
    assert rejects.count() == 0 and sorted(map(tuple, back.collect())) == sorted(map(tuple, g.collect()))
    escaped = spark.createDataFrame([('<http://a> <http://p> "' + r"\u0041\U0001F600\\" * 40_000 + '" .',)], "value string")
    assert NT.parse_lines(escaped)[0].select(F.length("o").alias("n")).first().n == 120_000


def test_files_with_several_parts_round_trip(spark, tmp_path):
    values = ["a b", '"', "\\", "\\u0041", "\U0001F600", "\x00\x01", "\u2028", "tab\tnl\ncr\r", "", "<x>", "#", "é\ufeff"]
    rows = [(f"http://s/{i}", f"http://p/{v!r} x", v, "literal", "http://t/ {}" if i % 2 else None, None if i % 2 else "en") for i, v in enumerate(values)]
    rows += [("_:n1", "http://p", "_:n2.x", "bnode", None, None), ("http://s/`^|", "http://p", "http://o/\\<>", "iri", None, None)]
    g = spark.createDataFrame(rows, M.TRIPLE_SCHEMA).repartition(5)
    path = NT.write_triples(g, str(tmp_path / "g"))
    back = NT.read_triples(spark, path)
    named = back.where("not s like '_:%'")
    assert sorted(map(tuple, named.collect()), key=str) == sorted((r for r in rows if r[0] != "_:n1"), key=str)
    node = back.where("s like '_:%'").first()
    assert node.s.endswith("_n1") and node.o.endswith("_n2.x") and node.s[:16] == node.o[:16]
    quads = NT.write_triples(g, str(tmp_path / "q"), "nquads", graph="http://g/a b")
    assert {r.g for r in NT.read_triples(spark, quads, with_graph=True).collect()} == {"http://g/a b"}


def test_the_reader_compiles_to_one_stage(spark):
    """One pass without Python, joins or fallbacks, and the generated code is used."""
    triples, _ = NT.parse_lines(_lines(spark, [GOOD[0][0]]).repartition(2))
    plan = triples._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen"))
    assert "WholeStageCodegen" in plan and "Python" not in plan
    spark.conf.set("spark.sql.codegen.fallback", "false")
    try:
        assert triples.count() == 1 and len(triples.collect()) == 1
    finally:
        spark.conf.unset("spark.sql.codegen.fallback")

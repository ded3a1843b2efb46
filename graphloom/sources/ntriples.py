"""N-Triples / N-Quads line formats (S7, S8, S9) and Parquet triples.

Reading is ``spark.read.text`` and one pattern per line, put together from one possessive
pattern per term: each term is scanned once from left to right, nothing is given back, and no
loop recurses, so very long literals are safe. A line that the grammar does not allow goes to a
reject frame or fails the job. Texts and IRIs with escapes are then cut into escapes and plain
pieces, each decoded by itself.
"""

from __future__ import annotations

import os
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from graphloom import model as M

FORMAT_EXT = {"ntriples": ".nt", "nquads": ".nq", "parquet": ".parquet"}


def escape(c: Column) -> Column:
    """Literal text -> N-Triples string body (backslash, quote, newline, return, tab)."""
    out = F.replace(c, F.lit("\\"), F.lit("\\\\"))
    for raw, esc in (('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        out = F.replace(out, F.lit(raw), F.lit(esc))
    return out


_HEX4 = "[0-9A-Fa-f]{4}"
#: One escape, a pair of escaped surrogates, or text without escapes.
_PIECE = rf"\\U[0-9A-Fa-f]{{8}}|\\u[Dd][89ABab][0-9A-Fa-f]{{2}}\\u{_HEX4}|\\u{_HEX4}|(?s:\\.)|[^\\]++"


def _decoded(piece: Column) -> Column:
    """The text that a piece stands for. UTF-16 keeps U+FEFF, which UTF-32 takes for a mark."""
    def code(start: int, digits: int, charset: str) -> Column:
        return F.decode(F.unhex(F.substring(piece, start, digits)), charset)
    letter = F.substring(piece, 2, 1)
    pair = F.decode(F.unhex(F.concat(F.substring(piece, 3, 4), F.substring(piece, 9, 4))), "UTF-16BE")
    return (F.when(~piece.startswith("\\"), piece)
            .when(letter == "u", F.when(F.length(piece) > 6, pair).otherwise(code(3, 4, "UTF-16BE")))
            .when(letter == "U", F.when(F.substring(piece, 3, 4) == "0000", code(7, 4, "UTF-16BE")).otherwise(code(3, 8, "UTF-32")))
            .otherwise(F.translate(letter, "tbnrf", "\t\b\n\r\f")))


def unescape(c: Column) -> Column:
    """Body of a valid term -> text: ``\\\\ \\" \\' \\t \\b \\n \\r \\f``, ``\\uXXXX`` and ``\\UXXXXXXXX``.

    Text without backslashes is taken as it is, and without the rarer escapes by plain
    replacements; only the rest is cut into pieces.
    """
    common = c
    for esc, raw in (('\\"', '"'), ("\\n", "\n"), ("\\r", "\r"), ("\\t", "\t")):
        common = F.replace(common, F.lit(esc), F.lit(raw))
    pieces = F.array_join(F.transform(F.regexp_extract_all(c, F.lit(_PIECE), F.lit(0)), _decoded), "")
    return F.when(~c.contains("\\"), c).when(c.rlike(r"\\[^\"nrt]"), pieces).otherwise(common)


# Characters that an IRI must not hold in these formats (fixed by the format).
_IRI_BAD = r"[\x00-\x20<>\"{}|^`\\]"


def escape_iri(c: Column) -> Column:
    """IRI -> IRI body: forbidden characters (a space in a column name) become ``\\uXXXX``."""
    coded = F.array_join(F.transform(F.split(c, ""), lambda x: F.when(
        x.rlike(_IRI_BAD), F.concat(F.lit("\\u"), F.lpad(F.hex(F.ascii(x)), 4, "0"))).otherwise(x)), "")
    return F.when(c.rlike(_IRI_BAD), coded).otherwise(c)


def _term(c: Column) -> Column:
    """``<iri>`` -> iri; ``_:b`` stays as is (kind tells them apart)."""
    return F.when(c.startswith("<"), unescape(F.substring(c, F.lit(2), F.length(c) - 2))).otherwise(c)


# The terms of the N-Triples grammar. An escape names a character, so half a
# surrogate pair is none; a whole pair is taken for its character.
_UCHAR = (r"\\u(?:[0-9A-CE-Fa-ce-f][0-9A-Fa-f]{3}|[Dd][0-7][0-9A-Fa-f]{2}|[Dd][89ABab][0-9A-Fa-f]{2}\\u[Dd][C-Fc-f][0-9A-Fa-f]{2})"
          r"|\\U(?:0000(?:[0-9A-CE-Fa-ce-f][0-9A-Fa-f]{3}|[Dd][0-7][0-9A-Fa-f]{2})|000[1-9A-Fa-f][0-9A-Fa-f]{4}|0010[0-9A-Fa-f]{4})")
_IRI = rf"<(?:[^\x00-\x20<>\"{{}}|^`\\]++|{_UCHAR})*+>"
_NAME_START = (r"A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u02FF\u0370-\u037D\u037F-\u1FFF\u200C-\u200D\u2070-\u218F\u2C00-\u2FEF"
               r"\u3001-\uD7FF\uF900-\uFDCF\uFDF0-\uFFFD\x{10000}-\x{EFFFF}_:")
_BNODE = rf"_:[{_NAME_START}0-9](?:\.*+[{_NAME_START}0-9\u00B7\u0300-\u036F\u203F-\u2040-]++)*+"
_STRING = rf"[^\"\\\r\n]*+(?:(?:\\[tbnrf\"'\\]|{_UCHAR})[^\"\\\r\n]*+)*+"
_LANG = r"[A-Za-z]++(?:-[A-Za-z0-9]++)*+"
_GAP = r"[\t ]*+"
_NOTE = r"(?s:#.*+)?+"
_NODE = rf"{_IRI}|{_BNODE}"
#: Groups: subject, predicate, object (IRI or blank node), literal, language, datatype, graph.
_LINE = (rf"\A{_GAP}({_NODE}){_GAP}({_IRI}){_GAP}(?:({_NODE})|\"({_STRING})\"(?:{_GAP}(?:@({_LANG})|\^\^{_GAP}({_IRI})))?+){_GAP}"
         rf"%s\.{_GAP}{_NOTE}\z")
_TRIPLE_LINE, _QUAD_LINE = _LINE % "()", _LINE % rf"(?:({_NODE}){_GAP})?+"


def parse_lines(lines: DataFrame, col: str = "value", with_graph: bool = False,
                keep=(), fail: bool = False) -> tuple[DataFrame, DataFrame]:
    """Text lines -> (triples, rejects). Blank and comment lines are skipped.

    A line is matched as a whole, once, and cut into its terms by line feeds, which no term and
    no line holds. Lines that do not match are rejected; with ``fail`` the first of them
    fails the job.
    """
    v = F.col(col)
    body = lines.where(~v.rlike(rf"\A{_GAP}{_NOTE}\z"))
    found = F.when(~v.contains("\n"), F.regexp_replace(v, _QUAD_LINE if with_graph else _TRIPLE_LINE, "\n$1\n$2\n$3\n$4\n$5\n$6\n$7"))
    cut = body.select("*", F.split(found, "\n").alias("_t"))
    ok = F.coalesce(F.size("_t") == 8, F.lit(False))
    bad = F.raise_error(F.concat(F.lit("line is not in the format: "), v)).cast("boolean") if fail else F.lit(False)
    checked = cut.select("*", F.when(ok, F.lit(True)).otherwise(bad).alias("_ok"))
    term = lambda i: F.get("_t", F.lit(i))
    is_lit = term(3) == ""
    cols = [
        _term(term(1)).alias("s"),
        _term(term(2)).alias("p"),
        F.when(is_lit, unescape(term(4))).otherwise(_term(term(3))).alias("o"),
        F.when(is_lit, F.lit(M.KIND_LITERAL)).when(term(3).startswith("_:"), F.lit(M.KIND_BNODE)).otherwise(F.lit(M.KIND_IRI)).alias("o_kind"),
        F.when(term(6) != "", _term(term(6))).alias("o_datatype"),
        F.when(term(5) != "", term(5)).alias("o_lang"),
    ]
    if with_graph:
        cols.append(F.when(term(7) != "", _term(term(7))).alias("g"))
    triples = checked.where("_ok").select(*cols, *keep)
    rejects = checked.where(~F.col("_ok")).select(v.alias("line"))
    return triples, rejects


def read_triples(spark: SparkSession, paths, with_graph: bool = False) -> DataFrame:
    """Read one or several N-Triples/N-Quads graphs as one graph.

    Lines are read whole (a literal with newlines is escaped in the format, so one triple is
    one line). A line that does not parse fails the job (``read_triples_with_rejects`` gives
    such lines back instead). Blank-node labels only have meaning inside one graph: each path
    of ``paths`` is a graph, whatever its number of part files, and its labels are prefixed
    with a hash of that path.
    """
    graphs = [paths] if isinstance(paths, str) else list(paths)
    read = [relabel_bnodes(parse_lines(spark.read.text(p).withColumn("_file", F.lit(p)), with_graph=with_graph, keep=["_file"], fail=True)[0])
            for p in graphs]
    out = reduce(DataFrame.unionByName, read)
    return out.select(*M.TRIPLE_COLUMNS, *(["g"] if with_graph else []))


def read_triples_with_rejects(spark: SparkSession, paths) -> tuple[DataFrame, DataFrame]:
    if isinstance(paths, str):
        paths = [paths]
    lines = spark.read.text(list(paths))
    return parse_lines(lines)


def relabel_bnodes(triples: DataFrame, file_col: str = "_file") -> DataFrame:
    """Prefix blank-node labels with a hash of the graph they come from."""
    tag = F.substring(F.sha1(F.col(file_col)), 1, 12)
    fix = lambda c, is_b: F.when(is_b, F.concat(F.lit("_:f"), tag, F.lit("_"), F.substring(c, 3, 1 << 30))).otherwise(c)
    rest = [c for c in triples.columns if c not in ("s", "o")]
    return triples.select(
        fix(F.col("s"), F.col("s").startswith("_:")).alias("s"),
        fix(F.col("o"), F.col("o_kind") == M.KIND_BNODE).alias("o"), *rest,
    )


def term_text(value: Column, kind: Column) -> Column:
    return F.when(kind == M.KIND_BNODE, value).otherwise(F.concat(F.lit("<"), escape_iri(value), F.lit(">")))


def to_lines(df: DataFrame, graph: str | None = None) -> DataFrame:
    """Triples -> one N-Triples (or N-Quads with ``graph``) line each, column ``value``."""
    s_kind = F.when(F.col("s").startswith("_:"), F.lit(M.KIND_BNODE)).otherwise(F.lit(M.KIND_IRI))
    lit = F.concat(
        F.lit('"'), escape(F.col("o")), F.lit('"'),
        F.when(F.col("o_lang").isNotNull(), F.concat(F.lit("@"), F.col("o_lang")))
        .when(F.col("o_datatype").isNotNull(), F.concat(F.lit("^^<"), escape_iri(F.col("o_datatype")), F.lit(">")))
        .otherwise(F.lit("")),
    )
    obj = F.when(F.col("o_kind") == M.KIND_LITERAL, lit).otherwise(term_text(F.col("o"), F.col("o_kind")))
    parts = [term_text(F.col("s"), s_kind), F.concat(F.lit("<"), escape_iri(F.col("p")), F.lit(">")), obj]
    if graph is not None:
        parts.append(F.concat(F.lit("<"), escape_iri(F.lit(graph)), F.lit(">")))
    return df.select(F.concat_ws(" ", *parts, F.lit(".")).alias("value"))


def write_triples(df: DataFrame, path: str, fmt: str = "ntriples", graph: str | None = None,
                  mode: str = "error") -> str:
    """Write a graph; the extension follows the format when the path has none
    (``ntriples`` -> ``.nt``, ``nquads`` -> ``.nq``, ``parquet``). Output is a directory of
    part files written in parallel. Returns the path written."""
    if os.path.splitext(path)[1] == "":
        path += FORMAT_EXT[fmt]
    if fmt == "parquet":
        df.select(*M.TRIPLE_COLUMNS).write.mode(mode).parquet(path)
    elif fmt in ("ntriples", "nquads"):
        to_lines(df, graph if fmt == "nquads" else None).write.mode(mode).text(path)
    else:
        raise ValueError(f"unsupported format {fmt}")
    return path


def write_graph(df: DataFrame, path: str, base: str, ts: int, name: str, fmt: str = "ntriples",
                is_ontology: bool = False, text: M.HeaderText = M.HeaderText(), graph: str | None = None,
                mode: str = "error") -> str:
    """S9 + T14 for a job's final output: the triples (a set that holds no header triple of
    ``base``) are written once to ``path``; the header and the count triple (written triples
    + header + 1) are appended as one more small part. The count is taken in the writing job,
    so the set is neither recomputed nor read back."""
    from graphloom.operators.metadata import HEADER_SIZE, header_triples
    from graphloom.operators.triples import emit, typed_triple

    spark = df.sparkSession
    seen = Observation()
    path = write_triples(df.observe(seen, F.count(F.lit(1)).alias("n")), path, fmt, graph=graph, mode=mode)  # "overwrite" re-runs a failed job
    n = seen.get["n"]
    header = header_triples(spark, base, ts, name, is_ontology, text)
    count = emit(spark.range(1), [typed_triple(base, M.VOID_TRIPLES, F.lit(str(n + HEADER_SIZE + 1)),
                                               M.XSD_NONNEGATIVEINTEGER)])
    extra = header.unionByName(count).coalesce(1)
    if fmt == "parquet":
        extra.select(*M.TRIPLE_COLUMNS).write.mode("append").parquet(path)
    else:
        to_lines(extra, graph if fmt == "nquads" else None).write.mode("append").text(path)
    return path

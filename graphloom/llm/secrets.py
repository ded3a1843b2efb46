"""Secret scans with an incremental blob ledger.

Every version of a path is addressed by the SHA-256 of its text. The ledger (Parquet,
append-only) has a row for each blob and rule version ever scanned, with the spans found. A
run looks up which (blob, rule version) pairs it lacks, scans one text of each such blob for
just those rules, appends the findings, and joins them back to all paths.

Spans count code points, end exclusive. A regular expression's matches are the leftmost
non-overlapping ones; matches that are too short are dropped afterwards, so they still
use up their text. Positions follow from the pieces between matches: a match starts after
all earlier pieces and matches.

Defined cases: a null text is an empty one; paths with equal texts share a blob; a path may
occur again with the same or another text; an empty table gives no rows; further columns
are left out.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from graphloom.llm.common import stage


@dataclass(frozen=True)
class Rule:
    """``pattern``'s matches whose group ``group`` has at least ``least`` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1

    @property
    def version(self) -> str:
        """Changes with anything that changes the findings."""
        return hashlib.sha256(repr((self.kind, self.pattern, self.group, self.least)).encode()).hexdigest()[:16]


#: Base rules, in the order in which kinds are listed. The run-shaped patterns carry their
#: least length themselves: a shorter run cannot hold a match that starts later in it.
BASE = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    Rule("access", r"AKIA[A-Z0-9]{14,}"),
    Rule("hex", r"(?<![0-9a-f])[0-9a-f]{16,}"),
)
MORE = (
    Rule("pem", r"-----BEGIN (?:[A-Z]+ ){0,3}PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
)
RULES = BASE + MORE

_LEDGER = "blob string, version string, spans array<struct<start:long,stop:long>>"


def blob_of(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def ledger(spark: SparkSession, path: str | None) -> DataFrame:
    """The ledger's rows; none for a path at which nothing has been written."""
    if path is not None:
        try:
            return spark.read.schema(_LEDGER).parquet(path)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
    return spark.createDataFrame([], _LEDGER)


def _found(rule: Rule) -> Column:
    """A rule's matches in ``text``: text before, whole match, length of its group."""
    whole = F.regexp_extract_all("text", F.lit(rule.pattern), F.lit(0))
    value = F.regexp_extract_all("text", F.lit(rule.pattern), F.lit(rule.group)) if rule.group else whole
    pieces = F.split("text", rule.pattern, -1)
    rows = F.arrays_zip(F.transform(pieces, lambda p: F.length(p)).alias("gap"), F.transform(whole, lambda m: F.length(m)).alias("width"),
                        F.transform(value, lambda v: F.length(v)).alias("held"))
    wanted = F.array_contains("need", rule.version) & F.col("text").rlike(rule.pattern)
    return F.when(wanted, F.struct(F.lit(rule.version).alias("version"), F.lit(rule.least).alias("least"), rows.alias("rows")))


def scan(texts: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(blob, version, start, stop) of every match in (blob, need, text)."""
    hit = F.lit(False)
    for rule in rules:
        hit = hit | F.col("text").rlike(rule.pattern)
    own = texts.where(hit).dropDuplicates(["blob"])
    per_rule = own.select("blob", F.explode(F.array(*[_found(r) for r in rules])).alias("f")).where("f IS NOT NULL")
    matches = per_rule.select("blob", "f.version", "f.least", F.posexplode("f.rows").alias("at", "m"))
    before = Window.partitionBy("blob", "version").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    earlier = F.coalesce(F.sum(F.col("m.gap") + F.coalesce(F.col("m.width"), F.lit(0))).over(before), F.lit(0))
    placed = matches.select("blob", "version", "least", (earlier + F.col("m.gap")).alias("start"), F.col("m.width").alias("width"), F.col("m.held").alias("held"))
    return placed.where("width IS NOT NULL AND held >= least").select("blob", "version", "start", (F.col("start") + F.col("width")).alias("stop"))


def update(versions: DataFrame, known: DataFrame, rules: tuple[Rule, ...] = RULES) -> tuple[DataFrame, DataFrame]:
    """Scan what the ledger lacks of ``versions`` (path, text): (paths, new ledger rows).

    ``paths`` is (path, blob) of every row. Of each blob one text is read, that of its
    smallest path; the join key holds the path, so copies of a text spread out.
    """
    paths = stage(versions.select("path", blob_of(F.col("text")).alias("blob")), "paths")
    current = F.array(*[F.lit(r.version) for r in rules])
    seen = known.groupBy("blob").agg(F.collect_set("version").alias("seen"))
    first = paths.groupBy("blob").agg(F.min("path").alias("first"))
    need = F.array_except(current, F.coalesce("seen", F.array().cast("array<string>")))
    open_ = stage(first.join(seen, "blob", "left").select("blob", "first", need.alias("need")).where("size(need) > 0"), "open")
    texts = versions.select(F.col("path"), blob_of(F.col("text")).alias("of"), F.coalesce("text", F.lit("")).alias("text"))
    one = texts.join(open_, (F.col("of") == F.col("blob")) & F.col("path").eqNullSafe(F.col("first"))).select("blob", "need", "text")
    spans = scan(one, rules).groupBy("blob", "version").agg(F.sort_array(F.collect_list(F.struct("start", "stop"))).alias("spans"))
    pairs = open_.select("blob", F.explode("need").alias("version"))
    none = F.array().cast("array<struct<start:long,stop:long>>")
    return paths, stage(pairs.join(spans, ["blob", "version"], "left").select("blob", "version", F.coalesce("spans", none).alias("spans")), "ledger")


def scan_versions(versions: DataFrame, rules: tuple[Rule, ...] = RULES, ledger_path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(paths, findings): (path, blob) of every row, and (blob, version, spans) of every pair
    of a blob with a match. New ledger rows are appended to ``ledger_path`` if one is given."""
    known = ledger(versions.sparkSession, ledger_path)
    paths, new = update(versions, known, rules)
    if ledger_path is not None:
        new.write.mode("append").parquet(ledger_path)
        known = ledger(versions.sparkSession, ledger_path)
    else:
        known = new
    return paths, known.where(F.col("version").isin([r.version for r in rules]) & (F.size("spans") > 0)).dropDuplicates(["blob", "version"])


def secret_report(docs: DataFrame, ledger_path: str | None = None) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans of every document."""
    paths, findings = scan_versions(docs.select(F.col("doc_id").alias("path"), "text"), RULES, ledger_path)
    place = F.array(*[F.lit(r.version) for r in RULES])
    kinds = F.array(*[F.lit(r.kind) for r in RULES])
    order = (F.array_position(place, F.col("version")) - 1).cast("int")
    flat = findings.select("blob", order.alias("rule"), F.explode("spans").alias("s"))
    entry = F.struct(F.col("s.start").alias("start"), "rule", F.col("s.stop").alias("stop"))
    counts = [F.sum((F.col("rule") == i).cast("long")).alias(f"n_{r.kind}") for i, r in enumerate(BASE)]
    per_blob = flat.groupBy("blob").agg(*counts, F.sort_array(F.collect_list(entry)).alias("all"))
    listed = lambda spans: F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(kinds, x["rule"]), x["start"], x["stop"])), ",")
    base = F.filter("all", lambda x: x["rule"] < len(BASE))
    digests = per_blob.select("blob", *[f"n_{r.kind}" for r in BASE], F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("all")).alias("spans"))
    zero = [F.coalesce(f"n_{r.kind}", F.lit(0)).cast("long").alias(f"n_{r.kind}") for r in BASE]
    return paths.join(digests, "blob", "left").select(F.col("path").alias("doc_id"), *zero, F.coalesce("base_sha256", F.sha2(F.lit(""), 256)).alias("base_sha256"),
                                                      F.coalesce("spans", F.lit("")).alias("spans"))

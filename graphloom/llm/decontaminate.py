"""Benchmark decontamination on templates.

Texts become tokens: runs of letters and digits in lower case. Their templates have typed
placeholders for numbers, units (after a number) and names (capitalised words inside a
sentence, and the same words at its start), token for token, so a question with other numbers
or names keeps its template. After a colon, quote, bracket or dash, words of ``OPENERS`` are
no names.

1.  Documents give every ``WINDOW``-th window of ``WINDOW`` tokens, benchmark items give all
    their windows, both as templates and as they are, and the two are hash-joined. A shared
    run of ``RUN`` = 2 * ``WINDOW`` - 1 tokens of either form always holds one of the
    document's windows, so none is missed and a copy does not depend on capitals. Tokens
    agree if they are equal in either form.
2.  Each hit is a diagonal (document position minus item position). On the few documents
    with hits, the item is laid along its diagonals: a document is contaminated by an item if
    ``RUN`` tokens in a row are equal, or a maximal run of at least ``RUN`` agreeing tokens has
    one value only for each of the item's slot values in it.

An item of fewer than ``RUN`` tokens has to occur as a whole; for each such length the
documents give all windows of that length. Items under ``LEAST`` tokens are too short to
tell and match nothing.

Defined cases: null and wordless texts match nothing; a null item matches nothing; equal
items and repeated rows are reported each; empty tables give no rows; further columns stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphloom.llm.common import stage

WINDOW, LEAST = 7, 5
RUN = 2 * WINDOW - 1

# Units that follow a number.
UNITS = ("km", "m", "cm", "mm", "mi", "mile", "miles", "ft", "foot", "feet", "inch", "inches", "kg", "g", "mg", "lb", "lbs", "oz", "ton", "tons",
         "l", "ml", "liter", "liters", "litre", "litres", "s", "sec", "second", "seconds", "min", "minute", "minutes", "h", "hour", "hours",
         "day", "days", "week", "weeks", "month", "months", "year", "years", "percent", "dollar", "dollars", "euro", "euros", "cent", "cents",
         "usd", "eur", "mph", "kmh", "kb", "mb", "gb", "degrees",
         "meter", "meters", "metre", "metres", "kilometer", "kilometers", "kilometre", "kilometres", "centimeter", "centimeters", "centimetre",
         "centimetres", "millimeter", "millimeters", "millimetre", "millimetres", "yard", "yards", "yd", "gram", "grams", "gramme", "grammes",
         "kilogram", "kilograms", "kilo", "kilos", "milligram", "milligrams", "pound", "pounds", "ounce", "ounces", "tonne", "tonnes", "t",
         "milliliter", "milliliters", "millilitre", "millilitres", "cl", "gallon", "gallons", "pint", "pints", "quart", "quarts", "cup", "cups",
         "ms", "millisecond", "milliseconds", "secs", "mins", "hr", "hrs", "decade", "decades", "century", "centuries", "degree", "celsius",
         "fahrenheit", "kelvin", "gbp", "penny", "pence", "pennies", "yen", "rupee", "rupees", "tb", "byte", "bytes", "kilobytes", "megabytes",
         "gigabytes", "hz", "khz", "mhz", "ghz", "w", "kw", "mw", "kwh", "watt", "watts", "kilowatt", "kilowatts", "v", "volt", "volts", "amp",
         "amps", "ampere", "amperes", "ohm", "ohms", "j", "kj", "joule", "joules", "n", "newton", "newtons", "cal", "kcal", "calorie", "calories",
         "pa", "kpa", "pascal", "pascals", "bar", "acre", "acres", "hectare", "hectares", "ha", "knot", "knots", "kph", "mol", "mole", "moles")

# Words that start a question or a sentence and are no names there.
OPENERS = ("What", "Which", "Who", "Whom", "Whose", "How", "When", "Where", "Why", "If", "The", "An", "In", "On", "At", "For", "From", "To", "Of",
           "By", "With", "Is", "Are", "Was", "Were", "Do", "Does", "Did", "Can", "Could", "Will", "Would", "Should", "Has", "Have", "Had", "There",
           "This", "That", "These", "Those", "It", "He", "She", "We", "They", "You", "Each", "Every", "All", "Some", "Suppose", "Given", "Let",
           "Find", "Calculate", "Compute", "Determine", "Name", "Write", "Consider", "After", "Before", "During", "Since", "While", "As", "And", "But", "Or", "Not", "No", "Yes")

# Marks before a token: a number, a unit after a number, a name, a capitalised word that starts a
# sentence. The first three stand for the whole token in a template.
NUMBER, UNIT, NAME, _FIRST = "\u0001", "\u0002", "\u0003", "\u0004"
_CAPITAL = r"\p{Lu}\p{Ll}+(?![\p{L}\p{N}])"
_NAMED = rf"(?=\p{{Lu}}\p{{Ll}})(?:(?<=[\p{{L}}\p{{N}},] )|(?<=: )(?!(?:{'|'.join(OPENERS)})(?![\p{{L}}\p{{N}}]))){_CAPITAL}"
_NUMBERS = r"\p{N}+(?:[.,]\p{N}+)*"


def _raw(text: Column) -> Column:
    """Words, sentence ends, decimal points, and a colon for what may open a sentence;
    everything else is one space."""
    opened = F.regexp_replace(F.coalesce(text, F.lit("")), r"[:;\"“”„«»()\[\]{}–—][^\p{L}\p{N}.,!?\n]*", " : ")
    return F.regexp_replace(opened, r"[^\p{L}\p{N}.,!?:\n]+", " ")


def _marked(raw: Column) -> Column:
    """The tokens of a raw text in lower case, each behind its mark if it has one, one space
    apart: sentence marks go, decimal points inside numbers stay."""
    named = F.regexp_replace(raw, _NAMED, f"{NAME}$0")
    first = F.regexp_replace(named, rf"(?=\p{{Lu}}\p{{Ll}})(?<![\p{{L}}\p{{N}}{NAME}])(?={_CAPITAL})", _FIRST)
    number = F.regexp_replace(first, rf"(?=\p{{N}})(?<![\p{{L}}\p{{N}}]){_NUMBERS}(?![\p{{L}}\p{{N}}])", f"{NUMBER}$0")
    unit = F.regexp_replace(number, rf"(?i)({NUMBER}{_NUMBERS} (?:: )?)((?:{'|'.join(UNITS)})(?![\p{{L}}\p{{N}}]))", f"$1{UNIT}$2")
    marked = F.when(raw.rlike(r"\p{N}"), unit).otherwise(first)
    return F.trim(F.regexp_replace(F.lower(marked), r"(?=[.,!?:\s])(?:[!?:\s]|[.,](?!\p{N})|(?<!\p{N})[.,])+", " "))


def _split(flat: Column) -> Column:
    return F.array_remove(F.split(flat, " "), "")


def templates(rows: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` plus ``raw`` and ``template``: two token arrays of equal length. Marks are set
    once a text and both arrays are cut from the marked text; the first word of a sentence is
    a name where the same text has it as a name elsewhere."""
    raws = rows.select(*keep, _raw(F.col("text")).alias("_raw"))
    flat = raws.select(*keep, _marked(F.col("_raw")).alias("_flat"))
    marked = lambda mark: F.array_distinct(F.regexp_extract_all("_flat", F.lit(f"{mark}([^ ]+)"), F.lit(1)))
    again = flat.select(*keep, "_flat", F.array_join(F.array_intersect(marked(_FIRST), marked(NAME)), "|").alias("_again"))
    named = F.regexp_replace("_flat", F.concat(F.lit(f"{_FIRST}(?:"), F.col("_again"), F.lit(")(?![^ ])")), F.lit(NAME + "_"))
    known = F.when(F.col("_again") == "", F.col("_flat")).otherwise(named)
    template = F.regexp_replace(F.translate(known, _FIRST, ""), f"([{NUMBER}{UNIT}{NAME}])[^ ]+", "$1")
    bare = F.translate("_flat", NUMBER + UNIT + NAME + _FIRST, "")
    return again.select(*keep, _split(bare).alias("raw"), _split(template).alias("template"))


def _windows(size: int, step: int, kind: int) -> Column:
    """(kind, at, hash) of the windows of ``size`` tokens at every ``step``-th place, as a
    template and, where that differs, as they are."""
    last = F.size("template") - size
    at = F.when(last >= 0, F.sequence(F.lit(0), last, F.lit(step))).otherwise(F.array().cast("array<int>"))
    of = lambda i: F.array_distinct(F.array(*[F.xxhash64(F.slice(c, i + 1, F.lit(size))) for c in ("template", "raw")]))
    return F.flatten(F.transform(at, lambda i: F.transform(of(i), lambda h: F.struct(F.lit(kind).alias("kind"), i.alias("at"), h.alias("hash")))))


def _hits(docs: DataFrame, items: DataFrame, short: list[int]) -> DataFrame:
    """(doc key, item, diagonal) of every window that a document and an item share: windows of
    all lengths in one pass over the documents. ``short`` has the lengths of the items that
    must occur whole (kind: their length), the longer ones are of kind 0. The item side is
    staged, so Spark knows its size and broadcasts it only if it is small."""
    n = F.size("template")
    own = F.when(n >= RUN, _windows(WINDOW, 1, 0))
    for size in short:
        own = own.when(n == size, _windows(size, 1, size))
    ours = items.select("item_row", F.explode(own).alias("w"))
    ours = stage(ours.select("item_row", F.col("w.kind").alias("_kind"), F.col("w.at").alias("item_at"), F.col("w.hash").alias("_hash")), "windows")
    every = F.concat(_windows(WINDOW, WINDOW, 0), *[_windows(size, 1, size) for size in short])
    theirs = docs.select("doc_id", "text_hash", F.explode(every).alias("w")).select("doc_id", "text_hash", "w.*")
    joined = theirs.join(ours, (F.col("hash") == F.col("_hash")) & (F.col("kind") == F.col("_kind")))
    return joined.select("doc_id", "text_hash", "item_row", (F.col("at") - F.col("item_at")).alias("diagonal"))


def _longest(equal: Column) -> Column:
    """Length of the longest run of true in an array."""
    zero = F.struct(F.lit(0).alias("now"), F.lit(0).alias("most"))

    def step(acc: Column, x: Column) -> Column:
        now = F.when(x, acc["now"] + 1).otherwise(0)
        return F.struct(now.alias("now"), F.greatest(acc["most"], now).alias("most"))
    return F.aggregate(equal, zero, step, lambda acc: acc["most"])


def _slots(pairs: Column) -> Column:
    return F.filter(pairs, lambda z: (z["a"] == z["b"]) & z["a"].isin(NUMBER, UNIT, NAME))


def _consistent(pairs: Column) -> Column:
    """Whether each of the item's slot values stands for one value."""
    values = F.array_distinct(F.transform(_slots(pairs), lambda z: F.struct(z["a"].alias("a"), z["x"].alias("x"), z["y"].alias("y"))))
    names = F.array_distinct(F.transform(_slots(pairs), lambda z: F.struct(z["a"].alias("a"), z["x"].alias("x"))))
    return F.size(values) == F.size(names)


def _runs(pairs: Column, agree: Column, least: Column) -> Column:
    """The maximal runs of at least ``least`` agreeing pairs, each an array of pairs."""
    n = F.size(agree)
    places = F.filter(F.transform(agree, lambda x, i: F.when(~x, i)), lambda i: i.isNotNull())
    ends = F.concat(F.array(F.lit(-1)), places, F.array(n))
    spans = F.transform(F.slice(ends, 2, n + 1), lambda e, i: F.struct((F.get(ends, i) + 2).alias("from"), (e - F.get(ends, i) - 1).alias("n")))
    return F.transform(F.filter(spans, lambda r: r["n"] >= least), lambda r: F.slice(pairs, r["from"], r["n"]))


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, text_hash, item_id, run, slots, item_tokens): a row for each document key and
    benchmark row that contaminates it. ``run`` is the longest run of agreeing tokens,
    ``slots`` the number of placeholders among the tokens that agree."""
    items = templates(benchmark.select("item_id", "text", F.xxhash64("item_id", "text").alias("item_row")), ["item_id", "item_row"])
    items = stage(items.where(F.size("template") >= LEAST), "items")
    keyed = templates(docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text"), ["doc_id", "text_hash"])
    plain = keyed.select("doc_id", "text_hash", "raw", "template")
    shorter = items.where(F.size("template") < RUN).select(F.size("template").alias("n")).distinct()
    found = _hits(plain, items, sorted(r["n"] for r in shorter.collect()))  # at most RUN - LEAST lengths
    diagonals = stage(found.distinct(), "diagonals")

    widest = max(items.agg(F.max(F.size("template"))).first()[0] or 0, 1)
    marked = diagonals.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).distinct()
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash"))
    texts = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text").join(marked, same, "left_semi")

    def block(i: Column) -> Column:  # twice as wide as an item, so a diagonal's tokens are in one block
        return F.struct(i.alias("_block"), *[F.slice(c, i * widest + 1, F.lit(2 * widest)).alias(c) for c in ("template", "raw")])
    held = F.transform(F.sequence(F.lit(0), F.floor((F.size("template") - 1) / widest).cast("int")), block)
    blocks = templates(texts, ["doc_id", "text_hash"]).select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), F.explode(held).alias("b"))
    start = F.greatest("diagonal", F.lit(0))  # the document's tokens from the item's first place on
    spots = diagonals.select("doc_id", "text_hash", "item_row", (start - F.col("diagonal")).alias("skip"), F.floor(start / widest).cast("int").alias("block"), (start % widest).alias("at"))
    along = spots.join(blocks.select("_id", "_hash", "b.*"), same & (F.col("block") == F.col("_block")))
    room = lambda c: F.slice(c, F.col("at") + 1, F.lit(widest))
    along = along.select("doc_id", "text_hash", "item_row", "skip", room("template").alias("t"), room("raw").alias("r"))
    both = along.join(items.withColumnsRenamed({"raw": "item_raw", "template": "item_template"}), "item_row")
    of = lambda c: F.slice(c, F.col("skip") + 1, F.size(c) + 1)
    pairs = F.arrays_zip(of(F.col("item_template")).alias("a"), F.col("t").alias("b"), of(F.col("item_raw")).alias("x"), F.col("r").alias("y"))
    both = both.select("doc_id", "text_hash", "item_row", "item_id", F.size("item_template").alias("item_tokens"), pairs.alias("pairs"))
    agree = F.transform("pairs", lambda z: F.coalesce((z["a"] == z["b"]) | (z["x"] == z["y"]), F.lit(False)))
    equal = F.transform("pairs", lambda z: F.coalesce(z["x"] == z["y"], F.lit(False)))
    least = F.least(F.col("item_tokens"), F.lit(RUN))
    both = both.select("*", agree.alias("agree"), _longest(agree).alias("run"), _longest(equal).alias("copied")).where(F.col("run") >= least)
    good = both.where((F.col("copied") >= least) | F.exists(_runs(F.col("pairs"), F.col("agree"), least), _consistent))
    good = good.select("doc_id", "text_hash", "item_row", "item_id", "item_tokens", "run", F.size(_slots(F.col("pairs"))).alias("slots"))
    return good.groupBy("doc_id", "text_hash", "item_row", "item_id", "item_tokens").agg(F.max("run").alias("run"), F.max("slots").alias("slots")).drop("item_row")


def leak_report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, run, slots, item_tokens of every contaminated document and its items."""
    return leaks(docs, benchmark).select("doc_id", "item_id", "run", "slots", "item_tokens")


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that no item contaminates, with all their columns."""
    bad = stage(leaks(docs, benchmark).select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).distinct(), "leaks")
    own = docs.select(F.struct("*").alias("_row"), F.col("doc_id").alias("_own_id"), F.xxhash64("text").alias("_own_hash"))
    match = (F.col("_own_hash") == F.col("_hash")) & F.col("_own_id").eqNullSafe(F.col("_id"))
    return own.join(bad, match, "left_anti").select("_row.*")

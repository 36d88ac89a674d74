"""Benchmark decontamination by template canonicalisation.

Texts become templates: numbers, names and units turn into typed placeholders, case and
punctuation go. Windows of a document's template are hash-joined with those of the
benchmark items. Windows that match at one distance between document and item form a
candidate, whose slots are then compared: an item's value must stand for one and the
same value of the document wherever it recurs, or the windows that hold it do not count.
Windows of little but placeholders are compared with the values in their places. A capital at a sentence's start may
make a name or not, so windows that hold one are posted in both readings. So a question is found verbatim as well
as with other numbers and names, while a chance likeness of shape is not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.llm.store import Scratch

WINDOW = 8
#: Part of an item's windows that must be found in a document.
COVERAGE = 0.3
#: Literal words that a window must hold; one of placeholders mostly says nothing but by its values.
LITERAL = 4
#: Rows up to which the benchmark's windows are sent to all tasks (32 bytes each).
BROADCAST_ROWS = 1_000_000

#: The placeholders, each one token that no canonical word can be.
NUMBER, NAME, UNIT = "0", "ꙮ", "ꙩ"
#: Stands before a word that its place, at a sentence's start, gives a capital.
START = "ꙭ"
#: Words that are units when they follow a number.
UNITS = (
    "mm cm m km in inch inches ft feet foot yd yard yards mile miles mg g kg lb lbs oz pound pounds ounce ounces ton tons "
    "ml l liter liters litre litres gallon gallons s sec second seconds min minute minutes h hr hour hours day days week "
    "weeks month months year years cent cents dollar dollars euro euros usd eur percent degree degrees mph kmh hz khz mhz "
    "ghz kb mb gb tb w kw v volt volts watt watts j joule joules n pa bar"
).split()


def _stripped(text: Column) -> Column:
    """Lower case, every run of signs one blank."""
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}" + NAME + UNIT + "]+", " "))


def _words(text: Column) -> Column:
    return F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(text, " ", -1))


def _template(text: Column) -> Column:
    """The template with blanks between its tokens; ``START`` stands before words that may be names or not."""
    text = F.coalesce(text, F.lit(""))
    numbers = F.regexp_replace(text, r"\p{N}+(?:[.,:/]\p{N}+)*", NUMBER)
    names = F.regexp_replace(numbers, r"\p{Lu}(?<=[\p{Ll}\p{N},;] .)\p{Ll}+", NAME)
    starts = F.regexp_replace(names, r"\p{Lu}(?<![\p{L}\p{N}].)(?=\p{Ll})", START + "$0")
    units = rf"(?<=(?:^| ){NUMBER} )(?:{'|'.join(UNITS)})(?= |$)"
    flat = _stripped(starts)
    return F.when(F.contains(flat, F.lit(NUMBER)), F.regexp_replace(flat, units, UNIT)).otherwise(flat)


def _as_words(template: Column) -> Column:
    """Words at sentence starts read as words."""
    return _words(F.replace(template, F.lit(START), F.lit("")))


def _as_names(template: Column) -> Column:
    """Words at sentence starts read as names."""
    return _words(F.regexp_replace(template, START + "[^ ]*", NAME))


def template_words(text: Column) -> Column:
    """The template's tokens: words, and placeholders for numbers, names inside sentences, and units."""
    return _as_words(_template(text))


def literal_words(text: Column) -> Column:
    """What stands at each place of the template."""
    text = F.coalesce(text, F.lit(""))
    return _words(_stripped(F.regexp_replace(text, r"(?<=\p{N})[.,:/](?=\p{N})", "")))


def _literal(words: str) -> Column:
    """1 for each word, 0 for each placeholder."""
    return F.expr(f"transform({words}, w -> CASE WHEN w IN ('{NUMBER}', '{NAME}', '{UNIT}') THEN 0 ELSE 1 END)")


def _windows(words: str, width: int, literal: int, said: str | None = None, poor_only: bool = False) -> Column:
    """The hash of each window in turn (``solid``: the words' ``_literal``); for one with too few literal words that of what is ``said`` there, or null."""
    held = [f"element_at({words}, i + {k})" for k in range(width)]
    fixed = " + ".join(f"get(solid, i + {k - 1})" for k in range(width))
    plain = f"(NOT has_slots OR {fixed} >= {min(literal, (width + 1) // 2)})"
    rich = "CAST(NULL AS BIGINT)" if poor_only else f"xxhash64({', '.join(held)})"
    values = ", ".join(f"get({said}, i + {k - 1})" for k in range(width))
    # fewer values than that are found anywhere
    poor = f"xxhash64('{NUMBER}{NAME}', {values})" if said and width >= literal else "CAST(NULL AS BIGINT)"
    each = f"CASE WHEN {plain} THEN {rich} ELSE {poor} END"
    last = f"size({words}) - {width - 1}"
    return F.expr(f"CASE WHEN {last} >= 1 THEN transform(sequence(1, {last}), i -> {each}) ELSE array() END")


def _other_windows(words: str, named: str, width: int, literal: int) -> Column:
    """``p, h`` of the windows that the two readings tell apart, read with names, if they hold enough words (``solid_named``)."""
    held = [f"element_at({named}, i + {k})" for k in range(width)]
    fixed = " + ".join(f"get(solid_named, i + {k - 1})" for k in range(width))
    last = f"size({words}) - {width - 1}"
    apart = f"filter(sequence(1, size({words})), i -> element_at({words}, i) <> element_at({named}, i))"
    begins = f"array_distinct(flatten(transform({apart}, s -> sequence(greatest(1, s - {width - 1}), least(s, {last})))))"
    each = f"CASE WHEN {fixed} >= {min(literal, (width + 1) // 2)} THEN struct(i - 1 AS p, xxhash64({', '.join(held)}) AS h) END"
    return F.expr(f"CASE WHEN {last} >= 1 THEN filter(transform({begins}, i -> {each}), x -> x IS NOT NULL) END")


def _side_by_side(read: DataFrame, width: int, literal: int, by_value: bool) -> DataFrame:
    """``doc_id, p, h`` of each window: the hashes of ``_windows`` and of ``_other_windows``, over rows that hold a window's words in columns.

    Shifted arrays are put side by side and taken apart in compiled code, several times
    faster than a function applied to each place of an array.
    """
    last = f"greatest(size(words) - {width - 1}, 0)"
    sides = {"w": "words", "n": "named"} | ({"s": "said"} if by_value else {})
    shifted = [f"slice({column}, {k + 1}, {last})" for column in sides.values() for k in range(width)]
    w, n, s = ([f"{side}{k}" for k in range(width)] for side in "wns")
    zipped = F.expr(f"arrays_zip(slice(sequence(0, size(words)), 1, {last}), {', '.join(shifted)})")
    rows = read.select("doc_id", "has_slots", F.inline(zipped).alias("p", *w, *n, *(s if by_value else [])))

    def rich(words: list[str]) -> str:
        fixed = " + ".join(f"CASE WHEN {c} IN ('{NUMBER}', '{NAME}', '{UNIT}') THEN 0 ELSE 1 END" for c in words)
        return f"{fixed} >= {min(literal, (width + 1) // 2)}"

    poor = f"xxhash64('{NUMBER}{NAME}', {', '.join(s)})" if by_value and width >= literal else "CAST(NULL AS BIGINT)"
    plain = f"CASE WHEN NOT has_slots OR {rich(w)} THEN xxhash64({', '.join(w)}) ELSE {poor} END"
    apart = " OR ".join(f"{a} <> {b}" for a, b in zip(n, w))
    other = f"CASE WHEN ({apart}) AND {rich(n)} THEN xxhash64({', '.join(n)}) END"
    return rows.select("doc_id", "p", F.expr(f"explode(array({plain}, {other})) AS h")).filter("h IS NOT NULL")


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    window: int = WINDOW,
    coverage: float = COVERAGE,
    literal: int = LITERAL,
) -> DataFrame:
    """Pairs ``doc_id, item_id, found, windows, coverage, reworded`` of documents and the items they hold.

    ``found`` of an item's ``windows`` stand in the document with consistent slots; a pair
    is reported from ``coverage`` on. These are the windows of enough literal words, or all
    of them where that covers more. ``reworded`` tells that a slot's value differs. An
    item shorter than the window is one window, as long as itself.

    Defined cases: null and empty texts hold nothing, items without words are in nothing.
    Items are told apart by id and text: those without id are reported with none, those
    that share an id each by a row of its own. Documents without id are not reported;
    documents that share an id are taken together, and so are equal rows. Empty tables give an empty result. Other columns are not read.
    """
    store = Scratch(docs.sparkSession, "decontaminate")
    items = benchmark.select(F.col(item_col).cast("bigint").alias("item_id"), F.col(text_col).alias("text"))
    items = items.distinct().withColumn("template", _template(F.col("text")))
    inside = F.slice(template_words(F.concat(F.lit("a "), "text")), F.lit(2), F.lit(1))
    items = items.select(
        F.monotonically_increasing_id().alias("item"),
        "item_id",
        _as_words(F.col("template")).alias("words"),
        _as_names(F.col("template")).alias("named"),
        literal_words(F.col("text")).alias("said"),
        inside.alias("first"),
    )
    items = store.keep(items.filter("size(words) > 0").withColumn("has_slots", _slotted("words")), "items")
    ids, items = items.select("item", "item_id"), items.drop("item_id").withColumnRenamed("item", "item_id")
    # within a sentence a capital makes an item's first word a name
    inner = items.filter(F.col("first") != F.slice("words", F.lit(1), F.lit(1)))
    inner = inner.withColumn("words", F.expr("concat(first, slice(words, 2, size(words)))")).withColumn("has_slots", F.lit(True))
    forms = items.union(inner).withColumn("solid", _literal("words"))
    named = items.withColumn("solid_named", _literal("named"))
    short = items.filter(F.size("words") < window).select(F.size("words").alias("n")).distinct().collect()
    widths = sorted({row.n for row in short} | {window})

    own = []
    for width in widths:
        of_width = forms.filter(F.size("words") >= width if width == window else F.size("words") == width)
        for rich in (True, False):
            hashes = _windows("words", width, literal, None if rich else "said", not rich)
            own.append(of_width.select("item_id", F.posexplode(hashes).alias("q", "h")).withColumn("rich", F.lit(rich)))
        of_width = named.filter(F.size("words") >= width if width == window else F.size("words") == width)
        other = of_width.select("item_id", F.explode(_other_windows("words", "named", width, literal)).alias("x"))
        own.append(other.select("item_id", F.col("x.p").alias("q"), "x.h", F.lit(True).alias("rich")))
    posted = own[0]
    for more in own[1:]:
        posted = posted.union(more)
    posted = store.keep(posted.filter("h IS NOT NULL").distinct(), "windows")
    # a window that one form of the item makes rich counts as such
    rich = F.collect_set(F.when(F.col("rich"), F.col("q"))).alias("rich")
    totals = store.keep(posted.groupBy("item_id").agg(F.count_distinct("q").alias("every"), rich), "totals")
    by_value = "said" if posted.filter(~F.col("rich")).limit(1).count() else None
    posted = posted.select("item_id", "q", "h").distinct()

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.filter("doc_id IS NOT NULL")
    read = rows.withColumn("template", _template(F.col("text")))
    read = read.select("doc_id", "text", _as_words(F.col("template")).alias("words"), _as_names(F.col("template")).alias("named"))
    none = F.array().cast("array<string>")
    read = read.withColumn("has_slots", _slotted("words"))
    if by_value:
        read = read.withColumn("said", F.when(F.col("has_slots"), literal_words(F.col("text"))).otherwise(none))
    # one reading of the texts for both readings of their sentence starts
    read = read.withColumn("named", F.when(F.col("named") != F.col("words"), F.col("named")).otherwise(none)).drop("text")
    seen = None
    for w in widths:
        of_width = _side_by_side(read, w, literal, bool(by_value))
        seen = of_width if seen is None else seen.union(of_width)
    small = posted.count() <= BROADCAST_ROWS
    hits = seen.join(F.broadcast(posted) if small else posted, "h").select(
        "doc_id", "item_id", "q", (F.col("p") - F.col("q")).alias("distance")
    )
    # an item's windows bound the set of each group
    runs = hits.groupBy("doc_id", "item_id", "distance").agg(F.collect_set("q").alias("places"))
    runs = store.keep(runs, "runs")
    # only what could reach the coverage, over all distances, needs its slots compared
    could = runs.groupBy("doc_id", "item_id").agg(F.sum(F.size("places")).alias("most")).join(totals, "item_id")
    asked = F.when(F.size("rich") > 0, F.size("rich")).otherwise(F.col("every"))
    could = could.filter(F.col("most") >= F.lit(coverage) * asked).select("doc_id", "item_id")
    runs = runs.join(could, ["doc_id", "item_id"])

    plain = items.select("item_id", _slotted("named").alias("has_slots"))
    runs = store.keep(runs.join(plain, "item_id"), "candidates")
    slotted = runs.filter("has_slots")
    holders = store.keep(slotted.select("doc_id").distinct(), "holders")
    listed = F.broadcast(holders) if holders.count() <= BROADCAST_ROWS else holders
    said = rows.join(listed, "doc_id", "left_semi").select("doc_id", literal_words(F.col("text")).alias("doc_said"))
    checked = _checked(slotted.drop("has_slots"), said, items.select("item_id", F.col("named").alias("words"), "said"), widths[-1])
    columns = ["doc_id", "item_id", "places", "reworded"]
    good = runs.filter("NOT has_slots").withColumn("reworded", F.lit(False)).select(columns).union(checked.select(columns))
    found = good.select("doc_id", "item_id", "reworded", F.explode("places").alias("q"))
    found = found.groupBy("doc_id", "item_id").agg(F.collect_set("q").alias("places"), F.max("reworded").alias("reworded"))
    found = found.join(totals, "item_id")

    def counted(some: Column, windows: Column) -> Column:
        amount, whole = F.size(some).cast("bigint"), windows.cast("bigint")
        return F.struct((amount / whole).alias("share"), amount.alias("found"), whole.alias("windows"))

    of_rich = F.when(F.size("rich") > 0, counted(F.array_intersect("places", "rich"), F.size("rich")))
    best = F.greatest(of_rich, counted(F.col("places"), F.col("every")))
    found = found.withColumn("best", best).filter(F.col("best.share") >= coverage)
    found = found.withColumnRenamed("item_id", "item").join(ids, "item")
    return found.select("doc_id", "item_id", "best.found", "best.windows", F.col("best.share").alias("coverage"), "reworded")


def _slotted(words: str) -> Column:
    return F.arrays_overlap(F.col(words), F.array(*[F.lit(p) for p in (NUMBER, NAME, UNIT)]))


def _checked(runs: DataFrame, said: DataFrame, items: DataFrame, window: int) -> DataFrame:
    """Runs without the windows of inconsistent slots, where a value of the item stands for two of the document."""
    met = runs.join(said, "doc_id").join(items, "item_id")
    covered = f"exists(places, q -> s >= q AND s < q + {window})"
    slots = F.expr(
        f"filter(sequence(0, size(words) - 1), s -> element_at(words, s + 1) IN ('{NUMBER}', '{NAME}', '{UNIT}') AND {covered})"
    )
    met = met.withColumn("slots", slots)
    pairs = F.expr(
        "array_distinct(transform(slots, s -> struct(get(said, s) AS ours, get(doc_said, cast(s + distance AS int)) AS theirs)))"
    )
    met = met.withColumn("pairs", pairs)
    changed = F.exists("pairs", lambda x: ~x["ours"].eqNullSafe(x["theirs"]))
    met = met.withColumn("reworded", changed)
    same = F.size("pairs") == F.size(F.array_distinct(F.col("pairs.ours")))
    torn = F.expr("filter(slots, s -> size(filter(pairs, x -> x.ours <=> get(said, s))) > 1)")
    met = met.withColumn("torn", F.when(same, F.array().cast("array<int>")).otherwise(torn))
    whole = F.expr(f"filter(places, q -> NOT exists(torn, s -> s >= q AND s < q + {window}))")
    return met.withColumn("places", whole).filter(F.size("places") > 0)

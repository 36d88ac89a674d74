"""Secret scans with an incremental ledger of blobs.

Every version of a file is addressed by the hash of its content. The ledger remembers
which blobs each version of each rule has seen, with what was found. A scan reads only
the blobs that are new, or old blobs for new rules, one holder of each; findings are
joined back to every path that holds the blob.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.llm.arrays import bound, running
from tallyward.llm.store import Scratch


@dataclass(frozen=True)
class Rule:
    """A kind of secret.

    Matches are taken leftmost first and do not overlap; of these, the ones whose
    ``group`` has fewer than ``least`` characters are dropped afterwards. ``hint`` is a
    cheap necessary condition on the text, as SQL over ``text``.
    """

    kind: str
    pattern: str
    least: int
    group: int = 0
    version: int = 1
    hint: str = "true"


#: The kinds every scan has, in their order.
BASE = (
    Rule(
        "assign",
        r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        6,
        2,
    ),
    # shorter runs would be dropped afterwards; asking for the length keeps them from being matches at all
    Rule("access", r"AKIA[A-Z0-9]{16,}", 20, hint="contains(text, 'AKIA')"),
    Rule("hex", r"[0-9a-f]{24,}", 24),
)
#: Further kinds: published formats of tokens and keys.
EXTRA = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", 40, hint="text rlike 'gh[pousr]_'"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 20, hint="contains(text, '.eyJ')"),
    Rule("pem", r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----", 20, hint="contains(text, 'PRIVATE KEY-----')"),
)
RULES = BASE + EXTRA

_SPAN = "struct<start:bigint,rank:int,kind:string,stop:bigint>"
_LEDGER = "blob string, scanned array<struct<kind:string,version:int,spans:array<struct<start:bigint,stop:bigint>>>>"


def _matches(rule: Rule) -> Column:
    """Start and end, in code points, of the rule's matches in ``text``.

    The gaps between matches and the matches themselves come from two passes of the same
    pattern; running sums of their lengths give the places.
    """
    text, pattern = F.col("text"), F.lit(rule.pattern)
    gaps = F.transform(F.split(text, rule.pattern, -1), lambda g: F.char_length(g).cast("bigint"))
    whole = F.transform(F.regexp_extract_all(text, pattern, F.lit(0)), lambda m: F.char_length(m).cast("bigint"))
    tested = (
        F.transform(F.regexp_extract_all(text, pattern, F.lit(rule.group)), lambda m: F.char_length(m).cast("bigint"))
        if rule.group
        else F.array().cast("array<bigint>")
    )

    def found(lengths: Column) -> Column:
        stops = running(F.zip_with(F.slice(lengths["gaps"], F.lit(1), F.size(lengths["whole"])), lengths["whole"], lambda g, m: g + m))
        tested_on = lengths["tested"] if rule.group else lengths["whole"]
        matches = F.arrays_zip(stops.alias("stop"), lengths["whole"].alias("whole"), tested_on.alias("long"))
        kept = F.filter(matches, lambda m: m["long"] >= rule.least)
        return F.transform(kept, lambda m: F.struct((m["stop"] - m["whole"]).alias("start"), m["stop"].alias("stop")))

    spans = bound(F.struct(gaps.alias("gaps"), whole.alias("whole"), tested.alias("tested")), found)
    likely = F.expr(rule.hint) & F.col("text").rlike(rule.pattern)
    return F.when(likely, spans).otherwise(F.array().cast("array<struct<start:bigint,stop:bigint>>"))


def empty_ledger(spark) -> DataFrame:
    return spark.createDataFrame([], _LEDGER)


def scan_blobs(versions: DataFrame, ledger: DataFrame | None = None, rules: Sequence[Rule] = RULES) -> DataFrame:
    """The rows to append to the ledger: per blob what its unseen rule versions found.

    ``versions`` has ``path, blob, text``. Of the paths that hold a blob the smallest one is read.
    """
    holders = versions.groupBy("blob").agg(F.min("path").alias("path"))
    wanted = F.array(*[F.concat_ws(":", F.lit(r.kind), F.lit(r.version)) for r in rules])
    if ledger is None:
        holders = holders.withColumn("wanted", wanted)
    else:
        pairs = holders.select("path", "blob", F.explode(wanted).alias("rule"))
        past = ledger.select("blob", F.explode("scanned").alias("s"))
        past = past.select("blob", F.concat_ws(":", "s.kind", "s.version").alias("rule"))
        unseen = pairs.join(past, ["blob", "rule"], "left_anti")
        holders = unseen.groupBy("blob", "path").agg(F.collect_set("rule").alias("wanted"))
    holders = holders.select("blob", F.col("path").alias("_path"), "wanted")
    texts = versions.join(holders, "blob").filter(F.col("path").eqNullSafe(F.col("_path"))).select("blob", "text", "wanted")
    scans = [
        F.when(
            F.array_contains("wanted", f"{r.kind}:{r.version}"),
            F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version"), _matches(r).alias("spans")),
        )
        for r in rules
    ]
    scanned = F.filter(F.array(*scans), lambda s: s.isNotNull()).alias("scanned")
    return texts.select("blob", scanned).dropDuplicates(["blob"])


def addressed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``path, blob, text``: the rows' content hash; a null text is empty."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("path"), text.alias("text"))
    return rows.select("path", F.sha2("text", 256).alias("blob"), "text")


def find_secrets(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    ledger: DataFrame | None = None,
    rules: Sequence[Rule] = RULES,
) -> tuple[DataFrame, DataFrame]:
    """The rows with their findings, and the grown ledger.

    Findings are ``doc_id, blob, spans``: an array of ``start, rank, kind, stop`` by start,
    then by the rules' order; one row per row of ``docs``.

    Defined cases: a null text is an empty one, which has no secrets. Rows without id and
    repeated rows are rows like any other. An empty table gives empty results. Other
    columns are not read.
    """
    spark = docs.sparkSession
    store = Scratch(spark, "secrets")
    versions = addressed(docs, id_col, text_col)
    fresh = store.keep(scan_blobs(versions, ledger, rules), "ledger")
    grown = fresh if ledger is None else ledger.select("blob", "scanned").union(fresh)
    ranks = F.create_map(*[F.lit(x) for k, r in enumerate(rules) for x in (f"{r.kind}:{r.version}", k)])
    each = grown.select("blob", F.explode("scanned").alias("s")).select("blob", "s.*").filter(F.size("spans") > 0)
    ranked = each.withColumn("rank", ranks[F.concat_ws(":", "kind", "version")]).filter("rank IS NOT NULL")
    one = F.transform(
        "spans", lambda s: F.struct(s["start"].alias("start"), F.col("rank"), F.col("kind"), s["stop"].alias("stop"))
    )
    # a blob's findings: bounded by its own text
    by_blob = ranked.groupBy("blob").agg(F.sort_array(F.flatten(F.collect_list(one))).alias("spans"))
    found = versions.select("path", "blob").join(by_blob, "blob", "left")
    none = F.array().cast(f"array<{_SPAN}>")
    return found.select(F.col("path").alias("doc_id"), "blob", F.coalesce("spans", none).alias("spans")), grown


def earlier_version(docs: DataFrame) -> DataFrame:
    """The documents before their last edit, to scan first: every other one, by the checksum of its id, without its last line."""
    edited = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 2 == 0
    text = F.col("text").cast("string")
    before = F.substring_index(text, "\n", -1)
    cut = F.left(text, F.greatest(F.char_length(text) - F.char_length(before) - 1, F.lit(0)))
    return docs.select("doc_id", F.when(edited, cut).otherwise(text).alias("text"))


def digest(findings: DataFrame) -> DataFrame:
    """Counts and texts of the findings, one row each."""
    base = F.filter("spans", lambda s: s["rank"] < len(BASE))

    def told(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return findings.select(
        "doc_id", *[count(r.kind) for r in BASE], F.sha2(told(base), 256).alias("base_sha256"), told(F.col("spans")).alias("spans")
    )


def masked(text: Column, spans: Column, mask: str = "[secret]") -> Column:
    """The text with every span, or run of overlapping spans, replaced by the mask."""
    zero = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        between = F.substring(text, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int"))
        fresh = s["start"] >= acc["at"]
        out = F.when(fresh, F.concat(acc["out"], between, F.lit(mask))).otherwise(acc["out"])
        return F.struct(F.greatest(acc["at"], s["stop"]).alias("at"), out.alias("out"))

    done = F.aggregate(spans, zero, step)
    return F.concat(done["out"], F.substring(text, (done["at"] + 1).cast("int"), F.lit(2**31 - 1)))

"""Secret scans with an incremental blob ledger.

Every version of every path is addressed by the SHA-256 of its text. The ledger
holds one row for each blob and rule version that was ever scanned, also when
nothing was found. A scan reads only the blobs that lack a ledger row for some
wanted rule version, once for all paths that share the text, and the findings
are joined back to all of them. DataFrame functions only.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomline.llm.common import text_or_empty, written


@dataclass(frozen=True)
class Rule:
    """Leftmost non-overlapping matches of pattern; those whose `group` has
    fewer than `least` characters are dropped after matching."""

    kind: str
    version: int
    pattern: str
    group: int = 0
    least: int = 1

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


# The base rules.
BASE_RULES = (
    Rule(
        "assign",
        1,
        "(?i)(password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        group=2,
        least=6,
    ),
    Rule("access", 1, "AKIA[A-Z0-9]+", least=20),
    Rule("hex", 1, "[0-9a-f]+", least=24),
)
# Kinds this library adds: key file headers and signed web tokens.
MORE_RULES = (
    Rule("pem", 1, "-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    # The first part is taken whether or not the others follow, and only a match with
    # them is kept: a long run of `eyJeyJ...` is then read once, not once for each start.
    Rule(
        "jwt",
        1,
        "eyJ[A-Za-z0-9_-]{8,}(\\.[A-Za-z0-9_-]{8,}\\.[A-Za-z0-9_-]{8,})?",
        group=1,
        least=18,
    ),
)
RULES = BASE_RULES + MORE_RULES

LEDGER_SCHEMA = "blob string, kind string, version int, spans array<struct<start:bigint,end:bigint>>"


def blob_id(text: str = "text") -> Column:
    return F.sha2(text_or_empty(text), 256)


def long_enough(rule: Rule) -> str:
    """A pattern with a match in a text only if the rule may have a kept one.

    For a single class the least length can be put into the pattern itself:
    its matches are then the long runs only, and no short one is counted.
    """
    return {
        "[0-9a-f]+": f"[0-9a-f]{{{rule.least},}}",
        "AKIA[A-Z0-9]+": f"AKIA[A-Z0-9]{{{max(rule.least - 4, 1)},}}",
    }.get(rule.pattern, rule.pattern)


def _pieces(rule: Rule, todo: Column) -> Column:
    """array<struct<kind, version, gap, size, ok>>: the matches of a rule with
    the number of code points between them; null where there is none."""
    pattern = F.lit(long_enough(rule))
    text = F.col("text")
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    judged = F.regexp_extract_all(text, pattern, F.lit(rule.group)) if rule.group else found
    gaps = F.split(text, long_enough(rule), -1)
    lengths = F.zip_with(
        F.zip_with(found, judged, lambda a, b: F.struct(F.length(a).alias("n"), F.length(b).alias("m"))),
        F.slice(gaps, F.lit(1), F.size(found)),
        lambda s, g: F.struct(
            F.length(g).alias("gap"), s["n"].alias("size"), (s["m"] >= rule.least).alias("ok")
        ),
    )
    return F.struct(
        F.lit(rule.kind).alias("kind"),
        F.lit(rule.version).alias("version"),
        todo.alias("todo"),
        F.when(todo & text.rlike(long_enough(rule)), lengths).alias("found"),
    )


def scan(docs: DataFrame, rules: Sequence[Rule] = RULES, ledger: DataFrame | None = None) -> DataFrame:
    """New ledger rows: blob, kind, version, spans (start and end in code points).

    docs has a column text; other columns are not read. One row comes out for
    each distinct text and each rule version that the ledger lacks, with an
    empty list where nothing is found. Null texts are the empty blob. Repeated
    rows are one blob. An empty table gives no rows. Equal texts meet in the
    map-side part of the grouping, so a text with very many copies is one row
    for each task. The places of matches come from a running sum over one text.
    """
    texts = docs.select(blob_id().alias("blob"), text_or_empty().alias("text"))
    if ledger is None:
        blobs = texts.groupBy("blob").agg(F.first("text").alias("text"))
        blobs = blobs.withColumn("seen", F.array().cast("array<string>"))
    else:
        keys = [r.key for r in rules]
        seen = (
            ledger.select("blob", F.concat_ws("@", "kind", F.col("version").cast("string")).alias("key"))
            .filter(F.col("key").isin(keys))
            .groupBy("blob")
            .agg(F.collect_set("key").alias("seen"))
        )
        done = seen.filter(F.size("seen") >= len(set(keys))).select("blob")
        blobs = texts.join(done, "blob", "left_anti").groupBy("blob").agg(F.first("text").alias("text"))
        blobs = blobs.join(seen, "blob", "left").withColumn(
            "seen", F.coalesce("seen", F.array().cast("array<string>"))
        )
    per_rule = F.array(*[_pieces(r, ~F.array_contains("seen", r.key)) for r in rules])
    rows = (
        blobs.select("blob", F.explode(per_rule).alias("r"))
        .filter("r.todo")
        .select("blob", "r.kind", "r.version", F.posexplode_outer("r.found").alias("i", "m"))
        .select("blob", "kind", "version", "i", "m.gap", "m.size", "m.ok")
    )
    run = Window.partitionBy("blob", "kind", "version").orderBy("i")
    places = rows.withColumn("end", F.sum(F.col("gap") + F.col("size")).over(run).cast("bigint"))
    span = F.struct(
        (F.col("end") - F.col("size")).cast("bigint").alias("start"), F.col("end").alias("end")
    )
    return places.groupBy("blob", "kind", "version").agg(
        F.sort_array(F.collect_list(F.when(F.col("ok"), span))).alias("spans")
    )


def findings(docs: DataFrame, ledger: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """The columns of docs, and spans: array<struct<start, place, end, kind>>,
    which takes the place of a column of that name.

    Every row of docs comes back once, repeated rows and null paths included.
    place is the rule's place in `rules`; spans are sorted by start, then place.
    """
    place = F.create_map(*[x for k, r in enumerate(rules) for x in (F.lit(r.key), F.lit(k))])
    key = F.concat_ws("@", "kind", F.col("version").cast("string"))
    entry = F.transform(
        "spans",
        lambda s: F.struct(
            s["start"].alias("start"),
            F.col("place").alias("place"),
            s["end"].alias("end"),
            F.col("kind").alias("kind"),
        ),
    )
    by_blob = (
        ledger.filter(F.size("spans") > 0)
        .withColumn("place", place[key])
        .filter(F.col("place").isNotNull())
        .groupBy(F.col("blob").alias("__blob"))
        .agg(F.sort_array(F.flatten(F.collect_list(entry))).alias("__spans"))
    )
    addressed = docs.withColumn("__blob", blob_id())
    joined = addressed.join(by_blob, "__blob", "left")
    none = F.array().cast("array<struct<start:bigint,place:int,end:bigint,kind:string>>")
    return joined.select(
        *[F.col(c) for c in docs.columns if c.lower() != "spans"],
        F.coalesce("__spans", none).alias("spans"),
    )


def of_kind(spans: Column, kinds: Sequence[str]) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin(list(kinds)))


def span_string(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(
        F.transform(
            spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
        ),
        ",",
    )


def document_secrets(docs: DataFrame, ledger: DataFrame | None = None) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans for each document.

    The ledger's new rows are written to the shared folder first; a next run
    that is given them scans only what they lack.
    """
    docs = docs.select("doc_id", "text")
    fresh = written(scan(docs, RULES, ledger), "secret-ledger")
    known = fresh if ledger is None else ledger.unionByName(fresh)
    found = findings(docs, known).select("doc_id", "spans")
    base = [r.kind for r in BASE_RULES]
    spans = F.col("spans")
    counts = [F.size(of_kind(spans, [k])).cast("bigint").alias(f"n_{k}") for k in base]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(span_string(of_kind(spans, base)), 256).alias("base_sha256"),
        span_string(spans).alias("spans"),
    )

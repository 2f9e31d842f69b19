"""Quality rules: base limits and robust multivariate outliers.

Each document becomes a short vector of transformed text statistics. For every
language and source a minimum-covariance-determinant estimate is found by
concentration steps: the mean and covariance of the three quarters of rows that
are nearest by the last estimate give the next one. Rows whose Mahalanobis
distance from the final estimate is beyond the cutoff are rejected.

All of it is DataFrame functions. A step is one grouping by (group, distance
bin) with partial sums, so a group of any size never meets in one task; sums are
of whole numbers, so the result does not depend on the order of rows.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomline.llm.common import BLANK_CHARS, text_or_empty, word_list, written

# The base rules.
MIN_WORDS = 50
REPEAT_PERCENT = 50
SYMBOLS = "#*$%&|<>"

# Statistics are whole numbers of 1/UNIT, so that sums are exact.
UNIT = 512
STATISTICS = ("log_words", "log_word_length", "symbol_share", "dup_line_share", "repeat_share")
#: Smallest standard deviation of each statistic, in its own units. It takes the
#: place of a smaller one only: a statistic that does not scatter at all in a
#: group is not held against a last digit.
FLOORS = (0.1, 0.02, 0.05, 0.08, 0.08)
#: Share of a group's rows that an estimate is made of.
CORE = 0.75
#: Starts of each estimate: quartiles, all rows, and rows drawn by the hash of their
#: vector, one of DRAWN each. All take STEPS steps; the one of least determinant goes on
#: until its determinant falls by less than LEAST_FALL of a natural logarithm.
STARTS = 5
DRAWN = 8
STEPS = 2
LEAST_FALL = 1e-9
#: A group with fewer rows is held against its whole language, a language with
#: fewer against all rows.
MIN_GROUP = 200
#: Probability of a row within the cutoff, were the vectors normal.
CUTOFF = 0.999
# Distances are sorted into bins of 1/BINS of a natural logarithm.
BINS = 32


def chi2_cdf(x: float, dof: int) -> float:
    """Chi-square distribution function, by the series of the lower gamma."""
    if x <= 0:
        return 0.0
    a, y = dof / 2, x / 2
    term = total = 1 / a
    k = a
    while term > total * 1e-16:
        k += 1
        term *= y / k
        total += term
    return total * math.exp(a * math.log(y) - y - math.lgamma(a))


def chi2_quantile(p: float, dof: int) -> float:
    low, high = 0.0, 1.0
    while chi2_cdf(high, dof) < p:
        high *= 2
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if chi2_cdf(mid, dof) < p else (low, mid)
    return high


def consistency(core: float, dof: int) -> float:
    """What the covariance of the nearest `core` of normal rows is divided by."""
    return chi2_cdf(chi2_quantile(core, dof), dof + 2) / core


def _repeat_words(docs: DataFrame) -> DataFrame:
    """Adds n_repeat_words from the array words.

    Windows are compared by a 64-bit hash of their three words. Only texts with
    a repeated window pay for the sort that finds its places.
    """
    w = F.col("words")
    grams = F.when(
        F.size("words") >= 3,
        F.transform(F.sequence(F.lit(0), F.size("words") - 3), lambda i: F.xxhash64(w[i], w[i + 1], w[i + 2])),
    )
    docs = docs.withColumn("grams", grams)
    repeated = F.size(F.array_distinct("grams")) < F.size("grams")
    ordered = F.when(
        repeated,
        F.sort_array(F.transform("grams", lambda g, i: F.struct(g.alias("g"), i.alias("i")))),
    )
    docs = docs.withColumn("ordered", ordered).drop("grams", "words")
    o = F.col("ordered")

    def twin(x: Column, j: Column) -> Column:
        beside = [F.coalesce(F.get(o, j + step)["g"] == x["g"], F.lit(False)) for step in (-1, 1)]
        return F.when(beside[0] | beside[1], x["i"])

    places = F.sort_array(F.filter(F.transform(o, twin), lambda i: i.isNotNull()))
    docs = docs.withColumn("places", places).drop("ordered")
    start = F.struct(F.lit(-3).alias("last"), F.lit(0).cast("bigint").alias("n"))
    covered = F.aggregate(
        "places",
        start,
        lambda a, i: F.struct(
            i.alias("last"), (a["n"] + F.least(F.lit(3), i - a["last"])).cast("bigint").alias("n")
        ),
        lambda a: a["n"],
    )
    return docs.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("bigint")).drop("places")


def text_statistics(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source, the base counts of each text, and n_chars, n_lines.

    Null texts have no words. Every row of docs gives one row.
    """
    text = F.col("text")
    removed = lambda chars: F.length(text) - F.length(F.translate(text, chars, ""))
    docs = docs.select("doc_id", "lang", "source", text_or_empty().alias("text"))
    # A line with a word is one that is not empty without its blanks.
    with_word = F.filter(
        F.split(text, "\n", -1), lambda x: F.length(F.translate(x, BLANK_CHARS, "")) > 0
    )
    docs = docs.select(
        "doc_id",
        "lang",
        "source",
        word_list(text).alias("words"),
        with_word.alias("lines"),
        F.length(text).cast("bigint").alias("n_chars"),
        (F.length(F.translate(text, BLANK_CHARS, ""))).cast("bigint").alias("word_chars"),
        removed(SYMBOLS).cast("bigint").alias("n_symbols"),
    )
    docs = docs.withColumns(
        {
            "n_words": F.size("words").cast("bigint"),
            "n_lines": F.size("lines").cast("bigint"),
            "n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint"),
        }
    ).drop("lines")
    return _repeat_words(docs)


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words")
    )


def _vector() -> list[Column]:
    """The statistics as whole numbers of 1/UNIT."""
    words = F.greatest(F.col("n_words"), F.lit(1))
    values = (
        F.log1p(F.col("n_words")),
        F.log1p(F.col("word_chars") / words),
        F.sqrt(F.col("n_symbols") / F.greatest(F.col("n_chars"), F.lit(1))),
        F.sqrt(F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1))),
        F.sqrt(F.col("n_repeat_words") / words),
    )
    return [F.round(v * UNIT).cast("bigint").alias(f"x{k}") for k, v in enumerate(values)]


P = len(STATISTICS)
PAIRS = [(i, j) for i in range(P) for j in range(i + 1)]


def _first_estimate(rows: DataFrame) -> DataFrame:
    """Medians, and a diagonal covariance from quartiles, of each group."""
    long = rows.select("g", F.posexplode(F.array(*[F.col(f"x{k}") for k in range(P)])).alias("k", "x"))
    counted = long.groupBy("g", "k", "x").agg(F.count("*").alias("n"))
    upto = Window.partitionBy("g", "k").orderBy("x")
    whole = Window.partitionBy("g", "k")
    ranked = counted.withColumn("c", F.sum("n").over(upto)).withColumn("all", F.sum("n").over(whole))
    at = lambda q: F.min(F.when(F.col("c") >= q * F.col("all"), F.col("x")))
    quartiles = ranked.groupBy("g", "k").agg(at(0.25).alias("a"), at(0.5).alias("m"), at(0.75).alias("b"))
    # 1.349: the distance of a normal distribution's quartiles in standard deviations.
    sd = (F.col("b") - F.col("a")) / 1.349
    part = quartiles.select("g", "k", F.col("m").cast("double").alias("m"), (sd * sd).alias("v"))
    return part.groupBy("g").agg(
        *[F.max(F.when(F.col("k") == k, F.col("m"))).alias(f"m{k}") for k in range(P)],
        *[
            F.max(F.when(F.col("k") == i, F.col("v"))).alias(f"c{i}{j}") if i == j else F.lit(0.0).alias(f"c{i}{j}")
            for i, j in PAIRS
        ],
    )


def _with_factors(estimate: DataFrame) -> DataFrame:
    """Adds the lower Cholesky factor l{i}{j} of the covariance, and log_det, the logarithm
    of its determinant, floors included.

    The scatter that a statistic has beside the ones before it is its own or the
    floor, whichever is larger.
    """
    for i, j in PAIRS:
        rest = F.col(f"c{i}{j}")
        for k in range(j):
            rest = rest - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
        least = F.lit((FLOORS[i] * UNIT) ** 2)
        value = F.sqrt(F.greatest(rest, least)) if i == j else rest / F.col(f"l{j}{j}")
        estimate = estimate.withColumn(f"l{i}{j}", value)
    return estimate.withColumn("log_det", reduce(lambda a, b: a + b, [2 * F.log(f"l{i}{i}") for i in range(P)]))


def _written_estimate(estimate: DataFrame) -> DataFrame:
    """The estimate with its factors as a table: what is joined with it has columns to
    read, not the terms they are made of, which would make plans of megabytes."""
    return written(_with_factors(estimate), "quality-estimate")


def _distances(rows: DataFrame, estimate: DataFrame, how: str = "left") -> DataFrame:
    """rows with d2, the squared Mahalanobis distance by an estimate with factors; null where
    the group has none."""
    factors = estimate.select("g", *[f"m{k}" for k in range(P)], *[f"l{i}{j}" for i, j in PAIRS])
    joined = rows.join(factors, "g", how)
    for i in range(P):
        rest = F.col(f"x{i}") - F.col(f"m{i}")
        for k in range(i):
            rest = rest - F.col(f"l{i}{k}") * F.col(f"z{k}")
        joined = joined.withColumn(f"z{i}", rest / F.col(f"l{i}{i}"))
    d2 = reduce(lambda a, b: a + b, [F.col(f"z{i}") * F.col(f"z{i}") for i in range(P)])
    return joined.withColumn("d2", d2).select(*rows.columns, "d2")


def _next_estimate(rows: DataFrame, estimate: DataFrame) -> DataFrame:
    """Mean and covariance of the rows in the nearest CORE of each group.

    The nearest rows are taken up to the bin of distances in which the share is
    reached, so rows at equal distance are taken together.
    """
    d = _distances(rows, estimate, "inner")  # not of starts that no row was drawn for
    binned = d.withColumn("bin", F.floor(F.log(F.col("d2") + 1e-3) * BINS))
    sums = binned.groupBy("g", "bin").agg(
        F.count("*").alias("n"),
        *[F.sum(f"x{k}").alias(f"s{k}") for k in range(P)],
        *[F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"q{i}{j}") for i, j in PAIRS],
    )
    before = Window.partitionBy("g").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("g")
    near = (
        sums.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
        .withColumn("all", F.sum("n").over(whole))
        .filter(F.col("before") < CORE * F.col("all"))
    )
    total = near.groupBy("g").agg(
        F.sum("n").alias("n"),
        *[F.sum(f"s{k}").alias(f"s{k}") for k in range(P)],
        # products of many rows: decimals do not overflow
        *[F.sum(F.col(f"q{i}{j}").cast("decimal(38,0)")).alias(f"q{i}{j}") for i, j in PAIRS],
    )
    return _moments(total)


def _sums(rows: DataFrame) -> DataFrame:
    """Number, sums and sums of products of the rows of each group."""
    return rows.groupBy("g").agg(
        F.count("*").alias("n"),
        *[F.sum(f"x{k}").alias(f"s{k}") for k in range(P)],
        *[F.sum((F.col(f"x{i}") * F.col(f"x{j}")).cast("decimal(38,0)")).alias(f"q{i}{j}") for i, j in PAIRS],
    )


def _moments(total: DataFrame) -> DataFrame:
    """Mean and covariance of each group from its sums."""
    n = F.col("n").cast("double")
    return total.select(
        "g",
        *[(F.col(f"s{k}") / n).alias(f"m{k}") for k in range(P)],
        *[
            (
                (F.col(f"q{i}{j}").cast("double") / n - (F.col(f"s{i}") / n) * (F.col(f"s{j}") / n))
                / consistency(CORE, P)
            ).alias(f"c{i}{j}")
            for i, j in PAIRS
        ],
    )


def _starts(rows: DataFrame) -> DataFrame:
    """The starts of each group, whose names are then `start:group`."""
    named = lambda k: F.concat(F.lit(f"{k}:"), F.col("g")).alias("g")
    columns = [f"m{k}" for k in range(P)] + [f"c{i}{j}" for i, j in PAIRS]
    found = _first_estimate(rows).select(named(0), *columns)
    # one scan: a row is in the sums of all rows, and of the draw that takes it
    drawn = F.pmod(F.xxhash64(*[f"x{k}" for k in range(P)]), F.lit(DRAWN))
    taken = F.array_compact(
        F.array(F.lit(1), *[F.when(drawn == k - 2, F.lit(k)) for k in range(2, STARTS)])
    )
    parts = rows.withColumn("start", F.explode(taken))
    parts = parts.withColumn("g", F.concat(F.col("start").cast("string"), F.lit(":"), F.col("g")))
    return found.unionByName(_moments(_sums(parts)).select("g", *columns))


def least_determinant(rows: DataFrame) -> DataFrame:
    """g, means m{k}, covariances c{i}{j} and their factors, of rows g, x{k}: of several starts
    the one whose nearest CORE of the rows has the least determinant, taken to its end.

    A step whose determinant is no lower leaves a group as it is, so the steps end.
    """
    every = F.array(*[F.concat(F.lit(f"{k}:"), F.col("g")) for k in range(STARTS)])
    spread = rows.withColumn("g", F.explode(every))
    estimate = _written_estimate(_starts(rows))
    for _ in range(STEPS):
        estimate = _written_estimate(_next_estimate(spread, estimate))
    columns = [c for c in estimate.columns if c != "g"]
    cut = F.locate(":", F.col("g"))
    group = F.expr("substring(g, locate(':', g) + 1)")
    start = F.substring("g", F.lit(1), cut - 1).cast("int")
    # of equal determinants the first start
    order = F.struct("log_det", start.alias("start"))
    best = estimate.groupBy(group.alias("name")).agg(F.min_by(F.struct(*columns), order).alias("best"))
    current = written(best.select(F.col("name").alias("g"), "best.*"), "quality-estimate")
    while True:
        fresh = _written_estimate(_next_estimate(rows, current)).select("g", F.struct(*columns).alias("fresh"))
        falls = F.coalesce(F.col("fresh.log_det") < F.col("log_det") - LEAST_FALL, F.lit(False))
        chosen = F.when(falls, F.col("fresh")).otherwise(F.struct(*columns))
        stepped = current.join(fresh, "g", "left").select("g", falls.alias("falls"), chosen.alias("best"))
        stepped = written(stepped.select("g", "best.*", "falls"), "quality-estimate")
        if stepped.filter("falls").isEmpty():
            return current
        current = stepped.drop("falls")


def _levels(rows: DataFrame) -> DataFrame:
    """pair, g, groups: whose estimate a pair's rows are held against (null: none),
    and the estimates that they are part of."""
    counts = rows.groupBy("pair", "language").agg(F.sum((~F.col("base_failed")).cast("bigint")).alias("n_pair"))
    counts = written(counts, "quality-counts")
    of_language = counts.groupBy("language").agg(
        F.sum("n_pair").alias("n_language"), (F.min("n_pair") < MIN_GROUP).alias("use_language")
    )
    of_all = of_language.agg(
        F.sum("n_language").alias("n_all"), (F.min("n_language") < MIN_GROUP).alias("use_all")
    )
    levels = counts.join(of_language, "language").crossJoin(F.broadcast(of_all))
    pair = F.when(F.col("n_pair") >= MIN_GROUP, F.col("pair"))
    language = F.when((F.col("n_language") >= MIN_GROUP) & F.col("use_language"), F.col("language"))
    everything = F.when((F.col("n_all") >= MIN_GROUP) & F.col("use_all"), F.lit("all"))
    return levels.select(
        "pair",
        F.coalesce(pair, language, everything).alias("g"),
        F.array_compact(F.array(pair, language, everything)).alias("groups"),
    )


def quality_verdicts(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, distance2, kept: one row for each row of docs.

    A row is kept if it passes the base rules and its distance is within the
    cutoff. Estimates are made of the rows that pass the base rules only. Null
    languages and sources are values of their own. A language and source with
    fewer than MIN_GROUP of them is held against the estimate of all rows of its
    language, a language with fewer against that of all rows; if those are fewer
    too, there is no estimate, the distance is null and the base rules decide
    alone. Null and empty texts fail the base rules. An empty table gives no rows.
    """
    rows = text_statistics(docs).select("*", base_failed().alias("base_failed"), *_vector())
    # JSON leaves nulls out, so a null and a value never make the same key.
    rows = rows.withColumn("pair", F.concat(F.lit("pair"), F.to_json(F.struct("lang", "source"))))
    rows = rows.withColumn("language", F.concat(F.lit("language"), F.to_json(F.struct("lang"))))
    rows = written(rows.drop("lang", "source"), "quality-statistics")
    rows = rows.join(_levels(rows), "pair").drop("pair", "language")
    rows = written(rows, "quality-groups")
    good = rows.filter("not base_failed").select(F.explode("groups").alias("g"), *[f"x{k}" for k in range(P)])
    judged = _distances(rows, least_determinant(good))
    within = F.coalesce(F.col("d2") <= chi2_quantile(CUTOFF, P), F.lit(True))
    return judged.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        F.col("d2").alias("distance2"),
        (~F.col("base_failed") & within).alias("kept"),
    )

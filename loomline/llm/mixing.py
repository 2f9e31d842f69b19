"""Mixing sources to target weights by cube-method balanced sampling.

A source's target of words over its size is the number of times each of its
documents is wanted. The whole part is taken outright; the fraction is an
inclusion probability. The flight phase moves probabilities along directions
that change neither the total of documents nor the total of words of a source,
until they are 0 or 1. It works in blocks of one source; each block leaves two
probabilities or little more, which meet in the blocks of the next level, until a
source is one block. The few that are left there land on the rounding that is
nearest to the target.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomline.llm.common import text_or_empty, word_list, written

WEIGHTS = (1, 2, 3)
CAP = 3
BLOCK = 1000
SEED = 11
_EPS = 1e-9


def document_sizes(docs: DataFrame) -> DataFrame:
    """doc_id, source, size in words (null texts: 0)."""
    sized = docs.select("doc_id", "source", text_or_empty().alias("text"))
    return sized.select("doc_id", "source", F.size(word_list(F.col("text"))).cast("bigint").alias("size"))


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """source, n_docs, source_size, target.

    Sources in code point order, null last, weigh `weights`, repeating, and share
    all words; no target is above `cap` times the source's size. With the sources
    in order of cap over weight, those below the level of the rest are capped:
    the level follows from running sums, one row for each source.
    """
    total = sizes.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.sum((F.col("size") > 0).cast("bigint")).alias("n_docs")
    )
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]), (F.row_number().over(by_name) - 1) % len(weights))
    weighed = total.withColumn("w", weight).withColumn("most", cap * F.col("source_size").cast("double"))
    by_level = Window.orderBy(F.col("most") / F.col("w"), "w", F.col("source").asc_nulls_last())
    everything = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0.0)
    rest = F.sum("source_size").over(everything) - F.coalesce(F.sum("most").over(before), zero)
    share = F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), zero)
    leveled = weighed.withColumn("level", rest / share)
    # the first source that is not capped sets the level of all
    free = F.when(
        F.col("most") >= F.col("level") * F.col("w"),
        F.struct(F.row_number().over(by_level).alias("nth"), F.col("level").alias("level")),
    )
    leveled = leveled.withColumn("free", free)
    level = F.coalesce(F.min("free").over(everything)["level"], F.lit(float("inf")))
    leveled = leveled.withColumn("level", level)
    target = F.when(F.col("most") < F.col("level") * F.col("w"), F.col("most")).otherwise(
        F.col("level") * F.col("w")
    )
    return leveled.select("source", "n_docs", "source_size", target.alias("target"))


def flight(sizes: Sequence[float], chances: Sequence[float], random: np.random.Generator) -> np.ndarray:
    """Chances moved to 0 or 1, but for a few, in the order given.

    The sum of chances and the sum of chance times size stay as they are. Each
    step settles the first open unit, or another that reaches 0 or 1 before it:
    the first moves, and all other open units share what keeps both sums. With
    large units first, what stays open at the end is small. Left open are two
    units, and such as the others cannot make up for (all others of one size).
    """
    p = np.asarray(chances, float).copy()
    s = np.asarray(sizes, float)
    p[p < _EPS], p[p > 1 - _EPS] = 0.0, 1.0
    s = s / max(s.max(initial=0.0), 1.0)
    open_ = np.flatnonzero((p > 0) & (p < 1))
    stuck = 0
    while len(open_) - stuck > 2:
        lead, rest = open_[stuck], open_[stuck + 1 :]
        slack, width = p[rest] * (1 - p[rest]), s[rest]
        a, b, c = slack.sum(), (slack * width).sum(), (slack * width * width).sum()
        det = a * c - b * b
        if det > 1e-12 * a * c:
            x, y = (c - b * s[lead]) / det, (a * s[lead] - b) / det
        elif abs(width[0] - s[lead]) <= 1e-12:
            x, y = 1 / a, 0.0
        else:
            stuck += 1
            continue
        moved = np.concatenate([open_[stuck : stuck + 1], rest])
        u = np.concatenate([[1.0], -slack * (x + y * width)])
        with np.errstate(divide="ignore", invalid="ignore"):
            up = np.where(u > 0, (1 - p[moved]) / u, np.where(u < 0, -p[moved] / u, np.inf)).min()
            down = np.where(u > 0, p[moved] / u, np.where(u < 0, (p[moved] - 1) / u, np.inf)).min()
        q = p[moved] + (up if random.random() * (up + down) < down else -down) * u
        q[q < _EPS], q[q > 1 - _EPS] = 0.0, 1.0
        p[moved] = q
        open_ = np.concatenate([open_[:stuck], moved[(q > 0) & (q < 1)]])
    return p


def land(sizes: Sequence[float], chances: np.ndarray) -> np.ndarray:
    """Open chances rounded one by one, large first, each to the nearer sum of sizes."""
    p = chances.copy()
    over = 0.0
    for k in np.flatnonzero((p > 0) & (p < 1)):
        up, down = over + (1 - p[k]) * sizes[k], over - p[k] * sizes[k]
        over, p[k] = (up, 1.0) if abs(up) < abs(down) else (down, 0.0)
    return p


def _fly(level: int, seed: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        # large documents are settled first: small ones are left for the landing
        rows = rows.sort_values(["size", "doc_id", "nth"], ascending=[False, True, True], kind="stable")
        first = rows.iloc[0]
        random = np.random.Generator(
            np.random.PCG64([seed, level, int(first["block"]), int(first["source_hash"]) % 2**63])
        )
        sizes = rows["size"].to_numpy(float)
        chances = flight(sizes, rows["chance"].to_numpy(float), random)
        if first["blocks"] == 1:
            chances = land(sizes, chances)
        return rows.assign(chance=chances)

    return run


def mix(
    docs: DataFrame, weights: Sequence[int] = WEIGHTS, cap: int = CAP, block: int = BLOCK, seed: int = SEED
) -> DataFrame:
    """doc_id, source, size, source_size, target, copies, taken: a row for each row of docs.

    copies is how often the mix takes the document, taken is copies times size.
    Texts without words, empty or null, have size 0 and are not taken. Null
    sources are one source. Repeated rows are units of their own. The result
    depends on the rows and the seed only, not on their order or partitions. An
    empty table gives no rows. The level of targets is found in one task that
    holds one row for each source.
    """
    sizes = written(document_sizes(docs), "mix-sizes")
    targets = written(source_targets(sizes, weights, cap), "mix-targets")
    same = sizes.groupBy("doc_id", "source", "size").agg(F.count("*").cast("int").alias("m"))
    units = same.withColumn("nth", F.explode(F.sequence(F.lit(1), F.col("m")))).drop("m")
    named = targets.withColumnRenamed("source", "of")
    units = units.join(named, F.col("source").eqNullSafe(F.col("of"))).drop("of")
    wanted = F.when(F.col("size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    state = units.withColumn("wanted", F.least(wanted, F.lit(float(cap)))).select(
        "doc_id",
        "source",
        "size",
        "nth",
        "n_docs",
        "source_size",
        "target",
        F.floor("wanted").cast("bigint").alias("whole"),
        (F.col("wanted") - F.floor("wanted")).alias("chance"),
        F.xxhash64(F.coalesce("source", F.lit(""))).alias("source_hash"),
    )
    schema = state.schema.simpleString()[7:-1]
    settled = (F.col("chance") < _EPS) | (F.col("chance") > 1 - _EPS)
    state = written(state, "mix-units")
    done = [state.filter(settled)]
    open_ = state.filter(~settled)
    level = 0
    while not open_.isEmpty():
        # many stuck units could fill the blocks again: blocks grow with the level
        counts = open_.groupBy(F.col("source").alias("of")).agg(F.count("*").alias("n"))
        dealt = open_.join(counts, F.col("source").eqNullSafe(F.col("of"))).drop("of")
        dealt = dealt.withColumn("blocks", F.ceil(F.col("n") / (block * 2**level))).drop("n")
        place = F.pmod(F.xxhash64("doc_id", "nth", F.lit(level)), F.col("blocks"))
        dealt = dealt.withColumn("block", place)
        flown = dealt.groupBy("source", "block").applyInPandas(
            _fly(level, seed), f"{schema},blocks:bigint,block:bigint".replace(":", " ")
        )
        flown = written(flown.drop("blocks", "block"), "mix-level")
        done.append(flown.filter(settled))
        open_ = flown.filter(~settled)
        level += 1
    every = done[0]
    for part in done[1:]:
        every = every.unionByName(part)
    copies = F.col("whole") + F.round("chance").cast("bigint")
    return every.select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        copies.alias("copies"),
        (copies * F.col("size")).alias("taken"),
    )

"""MinHash near-dedup with tensored banding.

Two collections of GROUPS band hashes are made, each of a band of WIDTH
minhashes. A table key is a pair of one band hash of the first collection and
one of the second, so GROUPS * GROUPS tables need 2 * GROUPS * WIDTH minhashes
only. Texts that meet in a table are checked on their full shingle sets.

At a similarity of 0.8 a pair misses all tables with probability
1 - (1 - (1 - 0.8**WIDTH)**GROUPS)**2, which is 7e-5 here.

Equal word sequences are one node from the start, told apart by two 64-bit hashes.
Members of a bucket are checked and linked as in clusters.py.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomline.llm.clusters import sets_of, similar_components, sketched, word_sets
from loomline.llm.common import written
from loomline.llm.components import connected_components
from loomline.llm.wordhash import U64, minhashes, mix, sequence_hash

SHINGLE = 4
PERCENT = 80
GROUPS = 10
WIDTH = 2
HASHES = 2 * GROUPS * WIDTH
_GENERATOR = np.random.Generator(np.random.PCG64(9))
XORS = _GENERATOR.integers(0, 2**63, HASHES, dtype=U64)
FACTORS = _GENERATOR.integers(0, 2**63, HASHES, dtype=U64) * U64(2) + U64(1)


def bands(words: np.ndarray, shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The band hashes of the two collections; none without shingles."""
    if not len(shingles):
        return shingles[:0], shingles[:0]
    mins = mix(minhashes(shingles, XORS, FACTORS)).reshape(2 * GROUPS, WIDTH)
    band = np.arange(2 * GROUPS, dtype=U64)
    for k in range(WIDTH):
        band = mix(band * U64(0x9E3779B97F4A7C15) + mins[:, k])
    return band[:GROUPS], band[GROUPS:]


def _signatures(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[list] = [[] for _ in range(7)]
            keys = zip(*(batch.column(c).to_pylist() for c in ("doc_id", "t")))
            for (doc_id, t), text in zip(keys, batch.column("text")):
                words, shingles = word_sets(text.as_py(), shingle)
                a, b = sequence_hash(words) if len(words) else (None, None)
                first, second = (x.view(np.int64).tolist() for x in bands(words, shingles))
                for column, value in zip(
                    rows, (doc_id, t, len(shingles), a, b, first, second)
                ):
                    column.append(value)
            longs = pa.list_(pa.int64())
            kinds = (*[pa.int64()] * 5, longs, longs)
            names = ("doc_id", "t", "n_shingles", "h1", "h2", "first", "second")
            yield pa.RecordBatch.from_arrays(
                [pa.array(r, k) for r, k in zip(rows, kinds)], names=list(names)
            )

    return run


SIGNATURE = (
    "doc_id bigint, t bigint, n_shingles bigint, h1 bigint, h2 bigint, "
    "first array<bigint>, second array<bigint>"
)


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row for each row of docs.

    docs has doc_id and text; other columns are not read. A text's set are its
    distinct shingles of lower-cased words; a shorter text is one shingle, and
    null, empty or blank texts have an empty set and are linked with nothing.
    component_id is the least doc_id that can be reached over links, and a
    document is kept if it is its own. Rows with one doc_id are one document: each
    of their texts links as any text does, and what one of them reaches, all with a
    word do. A row with a null doc_id is linked with nothing, has a null component and
    is kept.
    Texts of any length are compared whole. An empty table gives no rows.
    """
    text = F.col("text").cast("binary")
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(text).alias("t"), text.alias("text"))
    signed = written(texts.mapInArrow(_signatures(shingle), SIGNATURE), "near-signatures")
    worded = signed.filter("h1 is not null and doc_id is not null")
    # Equal word sequences are one node, whose number the written table keeps.
    own = F.struct("doc_id", "t")
    classes = worded.groupBy("h1", "h2").agg(
        F.min(own).alias("own"), F.first("first").alias("first"), F.first("second").alias("second")
    )
    classes = written(classes.withColumn("node", F.monotonically_increasing_id()), "near-classes")
    tables = F.transform(
        "first",
        lambda x, i: F.transform(
            "second",
            lambda y, j: F.struct(F.xxhash64(x, y).alias("key"), i.alias("i"), j.alias("j")),
        ),
    )
    members = classes.select(F.explode(F.flatten(tables)).alias("t"), "node").select("t.*", "node")
    shared = members.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select("key")
    buckets = written(members.join(shared, "key"), "near-buckets")
    needed = classes.join(buckets.select("node").distinct(), "node").select("own.*", "node")
    # rows of one id and one text are one text
    found = written(texts.join(needed, ["doc_id", "t"]).dropDuplicates(["node"]).select("node", "text"), "near-texts")
    nodes = written(sketched(found, shingle, bands), "near-nodes")
    labels = similar_components(buckets, nodes, sets_of(found, shingle), percent)
    named = classes.select("h1", "h2", "node", F.col("own.doc_id").alias("least"))
    # an id with several texts joins what they reach
    words = F.struct("h1", "h2")
    several = worded.groupBy("doc_id").agg((F.min(words) != F.max(words)).alias("several")).filter("several")
    ends = written(
        worded.join(several.select("doc_id"), "doc_id").join(named, ["h1", "h2"]).select("doc_id", "node").distinct(), "near-repeated"
    )
    if not ends.isEmpty():
        # links between components: a node, or the component it is in
        if labels is not None:
            ends = ends.join(labels, "node", "left").withColumn("node", F.coalesce("component", "node"))
        first = ends.groupBy("doc_id").agg(F.min("node").alias("b"))
        links = ends.join(first, "doc_id").select(F.col("node").alias("a"), "b")
        if labels is not None:
            links = links.union(labels.select(F.col("node").alias("a"), F.col("component").alias("b")))
        labels = connected_components(links)
    if labels is not None:
        named = named.join(labels, "node", "left").withColumn("group", F.coalesce("component", "node"))
        heads = named.groupBy("group").agg(F.min("least").alias("component_id"))
        named = named.join(heads, "group")
    else:
        named = named.withColumn("component_id", F.col("least"))
    of_class = named.select("h1", "h2", "component_id")
    found = signed.select("doc_id", "n_shingles", "h1", "h2").join(of_class, ["h1", "h2"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return found.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )

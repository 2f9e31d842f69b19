"""What the paragraph operator leaves on disk while it runs."""

from __future__ import annotations

import os

from loomline import staging
from loomline.llm import paragraph_dedup
from loomline.llm.components import connected_components


def left(spark, before: set) -> list[str]:
    """Names of the folders made since that are still there."""
    folders = set(staging._written.get(spark.sparkContext.applicationId, [])) - before
    places = [f.removeprefix("file:").replace("///", "/") for f in folders]
    return sorted(os.path.basename(p).rsplit("-", 1)[0] for p in places if os.path.exists(p))


def test_rounds_of_components_are_deleted(spark):
    before = set(staging._written.get(spark.sparkContext.applicationId, []))
    links = spark.createDataFrame([(k, k + 1) for k in range(40)], "a bigint, b bigint")
    got = connected_components(links)
    assert left(spark, before) == ["component-labels"]
    assert {(r.node, r.component) for r in got.collect()} == {(k, 0) for k in range(41)}


def test_equal_paragraphs_are_in_no_bucket(spark):
    """They were written once for each of their bands and shuffled three times more."""
    words = " ".join(f"w{k}" for k in range(80))
    rows = [(1, 1, words), (2, 2, words), (3, 3, " ".join(f"v{k}" for k in range(80)))]
    texts = spark.createDataFrame(rows, "d bigint, t bigint, text string").selectExpr("d", "t", "binary(text) text")
    buckets, nodes = paragraph_dedup.meeting_paragraphs(texts)
    own = paragraph_dedup.word_and_shingle_hashes(words.encode())
    places = paragraph_dedup.beginnings(own[1], len(own[0]))
    hashes = set(paragraph_dedup.paragraph_hashes(own[0], places)[0].tolist())
    assert {r.node for r in nodes.collect()} == hashes
    # neighbours of one text may share bands, equal ones of two texts share all
    assert buckets.groupBy("key").agg({"node": "count"}).filter("`count(node)` < 2").isEmpty()


def test_texts_are_not_written_again(docs, spark):
    before = set(staging._written.get(spark.sparkContext.applicationId, []))
    passage = " ".join(f"w{k}" for k in range(60))
    got = paragraph_dedup.without_repeated_paragraphs(docs([(k, f"{passage} x{k}") for k in range(3)]))
    assert [r.n_removed > 200 for r in got.orderBy("doc_id").collect()] == [False, True, True]
    assert not {"paragraph-texts", "paragraphs", "paragraphs-met", "paragraph-sets"} & set(left(spark, before))

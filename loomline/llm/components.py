"""Connected components of a table of links."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomline.llm.common import discard, written

#: Links of a task that are contracted.
LINKS = 500_000


def contracted(links: DataFrame) -> DataFrame:
    """Links (a, b) with the same components, of a written table: each task links the ends of its
    own with the least of them that they reach, so few rounds are left to do."""
    tasks = -(-links.count() // LINKS)
    return links.select("a", "b").coalesce(max(tasks, 1)).mapInArrow(_contracted, "a bigint, b bigint")


def _contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = [[batch.column(c).to_numpy() for c in ("a", "b")] for batch in batches]
    if not held:
        return
    a, b = (np.concatenate(x) for x in zip(*held))
    nodes, ends = np.unique(np.append(a, b), return_inverse=True)
    a, b = ends.reshape(2, -1)
    label = least_reachable(len(nodes), a, b)
    yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(nodes[label])], names=["a", "b"])


def least_reachable(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least of n numbers that each can reach over links."""
    label = np.arange(n)
    while True:
        la, lb = label[a], label[b]
        if (la == lb).all():
            return label
        least = np.minimum(la, lb)
        np.minimum.at(label, la, least)
        np.minimum.at(label, lb, least)
        while (label[label] != label).any():
            label = label[label]


def connected_components(links: DataFrame) -> DataFrame:
    """node, component (the least node reachable) for the ends of links (a, b).

    Each round every node takes the least label of its neighbours, then the
    label of its label, so labels travel along a chain in doubling steps. The
    labels are written each round, so a lost executor costs one round's part; those
    of the round before are deleted.
    Only (node, label) pairs move; a node with very many neighbours is reduced
    in the map-side part of the grouping. No links: no rows. Links from a node
    to itself make a component of one.
    """
    both = links.select("a", "b").union(links.select(F.col("b"), F.col("a")))
    both = written(both.distinct(), "component-links")
    labels = written(
        both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b")).select(
            "node", F.least("node", "b").alias("component")
        ),
        "component-labels",
    )
    while True:
        near = (
            both.join(labels.select(F.col("node").alias("b"), "component"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("component").alias("near"))
        )
        stepped = labels.join(near, "node").select(
            "node", F.col("component").alias("old"), F.least("component", "near").alias("component")
        )
        stepped = written(stepped, "component-step")
        jump = stepped.select(F.col("node").alias("component"), F.col("component").alias("root"))
        discard(labels)
        labels = written(
            stepped.join(jump, "component", "left").select(
                "node", "old", F.least(F.coalesce("root", "component"), "component").alias("component")
            ),
            "component-labels",
        )
        discard(stepped)
        if labels.filter("old <> component").isEmpty():
            discard(both)
            return labels.select("node", "component")

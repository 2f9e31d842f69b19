"""Ordinals, split, fraction and caps against plain arithmetic."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from loomline.operators.guards import checked_size
from loomline.operators.ordering import (
    assign_split,
    exclusive_prefix,
    limit_splits,
    mark_split,
    prefix_levels,
    split_sizes,
)
from loomline.sources.tables import lines_from_table, table_positions


def test_exclusive_prefix_over_many_blocks(spark):
    rng = random.Random(2)
    keys = rng.sample(range(-500, 100_000), 400)
    rows = [(k, rng.randint(0, 5)) for k in keys]
    df = spark.createDataFrame(rows, "k bigint, n bigint")
    got = {r.k: r.before for r in exclusive_prefix(df, "k", "n", "before", width=37).collect()}
    total, want = 0, {}
    for k, n in sorted(rows):
        want[k], total = total, total + n
    assert got == want


@pytest.mark.parametrize("levels", [1, 2, 4])
def test_exclusive_prefix_over_sparse_keys(spark, levels):
    rng = random.Random(levels)
    rows = [(rng.randint(-(2**62), 2**62), rng.randint(0, 5)) for _ in range(300)]
    rows += [(k, 1) for k in range(50)]
    df = spark.createDataFrame(rows, "k bigint, n bigint")
    got = {
        r.k: r.before for r in exclusive_prefix(df, "k", "n", "before", 10, levels).collect()
    }
    total, want = 0, {}
    for k, n in sorted(rows):
        want[k], total = total, total + n
    assert got == want


def test_prefix_levels(spark):
    def keys(*ks):
        return spark.createDataFrame([(k,) for k in ks], "k bigint")

    assert prefix_levels(keys(0, 10**9), "k") == 1
    assert prefix_levels(keys(0, 10**11), "k") == 2
    assert prefix_levels(keys(-(2**62), 2**62), "k") == 4
    assert prefix_levels(keys(), "k") == 1


def documents(spark):
    texts = ["a\n\nb", "", " \n\t", "c", "d\ne\nf\n", None, " g"]
    return spark.createDataFrame([(i * 3, t) for i, t in enumerate(texts)], "doc_id bigint, text string")


@pytest.mark.parametrize("width", [1, 4, 1000])
def test_table_positions_are_dense_and_ordered(spark, width):
    rows = sorted(table_positions(documents(spark), width=width).collect())
    assert [(r.doc_id, r.line_no) for r in rows] == [
        (0, 0), (0, 2), (9, 0), (12, 0), (12, 1), (12, 2), (18, 0)
    ]
    assert [r.ord for r in rows] == list(range(7))


def test_line_offsets(spark):
    rows = sorted(lines_from_table(documents(spark), with_offsets=True).collect())
    assert [(r.doc_id, r.byte_offset, r.text) for r in rows] == [
        (0, 0, "a"), (0, 3, "b"), (9, 0, "c"), (12, 0, "d"), (12, 2, "e"), (12, 4, "f"), (18, 0, "g")
    ]


@pytest.mark.parametrize("n", [0, 1, 2, 19, 20, 39, 40, 100, 1000])
@pytest.mark.parametrize("fraction", [0.0, 0.05, 0.29, 1.0])
def test_split_is_a_tail(spark, n, fraction):
    index = spark.range(n).withColumnRenamed("id", "ord")
    size = F.lit(n).cast("bigint")
    rows = sorted(assign_split(index, size, fraction).collect())
    n_val = max(1, int(fraction * n)) if fraction > 0 else 0
    n_val = min(n_val, n)
    assert [r.split for r in rows] == ["train"] * (n - n_val) + ["val"] * n_val
    assert [r.split_ord for r in rows] == [*range(n - n_val), *range(n_val)]


def test_checked_size_fails_inside_a_query(spark):
    one = split_sizes(F.lit(1).cast("bigint"))
    with pytest.raises(Exception, match="train split has no documents"):
        spark.range(1).select(checked_size(one["train"], "train")).collect()
    assert spark.range(1).select(checked_size(one["val"], "val")).first()[0] == 1


def test_fraction_is_a_double(spark):
    columns = split_sizes(F.lit(100).cast("bigint"), 0.0, 0.29)
    assert spark.range(1).select(columns["train"]).first()[0] == int(100 * 0.29) == 28


@pytest.mark.parametrize(
    "fraction,train,val", [(0.5, None, None), (None, 30, 2), (0.5, 30, 2), (0.1, 30, 2), (None, 0, 1)]
)
def test_fraction_then_caps(spark, fraction, train, val):
    n = 200
    size = F.lit(n).cast("bigint")
    index = assign_split(spark.range(n).withColumnRenamed("id", "ord"), size)
    rows = limit_splits(index, size, 0.05, fraction, train, val).collect()
    parts = {"train": list(range(190)), "val": list(range(190, 200))}
    for name, cap in (("train", train), ("val", val)):
        want = parts[name]
        if fraction is not None:
            want = want[: int(len(want) * fraction)]
        if cap is not None:
            want = want[:cap]
        assert sorted(r.ord for r in rows if r.split == name) == want


@pytest.mark.parametrize("fraction", [0.0, 0.05, 0.5, 1.0])
def test_mark_split_agrees_with_ordinals(spark, fraction):
    docs = documents(spark)
    positions, n = table_positions(docs), F.lit(7).cast("bigint")
    marked = mark_split(lines_from_table(docs), positions, n, fraction)
    want = assign_split(positions, n, fraction)
    got = {(r.doc_id, r.line_no): r.split for r in marked.collect()}
    assert got == {(r.doc_id, r.line_no): r.split for r in want.collect()}

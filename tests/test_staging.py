"""Staged tables and their removal."""

from __future__ import annotations

import os

from loomline.staging import bucketed, remove_staged, staged


def test_staged_tables_are_removed(spark):
    remove_staged(spark)
    table = staged(spark.range(5).toDF("n"), "five")
    folder = os.path.dirname(table.inputFiles()[0]).removeprefix("file://")
    assert table.count() == 5 and os.path.isdir(folder)
    assert remove_staged(spark) == 1 and not os.path.exists(folder)
    assert remove_staged(spark) == 0


def test_bucketed_tables_join_in_place_and_are_removed(spark):
    remove_staged(spark)
    table = bucketed(spark.range(100).selectExpr("id AS k", "id * 2 AS v"), ["k"], 3, "by-key")
    joined = table.hint("merge").join(spark.range(0, 200, 3).toDF("k"), "k")
    assert sorted(r.v for r in joined.collect()) == [2 * k for k in range(0, 100, 3)]
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan and plan.count("Exchange hashpartitioning") == 2  # initial and final plan
    assert remove_staged(spark) == 1
    assert not any(t.name.startswith("by_key") for t in spark.catalog.listTables())

"""Run settings and the examples a run asks for."""

from __future__ import annotations

from loomline.plans.run import FULL_RUN, SMOKE_RUN, run_examples


def test_example_counts(spark):
    # 1,001 steps and 6 x 2 x 30 evaluation batches; 21 steps and 5 x 2 x 2
    assert run_examples(spark, FULL_RUN).count() == (1001 + 360) * 64
    assert run_examples(spark, SMOKE_RUN).count() == (21 + 20) * 64
    rows = run_examples(spark, SMOKE_RUN, 2).collect()
    assert len(set(rows)) == len(rows)
    assert sum(r.split == "val" for r in rows) == 5 * 2 * 2

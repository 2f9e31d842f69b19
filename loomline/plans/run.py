"""What one training run asks for: its settings, its examples, its report."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomline.operators import runlog


@dataclass(frozen=True)
class RunSettings:
    """Step counts of a run; the full run's values are the defaults."""

    max_steps: int = 1000
    eval_every: int = 200
    eval_iters: int = 30
    warmup_steps: int = 100
    peak_rate: float = 1e-4
    floor_ratio: float = 0.1

    @property
    def n_evals(self) -> int:
        return self.max_steps // self.eval_every + 1


FULL_RUN = RunSettings()
SMOKE_RUN = RunSettings(max_steps=20, eval_every=5, eval_iters=2, warmup_steps=5)


def run_examples(spark: SparkSession, run: RunSettings, batch_size: int = 64) -> DataFrame:
    """split, example of every batch the run reads.

    train holds a batch for each step, the last step included, then the train
    batches of every evaluation; val holds the val batches of every evaluation.
    """
    eval_batches = run.n_evals * run.eval_iters
    wanted = {"train": run.max_steps + 1 + eval_batches, "val": eval_batches}
    train, val = (
        spark.range(n * batch_size).select(
            F.lit(split).alias("split"), F.col("id").alias("example")
        )
        for split, n in wanted.items()
    )
    return train.unionByName(val)


def run_report(losses: DataFrame, run: RunSettings) -> DataFrame:
    """The evaluation log of a run from its batch losses."""
    return runlog.eval_log(
        losses,
        run.eval_every,
        max_steps=run.max_steps,
        peak=run.peak_rate,
        warmup_steps=run.warmup_steps,
        floor_ratio=run.floor_ratio,
    )

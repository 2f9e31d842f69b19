"""Schedule, means, best marks and the log sink against plain arithmetic."""

from __future__ import annotations

import math
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from loomline.functions.schedule import learning_rate
from loomline.operators import runlog

NAN = float("nan")


def plain_rate(step, peak=1e-4, warmup=100, last=1000, ratio=0.1):
    if step < warmup:
        return peak * (step + 1) / warmup
    share = min(1.0, (step - warmup) / max(1, last - warmup))
    low = peak * ratio
    return low + (peak - low) * 0.5 * (1 + math.cos(math.pi * share))


@pytest.mark.parametrize("last,warmup", [(1000, 100), (20, 5), (100, 100), (50, 100), (10, 0)])
def test_learning_rate(spark, last, warmup):
    df = spark.range(last + 30)
    rows = df.select("id", learning_rate(F.col("id"), last, warmup_steps=warmup).alias("lr")).collect()
    for r in rows:
        assert math.isclose(r.lr, plain_rate(r.id, warmup=warmup, last=last), rel_tol=1e-12)


def test_known_rates(spark):
    df = spark.createDataFrame([(s,) for s in (0, 99, 100, 550, 1000)], "step bigint")
    got = [r[0] for r in df.orderBy("step").select(F.round(learning_rate(F.col("step")), 9)).collect()]
    assert got == [1e-6, 1e-4, 1e-4, 5.5e-5, 1e-5]


@pytest.mark.parametrize("block", [1, 7, 1_000_000])
@pytest.mark.parametrize(
    "values",
    [
        [NAN, 3.0, 3.0, 2.0, NAN, 5.0, 1.0],
        [NAN, NAN],
        [float("inf"), 4.0],
        [random.Random(1).randint(0, 50) / 4 for _ in range(60)],
    ],
)
def test_best_marks(spark, block, values):
    log = spark.createDataFrame(list(enumerate(values)), "step bigint, val_loss double")
    best = math.inf
    for r in sorted(runlog.mark_best(log, block).collect(), key=lambda r: r.step):
        won = values[r.step] < best
        best = values[r.step] if won else best
        assert (r.is_best, r.best_val) == (won, best)


def losses(spark):
    start = datetime(2024, 3, 31, 0, 30)
    rng = random.Random(9)
    rows = [
        (step, split, i, rng.random(), start + timedelta(seconds=step + i * 0.25))
        for step in range(0, 601, 100)
        for split in ("train", "val")
        for i in range(3)
    ]
    return rows, spark.createDataFrame(
        rows, "step bigint, split string, iter bigint, loss double, ts timestamp_ntz"
    )


def test_eval_log_sink_and_summary(spark, tmp_path):
    rows, df = losses(spark)
    log = runlog.eval_log(df, 200, max_steps=600)
    path = str(tmp_path / "log")
    runlog.append_log(log.filter("step < 400"), path, "run/0")
    runlog.append_log(log.filter("step >= 400"), path, "run/1")
    got = sorted(runlog.read_log(spark, path, log.schema).collect(), key=lambda r: r.step)
    assert [r.step for r in got] == [0, 200, 400, 600]
    best = math.inf
    for r in got:
        for split in ("train", "val"):
            mean = sum(x[3] for x in rows if x[:2] == (r.step, split)) / 3
            assert math.isclose(r[f"{split}_loss"], mean)
        assert math.isclose(r.lr, plain_rate(r.step, last=600))
        assert r.elapsed_s == r.step + 0.5
        best = min(best, r.val_loss)
        assert r.best_val == best
    summary = runlog.run_summary(log).first()
    assert (summary.total_s, summary.best_val) == (600.5, best)


def test_runs_are_told_apart(spark):
    rows = [(run, step, split, 0, 1.0 + run * 5 + step / 200) for run in (1, 2) for step in (0, 200) for split in ("train", "val")]
    df = spark.createDataFrame(rows, "run_id int, step int, split string, iter int, loss double")
    df = df.withColumn("ts", F.timestamp_seconds(F.col("run_id") * 1000 + F.col("step")).cast("timestamp_ntz"))
    log = runlog.eval_log(df, keys=["run_id"], max_steps=200)
    got = {(r.run_id, r.step): (r.val_loss, r.elapsed_s, r.is_best) for r in log.collect()}
    assert got == {
        (1, 0): (6.0, 0.0, True), (1, 200): (7.0, 200.0, False),
        (2, 0): (11.0, 0.0, True), (2, 200): (12.0, 200.0, False),
    }
    best = {r.run_id: r.best_val for r in runlog.run_summary(log, ["run_id"]).collect()}
    assert best == {1: 6.0, 2: 11.0}


def test_a_repeated_append_adds_nothing(spark, tmp_path, monkeypatch):
    _, df = losses(spark)
    log = runlog.eval_log(df, 200, max_steps=600)
    path = str(tmp_path / "log")
    assert runlog.read_log(spark, path, log.schema).count() == 0

    def killed(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        # the job dies between its rows and its manifest
        m.setattr(runlog, "_commit", killed)
        with pytest.raises(KeyboardInterrupt):
            runlog.append_log(log, path, "run/0")
    assert spark.read.parquet(f"{path}/rows").count() == 4
    assert runlog.read_log(spark, path, log.schema).count() == 0
    for _ in range(3):
        runlog.append_log(log, path, "run/0")
    got = runlog.read_log(spark, path, log.schema)
    assert got.columns == log.columns and sorted(r.step for r in got.collect()) == [0, 200, 400, 600]
    # two writers of one batch at the same time: the first in the manifest counts
    runlog._write_rows(log, path, "other")
    runlog._commit(spark, path, "run/0", "other")
    assert got.count() == 4
    runlog.append_log(log, path, "run/1")
    assert runlog.read_log(spark, path, log.schema).count() == 8

"""Learning rate as a column of the step."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def learning_rate(
    step: Column,
    max_steps: Column | int = 1000,
    peak: float = 1e-4,
    warmup_steps: int = 100,
    floor_ratio: float = 0.1,
) -> Column:
    """Linear warm-up to the peak, then half a cosine wave down to the floor."""
    last = F.lit(max_steps) if isinstance(max_steps, int) else max_steps
    floor = peak * floor_ratio
    rising = F.lit(peak) * (step + 1) / F.lit(float(warmup_steps or 1))
    span = F.greatest(last - warmup_steps, F.lit(1))
    done = F.least((step - warmup_steps) / span, F.lit(1.0))
    falling = F.lit(floor) + F.lit((peak - floor) / 2) * (F.cos(done * math.pi) + 1)
    return F.when(step < warmup_steps, rising).otherwise(falling)

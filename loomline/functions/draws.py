"""Seeded draws that give the same number on every run, retry and engine."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def keyed_draw(n: Column, *key: Column) -> Column:
    """Uniform integer in [0, n) fixed by the key: 60 bits of its md5, modulo n."""
    digest = F.md5(F.concat_ws("|", *[k.cast("string") for k in key]).cast("binary"))
    number = F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")
    # Never null, and said so: a join on the draw then needs no null test, which
    # would work the digest out a second time.
    return F.coalesce(number, F.lit(0).cast("bigint")) % n

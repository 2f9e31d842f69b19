"""Checks that stop a job early with a clear message."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


class EmptyCorpusError(ValueError):
    pass


class MissingTokenError(KeyError):
    pass


def require_files(n_files: int, where: str) -> None:
    if not n_files:
        raise FileNotFoundError(f"no corpus files in {where}")


def require_splits(sizes: Mapping[str, int]) -> None:
    for split in ("train", "val"):
        if not sizes.get(split):
            raise EmptyCorpusError(f"the {split} split has no documents")


def checked_size(size: Column, split: str) -> Column:
    """A split's size inside a query; the query fails when it is not positive."""
    empty = F.raise_error(F.lit(f"the {split} split has no documents"))
    return F.when(size > 0, size).otherwise(empty.cast("bigint"))


def require_specials(ids: Mapping[str, int | None], names: Sequence[str]) -> None:
    missing = [name for name in names if ids.get(name) is None]
    if missing:
        raise MissingTokenError(f"the vocabulary has no id for {missing}")

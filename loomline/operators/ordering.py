"""Dense document order, hold-out split, prefix limits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomline.staging import staged

# Rows the one table that is summed in a single task may have.
TOP_ROWS = 1_000_000


def prefix_levels(df: DataFrame, key: str, width: int = 10_000) -> int:
    """Levels exclusive_prefix needs so that its top table stays within TOP_ROWS.

    One for keys that are nearly dense; more for sparse ones such as hashes. Reads
    only the smallest and largest key.
    """
    low, high = df.agg(F.min(key), F.max(key)).first()
    blocks, levels = ((high or 0) - (low or 0)) // width, 1
    while blocks > TOP_ROWS:
        blocks, levels = blocks // width, levels + 1
    return levels


def exclusive_prefix(
    df: DataFrame, key: str, amount: str, out: str, width: int = 10_000, levels: int = 1
) -> DataFrame:
    """Add `out`: the sum of `amount` over all rows with a smaller integer `key`.

    Keys are unique. A global running sum would sort every row in one task. Here
    rows fall into blocks of `width` consecutive keys, so a block has at most
    `width` rows; the table of block totals, one row per block, is summed the same
    way, level by level, and only the last one in a single task.
    """
    blocked = df.withColumn("_block", F.expr(f"`{key}` div {width}"))
    totals = blocked.groupBy("_block").agg(F.sum(amount).alias("_total"))
    if levels > 1:
        totals = totals.withColumnsRenamed({"_block": "_key"})
        bases = exclusive_prefix(totals, "_key", "_total", "_below", width, levels - 1)
        bases = bases.select(F.col("_key").alias("_block"), F.col("_below").alias("_base"))
    else:
        earlier = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
        bases = totals.select(
            "_block", F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_base")
        )
    inside = (
        Window.partitionBy("_block").orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        blocked.join(bases, "_block")
        .withColumn(out, F.col("_base") + F.coalesce(F.sum(amount).over(inside), F.lit(0)))
        .drop("_block", "_base")
    )


def rank_rows(df: DataFrame, order: list[Column], out: str) -> DataFrame:
    """Add `out`: the place of each row from 0 on, in an order that has no ties.

    Rows are dealt out by ranges of the order and written. A row's place is its
    place in its part plus the rows of the parts before; only the number of rows
    of each part is summed in one task.
    """
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order)
    # The id's upper bits are the part, its lower 33 bits the place in it.
    placed = staged(dealt.withColumn("_id", F.monotonically_increasing_id()), "ranked")
    part = F.shiftright("_id", 33)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_base"))
    place = F.col("_id").bitwiseAND(F.lit((1 << 33) - 1)) + F.col("_base")
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(bases), "_part")
        .withColumn(out, place)
        .drop("_id", "_part", "_base")
    )


def holdout_size(n: Column, val_fraction: float) -> Column:
    """Documents held out: the truncated fraction, but at least one if it is positive
    and there is one."""
    if val_fraction <= 0:
        return F.lit(0).cast("bigint")
    share = F.greatest(F.floor(n * F.lit(float(val_fraction))), F.lit(1).cast("bigint"))
    return F.least(share, n)


def assign_split(index: DataFrame, n: Column, val_fraction: float = 0.05) -> DataFrame:
    """Add split and split_ord: the last documents are val, the rest train.

    n is the document count, as a literal or a scalar subquery.
    """
    first_val = n - holdout_size(n, val_fraction)
    is_val = F.col("ord") >= first_val
    return index.withColumns(
        {
            "split": F.when(is_val, "val").otherwise("train"),
            "split_ord": F.when(is_val, F.col("ord") - first_val).otherwise(F.col("ord")),
        }
    )


def mark_split(
    lines: DataFrame,
    positions: DataFrame,
    n: Column,
    val_fraction: float = 0.05,
    key: str = "doc_id",
) -> DataFrame:
    """Add split to lines that carry text, without joining them to their ordinals.

    The hold-out is a tail of the order, so one position parts it from the rest.
    """
    first_val = n - holdout_size(n, val_fraction)
    border = (
        positions.filter(F.col("ord") == first_val)
        .select(F.struct(F.col(key).alias("key"), F.col("line_no").alias("line")))
        .scalar()
    )
    in_val = F.struct(F.col(key).alias("key"), F.col("line_no").alias("line")) >= border
    return lines.withColumn("split", F.when(in_val, "val").otherwise("train"))


def prefix_size(n: Column, fraction: float | None, cap: int | None) -> Column:
    """Documents left of n after a prefix fraction and then a cap."""
    if fraction is not None:
        n = F.floor(n * F.lit(float(fraction)))
    if cap is not None:
        n = F.least(n, F.lit(cap).cast("bigint"))
    return n


def split_sizes(
    n: Column,
    val_fraction: float = 0.05,
    data_fraction: float | None = None,
    max_train_docs: int | None = None,
    max_val_docs: int | None = None,
) -> dict[str, Column]:
    """Documents left in each split of n documents."""
    n_val = holdout_size(n, val_fraction)
    return {
        "train": prefix_size(n - n_val, data_fraction, max_train_docs),
        "val": prefix_size(n_val, data_fraction, max_val_docs),
    }


def limit_splits(
    index: DataFrame,
    n: Column,
    val_fraction: float = 0.05,
    data_fraction: float | None = None,
    max_train_docs: int | None = None,
    max_val_docs: int | None = None,
) -> DataFrame:
    """Keep the first documents of each split: fraction first, then cap."""
    sizes = split_sizes(n, val_fraction, data_fraction, max_train_docs, max_val_docs)
    return index.filter(
        F.col("split_ord")
        < F.when(F.col("split") == "train", sizes["train"]).otherwise(sizes["val"])
    )

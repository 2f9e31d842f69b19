"""Corpus to training rows: index, split, draw, fetch, tokenise, pack, shift."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomline.operators.guards import require_splits
from loomline.operators.ordering import assign_split, holdout_size, limit_splits, split_sizes
from loomline.operators.packing import pack_examples
from loomline.operators.tokens import encode_words, tokenizer_ids, wrap
from loomline.sources.corpus_files import CorpusIndex
from loomline.sources.tables import all_lines, pick_lines, slot_firsts, slot_positions, written_slots
from loomline.sources.vocabulary import Vocabulary
from loomline.staging import broadcast_if_within, staged

# A wanted position is three numbers and a short string.
WANTED_BYTES = 48
# The number of a line in its document's slots.
SLOT_BYTES = 4


@dataclass(frozen=True)
class Settings:
    """Job parameters; the full run's values are the defaults."""

    val_fraction: float = 0.05
    data_fraction: float | None = None
    max_train_docs: int | None = None
    max_val_docs: int | None = None
    block_size: int = 128
    batch_size: int = 64
    seed: int = 0

    def limits(self) -> tuple:
        return (
            self.val_fraction,
            self.data_fraction,
            self.max_train_docs,
            self.max_val_docs,
        )


@dataclass(frozen=True)
class SplitIndex:
    """Positions of the documents in use, their split sizes, and how to get text."""

    positions: DataFrame  # split, split_ord, ...
    sizes: Mapping[str, int]
    # wanted (split, split_ord), or None for all -> split, split_ord, text
    fetch_text: Callable[[DataFrame | None], DataFrame]


def _split_rows(positions: DataFrame, n_docs: int, settings: Settings) -> DataFrame:
    n = F.lit(n_docs).cast("bigint")
    split = assign_split(positions, n, settings.val_fraction)
    return limit_splits(split, n, *settings.limits())


def _sizes(spark: SparkSession, n_docs: int, settings: Settings) -> dict[str, int]:
    n = F.lit(n_docs).cast("bigint")
    columns = split_sizes(n, *settings.limits())
    row = spark.range(1).select(*[c.alias(s) for s, c in columns.items()]).first()
    require_splits(row.asDict())
    return row.asDict()


def _counted(wanted: DataFrame) -> tuple[DataFrame, int]:
    """Write the wanted rows and count them: their number decides what is broadcast."""
    wanted = staged(wanted, "wanted")
    return wanted, wanted.count()


def index_table(
    docs: DataFrame,
    key: str,
    text: str,
    settings: Settings,
    slots: DataFrame | None = None,
) -> SplitIndex:
    """Index a document table. The index is narrow and written once; text is
    read again only for the lines that are wanted. slots, the table's line slots,
    may be given when they are written already."""
    slots = written_slots(docs, key, text) if slots is None else slots
    n_docs = slots.agg(F.sum("n_lines")).first()[0] or 0
    sizes = _sizes(docs.sparkSession, n_docs, settings)
    rows = _split_rows(slot_positions(slots, key), n_docs, settings)
    rows = staged(rows.select("split", "split_ord", key, "line_no"), "positions")

    def fetch_text(wanted: DataFrame | None) -> DataFrame:
        if wanted is None:
            n_rows = slots.filter("n_lines > 0").count()
            n_bytes = n_rows * WANTED_BYTES + n_docs * SLOT_BYTES
            firsts = slot_firsts(slots, key).filter("n_lines > 0").select(key, "_first", "slots")
            found = all_lines(docs, broadcast_if_within(firsts, 1, n_bytes), key, text)
            return _split_rows(found, n_docs, settings).select("split", "split_ord", "text")
        wanted, n = _counted(wanted)
        places = rows.join(broadcast_if_within(wanted, n, WANTED_BYTES), ["split", "split_ord"])
        per_row = places.groupBy(key).agg(
            F.collect_list(F.struct("split", "split_ord", "line_no")).alias("places")
        )
        return pick_lines(docs, broadcast_if_within(per_row, n, WANTED_BYTES), key, text)

    return SplitIndex(rows, sizes, fetch_text)


def index_files(corpus: CorpusIndex, settings: Settings) -> SplitIndex:
    """Split an indexed corpus folder; ordinals come with the reading, so neither the
    index nor the text is shuffled to number the documents. Wanted documents are read
    from the byte ranges they are in, and no others."""
    sizes = _sizes(corpus.spark, corpus.n_docs, settings)
    rows = _split_rows(corpus.positions(), corpus.n_docs, settings)
    n = F.lit(corpus.n_docs).cast("bigint")
    first_val = n - holdout_size(n, settings.val_fraction)

    def fetch_text(wanted: DataFrame | None) -> DataFrame:
        if wanted is None:
            found = corpus.documents()
        else:
            base = F.when(F.col("split") == "val", first_val).otherwise(F.lit(0))
            found = corpus.fetch(wanted.select((F.col("split_ord") + base).alias("ord")))
        return _split_rows(found, corpus.n_docs, settings).select("split", "split_ord", "text")

    return SplitIndex(rows.select("split", "split_ord"), sizes, fetch_text)


def packed_rows(
    index: SplitIndex,
    examples: DataFrame,
    vocab: Vocabulary,
    tokenizer_json: str | None,
    settings: Settings,
    add_special_tokens: bool = True,
) -> DataFrame:
    """(split, example, ids): block_size + 1 ids for each asked (split, example).

    Without a tokenizer file the vocabulary gives the ids of words.
    """

    def fetch_ids(wanted: DataFrame | None) -> DataFrame:
        found = index.fetch_text(wanted)
        if tokenizer_json is None:
            encoded = encode_words(found, vocab, ["split", "split_ord"], out="_ids")
            return encoded.select("split", "split_ord", wrap(F.col("_ids"), vocab).alias("ids"))
        ids = tokenizer_ids(
            found.sparkSession, F.col("text"), tokenizer_json, add_special_tokens
        )
        return found.select("split", "split_ord", ids.alias("_ids")).select(
            "split", "split_ord", wrap(F.col("_ids"), vocab).alias("ids")
        )

    return pack_examples(
        examples, index.sizes, fetch_ids, settings.block_size + 1, settings.seed
    )

"""Text to ids and back, special-token wrap, context cut."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomline.functions.text import words
from loomline.sources.vocabulary import Vocabulary
from loomline.sources.word_files import ids_of, words_of


def encode_words(
    df: DataFrame, vocab: Vocabulary, keys: Sequence[str], text: str = "text", out: str = "ids"
) -> DataFrame:
    """Word ids from the vocabulary, whatever its size; the whole text is encoded.

    Words are looked up in place, in files that workers map into memory: no row is
    exploded and nothing is shuffled.
    """
    ids = ids_of(words(F.col(text)), vocab.by_word, vocab.unknown)
    return df.select(*keys, ids.alias(out))


def _tokenizer_column(
    spark: SparkSession,
    column: Column,
    tokenizer_json: str,
    work: Callable[..., list],
    returns: str,
    kind: pa.DataType,
    slice_rows: int,
) -> Column:
    """work(tokenizer, values) over a column in Arrow batches, without a shuffle.

    The tokenizer is sent to each executor once and built once per task. An encoding
    takes far more memory than its ids, so a batch is worked on in short slices.
    Everything a task runs is local to this function: executors need no package.
    """
    shared = spark.sparkContext.broadcast(tokenizer_json)

    @F.arrow_udf(returns)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_str(shared.value)

        def part(values: list) -> pa.Array:
            done = iter(work(tokenizer, [v for v in values if v is not None]))
            return pa.array([None if v is None else next(done) for v in values], kind)

        for batch in batches:
            starts = range(0, len(batch), slice_rows)
            parts = [part(batch.slice(at, slice_rows).to_pylist()) for at in starts]
            yield pa.concat_arrays(parts) if parts else pa.array([], kind)

    return run(column)


def tokenizer_ids(
    spark: SparkSession,
    text: Column,
    tokenizer_json: str,
    add_special_tokens: bool = True,
    slice_rows: int = 256,
) -> Column:
    """Ids by a tokenizer file."""

    def encode(tokenizer, texts: list[str]) -> list[list[int]]:
        found = tokenizer.encode_batch_fast(texts, add_special_tokens=add_special_tokens)
        return [e.ids for e in found]

    kind = pa.list_(pa.int32())
    return _tokenizer_column(spark, text, tokenizer_json, encode, "array<int>", kind, slice_rows)


def tokenizer_text(
    spark: SparkSession,
    ids: Column,
    tokenizer_json: str,
    skip_special_tokens: bool = True,
    slice_rows: int = 256,
) -> Column:
    """Text of ids by a tokenizer file; special tokens are left out unless asked for."""

    def decode(tokenizer, lists: list[list[int]]) -> list[str]:
        return tokenizer.decode_batch(lists, skip_special_tokens=skip_special_tokens)

    return _tokenizer_column(spark, ids, tokenizer_json, decode, "string", pa.string(), slice_rows)


def decode_ids(
    df: DataFrame, vocab: Vocabulary, keys: Sequence[str], ids: str = "ids", out: str = "text"
) -> DataFrame:
    """Ids back to space-joined tokens; special tokens and unknown ids are left out."""
    tokens = words_of(F.col(ids), vocab.by_id, vocab.specials)
    return df.select(*keys, F.coalesce(F.array_join(tokens, " "), F.lit("")).alias(out))


def wrap(ids: Column, vocab: Vocabulary) -> Column:
    return F.concat(F.array(F.lit(vocab.bos)), ids, F.array(F.lit(vocab.eos)))


def context_window(ids: Column, block_size: int = 128) -> Column:
    """The last block_size ids; all of them when there are fewer."""
    first = F.greatest(F.size(ids) - (block_size - 1), F.lit(1))
    return F.slice(ids, first, F.lit(block_size))

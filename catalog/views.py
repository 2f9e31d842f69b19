"""Inputs of the registered queries, derived from the given tables.

The shapes the operators read (lines, vocabulary, batch losses, chat turns,
actions) are made from documents, events and conversations, whole tables each.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomline.functions.text import words
from loomline.operators.chat import ERROR_PREFIX
from loomline.operators.ordering import mark_split, rank_rows
from loomline.sources.tables import lines_from_table, read_table, slot_positions, written_slots
from loomline.sources.vocabulary import BOS, EOS, Vocabulary, vocabulary
from loomline.staging import staged

UNK = "[UNK]"
RUNS = 4
# Words of the tokenizer file; the rest is unknown to it, as to any file of fixed size.
TOKENIZER_WORDS = 200_000
VAL_FRACTION = 0.05
# Code points of blanks a strip must remove, one of each kind.
BLANKS = (0x09, 0x0A, 0x0D, 0x1C, 0x1F, 0x20, 0x85, 0xA0, 0x1680, 0x2003, 0x2028, 0x202F, 0x3000)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/documents.parquet").select("doc_id", "text")


def line_count(slots: DataFrame) -> Column:
    return slots.agg(F.coalesce(F.sum("n_lines"), F.lit(0))).scalar()


def split_lines(docs: DataFrame, slots: DataFrame) -> DataFrame:
    """doc_id, line_no, text, split."""
    return mark_split(
        lines_from_table(docs), slot_positions(slots), line_count(slots), VAL_FRACTION
    )


def word_vocabulary(docs: DataFrame, slots: DataFrame) -> DataFrame:
    """token, id: the specials, then the commonest words of the train lines."""
    train = split_lines(docs, slots).filter("split = 'train'")
    counted = train.select(F.explode(words(F.col("text"))).alias("token")).groupBy("token").count()
    ranked = rank_rows(counted, [F.desc("count"), F.col("token")], "place")
    ranked = ranked.select("token", (F.col("place") + 3).cast("int").alias("id"))
    specials = docs.sparkSession.createDataFrame(
        [(UNK, 0), (BOS, 1), (EOS, 2)], "token string, id int"
    )
    return specials.unionByName(ranked)


def staged_vocabulary(docs: DataFrame, slots: DataFrame | None = None) -> Vocabulary:
    slots = written_slots(docs) if slots is None else slots
    table = staged(word_vocabulary(docs, slots), "vocabulary")
    return vocabulary(table, UNK)


def word_tokenizer(vocab: Vocabulary) -> str:
    """A tokenizer file of the specials and the TOKENIZER_WORDS commonest words."""
    known = vocab.table.filter(F.col("id") < TOKENIZER_WORDS + 3)
    entries = {r.token: r.id for r in known.collect()}
    flags = {"single_word": False, "lstrip": False, "rstrip": False, "normalized": False}
    specials = [
        {"id": entries[t], "content": t, "special": True, **flags} for t in (UNK, BOS, EOS)
    ]
    return json.dumps(
        {
            "version": "1.0",
            "truncation": None,
            "padding": None,
            "added_tokens": specials,
            "normalizer": None,
            "pre_tokenizer": {"type": "WhitespaceSplit"},
            "post_processor": None,
            "decoder": None,
            "model": {"type": "WordLevel", "vocab": entries, "unk_token": UNK},
        }
    )


def batch_losses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """run_id, step, split, iter, loss, ts: batches of four runs at every 200th step."""
    event = F.col("event_id")
    return table(spark, sf_dir, "events").select(
        (F.col("user_id") % RUNS).alias("run_id"),
        (F.expr("event_id div 60") * 200).alias("step"),
        F.when(event % 60 < 30, "train").otherwise("val").alias("split"),
        (event % 30).alias("iter"),
        F.col("value").alias("loss"),
        "ts",
    )


def conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")


def think_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations whose assistant turns carry reasoning blocks."""
    twice = F.concat(F.lit("<think>\n"), F.col("text"), F.lit("\n</think>"))
    marked = F.concat(
        F.lit("<think> "), F.col("text"), F.lit(" & \"so\" it's <ok> </think>\n"), F.col("text")
    )
    said = F.when(
        F.col("turn") % 4 == 1, F.concat(twice, F.lit(" "), F.col("text"), F.lit(" "), twice)
    ).otherwise(marked)
    return conversations(spark, sf_dir).withColumn(
        "text", F.when(F.col("role") == "assistant", said).otherwise(F.col("text"))
    )


def reply_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations in which about every seventh reply is an error text."""
    failed = (F.col("role") == "assistant") & ((F.col("conv_id") * 3 + F.col("turn")) % 7 == 0)
    error = F.concat(F.lit(ERROR_PREFIX), F.col("text"))
    return conversations(spark, sf_dir).withColumn(
        "text", F.when(failed, error).otherwise(F.col("text"))
    )


def actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """user_id, ts, event_id, action: events read as button presses."""
    kinds = {
        "signup": "new_chat",
        "error": "clear",
        "click": "yes",
        "view": "cancel",
        "purchase": "prompt",
    }
    kind = F.lit(None).cast("string")
    for event_type, action in kinds.items():
        kind = F.when(F.col("event_type") == event_type, action).otherwise(kind)
    return table(spark, sf_dir, "events").select("user_id", "ts", "event_id", kind.alias("action"))

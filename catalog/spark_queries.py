"""The registered queries. Arrays go out as joined strings, doubles rounded."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import views
from loomline.functions.schedule import learning_rate
from loomline.functions.text import html_escape, lossy_utf8, strip_space
from loomline.operators import chat, runlog
from loomline.operators.guards import checked_size
from loomline.operators.ordering import assign_split, limit_splits, split_sizes
from loomline.operators.packing import draw_documents, shift_pairs, to_batches
from loomline.operators.tokens import (
    context_window,
    decode_ids,
    encode_words,
    tokenizer_ids,
    tokenizer_text,
    wrap,
)
from loomline.plans.training_rows import Settings, index_files, index_table, packed_rows
from loomline.sources.corpus_files import index_corpus
from loomline.sources.tables import line_slots, lines_from_table, slot_positions, written_slots
from loomline.staging import new_folder, staged

LINE = ["doc_id", "line_no"]
RUN = ["run_id"]
DATA_FRACTION = 0.29
PART_TURNS = 4
ACTIONS_PER_BUCKET = 1_000
MAX_TRAIN_DOCS, MAX_VAL_DOCS = 5_000, 100
SYSTEM_TEXT = "Think inside <think>...</think> tags, then answer."


def joined(ids: Column | str) -> Column:
    return F.array_join(ids, " ")


# ---- corpus ------------------------------------------------------------------------


def corpus_lines(spark: SparkSession, sf: str) -> DataFrame:
    return lines_from_table(views.documents(spark, sf), with_offsets=True)


def corpus_stats(spark: SparkSession, sf: str) -> DataFrame:
    return line_slots(views.documents(spark, sf)).agg(
        F.count("*").alias("files"), F.sum("n_lines").alias("documents")
    )


def corpus_files(spark: SparkSession, sf: str) -> DataFrame:
    """The documents written as text files and read back through the file index."""
    folder = new_folder(spark, "corpus")
    views.documents(spark, sf).select("text").write.text(folder)
    lines = index_corpus(spark, folder, "*.txt").documents()
    return lines.groupBy("text").agg(F.count("*").alias("copies"))


def _hidden_corpus(spark: SparkSession, sf: str) -> str:
    """The documents as text files, every second one under a name that Spark's own
    scans skip."""
    folder = new_folder(spark, "corpus")
    views.documents(spark, sf).select("text").repartition(6).write.text(folder)
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path
    system = path(folder).getFileSystem(context._jsc.hadoopConfiguration())
    parts = sorted(s.getPath().getName() for s in system.listStatus(path(folder)))
    for k, name in enumerate(n for n in parts if n.startswith("part-")):
        if k % 2:
            system.rename(path(folder, name), path(folder, f"{'_' if k % 4 == 1 else '.'}{name}"))
    return folder


def corpus_hidden(spark: SparkSession, sf: str) -> DataFrame:
    """A corpus folder with hidden files: all documents, and the places they start at."""
    index = index_corpus(spark, _hidden_corpus(spark, sf), "*.txt")
    placed = index.documents().join(index.positions().drop("file_idx"), "ord")
    return placed.groupBy("text").agg(
        F.count("*").alias("copies"), F.count_distinct("file_idx", "byte_offset").alias("places")
    )


def corpus_first_batch(spark: SparkSession, sf: str) -> DataFrame:
    """The first batch of each split, its documents read from a corpus folder by seeking."""
    docs = views.documents(spark, sf)
    folder = new_folder(spark, "corpus")
    docs.orderBy("doc_id").select("text").write.text(folder)
    settings = Settings(val_fraction=views.VAL_FRACTION)
    index = index_files(index_corpus(spark, folder, "*.txt"), settings)
    splits = F.explode(F.array(F.lit("train"), F.lit("val"))).alias("split")
    examples = spark.range(64).select(splits, F.col("id").alias("example"))
    packed = packed_rows(index, examples, views.staged_vocabulary(docs), None, settings)
    return packed.select("split", "example", joined("ids").alias("ids"))


def corpus_positions(spark: SparkSession, sf: str) -> DataFrame:
    """Totals over the file index: documents, the sum of their ordinals, the places
    in files they start at, each its own."""
    folder = new_folder(spark, "corpus")
    views.documents(spark, sf).select("text").write.text(folder)
    return index_corpus(spark, folder, "*.txt").positions().agg(
        F.count("*").alias("documents"),
        F.sum("ord").alias("ord_sum"),
        F.count_distinct("file_idx", "byte_offset").alias("places"),
    )


def lossy_decode(spark: SparkSession, sf: str) -> DataFrame:
    """Texts with broken bytes put round them, decoded."""
    broken = F.concat(
        F.unhex(F.lit("FFFE")), F.col("text").cast("binary"), F.unhex(F.lit("E282"))
    )
    return views.documents(spark, sf).select("doc_id", lossy_utf8(broken).alias("text"))


def text_strip(spark: SparkSession, sf: str) -> DataFrame:
    """Texts with blanks of many kinds put round them, stripped."""
    blanks = "".join(map(chr, views.BLANKS))
    padded = F.concat(F.lit(blanks), F.col("text"), F.lit(blanks))
    return views.documents(spark, sf).select("doc_id", strip_space(padded).alias("text"))


# ---- order, split, limits ------------------------------------------------------------


def doc_ordinals(spark: SparkSession, sf: str) -> DataFrame:
    """The order of all lines, in blocks narrow enough for their borders to count."""
    return slot_positions(written_slots(views.documents(spark, sf)), width=100)


def _split_index(spark: SparkSession, sf: str) -> tuple[DataFrame, Column]:
    slots = written_slots(views.documents(spark, sf))
    n = views.line_count(slots)
    return assign_split(slot_positions(slots), n, views.VAL_FRACTION), n


def split_docs(spark: SparkSession, sf: str) -> DataFrame:
    return _split_index(spark, sf)[0]


def split_fraction(spark: SparkSession, sf: str) -> DataFrame:
    index, n = _split_index(spark, sf)
    return limit_splits(index, n, views.VAL_FRACTION, DATA_FRACTION)


def split_caps(spark: SparkSession, sf: str) -> DataFrame:
    index, n = _split_index(spark, sf)
    return limit_splits(index, n, views.VAL_FRACTION, None, MAX_TRAIN_DOCS, MAX_VAL_DOCS)


def split_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Sizes of both splits; an empty one fails the query."""
    slots = written_slots(views.documents(spark, sf))
    counted = slots.agg(F.coalesce(F.sum("n_lines"), F.lit(0)).alias("n"))
    sizes = split_sizes(F.col("n"), views.VAL_FRACTION)
    return counted.select(
        *[checked_size(size, split).alias(f"{split}_docs") for split, size in sizes.items()]
    )


# ---- tokens --------------------------------------------------------------------------


def vocab(spark: SparkSession, sf: str) -> DataFrame:
    docs = views.documents(spark, sf)
    return views.word_vocabulary(docs, written_slots(docs))


def vocab_size(spark: SparkSession, sf: str) -> DataFrame:
    return vocab(spark, sf).agg(F.count("*").alias("vocab_size"))


def special_tokens(spark: SparkSession, sf: str) -> DataFrame:
    known = views.staged_vocabulary(views.documents(spark, sf))
    return known.table.filter(F.col("id").isin(known.bos, known.eos))


def _encoded(spark: SparkSession, sf: str):
    docs = views.documents(spark, sf)
    known = views.staged_vocabulary(docs)
    return encode_words(lines_from_table(docs), known, LINE), known


def encode_docs(spark: SparkSession, sf: str) -> DataFrame:
    encoded, _ = _encoded(spark, sf)
    return encoded.select(*LINE, joined("ids").alias("ids"))


def encode_docs_tokenizer(spark: SparkSession, sf: str) -> DataFrame:
    docs = views.documents(spark, sf)
    tokenizer = views.word_tokenizer(views.staged_vocabulary(docs))
    ids = tokenizer_ids(spark, F.col("text"), tokenizer)
    return lines_from_table(docs).select(*LINE, ids.alias("ids")).select(
        *LINE, joined("ids").alias("ids")
    )


def decode_docs(spark: SparkSession, sf: str) -> DataFrame:
    encoded, known = _encoded(spark, sf)
    wrapped = encoded.select(*LINE, wrap(F.col("ids"), known).alias("ids"))
    return decode_ids(wrapped, known, LINE)


def decode_docs_tokenizer(spark: SparkSession, sf: str) -> DataFrame:
    docs = views.documents(spark, sf)
    known = views.staged_vocabulary(docs)
    tokenizer = views.word_tokenizer(known)
    ids = tokenizer_ids(spark, F.col("text"), tokenizer)
    encoded = lines_from_table(docs).select(*LINE, ids.alias("ids"))
    text = tokenizer_text(spark, wrap(F.col("ids"), known), tokenizer)
    return encoded.select(*LINE, text.alias("text"))


def wrapped_docs(spark: SparkSession, sf: str) -> DataFrame:
    encoded, known = _encoded(spark, sf)
    return encoded.select(*LINE, joined(wrap(F.col("ids"), known)).alias("ids"))


def window_docs(spark: SparkSession, sf: str) -> DataFrame:
    encoded, known = _encoded(spark, sf)
    return encoded.select(*LINE, joined(context_window(wrap(F.col("ids"), known))).alias("ids"))


# ---- drawing and packing: one epoch, as many examples as a split has documents ---------


def doc_draws(spark: SparkSession, sf: str) -> DataFrame:
    index, n = _split_index(spark, sf)
    sizes = split_sizes(n, views.VAL_FRACTION)
    n_docs = F.when(F.col("split") == "train", sizes["train"]).otherwise(sizes["val"])
    examples = index.select("split", F.col("split_ord").alias("example"))
    return draw_documents(examples, n_docs, 0, 64)


def _packed(spark: SparkSession, sf: str, batch: int | None = None) -> DataFrame:
    docs = views.documents(spark, sf)
    slots = written_slots(docs)
    known = views.staged_vocabulary(docs, slots)
    settings = Settings(val_fraction=views.VAL_FRACTION)
    index = index_table(docs, "doc_id", "text", settings, slots)
    if batch is None:
        examples = index.positions.select("split", F.col("split_ord").alias("example"))
    else:
        splits = F.explode(F.array(F.lit("train"), F.lit("val"))).alias("split")
        examples = spark.range(batch).select(splits, F.col("id").alias("example"))
    return packed_rows(index, examples, known, None, settings)


def packed_examples(spark: SparkSession, sf: str) -> DataFrame:
    return _packed(spark, sf).select("split", "example", joined("ids").alias("ids"))


def first_batch(spark: SparkSession, sf: str) -> DataFrame:
    """The first batch of each split: only the documents it draws are fetched."""
    return _packed(spark, sf, 64).select("split", "example", joined("ids").alias("ids"))


def shifted_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return shift_pairs(_packed(spark, sf)).select(
        "split",
        "example",
        joined("input_ids").alias("input_ids"),
        joined("target_ids").alias("target_ids"),
    )


def batches(spark: SparkSession, sf: str) -> DataFrame:
    return to_batches(shift_pairs(_packed(spark, sf))).select(
        "split",
        "batch_id",
        "row_in_batch",
        joined("input_ids").alias("input_ids"),
        joined("target_ids").alias("target_ids"),
    )


# ---- run log ---------------------------------------------------------------------------


def eval_means(spark: SparkSession, sf: str) -> DataFrame:
    return runlog.eval_means(views.batch_losses(spark, sf), RUN).select(
        *RUN,
        "step",
        F.round("train_loss", 9).alias("train_loss"),
        F.round("val_loss", 9).alias("val_loss"),
    )


def _training_steps(spark: SparkSession, sf: str) -> tuple[DataFrame, Column]:
    """Every event as one training step; the run ends at the largest."""
    steps = views.table(spark, sf, "events").select(F.col("event_id").alias("step"), "value")
    return steps, steps.agg(F.max("step")).scalar()


def lr_schedule(spark: SparkSession, sf: str) -> DataFrame:
    steps, last = _training_steps(spark, sf)
    return steps.select("step", F.round(learning_rate(F.col("step"), last), 12).alias("lr"))


def eval_steps(spark: SparkSession, sf: str) -> DataFrame:
    steps, _ = _training_steps(spark, sf)
    return runlog.eval_steps(steps).select("step", F.col("value").alias("loss"))


def best_steps(spark: SparkSession, sf: str) -> DataFrame:
    means = runlog.eval_means(views.batch_losses(spark, sf), RUN)
    # small blocks, so that the best so far crosses their borders
    marked = runlog.mark_best(means, 1_000, RUN)
    return marked.select(*RUN, "step", F.round("best_val", 9).alias("best_val"), "is_best")


def _eval_log(spark: SparkSession, sf: str) -> DataFrame:
    losses = views.batch_losses(spark, sf)
    return runlog.eval_log(losses, keys=RUN, max_steps=losses.agg(F.max("step")).scalar())


def _rounded_log(log: DataFrame) -> DataFrame:
    return log.select(
        *RUN,
        "step",
        F.round("train_loss", 9).alias("train_loss"),
        F.round("val_loss", 9).alias("val_loss"),
        F.round("lr", 12).alias("lr"),
        F.round("elapsed_s", 6).alias("elapsed_s"),
        F.round("best_val", 9).alias("best_val"),
        "is_best",
    )


def eval_log(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded_log(_eval_log(spark, sf))


def eval_log_written(spark: SparkSession, sf: str) -> DataFrame:
    """The log appended run by run, the first run twice as by a job that is repeated,
    then read back."""
    path = new_folder(spark, "eval-log")
    log = staged(_eval_log(spark, sf), "eval-log-rows")
    for run in (0, *range(views.RUNS)):
        runlog.append_log(log.filter(F.col("run_id") == run), path, f"run-{run}")
    return _rounded_log(runlog.read_log(spark, path, log.schema))


def run_summary(spark: SparkSession, sf: str) -> DataFrame:
    return runlog.run_summary(_eval_log(spark, sf), RUN).select(
        *RUN, F.round("total_s", 6).alias("total_s"), F.round("best_val", 9).alias("best_val")
    )


# ---- chats -----------------------------------------------------------------------------


def think_split(spark: SparkSession, sf: str) -> DataFrame:
    return chat.split_reasoning(views.think_turns(spark, sf)).select(
        "conv_id", "turn", "role", "reasoning", "answer"
    )


def escaped_texts(spark: SparkSession, sf: str) -> DataFrame:
    return views.table(spark, sf, "pages").select(
        "page_id", html_escape(F.col("html")).alias("html")
    )


def transcripts(spark: SparkSession, sf: str) -> DataFrame:
    return chat.transcripts(views.think_turns(spark, sf), part_turns=PART_TURNS)


def pending_chats(spark: SparkSession, sf: str) -> DataFrame:
    return chat.pending_chats(views.conversations(spark, sf))


def error_replies(spark: SparkSession, sf: str) -> DataFrame:
    return chat.error_replies(views.reply_turns(spark, sf), "turn").withColumn(
        "error_rate", F.round("error_rate", 9)
    )


def prompts(spark: SparkSession, sf: str) -> DataFrame:
    return chat.prompts(views.think_turns(spark, sf), SYSTEM_TEXT, PART_TURNS)


def append_turns(spark: SparkSession, sf: str) -> DataFrame:
    """Every pending chat gets a reply that quotes its last message, every other one
    an answer to it."""
    messages = views.conversations(spark, sf)
    asked = chat.pending_chats(messages).withColumnRenamed("last_turn", "turn")
    replies = messages.join(asked, ["conv_id", "turn"]).select(
        "conv_id",
        F.lit("assistant").alias("role"),
        F.concat(F.lit("You asked: "), "text").alias("text"),
        F.lit(0).alias("nth"),
    )
    thanks = asked.filter("conv_id % 2 = 0").select(
        "conv_id", F.lit("user").alias("role"), F.lit("Thanks.").alias("text"), F.lit(1).alias("nth")
    )
    return chat.append_turns(messages, replies.unionByName(thanks), ["nth"])


def chat_segments(spark: SparkSession, sf: str) -> DataFrame:
    return chat.chat_segments(views.actions(spark, sf), ACTIONS_PER_BUCKET).select(
        "event_id", "user_id", "action", "is_reset", "chat_seq", "chat_id"
    )


def seed_greetings(spark: SparkSession, sf: str) -> DataFrame:
    actions = views.actions(spark, sf)
    return chat.seed_greetings(chat.chat_segments(actions, ACTIONS_PER_BUCKET), actions)


QUERIES = {
    f.__name__: f
    for f in (
        corpus_lines,
        corpus_stats,
        corpus_files,
        corpus_hidden,
        corpus_positions,
        corpus_first_batch,
        lossy_decode,
        text_strip,
        doc_ordinals,
        split_docs,
        split_fraction,
        split_caps,
        split_counts,
        vocab,
        vocab_size,
        special_tokens,
        encode_docs,
        encode_docs_tokenizer,
        decode_docs,
        decode_docs_tokenizer,
        wrapped_docs,
        doc_draws,
        packed_examples,
        first_batch,
        shifted_pairs,
        batches,
        eval_means,
        lr_schedule,
        eval_steps,
        best_steps,
        eval_log,
        eval_log_written,
        run_summary,
        think_split,
        escaped_texts,
        transcripts,
        pending_chats,
        error_replies,
        prompts,
        append_turns,
        chat_segments,
        seed_greetings,
    )
} | {"context_window": window_docs}

"""Chat-log tables: reasoning split, transcripts, prompts, chats from actions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomline.functions.text import html_escape, strip_space
from loomline.operators.ordering import rank_rows

# Tags and texts that must equal the chat page's.
THINK_OPEN, THINK_CLOSE = "<think>", "</think>"
ERROR_PREFIX = "Error connecting to the model: "
GREETINGS = {
    "first": "Hello! I am {name}.",
    "new_chat": "Hello! I am {name}. Nice to meet you.",
    "cleared": "Conversation reset. How can I help?",
}


# ---- single messages -------------------------------------------------------------


def think_block(content: Column) -> Column:
    """The first opening tag up to the first closing tag after it, or null.

    Found by position rather than by a pattern, so one pass over the text is enough.
    """
    start = F.position(F.lit(THINK_OPEN), content)
    end = F.position(F.lit(THINK_CLOSE), content, start + len(THINK_OPEN))
    length = end - start + len(THINK_CLOSE)
    closed = F.contains(content, F.lit(THINK_OPEN)) & (end > 0)
    return F.when(closed, F.substring(content, start, length))


def split_reasoning(messages: DataFrame, content: str = "text") -> DataFrame:
    """Add reasoning (null without a block) and answer; other roles stay whole.

    Every copy of the block leaves the answer; other blocks stay in it.
    """
    is_reply = F.col("role") == "assistant"
    block = F.when(is_reply, think_block(F.col(content)))
    inner = F.substring(
        F.col("_block"),
        F.lit(len(THINK_OPEN) + 1),
        F.length("_block") - len(THINK_OPEN + THINK_CLOSE),
    )
    rest = strip_space(F.replace(F.col(content), F.col("_block"), F.lit("")))
    return (
        messages.withColumn("_block", block)
        .withColumns(
            {
                "reasoning": strip_space(inner),
                "answer": F.when(F.col("_block").isNull(), F.col(content)).otherwise(rest),
            }
        )
        .drop("_block")
    )


def message_html(name: str = "Assistant", label: str = "Reasoning") -> Column:
    """A message's markup, from role, reasoning and answer; styling is left out.

    Fixed values: the class names and the two message labels.
    """
    answer = F.concat(F.lit("<div>"), html_escape(F.col("answer")), F.lit("</div>"))
    thoughts = F.concat(
        F.lit(f"<details><summary>{label}</summary><div>"),
        html_escape(F.col("reasoning")),
        F.lit("</div></details>"),
    )
    reply = F.concat(
        F.lit('<div class="message assistant-message"><span class="message-label">'),
        F.lit(f"{name} reply</span>"),
        F.coalesce(thoughts, F.lit("")),
        answer,
        F.lit("</div>"),
    )
    other = F.concat(
        F.lit('<div class="message user-message"><span class="message-label">Your message</span>'),
        answer,
        F.lit("</div>"),
    )
    return F.when(F.col("role") == "assistant", reply).otherwise(other)


# ---- whole chats -----------------------------------------------------------------


def _with_part(messages: DataFrame, part_turns: int) -> DataFrame:
    return messages.withColumn("part", F.expr(f"turn div {part_turns}"))


def _same_chat(left: str, right: str) -> Column:
    """One chat; messages without a conv_id are one chat too."""
    return F.col(f"{left}.conv_id").eqNullSafe(F.col(f"{right}.conv_id"))


def _last_is_user() -> Column:
    """Aggregate: does the message of the highest turn come from the user?

    The flag rides in the lowest bit of the turn, so the aggregate is one number
    and combines on the map side by hash, without a sort.
    """
    from_user = F.coalesce(F.col("role") == "user", F.lit(False))
    return F.max(F.col("turn").cast("bigint") * 2 + from_user.cast("bigint"))


def chat_parts(messages: DataFrame, part_turns: int = 1000) -> DataFrame:
    """One narrow row per (conv_id, part): opens, closes, and waiting for the chat.

    A chat may hold a third of all messages, so it is never gathered whole: a part
    covers part_turns consecutive turns. Most chats have one part. A chat waits
    when its last message is from the user.
    """
    parts = (
        _with_part(messages, part_turns)
        .groupBy("conv_id", "part")
        .agg(_last_is_user().alias("_last"))
    )
    ends = parts.groupBy("conv_id").agg(
        F.min("part").alias("_first_part"),
        F.max("part").alias("_last_part"),
        (F.max("_last") % 2 != 0).alias("waiting"),
    )
    joined = parts.alias("p").join(ends.alias("e"), _same_chat("p", "e"))
    return joined.select(
        "p.conv_id",
        "part",
        (F.col("part") == F.col("_first_part")).alias("opens"),
        (F.col("part") == F.col("_last_part")).alias("closes"),
        "waiting",
    )


def _join_pieces(
    pieces: DataFrame,
    parts: DataFrame,
    part_turns: int,
    head: Column,
    between: str,
    tail: Column,
    out: str,
) -> DataFrame:
    """Concatenate (conv_id, turn, piece) in turn order, part by part.

    The join and the grouping share one shuffle on (conv_id, part). head and tail
    stand around each part; they may look at opens and closes.
    """
    keys = ["conv_id", "part", "opens", "closes"]
    ordered = F.array_sort(F.collect_list(F.struct("turn", "piece")))
    body = F.array_join(F.transform(ordered, lambda p: p["piece"]), between)
    return (
        _with_part(pieces, part_turns)
        .alias("p")
        .join(parts.select(*keys).alias("k"), _same_chat("p", "k") & (F.col("p.part") == F.col("k.part")))
        .select("k.*", "turn", "piece")
        .groupBy(*keys)
        .agg(body.alias("_body"))
        .select(
            "conv_id",
            "part",
            F.concat(head, "_body", tail).alias(out),
        )
    )


def transcripts(
    messages: DataFrame,
    name: str = "Assistant",
    title: str = "Conversation",
    part_turns: int = 1000,
    label: str = "Reasoning",
) -> DataFrame:
    """Chat markup as (conv_id, part, html).

    Every chat comes in parts of part_turns turns; its parts, put one after the
    other, are its whole markup.
    """
    pieces = split_reasoning(messages).select(
        "conv_id", "turn", message_html(name, label).alias("piece")
    )
    shell = F.lit(f'<div class="chat-shell"><div class="chat-title">{title}</div>')
    head = F.when(F.col("opens"), shell).otherwise("")
    tail = F.when(F.col("closes"), F.lit("</div>")).otherwise("")
    parts = chat_parts(messages, part_turns)
    return _join_pieces(pieces, parts, part_turns, head, "", tail, "html")


def pending_chats(messages: DataFrame) -> DataFrame:
    """Chats whose last message is from the user."""
    return (
        messages.groupBy("conv_id")
        .agg(F.max("turn").alias("last_turn"), _last_is_user().alias("_last"))
        .filter(F.col("_last") % 2 != 0)
        .select("conv_id", "last_turn")
    )


def prompts(messages: DataFrame, system_text: str, part_turns: int = 1000) -> DataFrame:
    """Model input of pending chats as (conv_id, part, prompt).

    Each part of part_turns turns is a JSON list of role and content; the system
    message comes first in a chat's first part. The lists of a chat, joined in
    order, are its whole history.
    """

    def record(role: Column, content: Column) -> Column:
        pair = F.struct(role.alias("role"), content.alias("content"))
        return F.to_json(pair, {"ignoreNullFields": "false"})

    waiting = chat_parts(messages, part_turns).filter("waiting")
    pieces = messages.select(
        "conv_id", "turn", record(F.col("role"), F.col("text")).alias("piece")
    )
    system = F.concat(record(F.lit("system"), F.lit(system_text)), F.lit(","))
    head = F.concat(F.lit("["), F.when(F.col("opens"), system).otherwise(""))
    return _join_pieces(pieces, waiting, part_turns, head, ",", F.lit("]"), "prompt")


def error_replies(messages: DataFrame, by: str) -> DataFrame:
    """Replies, error replies and their share, by group."""
    is_error = F.col("text").startswith(ERROR_PREFIX)
    return (
        messages.filter(F.col("role") == "assistant")
        .groupBy(by)
        .agg(F.count("*").alias("replies"), F.count(F.when(is_error, 1)).alias("errors"))
        .withColumn("error_rate", F.col("errors") / F.col("replies"))
    )


def append_turns(
    messages: DataFrame, new: DataFrame, order: Sequence[str] = ("role", "text")
) -> DataFrame:
    """Add messages (conv_id, role, text) after the last turn of their chats.

    Several messages of one chat follow each other in the order of the columns
    named in order.
    """
    ends = messages.groupBy("conv_id").agg(F.max("turn").alias("_last"))
    nth = F.row_number().over(Window.partitionBy("conv_id").orderBy(*order))
    numbered = new.withColumn("_nth", nth.cast("bigint")).alias("n")
    placed = numbered.join(ends.alias("e"), _same_chat("n", "e"), "left").select(
        "n.conv_id", (F.coalesce("_last", F.lit(-1)) + F.col("_nth")).alias("turn"), "role", "text"
    )
    return messages.select("conv_id", "turn", "role", "text").unionByName(placed)


# ---- chats from button presses -----------------------------------------------------


def chat_id(user: Column, seq: Column) -> Column:
    """An id that is the same on every run and retry."""
    return F.sha2(F.concat_ws("|", user.cast("string"), seq.cast("string")), 256)


def _with_bucket(actions: DataFrame, rows_per_bucket: int) -> DataFrame:
    """Add _place, the place of a row in the order of all, and bucket, its block.

    Rows without a time come first. Many rows of one instant are told apart by
    event_id, so no bucket has more than rows_per_bucket rows.
    """
    order = [F.col("ts").asc_nulls_first(), F.col("event_id").asc_nulls_first(), F.col("user_id").asc_nulls_first()]
    placed = rank_rows(actions, order, "_place")
    return placed.withColumn("bucket", F.expr(f"_place div {rows_per_bucket}"))


def chat_segments(actions: DataFrame, rows_per_bucket: int = 1_000_000) -> DataFrame:
    """Add is_reset, chat_seq and chat_id to (user_id, ts, event_id, action).

    new_chat starts a chat at once. yes starts one only when the last action
    before it, new_chat left aside, is clear.

    One user may own a third of the rows, so a user's stream is cut into buckets
    of the order of all actions. Windows run inside a bucket; what one bucket
    hands to the next is one row each. Actions without a user are one user's,
    those without a time come first.
    """
    chunk = ["user_id", "bucket"]
    order = Window.partitionBy(*chunk).orderBy("_place")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    moves = F.when(F.col("action") != "new_chat", F.col("action"))
    local = _with_bucket(
        actions.select("user_id", "ts", "event_id", "action"), rows_per_bucket
    ).withColumn("prior", F.last(moves, ignorenulls=True).over(before))

    # What each bucket looks like from outside: its first and last move, and the
    # resets that do not depend on what came before it.
    moved = F.when(moves.isNotNull(), F.col("_place"))
    resets_alone = (F.col("action") == "new_chat") | (
        (F.col("action") == "yes") & F.coalesce(F.col("prior") == "clear", F.lit(False))
    )
    outside = local.groupBy(*chunk).agg(
        F.min_by("action", moved).alias("first_move"),
        F.max_by("action", moved).alias("last_move"),
        F.count(F.when(resets_alone, 1)).alias("resets"),
    )
    earlier = (
        Window.partitionBy("user_id").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    )
    armed = F.coalesce(F.col("carried_move") == "clear", F.lit(False))
    all_resets = F.col("resets") + (armed & (F.col("first_move") == "yes")).cast("int")
    carried = (
        outside.withColumn("carried_move", F.last("last_move", ignorenulls=True).over(earlier))
        .withColumn("all_resets", F.coalesce(all_resets, F.col("resets")))
        .select(
            *chunk,
            "carried_move",
            F.coalesce(F.sum("all_resets").over(earlier), F.lit(0)).alias("carried_resets"),
        )
    )

    last_move = F.coalesce("prior", "carried_move")
    is_reset = (F.col("action") == "new_chat") | (
        (F.col("action") == "yes") & F.coalesce(last_move == "clear", F.lit(False))
    )
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    seq = F.col("carried_resets") + F.count(F.when(F.col("is_reset"), 1)).over(upto)
    same = F.col("l.user_id").eqNullSafe(F.col("c.user_id")) & (F.col("l.bucket") == F.col("c.bucket"))
    return (
        local.alias("l")
        .join(carried.alias("c"), same)
        .select("l.*", "carried_move", "carried_resets")
        .withColumn("is_reset", is_reset)
        .withColumn("chat_seq", seq)
        .withColumn("chat_id", chat_id(F.col("user_id"), F.col("chat_seq")))
        .select("user_id", "ts", "event_id", "action", "is_reset", "chat_seq", "chat_id")
    )


def seed_greetings(
    segments: DataFrame, users: DataFrame, name: str = "Assistant"
) -> DataFrame:
    """The first assistant message of every chat, including each user's first.

    users may repeat a user_id.
    """
    opened = segments.filter("is_reset").select(
        "user_id",
        "chat_seq",
        F.when(F.col("action") == "new_chat", "new_chat").otherwise("cleared").alias("kind"),
    )
    visits = users.select("user_id").distinct().select(
        "user_id", F.lit(0).cast("bigint").alias("chat_seq"), F.lit("first").alias("kind")
    )
    text = F.lit(None).cast("string")
    for kind, greeting in GREETINGS.items():
        text = F.when(F.col("kind") == kind, greeting.format(name=name)).otherwise(text)
    return visits.unionByName(opened).select(
        "user_id",
        "chat_seq",
        chat_id(F.col("user_id"), F.col("chat_seq")).alias("chat_id"),
        F.lit(0).alias("turn"),
        F.lit("assistant").alias("role"),
        text.alias("text"),
    )

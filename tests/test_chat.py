"""Chat tables against plain Python on random and edge inputs."""

from __future__ import annotations

import html
import json
import random
import re
from datetime import datetime, timedelta

import pytest

from pyspark.sql import functions as F

from loomline.operators import chat

EDGE = [
    "no tags at all ",
    " <think>open only",
    "<THINK>x</THINK> y",
    "<think></think> z ",
    "<think>a</think> mid <think>b</think> end",
    "<think>a</think> x <think>a</think> y",
    "<think>$1 \\ .*</think> cost $1 \\ .*",
    "</think> first <think>in\nside</think> out",
    "<think>a<think>b</think>c</think>",
    "x<think> <b>&\"'</b> </think>é",
    "",
]


def plain_split(role, text):
    found = re.search(r"<think>(.*?)</think>", text, re.DOTALL) if role == "assistant" else None
    if not found:
        return None, text
    return found.group(1).strip(), text.replace(found.group(0), "").strip()


def messages(spark, rows):
    return spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")


def test_split_reasoning(spark):
    rng = random.Random(6)
    bits = ["<think>", "</think>", "a", " ", "\n", "é", "<", "think>"]
    texts = EDGE + ["".join(rng.choices(bits, k=rng.randint(0, 10))) for _ in range(2000)]
    rows = [(0, i, "user" if i % 9 == 4 else "assistant", t) for i, t in enumerate(texts)]
    for r in chat.split_reasoning(messages(spark, rows)).collect():
        assert (r.reasoning, r.answer) == plain_split(r.role, r.text), r.text


def random_chats(n=30):
    rng = random.Random(12)
    rows = []
    for conv in range(n):
        start = rng.randint(0, 3)
        for turn in range(start, start + rng.randint(1, 23)):
            role = rng.choice(["assistant", "user", "system"])
            rows.append((conv, turn, role, rng.choice(EDGE) + f" {conv} {turn}"))
    return rows


def by_chat(rows):
    chats = {}
    for row in sorted(rows):
        chats.setdefault(row[0], []).append(row)
    return chats


def put_together(df, column):
    whole = {}
    for r in sorted(df.collect(), key=lambda r: (r.conv_id, r.part)):
        whole[r.conv_id] = whole.get(r.conv_id, "") + r[column]
    return whole


def plain_message(role, text, name):
    reasoning, answer = plain_split(role, text)
    thoughts = ""
    if reasoning is not None:
        thoughts = (
            f"<details><summary>Reasoning</summary><div>{html.escape(reasoning)}</div></details>"
        )
    kind, label = (
        ("assistant", f"{name} reply") if role == "assistant" else ("user", "Your message")
    )
    return (
        f'<div class="message {kind}-message"><span class="message-label">{label}</span>'
        f"{thoughts}<div>{html.escape(answer)}</div></div>"
    )


@pytest.mark.parametrize("part_turns", [1, 4, 1000])
def test_transcripts_and_prompts_in_parts(spark, part_turns):
    rows = random_chats()
    df = messages(spark, rows).repartition(5)
    got = put_together(chat.transcripts(df, "Bot", "Talk", part_turns), "html")
    want = {
        conv: '<div class="chat-shell"><div class="chat-title">Talk</div>'
        + "".join(plain_message(r[2], r[3], "Bot") for r in turns)
        + "</div>"
        for conv, turns in by_chat(rows).items()
    }
    assert got == want

    waiting = {c: turns for c, turns in by_chat(rows).items() if turns[-1][2] == "user"}
    pending = {r.conv_id: r.last_turn for r in chat.pending_chats(df).collect()}
    assert pending == {c: turns[-1][1] for c, turns in waiting.items()}
    parts = chat.prompts(df, 'be "good"', part_turns).orderBy("conv_id", "part").collect()
    prompts = {}
    for r in parts:
        prompts.setdefault(r.conv_id, []).extend(json.loads(r.prompt))
    assert prompts == {
        c: [{"role": "system", "content": 'be "good"'}]
        + [{"role": r[2], "content": r[3]} for r in turns]
        for c, turns in waiting.items()
    }


def test_error_replies(spark):
    rows = [
        (1, 0, "assistant", "Error connecting to the model: timeout"),
        (1, 1, "user", "Error connecting to the model: quoted"),
        (1, 2, "assistant", "fine"),
        (2, 0, "assistant", " Error connecting to the model: "),
    ]
    got = {r.conv_id: tuple(r)[1:] for r in chat.error_replies(messages(spark, rows), "conv_id").collect()}
    assert got == {1: (2, 1, 0.5), 2: (1, 0, 0.0)}


def test_append_turns(spark):
    rows = random_chats(5)
    new = spark.createDataFrame(
        [(2, "user", "more"), (77, "user", "first")], "conv_id bigint, role string, text string"
    )
    got = {tuple(r) for r in chat.append_turns(messages(spark, rows), new).collect()}
    last = max(r[1] for r in rows if r[0] == 2)
    assert got == {*rows, (2, last + 1, "user", "more"), (77, 0, "user", "first")}


def plain_segments(stream):
    """stream: actions of one user in order -> (is_reset, chat_seq) of each."""
    seq, armed, out = 0, False, []
    for action in stream:
        reset = action == "new_chat" or (action == "yes" and armed)
        seq += reset
        if action == "clear":
            armed = True
        elif action != "new_chat":
            armed = False
        out.append((reset, seq))
    return out


def actions_table(spark, rows, kind="timestamp_ntz"):
    return spark.createDataFrame(rows, f"user_id bigint, ts {kind}, event_id bigint, action string")


@pytest.mark.parametrize(
    "stream,resets",
    [
        (["clear", "new_chat", "yes"], [False, True, True]),
        (["clear", "prompt", "yes"], [False, False, False]),
        (["clear", "cancel", "yes"], [False, False, False]),
        (["yes", "clear", "yes", "yes"], [False, False, True, False]),
    ],
)
def test_segment_rules(spark, stream, resets):
    start = datetime(2024, 1, 1)
    rows = [(5, start, i, a) for i, a in enumerate(stream)]
    got = sorted(chat.chat_segments(actions_table(spark, rows)).collect(), key=lambda r: r.event_id)
    assert [r.is_reset for r in got] == resets
    assert [(r.is_reset, r.chat_seq) for r in got] == plain_segments(stream)


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
@pytest.mark.parametrize("per_bucket", [1, 10, 200, 10**6])
def test_segments_across_buckets_with_a_hot_user(spark, kind, per_bucket):
    rng = random.Random(per_bucket)
    start = datetime(2024, 3, 31, 0, 0)
    kinds = ["new_chat", "clear", "yes", "cancel", "prompt"]
    rows = [
        (
            0 if rng.random() < 0.4 else rng.randint(1, 20),
            start + timedelta(seconds=rng.randint(0, 9000)),
            i,
            rng.choices(kinds, [1, 4, 4, 1, 1])[0],
        )
        for i in range(1500)
    ]
    actions = actions_table(spark, rows, kind).repartition(6)
    segments = chat.chat_segments(actions, per_bucket)
    got = segments.collect()
    want = {}
    for user in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == user), key=lambda r: (r[1], r[2]))
        for row, state in zip(own, plain_segments([r[3] for r in own])):
            want[row[2]] = state
    assert {r.event_id: (r.is_reset, r.chat_seq) for r in got} == want
    assert len({r.chat_id for r in got}) == len({(r.user_id, r.chat_seq) for r in got})

    greetings = chat.seed_greetings(segments, actions, "Bot").collect()
    ids = {(r.user_id, r.chat_seq): r for r in greetings}
    assert len(ids) == len(greetings)
    assert set(ids) == {(r.user_id, s) for r in got for s in range(r.chat_seq + 1)}
    for r in got:
        if r.is_reset:
            text = ids[r.user_id, r.chat_seq].text
            assert ids[r.user_id, r.chat_seq].chat_id == r.chat_id
            assert text == (
                "Hello! I am Bot. Nice to meet you."
                if r.action == "new_chat"
                else "Conversation reset. How can I help?"
            )
    assert {ids[r.user_id, 0].text for r in got} == {"Hello! I am Bot."}


def test_chats_without_an_id_and_texts_without_words(spark):
    rows = [(None, 0, "user", "a"), (None, 5, "user", None), (1, 0, "user", "b")]
    df = messages(spark, rows)
    assert {r.conv_id for r in chat.transcripts(df, part_turns=4).collect()} == {None, 1}
    found = {(r.conv_id, r.part): json.loads(r.prompt) for r in chat.prompts(df, "s", 4).collect()}
    assert found == {
        (None, 0): [{"role": "system", "content": "s"}, {"role": "user", "content": "a"}],
        (None, 1): [{"role": "user", "content": None}],
        (1, 0): [{"role": "system", "content": "s"}, {"role": "user", "content": "b"}],
    }


def test_append_several_turns(spark):
    old = messages(spark, [(1, 3, "user", "a"), (None, 0, "user", "n")])
    new = spark.createDataFrame(
        [(1, "user", "z", 1), (1, "assistant", "y", 0), (2, "user", "x", 0), (None, "user", "w", 0)],
        "conv_id long, role string, text string, nth int",
    )
    got = {(r.conv_id, r.turn): r.text for r in chat.append_turns(old, new, ["nth"]).collect()}
    assert got == {(1, 3): "a", (None, 0): "n", (1, 4): "y", (1, 5): "z", (2, 0): "x", (None, 1): "w"}


def test_reasoning_label(spark):
    df = messages(spark, [(1, 0, "assistant", "<think>why</think>so")])
    assert "<summary>Thoughts</summary>" in chat.transcripts(df, label="Thoughts").first().html


@pytest.mark.parametrize("per_bucket", [10, 10_000])
def test_segments_lose_no_action(spark, per_bucket):
    """Null users and times, and a thousand actions of one instant."""
    kinds = ["new_chat", "clear", "yes", "cancel", "prompt"]
    rows = [(None if k % 7 == 0 else k % 3, None if k % 11 == 0 else k, k, kinds[k % 5]) for k in range(60)]
    rows += [(1, 500, 1000 + k, kinds[(k * k) % 5]) for k in range(1000)]
    df = spark.createDataFrame(rows, "user_id long, ts long, event_id long, action string")
    df = df.withColumn("ts", F.timestamp_seconds("ts").cast("timestamp_ntz"))
    got = {r.event_id: (r.is_reset, r.chat_seq) for r in chat.chat_segments(df, per_bucket).collect()}
    want, last, seq = {}, {}, {}
    for user, ts, event, action in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2])):
        reset = action == "new_chat" or (action == "yes" and last.get(user) == "clear")
        seq[user] = seq.get(user, 0) + reset
        if action != "new_chat":
            last[user] = action
        want[event] = (reset, seq[user])
    assert got == want

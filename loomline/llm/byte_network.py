"""Quality by a convolutional network over bytes, in NumPy.

A text is read as its UTF-8 bytes. Each byte has a short learned vector; filters
of WINDOW bytes run over them at every STRIDE-th place. Blocks of BLOCK bytes
give the highest answer of each filter, and two neighbouring blocks make a chunk,
so chunks overlap by half and cover the whole text. A chunk's pooled answers, and the
share of it that is text, go through one hidden layer; the highest and the mean hidden value over all chunks
make one logit, and a logistic curve fitted on rows kept back from training makes
it a probability.

The network is trained on the driver on at most about ROWS documents of each
label, of up to TRAIN_BYTES bytes each. Texts of any length are scored whole, a
SLICE of bytes at a time. Byte 0 counts as nothing: it also fills up blocks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW, STRIDE, BLOCK = 6, 2, 256
WIDTH, FILTERS, HIDDEN = 8, 32, 16
#: Bounds of the sample that trains: documents of each label, and bytes of one.
ROWS = 800
TRAIN_BYTES = 1 << 16
EPOCHS, BATCH, RATE = 10, 32, 0.01
#: Every so many-th sampled row is kept back for the curve.
BACK = 5
#: Bytes whose filter answers are held at a time, and bytes of texts taken together.
SLICE, GROUP = 1 << 15, 1 << 20
_PLACES = BLOCK // STRIDE
_TAPS = WINDOW // STRIDE
_LEAD = WINDOW - STRIDE


@dataclass
class Network:
    bytes_: np.ndarray  # 256, WIDTH
    filters: np.ndarray  # WINDOW * WIDTH, FILTERS
    offset: np.ndarray
    inner: np.ndarray  # FILTERS + 1, HIDDEN
    inner_offset: np.ndarray
    last: np.ndarray  # 2 * HIDDEN
    last_offset: np.ndarray  # 1

    def parts(self) -> list[np.ndarray]:
        return list(vars(self).values())


def new_network(seed: int = 11) -> Network:
    draw = np.random.Generator(np.random.PCG64(seed))

    def normal(*shape: int, scale: float) -> np.ndarray:
        return (draw.standard_normal(shape) * scale).astype(np.float32)

    vectors = normal(256, WIDTH, scale=0.5)
    vectors[0] = 0
    return Network(
        vectors,
        normal(WINDOW * WIDTH, FILTERS, scale=1 / math.sqrt(WINDOW * WIDTH)),
        np.zeros(FILTERS, np.float32),
        normal(FILTERS + 1, HIDDEN, scale=1 / math.sqrt(FILTERS)),
        np.zeros(HIDDEN, np.float32),
        normal(2 * HIDDEN, scale=1 / math.sqrt(2 * HIDDEN)),
        np.zeros(1, np.float32),
    )


def laid_out(texts: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The texts one after another, each filled up to whole blocks; how many blocks each
    has, and how much of each block is text.

    A text begins with as many empty bytes as a window reaches beyond its first
    stride, so no window sees two texts.
    """
    blocks = np.array([-(-(_LEAD + len(t)) // BLOCK) for t in texts], np.int64)
    data = np.zeros(int(blocks.sum()) * BLOCK + _LEAD, np.uint8)
    at = 0
    for text, n in zip(texts, blocks.tolist()):
        data[at + _LEAD : at + _LEAD + len(text)] = np.frombuffer(text, np.uint8)
        at += n * BLOCK
    full = np.ones(int(blocks.sum()), np.float32)
    ends = np.cumsum(blocks) - 1
    full[ends] = [(_LEAD + len(t) - (n - 1) * BLOCK) / BLOCK for t, n in zip(texts, blocks.tolist())]
    return data, blocks, full


def windows(net: Network, data: np.ndarray) -> np.ndarray:
    """The vectors of each window, one row for each place."""
    flat = net.bytes_[data].reshape(-1)
    n = (len(data) - _LEAD) // STRIDE
    step = flat.strides[0]
    view = np.lib.stride_tricks.as_strided(
        flat, (n, WINDOW * WIDTH), (STRIDE * WIDTH * step, step), writeable=False
    )
    return np.ascontiguousarray(view)


def block_answers(net: Network, data: np.ndarray) -> np.ndarray:
    """The highest answer of each filter in each block, before its offset."""
    n = (len(data) - _LEAD) // BLOCK
    out = np.empty((n, FILTERS), np.float32)
    many = SLICE // BLOCK
    for at in range(0, n, many):
        end = min(n, at + many)
        answers = windows(net, data[at * BLOCK : end * BLOCK + _LEAD]) @ net.filters
        answers.reshape(end - at, _PLACES, FILTERS).max(axis=1, out=out[at:end])
    return out


def chunk_places(blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and second block of each chunk, and the place of each text's first chunk.

    A text of one block is one chunk of that block.
    """
    count = np.maximum(blocks - 1, 1)
    starts = np.cumsum(count) - count
    first = np.arange(int(count.sum())) + np.repeat(np.cumsum(blocks) - blocks - starts, count)
    second = first + np.repeat((blocks > 1).astype(np.int64), count)
    return first, second, starts


def document_values(
    net: Network, answers: np.ndarray, blocks: np.ndarray, full: np.ndarray
) -> dict[str, np.ndarray]:
    """All values from the blocks' answers to the logits of their texts."""
    raised = np.maximum(answers + net.offset, 0)
    first, second, starts = chunk_places(blocks)
    share = (full[first] + full[second]) / 2 * np.where(first == second, 0.5, 1)
    pooled = np.column_stack([np.maximum(raised[first], raised[second]), share.astype(np.float32)])
    hidden = np.maximum(pooled @ net.inner + net.inner_offset, 0)
    count = np.diff(np.append(starts, len(first)))
    highest = np.maximum.reduceat(hidden, starts)
    mean = np.add.reduceat(hidden, starts) / count[:, None].astype(np.float32)
    logit = np.concatenate([highest, mean], axis=1) @ net.last + net.last_offset[0]
    return {
        "raised": raised, "first": first, "second": second, "count": count, "pooled": pooled,
        "hidden": hidden, "highest": highest, "mean": mean, "logit": logit,
    }


def logits(net: Network, texts: Sequence[bytes]) -> np.ndarray:
    """One logit for each text, in groups of GROUP bytes; one text may be longer."""
    out = [np.empty(0, np.float32)]
    group: list[bytes] = []
    size = 0
    for k, text in enumerate(texts):
        group.append(text)
        size += len(text) + BLOCK
        if size >= GROUP or k + 1 == len(texts):
            data, blocks, full = laid_out(group)
            out.append(document_values(net, block_answers(net, data), blocks, full)["logit"])
            group, size = [], 0
    return np.concatenate(out)


def gradients(
    net: Network, texts: Sequence[bytes], target: np.ndarray, weight: np.ndarray
) -> tuple[float, list[np.ndarray]]:
    """The weighted logistic loss of the texts, and its slope in each part of the network."""
    data, blocks, full = laid_out(texts)
    rows = windows(net, data)
    answers = (rows @ net.filters).reshape(-1, _PLACES, FILTERS)
    where = answers.argmax(axis=1)
    v = document_values(net, np.take_along_axis(answers, where[:, None], 1)[:, 0], blocks, full)
    chance = 1 / (1 + np.exp(-np.clip(v["logit"], -30, 30)))
    loss = float(np.sum(weight * (np.logaddexp(0, v["logit"]) - target * v["logit"])))
    d_logit = (weight * (chance - target)).astype(np.float32)
    both = np.concatenate([v["highest"], v["mean"]], axis=1)
    d_both = d_logit[:, None] * net.last
    text_of = np.repeat(np.arange(len(blocks)), v["count"])
    top = v["hidden"] == v["highest"][text_of]
    ties = np.add.reduceat(top, np.cumsum(v["count"]) - v["count"]).astype(np.float32)
    share = d_both[:, :HIDDEN] / np.maximum(ties, 1)
    d_hidden = top * share[text_of] + (d_both[:, HIDDEN:] / v["count"][:, None])[text_of]
    d_hidden = (d_hidden * (v["hidden"] > 0)).astype(np.float32)
    d_pooled = d_hidden @ net.inner[:FILTERS].T
    left = v["raised"][v["first"]] >= v["raised"][v["second"]]
    d_raised = np.zeros_like(v["raised"])
    np.add.at(d_raised, v["first"], np.where(left, d_pooled, 0))
    np.add.at(d_raised, v["second"], np.where(left, 0, d_pooled))
    d_raised *= v["raised"] > 0
    place = where + np.arange(len(where))[:, None] * _PLACES
    d_filters = np.einsum("bf,bfk->kf", d_raised, rows[place])
    live = np.flatnonzero(d_raised)
    # bytes of the windows that answered highest take part, no others
    slope = d_raised.reshape(-1)[live, None] * net.filters.T[live % FILTERS]
    seen = data[place.reshape(-1)[live, None] * STRIDE + np.arange(WINDOW)]
    d_bytes = np.zeros_like(net.bytes_)
    np.add.at(d_bytes, seen.reshape(-1), slope.reshape(-1, WIDTH))
    d_bytes[0] = 0
    return loss, [
        d_bytes, d_filters, d_raised.sum(axis=0), v["pooled"].T @ d_hidden, d_hidden.sum(axis=0),
        both.T @ d_logit, d_logit.sum(keepdims=True),
    ]


def curve(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope (positive) and offset of a logistic curve of y (0 or 1) over x."""
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        pull = weight * (p - y)
        bend = weight * (p * (1 - p) + 1e-6)
        slope = np.array([pull @ x + 0.1 * (a - 1), pull.sum() + 0.01 * b])
        matrix = np.array([[bend @ (x * x) + 0.1, bend @ x], [bend @ x, bend.sum() + 0.01]])
        step = np.clip(np.linalg.solve(matrix, slope), -1, 1)
        a, b = max(a - step[0], 0.05), b - step[1]
        if abs(step).max() < 1e-7:
            break
    return float(a), float(b)


@dataclass
class Scorer:
    net: Network | None
    slope: float
    offset: float

    def scores(self, texts: Sequence[bytes]) -> np.ndarray:
        x = np.zeros(len(texts)) if self.net is None else logits(self.net, texts).astype(float)
        return 1 / (1 + np.exp(-np.clip(self.slope * x + self.offset, -30, 30)))


def fit(rows: Sequence[tuple[bytes, int]], share: float) -> Scorer:
    """A scorer from labelled texts, drawn so that share of all rows have label 1.

    Without rows of both labels it answers share.
    """
    y = np.array([label for _, label in rows], float)
    if len(set(y.tolist())) < 2:
        return Scorer(None, 0.0, math.log(max(share, 1e-6) / max(1 - share, 1e-6)))
    back = np.arange(len(rows)) % BACK == BACK - 1
    if len(set(y[back].tolist())) < 2 or len(set(y[~back].tolist())) < 2:
        back = np.zeros(len(rows), bool)
    train = np.flatnonzero(~back)
    # both labels weigh the same while training; the curve has the rows' own shares
    even = np.where(y > 0, 0.5 / y[train].mean(), 0.5 / (1 - y[train].mean()))
    net = new_network()
    order = np.random.Generator(np.random.PCG64(12))
    speed = [(np.zeros_like(p), np.zeros_like(p)) for p in net.parts()]
    steps = 0
    total = EPOCHS * -(-len(train) // BATCH)
    for _ in range(EPOCHS):
        shuffled = order.permutation(train)
        for at in range(0, len(shuffled), BATCH):
            own = shuffled[at : at + BATCH]
            _, slopes = gradients(net, [rows[k][0] for k in own], y[own], even[own] / len(own))
            steps += 1
            rate = RATE * min(1.0, steps / 20) * (1 - steps / (total + 1))
            for part, slope, (mean, square) in zip(net.parts(), slopes, speed):
                mean += 0.1 * (slope - mean)
                square += 0.01 * (slope * slope - square)
                near = mean / (1 - 0.9**steps)
                part -= (rate * near / (np.sqrt(square / (1 - 0.99**steps)) + 1e-8)).astype(np.float32)
    held = np.flatnonzero(back) if back.any() else train
    x = logits(net, [rows[k][0] for k in held]).astype(float)
    ones = y[held].mean()
    weight = np.where(y[held] > 0, share / ones, (1 - share) / (1 - ones))
    return Scorer(net, *curve(x, y[held], weight))


def learnable() -> Column:
    """Rows that may be learned from: crc32 of the id is not 1 modulo 3."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 != 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame) -> Scorer:
    """A scorer from learnable documents that labels marks quality 0 or 1."""
    marked = labels.select("doc_id", F.col("quality").cast("int").alias("quality")).filter(
        learnable() & F.col("quality").isin(0, 1)
    )
    sizes = {r["quality"]: r["count"] for r in marked.groupBy("quality").count().collect()}
    rank = F.pmod(F.xxhash64("doc_id", F.lit("quality")), F.lit(1 << 30))
    rate = F.when(F.col("quality") == 1, ROWS / max(sizes.get(1, 0), 1)).otherwise(
        ROWS / max(sizes.get(0, 0), 1)
    )
    drawn = marked.withColumn("rank", rank).filter(F.col("rank") < rate * (1 << 30))
    text = F.col("text").cast("binary")
    # about 2 * ROWS ids, and texts of up to TRAIN_BYTES bytes: small at every size
    rows = docs.select("doc_id", text.alias("text")).join(F.broadcast(drawn), "doc_id")
    rows = rows.filter(F.octet_length("text") <= TRAIN_BYTES).select("rank", "quality", "text")
    taken = sorted((r["rank"], bytes(r["text"]), r["quality"]) for r in rows.collect())
    ones, zeros = sizes.get(1, 0), sizes.get(0, 0)
    share = (ones + 1) / (ones + zeros + 2) if ones + zeros else 0.5
    return fit([(text, label) for _, text, label in taken], share)


def _score(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = shared.value
        for batch in batches:
            texts = [t or b"" for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(scorer.scores(texts), pa.float64())],
                names=["doc_id", "score"],
            )

    return run


def score_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted: one row for each row of docs.

    The score is the probability of quality 1. Null texts are scored as empty
    ones, and an empty text has the score of a block without a byte. Very long
    texts are scored whole, but do not train. A label on a missing document and a
    label other than 0 or 1 is not learned from; repeated labels count once each.
    Rows with a null doc_id are scored, not learned from and not held out. With
    labels of one kind only, every score is their smoothed share; without labels
    it is 0.5. Repeated rows are scored alike. An empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, labels))
    kind = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    scored = texts.mapInArrow(_score(shared), f"doc_id {kind}, score double")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    return scored.select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )

"""Language identification: sparse multinomial logistic regression.

A text is its lower-cased letters with every run of other characters as one
blank; its features are hashed character n-grams, weighed by TF-IDF and brought
to length one. Document frequencies are counted over all learnable documents.
The regression is trained on a bounded sample of them with
follow-the-regularised-leader steps under L1 and L2 penalties, and its
probabilities are calibrated by one temperature on a part held back from it.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS = 15
SLOTS = 1 << BITS
ORDERS = (1, 2, 3)
#: Languages that are learned at most: those with the most documents.
MOST_LANGUAGES = 128
#: At most about so many documents, spread evenly over languages, train the model.
TRAIN_ROWS = 1600
EPOCHS = 4
ALPHA, BETA, L1, L2 = 0.5, 1.0, 2e-3, 1e-3
CHUNK = 1 << 18
UNKNOWN = "und"
#: Share of held-back rows that may lie below the score that sets Model.least.
CLEAN_LOSS = 0.01


@functools.cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def _folded(text: str, last: int) -> np.ndarray:
    """Code points of the letters, 0 for a run of others; `last` comes before."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[points]
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    if len(keep):
        keep[0] |= last != 0
    return np.where(letter, points, 0)[keep]


def gram_counts(text: str | None) -> np.ndarray | None:
    """Counts of the hashed n-grams of a whole text; None without a letter."""
    if not text:
        return None
    counts = np.zeros(SLOTS, np.int64)
    seen = False
    tail = np.zeros(1, np.uint32)
    for at in range(0, len(text), CHUNK):
        fresh = _folded(text[at : at + CHUNK], int(tail[-1]))
        seen = seen or bool(fresh.any())
        line = np.concatenate([tail, fresh]).astype(np.uint64)
        new = len(fresh)
        for order in ORDERS:
            if len(line) < order:
                continue
            h = np.full(len(line) - order + 1, order, np.uint64)
            for k in range(order):
                h = (h ^ line[k : len(line) - order + 1 + k]) * np.uint64(0x9E3779B97F4A7C15)
                h ^= h >> np.uint64(29)
            # grams that end in this chunk only
            h = h[max(0, len(h) - new) :]
            counts += np.bincount((h >> np.uint64(64 - BITS)).astype(np.int64), minlength=SLOTS)
        tail = line[-(max(ORDERS) - 1) :].astype(np.uint32)
    return counts if seen else None


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    idf: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    #: Untempered probability of the likeliest language from which a text counts
    #: as one of the learned languages.
    least: float = 0.0

    def logits(self, counts: np.ndarray) -> np.ndarray:
        used = np.flatnonzero(counts)
        values = tfidf(counts[used], self.idf[used])
        return (values @ self.weights[used] + self.bias) / self.temperature


def tfidf(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    values = (1 + np.log(counts)) * idf
    return values / max(float(np.sqrt(values @ values)), 1e-12)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max())
    return e / e.sum()


def _document_frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(SLOTS, np.int64)
    n = 0
    for batch in batches:
        for text in batch.column("text"):
            counts = gram_counts(text.as_py())
            if counts is not None:
                total += counts > 0
                n += 1
    used = np.flatnonzero(total)
    slots = np.concatenate([used, [-1]])
    yield pa.RecordBatch.from_arrays(
        [pa.array(slots, pa.int64()), pa.array(np.concatenate([total[used], [n]]), pa.int64())],
        names=["slot", "df"],
    )


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        slots, values = [], []
        for text in batch.column("text"):
            counts = gram_counts(text.as_py())
            used = np.flatnonzero(counts) if counts is not None else np.empty(0, np.int64)
            slots.append(used.astype("<u2").tobytes())
            values.append(counts[used].astype("<u4").tobytes() if len(used) else b"")
        yield pa.RecordBatch.from_arrays(
            [batch.column("lang"), batch.column("rank"), pa.array(slots, pa.binary()), pa.array(values, pa.binary())],
            names=["lang", "rank", "slots", "counts"],
        )


def ftrl(rows: list[tuple[np.ndarray, np.ndarray, int]], classes: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights and bias of a multinomial regression, one pass a row and epoch.

    rows are (slots, values, class). Each weight has its own step size; a weight
    whose accumulated gradient stays within L1 is zero.
    """
    z = np.zeros((SLOTS + 1, classes))
    n = np.zeros((SLOTS + 1, classes))

    def weights(at: np.ndarray) -> np.ndarray:
        zs, ns = z[at], n[at]
        out = -(zs - np.sign(zs) * L1) / ((BETA + np.sqrt(ns)) / ALPHA + L2)
        out[np.abs(zs) <= L1] = 0.0
        return out

    for _ in range(EPOCHS):
        for slots, values, label in rows:
            at = np.append(slots, SLOTS)
            x = np.append(values, 1.0)
            w = weights(at)
            error = softmax(x @ w)
            error[label] -= 1.0
            g = x[:, None] * error[None, :]
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
            z[at] += g - sigma * w
            n[at] += g * g
    every = weights(np.arange(SLOTS + 1))
    return every[:-1], every[-1]


def _temperature(model: Model, rows: list[tuple[np.ndarray, np.ndarray, int]]) -> float:
    """The temperature at which held-back rows are likeliest, among a fixed grid."""
    if not rows:
        return 1.0
    raw = [(values @ model.weights[slots] + model.bias, label) for slots, values, label in rows]

    def loss(t: float) -> float:
        return -sum(float(np.log(softmax(x / t)[label] + 1e-12)) for x, label in raw)

    return min(np.geomspace(0.02, 20, 121).tolist(), key=loss)


def _least(model: Model, rows: list[tuple[np.ndarray, np.ndarray, int]]) -> float:
    """Midway between chance and what all but CLEAN_LOSS of the held-back rows reach.

    Only rows whose language is found count. The temperature stays out of it: on
    rows that are told apart without an error it makes any text a sure one.
    """
    chance = 1 / len(model.languages)
    found = [softmax(values @ model.weights[slots] + model.bias) for slots, values, _ in rows]
    tops = [float(p.max()) for p, (_, _, label) in zip(found, rows) if int(p.argmax()) == label]
    return (chance + float(np.quantile(tops, CLEAN_LOSS))) / 2 if tops else chance


def learnable() -> F.Column:
    """Rows that may be learned from: those whose crc32 of the id is not 2 modulo 4."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 != 2, F.lit(False))


def train(docs: DataFrame) -> Model:
    """A model of the languages of learnable documents with a language and a letter.

    With no such document the model knows no language; with one language it
    always answers it. Of more than MOST_LANGUAGES languages those with the most
    documents are learned; the weights have that many columns at most.
    """
    known = docs.select("doc_id", "lang", "text").filter(learnable() & F.col("lang").isNotNull())
    counted = known.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MOST_LANGUAGES)
    sizes = {r["lang"]: r["count"] for r in counted.collect()}
    languages = tuple(sorted(sizes))
    if not languages:
        return Model((), np.ones(SLOTS), np.zeros((SLOTS, 0)), np.zeros(0))
    parts = known.select("text").mapInArrow(_document_frequencies, "slot bigint, df bigint")
    df = np.zeros(SLOTS)
    n = 0
    for row in parts.groupBy("slot").agg(F.sum("df").alias("df")).toLocalIterator():
        if row["slot"] < 0:
            n = row["df"]
        else:
            df[row["slot"]] = row["df"]
    idf = np.log((1 + n) / (1 + df)) + 1
    share = TRAIN_ROWS / len(languages)
    rates = F.create_map(*[x for lang, size in sizes.items() for x in (F.lit(lang), F.lit(share / size))])
    rank = F.pmod(F.xxhash64("doc_id", F.lit("train")), F.lit(1 << 30))
    drawn = known.withColumn("rank", rank).filter(F.col("rank") < rates[F.col("lang")] * (1 << 30))
    taken = drawn.select("lang", "rank", "text").mapInArrow(
        _vectors, "lang string, rank bigint, slots binary, counts binary"
    )
    rows = []
    for r in sorted(taken.collect(), key=lambda r: (r["rank"], r["lang"], r["slots"])):
        slots = np.frombuffer(r["slots"], "<u2").astype(np.int64)
        if len(slots):
            counts = np.frombuffer(r["counts"], "<u4").astype(float)
            rows.append((slots, tfidf(counts, idf[slots]), languages.index(r["lang"])))
    held, used = rows[::5], [r for k, r in enumerate(rows) if k % 5]
    weights, bias = ftrl(used, len(languages))
    model = Model(languages, idf, weights, bias)
    return Model(languages, idf, weights, bias, _temperature(model, held), _least(model, held))


def _predict(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        for batch in batches:
            names, scores, sure = [], [], []
            for text in batch.column("text"):
                counts = gram_counts(text.as_py())
                if counts is None or not m.languages:
                    names.append(UNKNOWN)
                    scores.append(0.0)
                    sure.append(False)
                    continue
                logits = m.logits(counts)
                p = softmax(logits)
                best = int(p.argmax())
                names.append(m.languages[best])
                scores.append(float(p[best]))
                # a little room for rounding: a model of one language is always sure
                sure.append(float(softmax(logits * m.temperature)[best]) >= m.least - 1e-9)
            kept = [batch.column(c) for c in batch.schema.names]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(sure, pa.bool_())],
                names=[*batch.schema.names, "lang_pred", "lang_score", "lang_sure"],
            )

    return run


def with_language(docs: DataFrame, model: Model, columns: list[str]) -> DataFrame:
    """columns of docs (text among them), lang_pred, lang_score, lang_sure.

    lang_sure says if the text is in a learned language: its untempered
    probability is model.least or more.
    """
    chosen = docs.select(*columns)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return chosen.mapInArrow(_predict(shared), f"{fields}, lang_pred string, lang_score double, lang_sure boolean")


def predict_languages(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score: one row for each row of docs.

    The prediction is `und` with score 0 if the text is null or has no letter,
    or if nothing could be learned. Rows with a null doc_id are not learned from
    and not held out. An empty table gives no rows.
    """
    found = with_language(docs, train(docs), ["doc_id", "text"])
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))

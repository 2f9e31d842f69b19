"""Toxicity by a subsequence string kernel, a support vector machine and Nystroem landmarks.

Two words are alike by the gap-weighted four-character subsequences they share:
one that spans k characters counts DECAY**k, up to SPAN characters, so an insult
with a few inserted or dropped characters stays near its plain form. A word's
two ends count as characters.
Characters other than letters and digits are dropped first, and runs of single
letters are joined, so "i.d-i o t" is one word.

The machine is trained on the sentences of a bounded sample of labelled
documents. A sentence has its document's label, so a toxic document is a bag in
which some word must be the witness: witnesses are chosen, the machine is
trained on them against words of clean sentences, and both steps are repeated.
Landmarks give each word a short vector (Nystroem); the machine is linear in it.
Since the kernel is a sum over shared subsequences, the trained machine folds
into one weight for each four characters, and a whole text is scored by adding up
weights at its characters. A document's score is that of its two worst words.
"""

from __future__ import annotations

import functools
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DECAY = 0.5
SPAN = 6
SYMBOLS = 40
KEYS = SYMBOLS**4
LANDMARKS = 300
#: At most about so many toxic and clean labelled documents train the machine.
TOXIC_ROWS, CLEAN_ROWS = 1000, 3000
ROUNDS = 3
#: A document is judged by so many of its words.
WORST = 2
#: A witness is so many times as frequent in toxic documents as in clean ones.
RATIO = 5
#: Words of clean sentences with the highest values that join the negatives each round.
HARD = 1000
PENALTY = 2000.0
#: Shorter words count as nothing: a few letters are part of too many words.
LEAST = 4
CHUNK = 1 << 18
_CUT, _DROP = 0, 255
_OFFSETS = [(a, b, c) for c in range(3, SPAN) for b in range(2, c) for a in range(1, b)]


@functools.cache
def _codes() -> np.ndarray:
    """Code point to symbol: blanks cut words, other marks are dropped."""
    table = np.full(0x110000, _DROP, np.uint8)
    for c in range(0x110000):
        char = chr(c)
        if char.isspace():
            table[c] = _CUT
        elif "a" <= char <= "z":
            table[c] = 1 + c - ord("a")
        elif "0" <= char <= "9":
            table[c] = 27
        elif char.isalnum():
            table[c] = 28 + c % (SYMBOLS - 28)
    return table


def symbols(text: str) -> np.ndarray:
    """Symbols of a text with one cut before, between and after its words."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = _codes()[points]
    codes = np.concatenate([[_CUT], codes[codes != _DROP], [_CUT]]).astype(np.uint8)
    codes = codes[np.append(True, (codes[1:] != _CUT) | (codes[:-1] != _CUT))]
    cuts = np.flatnonzero(codes == _CUT)
    lone = np.diff(cuts) == 2
    return np.delete(codes, cuts[1:-1][lone[:-1] & lone[1:]]) if len(cuts) > 2 else codes


@functools.cache
def _scale(length: int) -> float:
    """One over the length of the vector of a word without repeated subsequences."""
    total = sum(DECAY ** (2 * (c + 1)) * max(0, length + 2 - c) for _, _, c in _OFFSETS)
    return 1 / math.sqrt(total) if total else 0.0


@functools.cache
def _scale_table() -> np.ndarray:
    return np.array([_scale(n) for n in range(257)])


def scales(lengths: np.ndarray) -> np.ndarray:
    """_scale of each length; beyond 256 it falls with the root of the length."""
    near = _scale_table()[np.minimum(lengths, 256)]
    return np.where(lengths <= 256, near, near * np.sqrt(256 / np.maximum(lengths, 1)))


def _keys(line: np.ndarray) -> Iterator[tuple[float, np.ndarray, np.ndarray]]:
    """For each way to pick: its weight, the keys by first character, which are in one word."""
    wide = line.astype(np.int32)
    cuts = np.cumsum(line == _CUT)
    for a, b, c in _OFFSETS:
        n = len(line) - c
        if n > 0:
            key = ((wide[:n] * SYMBOLS + wide[a : a + n]) * SYMBOLS + wide[b : b + n]) * SYMBOLS + wide[c:]
            yield DECAY ** (c + 1), key, cuts[c - 1 : c - 1 + n] == cuts[:n]


def word_sums(line: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, lengths and values of the words of a line of symbols.

    table has a weight for each four symbols. The value is the scaled sum of the
    weights of a word's subsequences.
    """
    cuts = np.flatnonzero(line == _CUT)
    if len(cuts) < 2:
        return cuts[:0], cuts[:0], np.empty(0)
    total = np.zeros(len(line))
    for weight, key, inside in _keys(line):
        total[: len(key)] += np.where(inside, table[key], 0.0) * weight
    lengths = np.diff(cuts) - 1
    values = np.add.reduceat(total, cuts)[:-1] * scales(lengths)
    return cuts[:-1] + 1, lengths, np.where(lengths < LEAST, 0.0, values)


class Vectors:
    """The scaled vectors of words of symbols: keys and values, word after word."""

    def __init__(self, words: list[bytes]) -> None:
        parts = [self._one(w) for w in words]
        sizes = [len(k) for k, _ in parts]
        self.ends = np.cumsum(sizes)
        self.keys = np.concatenate([np.empty(0, np.int64), *[k for k, _ in parts]])
        self.values = np.concatenate([np.empty(0), *[v for _, v in parts]])

    @staticmethod
    def _one(word: bytes) -> tuple[np.ndarray, np.ndarray]:
        line = np.frombuffer(b"\0" + word + b"\0", np.uint8)
        found = [(key[inside], np.full(inside.sum(), weight)) for weight, key, inside in _keys(line)]
        if not found:
            return np.empty(0, np.int64), np.empty(0)
        keys, where = np.unique(np.concatenate([k for k, _ in found]), return_inverse=True)
        values = np.bincount(where, np.concatenate([v for _, v in found]))
        return keys, values * float(scales(np.array([len(word)]))[0])

    def of(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        at = slice(self.ends[k - 1] if k else 0, self.ends[k])
        return self.keys[at], self.values[at]

    def products(self, table: np.ndarray) -> np.ndarray:
        """The sum of each word's values times the table at its keys."""
        sums = np.concatenate([[0.0], np.cumsum(self.values * table[self.keys])])
        return sums[self.ends] - sums[np.concatenate([[0], self.ends[:-1]])]


def kernel(left: list[bytes], right: list[bytes]) -> np.ndarray:
    """The kernel of every word of left with every word of right."""
    rows, columns = Vectors(left), Vectors(right)
    out = np.zeros((len(left), len(right)))
    table = np.zeros(KEYS)
    for j in range(len(right)):
        keys, values = columns.of(j)
        table[keys] = values
        out[:, j] = rows.products(table)
        table[keys] = 0.0
    return out


def landmarks(words: list[bytes], limit: int = LANDMARKS) -> list[bytes]:
    """Words whose kernel columns explain most of the rest (pivoted Cholesky)."""
    vectors = Vectors(words)
    table = np.zeros(KEYS)
    rest = np.array([float(v @ v) for _, v in map(vectors.of, range(len(words)))])
    chosen: list[int] = []
    rows = np.zeros((min(limit, len(words)), len(words)))
    while len(chosen) < len(rows) and rest.max(initial=0) > 1e-6:
        k = int(rest.argmax())
        keys, values = vectors.of(k)
        table[keys] = values
        column = vectors.products(table) - rows.T @ rows[:, k]
        table[keys] = 0.0
        column /= math.sqrt(rest[k])
        rows[len(chosen)] = column
        rest = np.maximum(rest - column**2, 0)
        rest[k] = 0
        chosen.append(k)
    return [words[k] for k in chosen]


def squared_hinge(x: np.ndarray, y: np.ndarray, weight: np.ndarray, steps: int = 40) -> tuple[np.ndarray, float]:
    """Linear support vector machine with squared hinge loss, by Newton steps.

    Each step solves the least squares problem of the rows within the margin.
    """
    x1 = np.hstack([x, np.ones((len(x), 1))])
    ridge = np.diag(np.append(np.full(x.shape[1], 1.0), 0.01))
    w = np.zeros(x1.shape[1])
    inside = np.ones(len(y), bool)
    for step in range(steps):
        rows, scale = x1[inside], 2 * PENALTY * weight[inside]
        target = np.linalg.solve(ridge + (rows.T * scale) @ rows, rows.T @ (scale * y[inside]))
        w = w + (target - w) * (1.0 if step < steps // 2 else 0.5)
        fresh = y * (x1 @ w) < 1
        if (fresh == inside).all():
            break
        inside = fresh
    return w[:-1], float(w[-1])


def logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Slopes and offset of a logistic curve of y (0 or 1) over rows x, with smoothed targets."""
    n1, n0 = y.sum(), len(y) - y.sum()
    target = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x1 = np.hstack([x, np.ones((len(x), 1))])
    ridge = np.append(np.full(x.shape[1], 0.05), 1e-6)
    w = np.zeros(x1.shape[1])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x1 @ w, -30, 30)))
        curve = p * (1 - p) + 1e-9
        step = np.linalg.solve(
            (x1.T * curve) @ x1 + np.diag(ridge), x1.T @ (p - target) + ridge * w
        )
        w = w - step
        if abs(step).max() < 1e-8:
            break
    w[:-1] = np.maximum(w[:-1], 1e-3)
    return w


def highest(values: np.ndarray, best: list[float]) -> list[float]:
    """The highest values of best and values; equal words have equal values and count once."""
    high = values[values > best[-1]]
    return sorted({*best, *np.unique(high)[-WORST:].tolist()}, reverse=True)[:WORST] if len(high) else best


@dataclass(frozen=True)
class Machine:
    table: np.ndarray
    bias: float
    curve: np.ndarray

    def score(self, text: str | None) -> float:
        """The probability that a text is toxic, from its WORST worst distinct words.

        A word counts for 1, the machine's margin, at most, and a missing word
        as much as one that shares nothing with the landmarks.
        """
        best = [0.0] * WORST
        tail = ""
        text = text or ""
        at = 0
        while at < len(text):
            part = tail + text[at : at + CHUNK]
            at += CHUNK
            tail = ""
            if at < len(text):
                # the last words of a chunk are scored with the next one
                cut = max(part.rfind(c, 0, len(part) - 64) for c in " \n\t")
                if cut > 0:
                    part, tail = part[:cut], part[cut:]
            best = highest(word_sums(symbols(part), self.table)[2], best)
        x = sum(w * min(1.0, b + self.bias) for w, b in zip(self.curve, best)) + self.curve[-1]
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, float(x)))))


def sentences(text: str) -> list[str]:
    out = []
    for line in text.split("\n"):
        out.extend(s for s in line.replace("!", ".").replace("?", ".").split(". ") if s.strip())
    return out


def bag(text: str) -> frozenset[bytes]:
    """The distinct words of the sentences of a text."""
    words = (w for s in sentences(text) for w in symbols(s).tobytes().split(b"\0"))
    return frozenset(w for w in words if LEAST <= len(w) <= 64)


def fit(rows: list[tuple[frozenset[bytes], int]]) -> Machine:
    """A machine from labelled bags of words; equal bags count once.

    Without both labels it answers their share.
    """
    bags = list(dict.fromkeys(rows))
    toxic = [b for b, label in bags if label]
    clean = [b for b, label in bags if not label]
    if not toxic or not clean:
        share = 0.5 if not bags else len(toxic) / len(bags)
        share = min(max(share, 1e-6), 1 - 1e-6) if bags else 1e-6
        return Machine(np.zeros(KEYS), 0.0, np.append(np.zeros(WORST), math.log(share / (1 - share))))
    seen_clean = Counter(w for b in clean for w in b)
    seen_toxic = Counter(w for b in toxic for w in b)

    def odds(word: bytes) -> tuple[float, bytes]:
        # words of many toxic and of no clean documents first
        n, m = seen_toxic[word], seen_clean[word]
        return n * math.log((n + 0.5) / (len(toxic) + 1) / ((m + 0.5) / (len(clean) + 1))), word

    def marked(word: bytes) -> bool:
        return seen_toxic[word] * len(clean) >= RATIO * seen_clean[word] * len(toxic)

    # a toxic document without a word that is mostly toxic has no witness
    suspects = [s for s in (sorted(w for w in b if marked(w)) for b in toxic) if s]
    witnesses: set[bytes] = set()
    for suspect in suspects:
        best = max(odds(w)[0] for w in suspect)
        witnesses.update(w for w in suspect if odds(w)[0] >= max(best / 2, 1e-9))
    witnesses = {w for w in witnesses if seen_toxic[w] >= 2} or witnesses or {max(toxic[0] or {b"?"})}
    common = [w for w, _ in sorted(seen_clean.items(), key=lambda x: (-x[1], x[0]))]
    rare = sorted(seen_clean, key=lambda w: hash_order(w))
    negatives = dict.fromkeys(common[:1000] + rare[:2000])
    table, bias = np.zeros(KEYS), 0.0
    vocabulary = sorted(set(seen_clean) | set(seen_toxic))
    joined = np.frombuffer(b"\0" + b"\0".join(vocabulary) + b"\0", np.uint8)
    for turn in range(ROUNDS):
        positive = sorted(witnesses)
        negative = [w for w in negatives if w not in witnesses]
        marks = landmarks(positive + negative[:400])
        gram = kernel(marks, marks)
        values, vectors = np.linalg.eigh(gram)
        good = values > 1e-6 * values.max()
        root = vectors[:, good] / np.sqrt(values[good])
        x = kernel(positive + negative, marks) @ root
        y = np.append(np.ones(len(positive)), -np.ones(len(negative)))
        weight = np.append(
            np.full(len(positive), 0.5 / len(positive)), np.full(len(negative), 0.5 / len(negative))
        )
        w, bias = squared_hinge(x, y, weight)
        table = np.zeros(KEYS)
        folded = Vectors(marks)
        for k, share in enumerate(root @ w):
            keys, parts = folded.of(k)
            table[keys] += share * parts
        scored = dict(zip(vocabulary, word_sums(joined, table)[2].tolist()))
        if turn + 1 < ROUNDS:
            witnesses |= {w for b in suspects if scored[w := max(b, key=lambda w: (scored[w], w))] + bias > 0}
            worst = sorted(seen_clean, key=lambda w: (-scored[w], w))[:HARD]
            negatives |= dict.fromkeys(worst)
    tops = [highest(np.array([scored[w] for w in b]), [0.0] * WORST) for b, _ in bags]
    x = np.minimum(1.0, np.array(tops) + bias)
    return Machine(table, bias, logistic(x, np.array([label for _, label in bags], float)))


def hash_order(word: bytes) -> int:
    value = 1469598103934665603
    for byte in word:
        value = (value ^ byte) * 1099511628211 % 2**64
    return value


def learnable() -> F.Column:
    """Rows that may be learned from: crc32 of the id is not 0 modulo 5."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 != 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame) -> Machine:
    """A machine from learnable documents that labels marks toxic 0 or 1."""
    marked = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).filter(
        learnable() & F.col("toxic").isin(0, 1)
    )
    sizes = {r["toxic"]: r["count"] for r in marked.groupBy("toxic").count().collect()}
    rank = F.pmod(F.xxhash64("doc_id", F.lit("train")), F.lit(1 << 30))
    rate = F.when(F.col("toxic") == 1, TOXIC_ROWS / max(sizes.get(1, 0), 1)).otherwise(
        CLEAN_ROWS / max(sizes.get(0, 0), 1)
    )
    drawn = marked.withColumn("rank", rank).filter(F.col("rank") < rate * (1 << 30))
    # about TOXIC_ROWS + CLEAN_ROWS ids: small at every size
    rows = docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id").filter("text is not null")
    taken = rows.select("rank", "toxic", "text").mapInArrow(_bags, "rank bigint, toxic int, words binary")
    ordered = sorted((r["rank"], bytes(r["words"]), r["toxic"]) for r in taken.collect())
    return fit([(frozenset(words.split(b"\0")) - {b""}, toxic) for _, words, toxic in ordered])


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words = [b"\0".join(sorted(bag(t.as_py()))) for t in batch.column("text")]
        yield pa.RecordBatch.from_arrays(
            [batch.column("rank"), batch.column("toxic"), pa.array(words, pa.binary())],
            names=["rank", "toxic", "words"],
        )


def _score(machine):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = machine.value
        for batch in batches:
            scores = [m.score(text.as_py()) for text in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(scores, pa.float64())], names=["doc_id", "score"]
            )

    return run


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted: one row for each row of docs.

    Null and empty texts have the score of a text without a word. A label on a
    document that is missing, and a label other than 0 or 1, is not learned
    from. Repeated labels count once each. Rows with a null doc_id are scored,
    not learned from and not held out. Without labels of both kinds every score
    is the share of toxic ones (nearly 0 without any). Empty tables give no rows.
    """
    machine = docs.sparkSession.sparkContext.broadcast(train(docs, labels))
    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = docs.select("doc_id", "text").mapInArrow(_score(machine), f"doc_id {kind}, score double")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    return scored.select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )

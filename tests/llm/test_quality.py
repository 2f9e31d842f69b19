"""Base counts against plain Python; outliers of planted groups."""

from __future__ import annotations

import collections
import random
import re
import struct

import numpy as np
import pytest
import xxhash
from edge_rows import EDGE

from loomline.llm import quality

WORD = re.compile("[^\x20\x09-\x0D]+")


def base_counts(text):
    text = text or ""
    words = WORD.findall(text)
    grams = collections.Counter(zip(words, words[1:], words[2:]))
    covered = {k + j for k in range(len(words) - 2) if grams[tuple(words[k : k + 3])] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


def test_base_counts(docs):
    rng = random.Random(6)
    bits = ["a", "b", "c", "é#", "\n", "\n\n", "\t", "|", "$x", "a b a b", "\x0b", " "]
    rows = [*EDGE, *((100 + k, " ".join(rng.choices(bits, k=rng.randint(0, 30)))) for k in range(150))]
    got = quality.quality_verdicts(docs(rows)).collect()
    fields = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert sorted((str(r.doc_id), *(r[f] for f in fields)) for r in got) == sorted(
        (str(i), *base_counts(t)) for i, t, *_ in rows
    )
    for r in got:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)


def test_planted_outliers_go_and_clean_rows_stay(docs):
    rng = random.Random(7)
    clean = [(k, " ".join("x" * rng.randint(2, 9) + str(rng.random()) for _ in range(rng.randint(80, 400))), "en", "s") for k in range(600)]
    junk = [(1000 + k, " ".join(f"w{rng.randint(0, 9999)}$$$***###" for _ in range(150)), "en", "s") for k in range(60)]
    kept = {r.doc_id: r.kept for r in quality.quality_verdicts(docs([*clean, *junk])).collect()}
    assert sum(kept[i] for i, *_ in clean) >= 0.995 * len(clean)
    assert not any(kept[i] for i, *_ in junk)


class Plain:
    """The estimate of one group in NumPy, step for step."""

    def __init__(self, x):
        self.x = np.array(x, float)
        n = len(self.x)
        starts = [self.quartiles(), self.moments(np.ones(n, bool))]
        drawn = np.array([self.drawn(v) for v in x])
        starts += [self.moments(drawn == k - 2) for k in range(2, quality.STARTS) if (drawn == k - 2).any()]
        for _ in range(quality.STEPS):
            starts = [self.step(*s) for s in starts]
        self.best = min(starts, key=self.log_det)
        while self.log_det(fresh := self.step(*self.best)) < self.log_det(self.best) - quality.LEAST_FALL:
            self.best = fresh

    @staticmethod
    def drawn(v):
        seed = 42
        for value in v:
            seed = xxhash.xxh64(struct.pack("<q", value), seed=seed).intdigest()
        return (seed - 2**64 if seed >> 63 else seed) % quality.DRAWN

    def quartiles(self):
        ordered = np.sort(self.x, axis=0)
        at = lambda q: ordered[int(np.ceil(q * len(ordered))) - 1]
        return at(0.5), np.diag(((at(0.75) - at(0.25)) / 1.349) ** 2)

    def moments(self, rows):
        own = self.x[rows]
        centre = own.mean(axis=0)
        return centre, (own.T @ own / len(own) - np.outer(centre, centre)) / quality.consistency(quality.CORE, quality.P)

    @staticmethod
    def factor(cov):
        low = np.zeros_like(cov)
        for i in range(len(cov)):
            for j in range(i):
                low[i, j] = (cov[i, j] - low[i, :j] @ low[j, :j]) / low[j, j]
            low[i, i] = max(cov[i, i] - low[i, :i] @ low[i, :i], (quality.FLOORS[i] * quality.UNIT) ** 2) ** 0.5
        return low

    def distances(self, centre, cov):
        return (np.linalg.solve(self.factor(cov), (self.x - centre).T) ** 2).sum(axis=0)

    def step(self, centre, cov):
        bins = np.floor(np.log(self.distances(centre, cov) + 1e-3) * quality.BINS)
        taken = np.sort(bins)[int(np.ceil(quality.CORE * len(bins))) - 1]
        return self.moments(bins <= taken)

    def log_det(self, estimate):
        return 2 * np.log(np.diag(self.factor(estimate[1]))).sum()


def vectors(rng, n, kind):
    """n whole vectors; most of one kind, some of another, some kinds all alike."""
    draw = np.random.Generator(np.random.PCG64(rng))
    mixed = draw.normal(size=(n, 5)) @ draw.normal(size=(5, 5)) * 300 + 2000
    if kind == "planted":
        far = draw.random(n) < 0.2
        mixed[far] = draw.normal(size=(far.sum(), 5)) * 40 + [9000, 100, 5000, 0, 7000]
    if kind == "alike":
        mixed[:, 2:] = 0
        mixed[: n // 10, 3] = 200
    return np.round(mixed).astype(int).tolist()


def test_estimates_equal_numpy(spark):
    groups = {f"g{k}": vectors(k, 150 + 70 * k, kind) for k, kind in enumerate(["plain", "planted", "alike", "planted"])}
    rows = [(g, *map(int, v)) for g, many in groups.items() for v in many]
    table = spark.createDataFrame(rows, "g string, x0 long, x1 long, x2 long, x3 long, x4 long").repartition(5)
    estimate = quality.least_determinant(table)
    got = collections.defaultdict(list)
    for r in quality._distances(table, estimate).collect():
        got[r.g].append((r.x0, r.x1, r.x2, r.x3, r.x4, r.d2))
    for g, many in groups.items():
        plain = Plain(many)
        want = sorted((*v, d) for v, d in zip(many, plain.distances(*plain.best)))
        assert len(got[g]) == len(want)
        for a, b in zip(sorted(got[g]), want):
            assert a[:5] == b[:5] and a[5] == pytest.approx(b[5], rel=1e-6)


def test_planted_rows_do_not_hide_behind_one_another(spark):
    """A fifth of the rows far away in a crowd: the estimate of least determinant leaves it out."""
    many = vectors(7, 600, "planted")
    table = spark.createDataFrame([("g", *map(int, v)) for v in many], "g string, x0 long, x1 long, x2 long, x3 long, x4 long")
    limit = quality.chi2_quantile(quality.CUTOFF, quality.P)
    found = {tuple(r)[1:6]: r.d2 > limit for r in quality._distances(table, quality.least_determinant(table)).collect()}
    assert all(found[tuple(v)] for v in many if v[0] > 7000)
    assert sum(found[tuple(v)] for v in many if v[0] < 7000) < 0.05 * len(many)


def test_plans_stay_small(spark, monkeypatch):
    """A step reads the factors of the estimate before: their terms, written out in every join
    and filter, filled the driver's memory."""
    sizes, plain = [], quality.written

    def measured(df, label):
        sizes.append(len(df._jdf.queryExecution().optimizedPlan().toString()))
        return plain(df, label)

    monkeypatch.setattr(quality, "written", measured)
    table = spark.createDataFrame([("g", *map(int, v)) for v in vectors(3, 250, "planted")], "g string, x0 long, x1 long, x2 long, x3 long, x4 long")
    quality.least_determinant(quality.written(table, "quality-test"))
    assert len(sizes) > 4 and max(sizes) < 20_000, sizes


def lines(rng, n, low, high):
    """n different lines of ten words of low to high letters, no window of words twice."""
    return [" ".join("x" * rng.randint(low, high) + str(rng.randint(10**5, 10**6)) for _ in range(10)) for _ in range(n)]


def test_moderate_junk_goes(docs):
    rng = random.Random(8)
    clean = [(k, "\n".join(lines(rng, rng.randint(20, 30), 1, 4)), "en", "s") for k in range(400)]
    junk = []
    for k in range(10):
        body = lines(rng, 24, 1, 4)
        junk.append((1000 + k, "\n".join(body[:18] + body[:6]), "en", "s"))  # a quarter of the lines twice
        junk.append((2000 + k, "\n".join(x + " " + "#|" * 5 for x in body), "en", "s"))  # 8 % symbols
    kept = {r.doc_id: r.kept for r in quality.quality_verdicts(docs([*clean, *junk])).collect()}
    assert sum(kept[i] for i, *_ in clean) >= 0.99 * len(clean)
    assert not any(kept[i] for i, *_ in junk)


def test_small_groups_are_held_against_their_language(docs):
    rng = random.Random(9)
    rows = []
    for lang, low, high in (("en", 1, 3), ("de", 9, 12)):
        for k in range(240):  # sources of 80 rows
            rows.append((len(rows), "\n".join(lines(rng, rng.randint(20, 30), low, high)), lang, f"s{k % 3}"))
    rows += [(5000 + k, "\n".join(lines(rng, 25, 9, 12)), "en", "s0") for k in range(3)]  # of the other language
    rows += [(6000 + k, "\n".join(lines(rng, 25, 1, 3)), "fr", None) for k in range(3)]  # too few: all rows
    got = {r.doc_id: r for r in quality.quality_verdicts(docs(rows)).collect()}
    assert sum(got[i].kept for i in range(480)) >= 0.99 * 480
    assert not any(got[5000 + k].kept for k in range(3))
    assert all(got[6000 + k].distance2 is not None for k in range(3))


def test_empty_and_small_tables(docs):
    assert quality.quality_verdicts(docs([])).count() == 0
    text = " ".join(f"w{k}" for k in range(80))
    rows = quality.quality_verdicts(docs([(1, text, None, None), (2, text, "en", None)])).collect()
    assert [(r.kept, r.distance2) for r in rows] == [(True, None)] * 2


@pytest.mark.parametrize("dof, p, x", [(5, 0.95, 11.0705), (7, 0.5, 6.3458), (5, 0.75, 6.6257)])
def test_chi_square(dof, p, x):
    assert quality.chi2_quantile(p, dof) == pytest.approx(x, abs=1e-3)
    assert quality.chi2_cdf(x, dof) == pytest.approx(p, abs=1e-4)

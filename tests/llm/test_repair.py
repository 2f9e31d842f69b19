"""Conversation repair against the whole table of costs and edits."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import pytest

from loomline.llm import repair

SCHEMA = (
    "conv_id bigint, turn bigint, role string, text string, "
    # names the operator uses inside
    "conv string, none string, seg string, place string, codes string, cost string, k1 string, copy string, hit string"
)
EXTRA = ("x",) * 9
NOTHING = hashlib.sha256(b"").hexdigest()
ROLES = {2: "user", 3: "assistant"}


def table(spark, rows):
    return spark.createDataFrame([(*r, *EXTRA) for r in rows], SCHEMA)


def damage(rows):
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        out[conv]
        role, text = (" " if v is None else v for v in (role, text))
        hit = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if hit == 0:
            continue
        text = "" if hit == 1 else re.sub("[.!?]", "", text) if hit == 2 else text
        out[conv] += [(turn, "user" if hit == 4 else role, text)] * (2 if hit == 3 else 1)
    return {c: sorted(v, key=lambda x: (x[0] is not None, x[0] or 0)) for c, v in out.items()}


def least(rows, faults):
    """Least (cost, letters) by trying all edits from each state on, letters with the suffix."""

    def follow(state, initial):
        return {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}.get((state, initial))

    new = {s: "a" if s == 2 else "u" for s in range(4)}
    after = {0: (0, ""), 1: (9999, ""), 2: (9999, ""), 3: (0, "")}
    for k in range(len(rows), -1, -1):
        now = dict(after) if k == len(rows) else {}
        if k < len(rows):
            _, role, _ = rows[k]
            for s in range(4):
                tries = [(after[s][0] + 3, "D" + after[s][1])]
                if faults[k] in (None, "truncated"):
                    extra = faults[k] == "truncated"
                    for letter, initial, cost in (("K", role[:1], 0), ("R", new[s], 2)):
                        to = follow(s, initial)
                        if to is not None:
                            tries.append((after[to][0] + cost + extra, letter + after[to][1]))
                now[s] = min(tries)
        for _ in range(4):
            for s in range(4):
                to = now[follow(s, new[s])]
                now[s] = min(now[s], (to[0] + 2, "I" + to[1]))
        after = now
    return after[0]


def brute_force(rows):
    out = {}
    for conv, own in damage(rows).items():
        if not own:
            out[conv] = (0, 0, 0, 0, 0, 0, "", NOTHING)
            continue
        turns = [t for t, _, _ in own if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        faults, seen = [], set()
        for _, role, text in own:
            ink = re.findall(r"[^\x20\x09-\x0D]", text)
            if not ink:
                faults.append("blank")
            elif (role, text) in seen:
                faults.append("duplicate")
            else:
                faults.append(None if ink[-1] in ".!?" else "truncated")
            seen.add((role, text))
        initials = [r[:1] for _, r, _ in own]
        wrong = sum(x + y not in ("su", "ua", "au") for x, y in itertools.pairwise(initials))
        cost, audit = least(own, faults)
        state, said, rest = 0, [], iter(own)
        for letter in audit:
            _, role, text = next(rest) if letter != "I" else (None, None, "")
            if letter == "D":
                continue
            if letter != "K":
                role = "assistant" if state == 2 else "user"
            state = {"s": 1, "u": 2, "a": 3}[role[0]]
            said.append(f"{role}:{text}")
        assert re.fullmatch("(s?(ua)+)?", "".join(x[0] for x in said))
        digest = hashlib.sha256("\n".join(said).encode()).hexdigest()
        out[conv] = (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), wrong, cost, audit, digest)
    return out


def found(df):
    return {r[0]: tuple(r)[1:] for r in df.collect()}


def random_rows(rng, n, most):
    said = ["Yes.", "No!", "cut off", "ü?", " \t", "", "a long text. " * 40, "one\ntwo."]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "Ugly", "s", ""]
    rows = []
    for conv in rng.sample(range(-50, 5000), n):
        turn = rng.randint(0, 3)
        for _ in range(rng.randint(0, most)):
            rows.append((conv, turn, rng.choice(roles), rng.choice(said) + rng.choice(["", str(turn) + "."])))
            turn += rng.choice([1, 1, 1, 2, 5])
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("segment", "most"), [(1 << 12, 12), (3, 20), (16, 150)])
def test_reports_equal_brute_force(spark, segment, most):
    rows = random_rows(random.Random(segment), 4000 // most, most)
    want = brute_force(rows)
    got = found(repair.repair_report(table(spark, rows), segment))
    assert got == want
    assert any(set(w[6]) == set("DIKR") for w in want.values())


def test_walk_with_checkpoints_equals_the_whole_table():
    rng = random.Random(5)
    for n in (0, 1, 2, 3, 9, 50, 400):
        codes = bytes(rng.choices(range(12), k=n))
        rows = [(0, "sua?"[c // 3], "x") for c in codes]
        faults = [(None, "truncated", "blank")[c % 3] for c in codes]
        end, vector = repair.END, repair.END
        for c in reversed(codes):
            vector = repair.before(c, vector)
        cost, audit = least(rows, faults)
        (_, letters), *_ = repair.walks(codes, end, True, (0, 1, 2, 3))
        assert (vector[0], letters) == (cost, audit)
        costs = repair.transfer(codes)
        assert tuple(min(costs[4 * s + t] + end[t] for t in range(4)) for s in range(4)) == vector


def test_repaired_rows(spark):
    rows = [(1, 0, "user", "Hello."), (1, 2, "user", "Again."), (2, 0, "assistant", "Alone.")]
    work = repair.Repair(table(spark, rows))
    got = defaultdict(list)
    for r in sorted(work.repaired().collect()):
        got[r.conv_id].append(f"{r.role}:{r.text}")
    want = brute_force(rows)
    assert {c: hashlib.sha256("\n".join(v).encode()).hexdigest() for c, v in got.items()} == {
        c: w[7] for c, w in want.items() if w[7] != NOTHING
    }


def test_edge_rows(spark):
    rows = [
        (None, 0, "user", "a."), (None, None, "user", "b."), (1, None, None, None), (2, 5, "user", "x" * 300_000),
        (3, 0, "user", "same."), (3, 1, "user", "same."), (3, 1, "user", "same."), (4, 7, "assistant", "A."),
        *((9, t, "user", f"{t}.") for t in range(60)),
    ]
    dropped = next(t for t in range(999) if zlib.crc32(f"5:{t}".encode()) % 20 == 0)
    rows.append((5, dropped, "user", "gone."))
    got = found(repair.repair_report(table(spark, rows), 8))
    assert got == brute_force(rows) and got[5] == (0, 0, 0, 0, 0, 0, "", NOTHING)
    assert repair.repair_report(table(spark, [])).count() == 0

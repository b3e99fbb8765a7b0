"""Conversation repair against a search over all audits."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import defaultdict
from itertools import pairwise, product

import numpy as np
import pytest

from tidemark.llm import conversation_repair as rep
from tidemark.llm.queries import QUERIES

GOOD = re.compile(r"(s?(ua)+)?")
SCHEMA = "conv_id long, turn long, role string, text string, at long, place int, segment long, symbols string"


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        code = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if code == 0:
            continue
        text = "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text
        role = "user" if code == 4 else role
        out += [(conv, turn, role, text)] * (2 if code == 3 else 1)
    return out


def faults(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        marks = re.findall(r"[^\x20\x09-\x0D]", text)
        if not marks:
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            out.append("" if marks[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def best_edits(rows, found):
    """Least (cost, audit) by trying every way to write each row, and its repaired lines."""
    best = None
    inserts = ["", "u", "a", "ua", "au"]

    def go(k, cost, audit, roles, lines):
        nonlocal best
        if best and cost > best[0]:
            return
        # no role string that the grammar cannot go on from
        if not re.fullmatch(r"s?(ua)*u?", roles):
            return
        if k == len(rows):
            if GOOD.fullmatch(roles) and (best is None or (cost, audit) < best[:2]):
                best = (cost, audit, lines)
            return
        _, _, role, text = rows[k]
        more = 3 if found[k] == "truncated" else 0
        choices = [(4, "D", "", [])]
        if found[k] not in ("blank", "duplicate"):
            choices.append((more, "K", role[:1] or "?", [f"{role}:{text}"]))
            choices += [(3 + more, "R", x[0], [f"{x}:{text}"]) for x in ("user", "assistant")]
        for (c, e, r, ls), ins in product(choices, inserts):
            extra = [{"u": "user:", "a": "assistant:"}[x] for x in ins]
            go(k + 1, cost + c + 3 * len(ins), audit + e + "I" * len(ins), roles + r + ins, [*lines, *ls, *extra])

    for ins in inserts:
        go(0, 3 * len(ins), "I" * len(ins), ins, [{"u": "user:", "a": "assistant:"}[x] for x in ins])
    return best


def plain_report(conv, rows):
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
    found = faults(rows)
    turns = [r[1] for r in rows if r[1] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in pairwise(rows))
    cost, audit, lines = best_edits(rows, found) if rows else (0, "", [])
    digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    counts = [found.count(x) for x in ("blank", "duplicate", "truncated")]
    return (conv, gaps, *counts, illegal, cost, audit, digest)


def check(report, rows, damaged):
    after = defaultdict(list)
    for r in plain_damage(rows) if damaged else [(c, t, x or " " * (x is None), y or " " * (y is None)) for c, t, x, y in rows]:
        after[r[0]].append(r)
    want = {conv: plain_report(conv, after[conv]) for conv in {r[0] for r in rows}}
    found = {r["conv_id"]: tuple(r) for r in report.collect()}
    assert found.keys() == want.keys()
    for conv, row in want.items():
        assert found[conv] == row


def test_query(spark, small):
    rows = [tuple(r) for r in spark.read.parquet(f"{small}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    check(QUERIES["op13_repair"](spark, small), rows, damaged=True)


def random_rows(rng, n):
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", None]
    texts = ["One.", "Two!", "cut off", "", None, " \t", "Why? ", "done.\n", "x" * 40 + "."]
    out = []
    for conv in range(n):
        for turn in range(int(rng.integers(0, 6))):
            number = None if rng.random() < 0.1 else int(turn * rng.integers(1, 3))
            out.append((conv if conv else None, number, roles[rng.integers(8)], texts[rng.integers(9)]))
    return out


@pytest.mark.parametrize("bits", [rep.SEGMENT_BITS, 1])
def test_random_conversations(spark, monkeypatch, bits):
    """In one segment and in segments of two rows, without and with damage."""
    monkeypatch.setattr(rep, "SEGMENT_BITS", bits)
    rows = random_rows(np.random.default_rng(5 + bits), 150)
    docs = spark.createDataFrame([(*r, None, None, None, None) for r in rows], SCHEMA)
    for damaged in (False, True):
        check(rep.repair(docs, damaged=damaged)[0], rows, damaged)


def test_repaired_rows(spark):
    rows = [(1, 0, "assistant", "a."), (1, 1, "user", "b."), (1, 2, "user", "c."), (2, 0, "user", "")]
    docs = spark.createDataFrame([(*r, None, None, None, None) for r in rows], SCHEMA)
    report, repaired = rep.repair(docs)
    own = [tuple(r) for r in repaired.orderBy("at", "place").select("conv_id", "role", "text").collect()]
    by_id = {r["conv_id"]: r for r in report.collect()}
    assert by_id[2]["audit"] == "D" and by_id[2]["cost"] == 4
    assert "\n".join(f"{r}:{t}" for c, r, t in own if c == 1).encode()
    roles = "".join(r[0] for c, r, t in own if c == 1)
    assert GOOD.fullmatch(roles)
    text = "\n".join(f"{r}:{t}" for c, r, t in own if c == 1)
    assert by_id[1]["repaired_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_empty_and_null(spark):
    empty = spark.createDataFrame([], SCHEMA)
    report, repaired = rep.repair(empty, damaged=True)
    assert report.collect() == [] and repaired.collect() == []
    nulls = spark.createDataFrame([(None,) * 8] * 3, SCHEMA)
    check(rep.repair(nulls)[0], [(None,) * 4] * 3, damaged=False)


def test_long_conversation(spark):
    """More rows than a segment; the answer is that of a plain pass over costs."""
    n = 3 * (1 << rep.SEGMENT_BITS) + 17
    rng = np.random.default_rng(11)
    rows = [(1, k, ["user", "assistant", "tool"][rng.integers(3)], f"Turn {k}.") for k in range(n)]
    docs = spark.createDataFrame([(*r, None, None, None, None) for r in rows], SCHEMA)
    report, repaired = rep.repair(docs)
    row = report.first()
    # cheapest cost to each state, row by row
    state = {p: x[0] for (s, p), x in rep.INSERTED.items() if s == rep.START}
    for r in rows:
        new = {}
        for (p, q), (cost, _) in rep.ROWS[r[2][0] if r[2][0] in "ua" else "o"].items():
            if p in state:
                new[q] = min(new.get(q, 1 << 60), state[p] + cost)
        state = new
    assert row["cost"] == min(state[rep.START], state[rep.ASSISTANT])
    assert sum({"K": 0, "R": 3, "D": 4, "I": 3}[x] for x in row["audit"]) == row["cost"]
    assert len(row["audit"].replace("I", "")) == n
    own = [tuple(r) for r in repaired.orderBy("at", "place").select("role", "text").collect()]
    assert GOOD.fullmatch("".join(r[0][0] for r in own))
    assert hashlib.sha256("\n".join(f"{r}:{t}" for r, t in own).encode()).hexdigest() == row["repaired_sha256"]


def test_grammar_gives_the_strings_back():
    rng = np.random.default_rng(2)
    strings = ["", "s", "uauauauaua", "u" * 33, *("".join(rng.choice(list(rep.SYMBOLS), int(rng.integers(0, 40)))) for _ in range(50))]
    compressed, rules = rep.re_pair(strings)

    def spell(x):
        if x < len(rep.SYMBOLS):
            return rep.SYMBOLS[x]
        a, b = rules[x - len(rep.SYMBOLS)]
        return spell(a) + spell(b)

    assert ["".join(map(spell, own)) for own in compressed] == strings
    assert rules and sum(map(len, compressed)) < sum(map(len, strings))
    pairs = [p for own in compressed for p in pairwise(own)]
    assert all(pairs.count(p) == 1 or p[0] == p[1] for p in pairs)


def test_ropes_compare_as_strings():
    rng = np.random.default_rng(4)
    made = [(x, rep.Rope(x)) for x in ("", "a", "b", "ab", "ba")]
    for _ in range(300):
        (s, a), (t, b) = (made[k] for k in rng.integers(0, len(made), 2))
        if len(s) + len(t) < 200:
            made.append((s + t, a + b))
    for _ in range(2000):
        (s, a), (t, b) = (made[k] for k in rng.integers(0, len(made), 2))
        assert (a < b) == (s < t) and str(a) == s

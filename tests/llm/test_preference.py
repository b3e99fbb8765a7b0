"""Preference pairs of plain, null, empty and long conversations against a plain version."""

from __future__ import annotations

import random

from tidemark.llm import preference

SCHEMA = "conv_id long, turn long, role string, text string, turns string, at int, pair_id long, c string, r string"


def table(spark, rows):
    return spark.createDataFrame([(*x, *(None,) * 5) for x in rows], SCHEMA)


def formatted(turns):
    return preference.format_pairs(preference.partner_pairs(preference.conversations(turns)))


def plain(rows):
    """``pair_id`` to common turns, prompt, completions and masks."""
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    cut = {}
    for conv, turns in own.items():
        turns = [x[2:] for x in sorted(turns)]
        answers = [k for k, x in enumerate(turns) if x[0] == "assistant"]
        if answers:
            cut[conv] = turns[: answers[-1] + 1]

    def render(turns):
        text, mask = "", []
        for role, said in turns:
            start = len(text) + len(f"<|im_start|>{role}\n")
            text += f"<|im_start|>{role}\n{said}<|im_end|>\n"
            if role == "assistant":
                mask.append((start, len(text)))
        return text, mask

    out = {}
    for conv, chosen in cut.items():
        other = cut.get(conv ^ 1)
        rejected = chosen[:-1] + ([other[-1]] if other else [])
        n = 0
        while n < min(len(chosen), len(rejected)) and chosen[n] == rejected[n]:
            n += 1
        (a, am), (b, bm) = render(chosen[n:]), render(rejected[n:])
        out[conv] = (n, render(chosen[:n])[0], a, b, am, bm)
    return out


def told(frame):
    rows = frame.collect()
    found = {
        r["pair_id"]: (
            r["n_common"], r["prompt"], r["chosen"], r["rejected"],
            [tuple(x) for x in r["chosen_mask"]], [tuple(x) for x in r["rejected_mask"]],
        )
        for r in rows
    }
    assert len(found) == len(rows)
    return found


def test_pairs_against_a_plain_version(spark):
    draw = random.Random(7)
    rows = [
        (draw.choice([*range(60), None]), draw.choice([*range(6), None]),
         draw.choice(["user", "assistant", "system", None, "assistant"]), draw.choice(["", None, "yes", "né 🙂", "<|im_end|>"]))
        for _ in range(500)
    ]
    rows += rows[:20]
    assert told(formatted(table(spark, rows))) == plain(rows)


def test_a_long_conversation(spark):
    rows = [(c, k, ["user", "assistant"][k % 2], f"turn {k} " * 40) for c in (2, 3) for k in range(1500)]
    rows.append((2, 1500, "assistant", "word " * 200_000))
    assert told(formatted(table(spark, rows))) == plain(rows)


def test_no_conversations(spark):
    assert formatted(table(spark, [])).collect() == []
    assert formatted(table(spark, [(None, 1, "assistant", "x"), (4, 1, "user", "x"), (5, None, None, None)])).collect() == []

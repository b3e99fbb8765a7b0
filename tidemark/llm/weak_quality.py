"""A quality classifier learned from overlapping heuristics, without labels.

Heuristics vote good, bad or nothing on each text. Expectation-maximisation estimates how often
each votes what on good and on bad texts, from the counts of all vote patterns of the corpus:
there are at most ``3 ** 10`` patterns, however many documents, and all documents are counted. The
posterior of a pattern is the soft label of its texts. A linear scorer over hashed words, word
shapes and echoes learns from these labels on a bounded sample and scores every text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Memory, arrow_map, utf8

#: Rows that the scorer learns from, about; hashed features; passes over each task's rows.
TRAIN_ROWS, WIDTH, PASSES, RATE = 20_000, 1 << 14, 3, 0.5
BAD, GOOD, NONE = 0, 1, 2
HEURISTICS = (
    "length",
    "symbols",
    "odd_words",
    "runs",
    "variety",
    "echoes",
    "capitals",
    "marks",
    "lines",
    "endings",
)
CAPITALS = bytes(range(0x41, 0x5B))
#: Words with a symbol or without a letter; runs of one punctuation mark.
ODD = re.compile(rb"(?<!\S)(?=[^\sA-Za-z\x80-\xff]+(?!\S)|\S*[#*$%&|<>])\S+")
RUN = re.compile(rb"([#*$%&|<>!?=_~-])\1\1")


def _vote(bad: bool, good: bool) -> int:
    return BAD if bad else GOOD if good else NONE


def votes(text: bytes) -> tuple[int, ...]:
    """The vote of each heuristic on a text."""
    words = text.split()
    n = len(words)
    if not n:
        return BAD, *(NONE,) * (len(HEURISTICS) - 1)
    symbols = sum(text.count(x) for x in (b"#", b"*", b"$", b"%", b"&", b"|", b"<", b">"))
    odd = sum(1 for _ in ODD.finditer(text))
    runs = sum(1 for _ in RUN.finditer(text))
    kinds = len(set(words))
    echoes = sum(map(eq, words, words[1:]))
    capitals = len(text) - len(text.translate(None, CAPITALS))
    marks = text.count(b"!!") + text.count(b"??")
    lines = [x.strip() for x in text.split(b"\n") if x.strip()]
    ended = sum(x.endswith((b".", b"!", b"?", b'"')) for x in lines)
    own = len(set(lines))
    return (
        _vote(n < 30, n >= 60),
        _vote(symbols > 0.05 * n, symbols <= 0.005 * n),
        _vote(odd > 0.05 * n, odd <= 0.01 * n),
        _vote(runs > 0.02 * n, runs <= 0.002 * n),
        _vote(n >= 20 and kinds < 0.3 * n**0.9, kinds > 0.45 * n**0.9),
        _vote(echoes > 0.2 * n, echoes <= 0.05 * n),
        _vote(capitals > 0.3 * len(text), capitals <= 0.15 * len(text)),
        _vote(marks > 0.1 * n, marks <= 0.01 * n),
        _vote(own < 0.8 * len(lines), own == len(lines) > 1),
        _vote(ended < 0.4 * len(lines), ended >= 0.8 * len(lines)),
    )


def vote_patterns(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``pattern, n``: how many texts got each combination of votes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[str, int] = {}
            for x in batch.column(0):
                key = "".join(map(str, votes(x.as_py())))
                found[key] = found.get(key, 0) + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())],
                ["pattern", "n"],
            )

    counted = arrow_map(docs.select(utf8(text_col).alias("text")), run, "pattern string, n long")
    return counted.groupBy("pattern").agg(F.sum("n").alias("n"))


def fit_votes(counts: dict[str, int], rounds: int = 100) -> dict[str, float]:
    """Posterior of good for each pattern, by expectation-maximisation from the majority vote."""
    if not counts:
        return {}
    patterns = sorted(counts)
    n = np.array([counts[x] for x in patterns], float)
    v = np.array([[int(c) for c in x] for x in patterns])
    one_hot = np.stack([v == k for k in (BAD, GOOD, NONE)], axis=2).astype(float)
    lead = (v == GOOD).sum(1) - 2.0 * (v == BAD).sum(1)
    good = 1 / (1 + np.exp(-lead))
    for _ in range(rounds):
        prior = (n @ good + 1) / (n.sum() + 2)
        chance = []
        for weight in (n * (1 - good), n * good):
            table = np.einsum("p,pjk->jk", weight, one_hot) + 1.0
            chance.append(np.log(table / table.sum(1, keepdims=True)))
        scores = [np.einsum("pjk,jk->p", one_hot, x) for x in chance]
        odds = np.log(prior) - np.log(1 - prior) + scores[1] - scores[0]
        new = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
        if np.abs(new - good).max() < 1e-9:
            break
        good = new
    return dict(zip(patterns, good.tolist(), strict=True))


def _shape(word: bytes) -> bytes:
    """A word with its letters, digits and other characters replaced by their kind, runs as one."""
    out = bytearray()
    for c in word.decode("utf-8", "replace"):
        kind = 97 if c.isalpha() else 48 if c.isdigit() else ord(c) if c < "\x80" else 63
        if not out or out[-1] != kind:
            out.append(kind)
    return bytes(out)


ECHO = xxhash.xxh64_intdigest(b"\1") % (WIDTH - 1) + 1


def _slots(word: bytes) -> tuple[int, int]:
    digest = xxhash.xxh64_intdigest
    return digest(word.lower()) % (WIDTH - 1) + 1, digest(b"\0" + _shape(word)) % (WIDTH - 1) + 1


def features(text: bytes, slots: Memory) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features and their values, of unit length; slot 0 is the constant.

    A word, its shape, and whether it is the word before it again.
    """
    words = text.split()
    found = [x for w in words for x in slots[w]]
    found += [ECHO] * sum(map(eq, words, words[1:]))
    where, n = np.unique(np.array(found, np.int64), return_counts=True)
    value = np.log1p(n)
    value = value / max(1e-9, float(np.sqrt(value @ value)))
    return np.append(where, 0), np.append(value, 1.0)


def train(
    docs: DataFrame,
    labels: dict[str, float],
    total: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    rows: int = TRAIN_ROWS,
) -> np.ndarray:
    """Weights of the scorer: each task descends on its own rows, and their weights are averaged.

    Rows are drawn by a hash of id and text, about ``rows`` of ``total``; that bounds the tasks'
    work and the number of weight vectors.
    """
    shared = docs.sparkSession.sparkContext.broadcast(labels)
    share = min(1.0, rows / max(1, total))
    drawn = F.pmod(F.xxhash64(F.col(id_col), F.col(text_col)), F.lit(1 << 20)) < int(share * (1 << 20)) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots, examples = Memory(_slots), []
        for batch in batches:
            for x in batch.column(0):
                text = x.as_py()
                label = shared.value["".join(map(str, votes(text)))]
                examples.append((*features(text, slots), label))
        weights = np.zeros(WIDTH)
        for turn in range(PASSES):
            for where, value, label in examples:
                p = 1 / (1 + np.exp(-np.clip(value @ weights[where], -30, 30)))
                weights[where] += RATE / (1 + turn) * (label - p) * value
        if examples:
            yield pa.RecordBatch.from_arrays(
                [pa.array([len(examples)]), pa.array([weights.astype("<f4").tobytes()])], ["n", "w"]
            )

    sample = docs.where(drawn).select(utf8(text_col).alias("text"), F.xxhash64(text_col).alias("h"))
    tasks = max(1, -(-min(rows, total) // 2_000))
    sample = sample.repartition(tasks, "h").sortWithinPartitions("h").select("text")
    found = arrow_map(sample, run, "n long, w binary").collect()
    out = np.zeros(WIDTH)
    for r in sorted(found, key=lambda r: bytes(r["w"])):
        out += r["n"] * np.frombuffer(r["w"], "<f4")
    return (out / max(1, sum(r["n"] for r in found))).astype(np.float32)


def classify(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rows: int = TRAIN_ROWS
) -> DataFrame:
    """``doc_id, weak_label, score, kept`` for every row.

    ``weak_label`` is the posterior of the heuristics, ``score`` the scorer's probability of good,
    ``kept`` whether it is at least a half. Null and empty texts score 0 and are not kept. Null
    ids and rows of equal id are scored like any other; other columns are not read.
    """
    counts = {r["pattern"]: r["n"] for r in vote_patterns(docs, text_col).collect()}
    labels = fit_votes(counts)
    weights = train(docs, labels, sum(counts.values()), id_col, text_col, rows)
    shared = docs.sparkSession.sparkContext.broadcast((labels, weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labels, weights = shared.value
        slots = Memory(_slots)
        for batch in batches:
            weak, scores = [], []
            for x in batch.column(1):
                text = x.as_py()
                weak.append(labels["".join(map(str, votes(text)))])
                where, value = features(text, slots)
                odds = float(value @ weights[where])
                scores.append(1 / (1 + np.exp(-np.clip(odds, -30, 30))) if len(where) > 1 else 0.0)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(weak, pa.float64()),
                    pa.array(scores, pa.float64()),
                    pa.array([x >= 0.5 for x in scores], pa.bool_()),
                ],
                ["doc_id", "weak_label", "score", "kept"],
            )

    kept = docs.select(F.col(id_col).cast("long").alias("doc_id"), utf8(text_col).alias("text"))
    return arrow_map(kept, run, "doc_id long, weak_label double, score double, kept boolean")

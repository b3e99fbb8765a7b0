"""Quality rules of documents, and of the hosts they come from.

Rules count words, symbols, repeated lines and repeated word windows of each whole text. Failures
of each rule are added up by host, and each host's rate is shrunk towards that of all hosts by an
empirical beta prior (method of moments over the hosts' rates): a host with few documents is
judged mostly by the prior, one with many by its own. Verdicts are joined back to documents:

* a host whose shrunk rate of any rule exceeds ``limit`` is rejected with all its documents;
* the rules on symbols and on repeated lines are held against a host's documents only if the
  host's shrunk rate of that rule is more than ``relative`` of the mean of all hosts. Where next to
  nothing fails a rule, a lone failure is let stand, since it is a table or a poem more often than
  junk.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import arrow_map, stage, utf8

SYMBOLS = b"#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
#: Shrunk failure rate above which a host is rejected, and share of the mean rate above which a
#: rule holds at a host.
LIMIT, RELATIVE = 0.5, 0.5
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")
RULES = ("base_failed", "symbols_failed", "lines_failed")


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a three-word window found twice or more."""
    if len(words) < 4:
        return 0
    code: dict[bytes, int] = {}
    w = np.array([code.setdefault(x, len(code)) for x in words], np.int64)
    # pairs as codes first, so that three codes never overflow
    _, pair = np.unique(w[:-1] * len(code) + w[1:], return_inverse=True)
    _, which, n = np.unique(
        pair[:-1] * len(code) + w[2:], return_inverse=True, return_counts=True
    )
    starts = n[which] > 1
    covered = np.zeros(len(w), bool)
    for k in range(3):
        covered[k : k + len(starts)] |= starts
    return int(covered.sum())


def text_counts(text: bytes) -> tuple[int, int, int, int, int, int]:
    """``COUNTS`` of a text; words are runs of anything but space and U+0009 to U+000D."""
    words = text.split()
    chars = sum(map(len, words))
    if not text.isascii():
        # continuation bytes are not characters of their own
        raw = np.frombuffer(text, np.uint8)
        chars -= int(np.count_nonzero((raw & 0xC0) == 0x80))
    symbols = sum(text.count(SYMBOLS[k : k + 1]) for k in range(len(SYMBOLS)))
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    again = len(lines) - len(set(lines))
    return len(words), chars, symbols, again, repeated_words(words), len(lines)


def counts(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source"
) -> DataFrame:
    """``doc_id, host`` and ``COUNTS`` of every row; null texts have no words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [text_counts(x.as_py()) for x in batch.column(2)]
            columns = zip(*found, strict=True) if found else [()] * len(COUNTS)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *(pa.array(x, pa.int64()) for x in columns)],
                ["doc_id", "host", *COUNTS],
            )

    kept = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(host_col).cast("string").alias("host"),
        utf8(text_col).alias("text"),
    )
    schema = "doc_id long, host string, " + ", ".join(f"{x} long" for x in COUNTS)
    return arrow_map(kept, run, schema)


def base_failed() -> Column:
    """Too short, or more than half of the words in repeated windows."""
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def symbols_failed() -> Column:
    """More than a symbol for ten words."""
    return 10 * F.col("n_symbols") > F.col("n_words")


def lines_failed() -> Column:
    """More than three in ten lines equal to an earlier one."""
    return 10 * F.col("n_dup_lines") > 3 * F.col("n_lines")


def beta_prior(mean: float | None, variance: float | None) -> tuple[float, float]:
    """The beta distribution of the given moments; the uniform one where there is none."""
    if mean is None or variance is None or not 1e-12 < variance < mean * (1 - mean):
        return 1.0, 1.0
    weight = mean * (1 - mean) / variance - 1
    return mean * weight, (1 - mean) * weight


def host_verdicts(judged: DataFrame, limit: float = LIMIT, relative: float = RELATIVE) -> DataFrame:
    """The verdicts on each host from rows with ``host`` and a column for each of ``RULES``.

    ``host, n_docs, host_failed``, and for each rule the shrunk ``<rule>_rate`` and whether the
    rule holds at the host, ``<rule>_holds``. Null hosts are one host. With one host, or equal
    rates at all of them, there is no spread to fit and the prior is the uniform one.
    """
    hosts = judged.groupBy("host").agg(
        F.count("*").alias("n_docs"), *(F.sum(F.col(x).cast("long")).alias(x) for x in RULES)
    )
    raw = {x: F.col(x) / F.col("n_docs") for x in RULES}
    moments = [f(raw[x]).alias(f"{m}_{x}") for x in RULES for m, f in (("m", F.avg), ("v", F.var_samp))]
    # one row: two moments of each rule
    found = hosts.agg(*moments).first()
    rates, holds = [], []
    for x in RULES:
        mean = found[f"m_{x}"]
        a, b = beta_prior(mean, found[f"v_{x}"])
        rates.append(((F.col(x) + a) / (F.col("n_docs") + a + b)).alias(f"{x}_rate"))
        holds.append((F.col(f"{x}_rate") > relative * (mean or 0.0)).alias(f"{x}_holds"))
    failed = F.greatest(*(F.col(f"{x}_rate") for x in RULES)) > limit
    return hosts.select("host", "n_docs", *rates).select("*", *holds, failed.alias("host_failed"))


def judge(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
    limit: float = LIMIT,
    relative: float = RELATIVE,
) -> DataFrame:
    """``doc_id``, ``COUNTS``, ``base_failed``, ``kept`` and the host's ``host_rate`` of every row.

    A document is kept if it passes the base rules, its host is not rejected, and it passes those
    of the other rules that hold at its host. ``host_rate`` is the host's shrunk rate of the base
    rules. Null and empty texts have no words and fail; null ids and rows of equal id are judged
    like any other; only the three named columns are read. An empty table gives an empty result.
    """
    judged = counts(docs, id_col, text_col, host_col).select(
        "*",
        base_failed().alias("base_failed"),
        symbols_failed().alias("symbols_failed"),
        lines_failed().alias("lines_failed"),
    )
    judged = stage(judged, "rules")
    hosts = host_verdicts(judged, limit, relative).withColumnRenamed("host", "of")
    joined = judged.join(hosts, F.col("host").eqNullSafe(F.col("of")))
    against = F.col("base_failed") | F.col("host_failed")
    for x in RULES[1:]:
        against = against | (F.col(x) & F.col(f"{x}_holds"))
    return joined.select(
        "doc_id", *COUNTS, "base_failed", (~against).alias("kept"), F.col("base_failed_rate").alias("host_rate")
    )


ORACLE = r"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id, source,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
           list_filter(string_split(coalesce(text, ''), chr(10)),
                       lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines,
           length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]', '', 'g')) AS n_symbols
    FROM documents),
grams AS (
    SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
    FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
repeated AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM grams) WHERE n > 1),
covered AS (
    SELECT r, count(DISTINCT i + k) AS n
    FROM repeated, (VALUES (0), (1), (2)) AS s(k) GROUP BY r),
c AS (
    SELECT doc_id, source, CAST(len(w) AS BIGINT) AS n_words,
           CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
           CAST(n_symbols AS BIGINT) AS n_symbols,
           CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
           CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words,
           CAST(len(lines) AS BIGINT) AS n_lines
    FROM d LEFT JOIN covered USING (r)),
j AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
             10 * n_symbols > n_words AS symbols_failed,
             10 * n_dup_lines > 3 * n_lines AS lines_failed FROM c),
h AS (SELECT source, count(*) AS n, {failures} FROM j GROUP BY source),
m AS (SELECT {moments} FROM h),
p AS (SELECT *, {priors} FROM m),
q AS (SELECT source, {rates} FROM h, p),
bad AS (SELECT source, greatest(base_rate, symbols_rate, lines_rate) > 0.5 AS failed,
               symbols_rate > 0.5 * m_symbols AS symbols_hold,
               lines_rate > 0.5 * m_lines AS lines_hold FROM q, p)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, base_failed,
       NOT (base_failed OR failed OR symbols_failed AND symbols_hold
            OR lines_failed AND lines_hold) AS kept
FROM j JOIN bad ON j.source IS NOT DISTINCT FROM bad.source
"""


def _for_each_rule(pattern: str) -> str:
    return ", ".join(pattern.replace("@", x) for x in ("base", "symbols", "lines"))


for _place, _pattern in {
    "{failures}": "sum(@_failed::INT) AS f_@",
    "{moments}": "avg(f_@ / n) AS m_@, coalesce(var_samp(f_@ / n), 0) AS v_@",
    "{priors}": "CASE WHEN v_@ > 1e-12 AND v_@ < m_@ * (1 - m_@) "
    "THEN m_@ * (m_@ * (1 - m_@) / v_@ - 1) ELSE 1 END AS a_@, "
    "CASE WHEN v_@ > 1e-12 AND v_@ < m_@ * (1 - m_@) "
    "THEN (1 - m_@) * (m_@ * (1 - m_@) / v_@ - 1) ELSE 1 END AS b_@",
    "{rates}": "(f_@ + a_@) / (n + a_@ + b_@) AS @_rate",
}.items():
    ORACLE = ORACLE.replace(_place, _for_each_rule(_pattern))

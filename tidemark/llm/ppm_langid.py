"""Language identification by partial matching of byte contexts.

Each language has a tree of byte contexts up to ``order`` bytes with the counts of the byte that
followed. A text is coded byte by byte under the frozen counts of each language: the longest known
context gives the byte with probability count / (total + distinct), or an escape with probability
distinct / (total + distinct) to the next shorter context; below the empty context all 256 bytes
are equally likely. (Counts are not reduced by bytes that longer contexts have already excluded,
so the code is a little longer than it need be.) The language with the shortest code wins.

Costs are whole numbers of 1/65536 bit, so sums do not depend on how texts are cut or ordered.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import arrow_map, pieces, utf8

UNKNOWN = "und"
#: Labelled rows of a language that the trees are fitted to.
ROWS_PER_LANG = 2_000
DRAWS = 1 << 40
ORDER = 3
UNIT = 65_536
#: Bytes counted or coded at once; it divides the work and changes no result.
STEP = 1 << 19
#: Costs by byte and language held at once, about: strips are shorter for many languages.
CELLS = 1 << 22
LETTER = re.compile(r"[^\W\d_]")


def has_letter(text: bytes) -> bool:
    """Whether a text has a letter; the pattern also lets numbers like ½ pass, so look closer."""
    s = text.decode("utf-8", "replace")
    return any(m.group().isalpha() for m in LETTER.finditer(s))


def gram_counts(
    rows: DataFrame, order: int = ORDER, text_col: str = "text", lang_col: str = "lang"
) -> DataFrame:
    """``lang, size, gram, n``: byte strings of up to ``order + 1`` bytes, high byte first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column(0).to_pylist()
            for first, texts in pieces(batch.column(1)):
                by_lang: dict[str, list[bytes]] = {}
                for row, text in enumerate(texts, first):
                    by_lang.setdefault(langs[row], []).append(text)
                for lang, own in by_lang.items():
                    for size, found, n in count_grams(own, order):
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array([lang] * len(found), pa.string()),
                                pa.array(np.full(len(found), size, np.int32)),
                                pa.array(found),
                                pa.array(n),
                            ],
                            ["lang", "size", "gram", "n"],
                        )

    counted = arrow_map(
        rows.select(F.col(lang_col).alias("lang"), utf8(text_col).alias("text")),
        count,
        "lang string, size int, gram long, n long",
    )
    return counted.groupBy("lang", "size", "gram").agg(F.sum("n").alias("n"))


def strips(
    texts: list[bytes], before: int, after: int, step: int
) -> Iterator[list[tuple[int, int, int, bytes]]]:
    """The texts in strips of at most ``step`` bytes, some at once that are about as long together.

    A strip is: the place of its text, how many bytes before it are at hand (0 or ``before``), its
    length, and its bytes with those and up to ``after`` more behind it.
    """
    held, size = [], 0
    for k, text in enumerate(texts):
        for a in range(0, len(text), step):
            known = before if a else 0
            held.append((k, known, min(step, len(text) - a), text[a - known : a + step + after]))
            size += len(held[-1][3])
            if size >= step:
                yield held
                held, size = [], 0
    if held:
        yield held


def count_grams(texts: list[bytes], order: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Size, byte strings as numbers, and counts; a string may come several times."""
    for held in strips(texts, 0, order, STEP):
        sizes = [len(x) for *_, x in held]
        data = np.frombuffer(b"".join(x for *_, x in held), np.uint8).astype(np.int64)
        room = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(data))
        # strings are counted in the strip that they begin in
        past = [len(x) - n for _, _, n, x in held]
        begins = room > np.repeat(past, sizes)
        gram = np.zeros(len(data), np.int64)
        for size in range(1, order + 2):
            at = len(data) - size + 1
            if at <= 0:
                break
            gram = gram[:at] * 256 + data[size - 1 :]
            yield size, *np.unique(gram[(room[:at] >= size) & begins[:at]], return_counts=True)


def bounded_sample(rows: DataFrame, per_lang: int, id_col: str, lang_col: str) -> DataFrame:
    """At most ``per_lang`` different rows of each language, the least by a hash of the row.

    Rows of equal id and text count once, so no language is learned from copies of one text. Rows
    whose hash is too great to be among them are passed over before the shuffle, and copies are
    put together before it, so that neither a language nor a text with most of the rows moves
    more than others.
    """
    private = rows.select(
        F.col(lang_col).alias("lang"),
        F.col(id_col).alias("id"),
        F.col("text"),
        F.pmod(F.xxhash64(F.col(id_col), F.col("text")), F.lit(DRAWS)).alias("draw"),
    )
    counted = private.groupBy("lang").agg(F.approx_count_distinct("draw", 0.05).alias("n")).collect()
    # twice the share of the different rows that is wanted, and some more where there are few
    bound = {r["lang"]: min(DRAWS, (2 * per_lang + 50) * DRAWS // max(1, r["n"]) + 1) for r in counted}
    bounds = F.create_map(*(F.lit(x) for pair in sorted(bound.items()) for x in pair))
    if bound:
        private = private.where(F.col("draw") < bounds[F.col("lang")])
    different = private.groupBy("lang", "draw", "id", "text").agg(F.count("*"))
    order = Window.partitionBy("lang").orderBy("draw", "id", "text")
    ranked = different.withColumn("rank", F.row_number().over(order))
    return ranked.where(F.col("rank") <= per_lang).select("lang", "text")


@dataclass(frozen=True)
class Known:
    """Values of (string, language) pairs, of those that are known only.

    The pairs of ``keys[k]`` are ``langs`` and ``values`` from ``starts[k]`` to ``starts[k + 1]``.
    """

    keys: np.ndarray
    starts: np.ndarray
    langs: np.ndarray
    values: np.ndarray

    @classmethod
    def of(cls, keys: np.ndarray, langs: np.ndarray, values: np.ndarray) -> Known:
        """From pairs in any order."""
        order = np.lexsort((langs, keys))
        different, starts = np.unique(keys[order], return_index=True)
        starts = np.append(starts, len(keys)).astype(np.int64)
        return cls(different, starts, langs[order].astype(np.int32), values[order])

    def pairs(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Place in ``wanted``, language and value of each known pair."""
        at, known = find(self.keys, wanted)
        row = np.nonzero(known)[0]
        first, last = self.starts[at[row]], self.starts[at[row] + 1]
        n = last - first
        place = np.arange(n.sum()) + np.repeat(first - (np.cumsum(n) - n), n)
        return np.repeat(row, n), self.langs[place], self.values[place]


@dataclass(frozen=True)
class Trees:
    """Frozen trees of all languages by length of string, as large as what each has seen.

    ``grams[s]`` holds for strings of ``s + 1`` bytes the code length of their last byte after the
    others, ``escapes[s]`` for contexts of ``s`` bytes the cost of leaving them.
    """

    langs: list[str]
    grams: list[Known]
    escapes: list[Known]
    order: int

    def costs(self, size: int, gram: np.ndarray) -> np.ndarray:
        """Cost of the last byte of strings of ``size`` bytes, a column for each language."""
        if size == 0:
            return np.full((len(gram), len(self.langs)), 8 * UNIT, np.int32)
        # as if no language knew the strings, then what each knows
        out = self.costs(size - 1, gram & ((1 << 8 * (size - 1)) - 1))
        row, lang, escape = self.escapes[size - 1].pairs(gram >> 8)
        out[row, lang] += escape
        row, lang, cost = self.grams[size - 1].pairs(gram)
        out[row, lang] = cost
        return out


def find(held: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of numbers in a table in order, and whether they are there."""
    if not len(held):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(held, wanted), len(held) - 1)
    return at, held[at] == wanted


def grow(counts: list[tuple[str, int, int, int]], order: int = ORDER) -> Trees | None:
    """The trees from (language, size, gram, count) rows; None without any."""
    if not counts:
        return None
    lang, size, gram, n = (np.array(x) for x in zip(*counts, strict=True))
    langs, place = np.unique(lang, return_inverse=True)
    return grow_arrays(langs.tolist(), place, size, gram.astype(np.int64), n, order)


def grow_arrays(
    langs: list[str],
    lang: np.ndarray,
    sizes: np.ndarray,
    gram: np.ndarray,
    n: np.ndarray,
    order: int = ORDER,
) -> Trees:
    """The trees from columns; ``lang`` holds places in ``langs``."""
    trees = Trees(langs, [], [], order)

    def bits(p: np.ndarray) -> np.ndarray:
        return np.rint(-UNIT * np.log2(p)).astype(np.int32)

    for size in range(1, order + 2):
        level = sizes == size
        grams, own, k = gram[level], lang[level].astype(np.int64), n[level]
        contexts, place = np.unique(grams >> 8, return_inverse=True)
        # what follows a context in a language: how often anything, how many different bytes
        seen, pair, kinds = np.unique(place * len(langs) + own, return_inverse=True, return_counts=True)
        total = np.zeros(len(seen), np.int64)
        np.add.at(total, pair, k)
        escape = bits(kinds / (total + kinds))
        trees.escapes.append(Known.of(contexts[seen // len(langs)], seen % len(langs), escape))
        trees.grams.append(Known.of(grams, own, bits(k / (total + kinds)[pair])))
    return trees


def fit(
    labelled: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    rows_per_lang: int = ROWS_PER_LANG,
    order: int = ORDER,
) -> Trees | None:
    """Trees of the languages found in ``labelled``; rows without language are passed over.

    The one bound is the number of rows that a language is learned from, a parameter; every
    context of these rows is kept. It bounds what the driver holds and broadcasts.
    """
    rows = labelled.where(F.col(lang_col).isNotNull()).select(
        id_col, F.col(text_col).alias("text"), lang_col
    )
    counts = gram_counts(
        bounded_sample(rows, rows_per_lang, id_col, lang_col), order, "text", lang_col
    )
    found = counts.toArrow().combine_chunks()
    if not found.num_rows:
        return None
    langs = sorted(found["lang"].unique().to_pylist())
    lang = np.searchsorted(np.array(langs), found["lang"].to_numpy().astype(str))
    size, gram, n = (found[x].to_numpy() for x in ("size", "gram", "n"))
    return grow_arrays(langs, lang, size, gram, n, order)


def code_lengths(texts: list[bytes], trees: Trees) -> np.ndarray:
    """Code length of each text in each language, in units of 1/65536 bit."""
    order = trees.order
    shift = 8 * (order + 1)
    out = np.zeros((len(texts), len(trees.langs)), np.int64)
    step = min(STEP, max(1 << 12, CELLS // len(trees.langs)))
    for held in strips(texts, order, 0, step):
        sizes = np.array([n for _, _, n, _ in held])
        joined = b"".join(bytes(order - known) + x for _, known, _, x in held)
        data = np.frombuffer(joined, np.uint8).astype(np.int64)
        owner = np.repeat(np.arange(len(held)), sizes)
        at = np.arange(len(owner)) + order * (owner + 1)
        # a text begins without context
        before = at - (np.cumsum(sizes + order) - sizes)[owner]
        before += np.array([known for _, known, _, _ in held])[owner]
        gram = np.minimum(before, order) + 1
        for k in range(order, -1, -1):
            gram = gram << 8 | data[at - k]
        different, place = np.unique(gram, return_inverse=True)
        cost = np.zeros((len(different), len(trees.langs)), np.int32)
        for size in range(1, order + 2):
            own = different >> shift == size
            cost[own] = trees.costs(size, different[own] & ((1 << shift) - 1))
        cost = cost[place]
        first = np.cumsum(sizes) - sizes
        lengths = np.add.reduceat(cost, first, axis=0, dtype=np.int64)
        np.add.at(out, [k for k, *_ in held], lengths)
    return out


def judge(texts: list[bytes], trees: Trees | None) -> list[tuple[str, float, float | None]]:
    """Language, score and bits per byte of each text."""
    known = [trees is not None and has_letter(x) for x in texts]
    picked = [x for x, ok in zip(texts, known, strict=True) if ok]
    lengths = iter(code_lengths(picked, trees) if picked else ())
    out: list[tuple[str, float, float | None]] = []
    for text, ok in zip(texts, known, strict=True):
        if not ok:
            out.append((UNKNOWN, 0.0, None))
            continue
        length = next(lengths)
        best = int(np.argmin(length))
        more = np.minimum((length - length[best]) / UNIT, 1000.0)
        score = float(1 / np.sum(2.0**-more))
        out.append((trees.langs[best], score, float(length[best] / UNIT / len(text))))
    return out


def is_told(texts: list[bytes], trees: Trees | None) -> list[bool]:
    """Whether the language of each text is told; without trees, whether it could be."""
    if trees is None:
        return [has_letter(x) for x in texts]
    return [x[0] != UNKNOWN for x in judge(texts, trees)]


def predict(
    docs: DataFrame,
    trees: Trees | None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, lang_pred, score``, and ``bits_per_byte`` of the winning language.

    ``score`` is the winner's share of 2 ** -bits over all languages. Null texts, texts without
    letters and all texts where nothing was learned are ``und`` with score 0. Equal code lengths
    go to the language that sorts first. Only the two named columns are read; every row of the
    input gives one of the output.
    """
    shared = docs.sparkSession.sparkContext.broadcast(trees)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [x for _, texts in pieces(batch.column(1)) for x in judge(texts, shared.value)]
            langs, scores, rates = zip(*found, strict=True) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(langs, pa.string()),
                    pa.array(scores, pa.float64()),
                    pa.array(rates, pa.float64()),
                ],
                ["doc_id", "lang_pred", "score", "bits_per_byte"],
            )

    kept = docs.select(F.col(id_col).cast("long").alias("doc_id"), utf8(text_col).alias("text"))
    return arrow_map(
        kept, run, "doc_id long, lang_pred string, score double, bits_per_byte double"
    )


def fold(id_col: str = "doc_id") -> Column:
    """The fold of a row, 0 to 2, from the CRC-32 of its id as text; null ids are in fold 0."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3, F.lit(0))


def known_language(docs: DataFrame, trees: Trees | None, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose language is told, all columns as they were.

    Null texts and texts without letters are rejected in any case. Where nothing was learned, no
    other row is.
    """
    shared = docs.sparkSession.sparkContext.broadcast(trees)
    place = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(place).cast(pa.binary())
            told = [x for _, piece in pieces(texts) for x in is_told(piece, shared.value)]
            yield batch.filter(pa.array(told, pa.bool_()))

    return arrow_map(docs, run, docs.schema)

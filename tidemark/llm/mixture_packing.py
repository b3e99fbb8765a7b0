"""Packing into sequences of a fixed length under control of the mixture of sources.

Every source is a queue of token ids. Windows are filled by deficit round-robin: a window adds each
queue's share of it to the queue's deficit, a queue sends tokens while its deficit lasts, and what
it sent too little or too much is carried to the next window. Documents are cut where a window or
an allotment ends; within ``slack`` tokens a queue rather ends its document, or waits with the
next one, and settles that later.

Partitions. How much of each queue the first ``x`` tokens of the whole run take is known in closed
form (:class:`Mixture`), so the run is parted into blocks of ``BLOCK`` windows that tasks fill on
their own: a block starts with the deficits that its predecessors leave, which is what the closed
form says and no task has to wait for. Each window is full but the very last of the run, which is
the only one to be padded.

A queue that has run dry leaves its share to the others. With no weights given, targets are the
shares of the sources in all tokens, so all queues last to the end.
"""

from __future__ import annotations

import json
from array import array
from bisect import bisect_right
from collections.abc import Iterator, Mapping
from fractions import Fraction
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import forced_bpe
from tidemark.llm.common import Memory, arrow_map, pieces, spaced_strips, stage, utf8

#: Tokens of a sequence, and sequences that one task fills in a row.
LENGTH, BLOCK = 4096, 128
#: Tokens up to which a document is not cut but settled with later windows.
SLACK = 64
#: Sources with less than this share of all tokens form one queue together, so there are at most
#: 256 queues beside it.
MIN_SHARE = 1 / 256
#: Ids of a row of the encoded table; longer documents have several rows.
CHUNK = 16_384
#: Bytes of text whose words are told apart at once.
ENCODE_BYTES = 4 << 20
#: Ends a strip: no byte of UTF-8.
STOP = b"\xff"

ENCODED = (
    "at long, source string, doc_id long, start long, n long, doc_tokens long, before long, "
    "ids binary"
)

#: Kinds of characters: white space, of words, signs in a row, words of their own.
SPACE, LETTER, SIGN, ALONE = range(4)


def kind(c: str) -> int:
    """A character's kind as ``forced_bpe.LATIN`` has it."""
    match = forced_bpe.LATIN.fullmatch
    if not match(c):
        return SPACE
    return LETTER if match("a" + c) else SIGN if match(c + c) else ALONE


#: Kinds of all characters of at most two bytes.
KINDS = np.array([kind(chr(c)) for c in range(0x800)], np.uint8)


class WordIds:
    """Ids of texts as little-endian 32-bit integers.

    The vocabulary splits a text into words before merging, so the tokenizers library's model is
    asked for each distinct word once. Words of Latin letters are found and told apart by arrays,
    many texts at once; strips with other characters are split by the library, and those that may
    hold a special token go through it whole.
    """

    def __init__(self, path: str):
        from tokenizers import models

        self.bpe = forced_bpe.load(path)
        with open(path, encoding="utf-8") as file:
            made = json.load(file)["model"]
        merges = [tuple(x.split(" ") if isinstance(x, str) else x) for x in made["merges"]]
        # without a cache: words come here once
        self.model = models.BPE(
            made["vocab"], merges, cache_capacity=0, end_of_word_suffix=forced_bpe.END
        )
        self.known = Memory(self._word)

    def _word(self, word: bytes) -> bytes:
        if word == STOP:
            return b""
        if word.isalpha():  # ASCII letters stand for themselves
            letters = word.decode()
        else:
            letters = "".join(map(self.bpe.letter.__getitem__, word))
        return array("I", [x.id for x in self.model.tokenize(letters)]).tobytes()

    def __call__(self, texts: list[bytes], limit: int = ENCODE_BYTES) -> list[bytes]:
        """The ids of each text; arrays are made for strips of about ``limit`` bytes in all."""
        out: list[list[bytes]] = [[] for _ in texts]
        latin, places, size = [], [], 0
        for own, text in zip(out, texts, strict=True):
            for strip in spaced_strips(text):
                s = strip.decode("utf-8", "replace")
                if "<|" in s:  # perhaps a special token
                    own.append(np.array(self.bpe.encode(s), "<u4").tobytes())
                elif forced_bpe.BEYOND.search(s):
                    words = (x.encode() for x in self.bpe._words(s))
                    own.append(b"".join(map(self.known.__getitem__, words)))
                else:
                    latin.append(s.lower().encode())
                    places.append((own, len(own)))
                    own.append(b"")
                    size += len(strip)
                    if size >= limit:
                        self._fill(places, latin)
                        latin, places, size = [], [], 0
        self._fill(places, latin)
        return [b"".join(own) for own in out]

    def _fill(self, places: list[tuple[list[bytes], int]], latin: list[bytes]) -> None:
        """Put the ids of lower-cased strips of Latin letters into their places."""
        if not latin:
            return
        found = latin_words(STOP.join([*latin, b""])).dictionary_encode()
        # ids of each distinct word, then of one word after the other
        words = found.dictionary.to_numpy(zero_copy_only=False).tolist()
        ids = list(map(self.known.__getitem__, words))
        table = np.frombuffer(b"".join(ids), "<u4")
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        codes = found.indices.to_numpy()
        n = sizes[codes]
        ends = np.cumsum(n)
        at = np.repeat((np.cumsum(sizes) - sizes)[codes] - (ends - n), n)
        at += np.arange(len(at))
        raw = table[at].tobytes()
        stops = 4 * ends[codes == words.index(STOP)]
        first = 0
        for (own, k), end in zip(places, stops.tolist(), strict=True):
            own[k] = raw[first:end]
            first = end


def latin_words(text: bytes) -> pa.Array:
    """The matches of ``forced_bpe.LATIN`` in lower-cased text, and each ``STOP`` in it.

    The text ends with ``STOP``; its characters have one or two bytes.
    """
    data = np.frombuffer(text, np.uint8)
    kinds = KINDS[data]
    pair = np.flatnonzero((data >= 0xC2) & (data < 0xE0))
    kinds[pair] = kinds[pair + 1] = KINDS[
        ((data[pair] & 0x1F).astype(np.int64) << 6) | (data[pair + 1] & 0x3F)
    ]
    kinds[data == STOP[0]] = ALONE
    first = kinds == ALONE
    first[1:] |= kinds[1:] != kinds[:-1]
    first[0] = True
    first[pair + 1] = False
    # an apostrophe that no other sign stands before takes its letters, which end there
    quote = np.flatnonzero(first & (data == ord("'")))
    one = data[quote + 1]
    two = data[np.minimum(quote + 2, len(data) - 1)]
    long = np.zeros(len(quote), bool)
    for a, b in (b"re", b"ve", b"ll"):
        long |= (one == a) & (two == b)
    short = np.isin(one, list(b"stmd"))
    first[quote[short | long] + 1] = False
    first[quote[short] + 2] = True
    first[quote[long] + 3] = True

    kept = kinds != SPACE
    starts = np.flatnonzero(first[kept])
    body = data[kept]
    offsets = np.append(starts, len(body)).astype(np.int32)
    return pa.Array.from_buffers(
        pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(body)]
    )


@lru_cache(2)
def load(path: str) -> WordIds:
    return WordIds(path)


def encode(
    docs: DataFrame,
    tokenizer: str,
    end_id: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """The documents' ids in rows of at most ``CHUNK``, staged.

    ``at`` numbers the rows by task and place; ``before`` counts the ids of the same source that
    come earlier in the same task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        ids_of = load(tokenizer)
        end = np.array([end_id], "<u4").tobytes()
        at = TaskContext.get().partitionId() << 33
        seen: dict[str, int] = {}
        for batch in batches:
            doc_ids, sources = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for first, texts in pieces(batch.column(2), ENCODE_BYTES):
                rows = []
                for k, ids in enumerate(ids_of(texts), first):
                    raw, source = ids + end, sources[k]
                    total = len(raw) // 4
                    for start in range(0, total, CHUNK):
                        own = raw[4 * start : 4 * (start + CHUNK)]
                        n = len(own) // 4
                        before = seen.get(source, 0)
                        rows.append((at, source, doc_ids[k], start, n, total, before, own))
                        seen[source] = before + n
                        at += 1
                kinds = [pa.int64(), pa.string(), *[pa.int64()] * 5, pa.binary()]
                columns = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, kind) for x, kind in zip(columns, kinds, strict=True)],
                    [x.split()[0] for x in ENCODED.split(", ")],
                )

    kept = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        # null is a source of its own
        F.coalesce(F.concat(F.lit("="), F.col(source_col).cast("string")), F.lit("")).alias("source"),
        utf8(text_col).alias("text"),
    )
    return stage(arrow_map(kept, run, ENCODED), "packing-ids")


class Mixture:
    """How much of each queue the first ``x`` tokens of a run take.

    ``totals`` are the tokens and ``weights`` the whole-numbered target proportions of the queues.
    In fluid form queue ``s`` has sent ``min(totals[s], weights[s] * v)`` at time ``v``. Whole
    tokens are differences of running sums rounded down, so they add up to ``x`` at any time, and
    no queue ever takes back a token as long as all but one send one in each block.
    """

    def __init__(self, totals: list[int], weights: list[int], length: int, block: int):
        self.totals, self.weights = totals, weights
        self.tokens = sum(totals)
        self.step = length * block
        # the last block takes what is left beside full ones, so none is short
        self.blocks = max(1, self.tokens // self.step)
        self.order = sorted(range(len(totals)), key=weights.__getitem__)
        if self.blocks > 1 and any(weights[s] * self.step < 2 * sum(weights) for s in self.order[1:]):
            raise ValueError("a source's share is less than a token of each block")
        # tokens sent when one queue after the other runs dry; what was dry before and what was not
        self.ends, self.phases = [], []
        dry, active = 0, sum(weights)
        for s in sorted(self.order, key=lambda s: Fraction(totals[s], weights[s])):
            self.phases.append((dry, active))
            self.ends.append(dry - -active * totals[s] // weights[s])
            dry += totals[s]
            active -= weights[s]
        self.vectors: dict[int, list[int]] = {}

    def taken(self, x: int) -> list[int]:
        """Tokens of each queue among the first ``x``."""
        out = list(self.totals)
        if x >= self.tokens:
            return out
        dry, active = self.phases[bisect_right(self.ends, x)]
        so_far = 0
        for s in self.order:
            own = min(self.totals[s] * active, self.weights[s] * (x - dry))
            out[s] = (so_far + own) // active - so_far // active
            so_far += own
        return out

    def known(self, block: int) -> list[int]:
        """Tokens of each queue in the blocks before ``block``."""
        found = self.vectors.get(block)
        if found is None:
            if len(self.vectors) >= 4096:
                self.vectors.clear()
            found = self.taken(self.tokens if block >= self.blocks else block * self.step)
            self.vectors[block] = found
        return found

    def block_of(self, queue: int, position: int, near: int = 0) -> int:
        """The block that sends the token at ``position`` of a queue; ``near`` is a guess."""
        if self.known(near)[queue] <= position < self.known(near + 1)[queue]:
            return near
        low, high = 0, self.blocks - 1
        while low < high:
            middle = (low + high) // 2
            if self.known(middle + 1)[queue] > position:
                high = middle
            else:
                low = middle + 1
        return low

    def cut(self, queue: int, position: int, n: int, near: int = 0) -> Iterator[tuple[int, int, int]]:
        """Block, place in the row and length of the parts that blocks take of a row."""
        at = 0
        while at < n:
            near = self.block_of(queue, position + at, near)
            size = min(n - at, self.known(near + 1)[queue] - position - at)
            yield near, at, size
            at += size


def fill(
    queues: list[list[tuple[int, int, int]]], length: int, slack: int
) -> Iterator[tuple[int, int, int, int, int]]:
    """Deficit round-robin over the queues of one block.

    A queue is a list of (row, place in the row, length). Yields row, place, length, window and
    place in the window. Deficits are kept in whole units, ``total`` of them to a token.
    """
    queues = [q for q in queues if q]
    sizes = [sum(x[2] for x in q) for q in queues]
    total = sum(sizes)
    deficit = [0] * len(queues)
    item, done = [0] * len(queues), [0] * len(queues)
    left, window = total, 0
    while left:
        room = size = min(length, left)
        for s, n in enumerate(sizes):
            deficit[s] += n * size
        sent: list[list[int]] = []

        def send(s: int, n: int) -> None:
            row, place, whole = queues[s][item[s]]
            if sent and sent[-1][0] == row and sent[-1][1] + sent[-1][2] == place + done[s]:
                sent[-1][2] += n
            else:
                sent.append([row, place + done[s], n])
            deficit[s] -= n * total
            done[s] += n
            if done[s] == whole:
                item[s], done[s] = item[s] + 1, 0

        # those that wait longest come first
        for s in sorted(range(len(queues)), key=lambda s: -deficit[s]):
            while room and deficit[s] >= total and item[s] < len(queues[s]):
                allowed = min(room, deficit[s] // total)
                rest = queues[s][item[s]][2] - done[s]
                if rest <= allowed or (rest <= room and rest - allowed <= slack):
                    n = rest
                elif allowed <= slack and not done[s]:
                    break
                else:
                    n = allowed
                send(s, n)
                room -= n
        while room:
            s = max(range(len(queues)), key=deficit.__getitem__)
            n = min(room, queues[s][item[s]][2] - done[s], max(1, deficit[s] // total))
            send(s, n)
            room -= n
        offset = 0
        for row, place, n in sent:
            yield row, place, n, window, offset
            offset += n
        left -= size
        window += 1


def queue_weights(
    totals: Mapping[str, int], rest: int, weights: Mapping[str | None, float] | None
) -> tuple[list[str], list[int], list[int]]:
    """Sources with a queue of their own, and the totals and weights of all queues.

    The last queue is that of all other sources, ``rest`` tokens; its target is its own share of
    all tokens. Weights are proportions of what is left beside it.
    """
    names = sorted(totals)
    tokens = [totals[x] for x in names]
    if weights is None:
        aims = tokens
    else:
        own = {"" if k is None else f"={k}": Fraction(w) for k, w in weights.items()}
        scale = sum(own[x] for x in names)
        aims = [max(1, int(own[x] / scale * sum(tokens))) for x in names]
    if rest:
        return names, [*tokens, rest], [*aims, rest]
    return names, tokens, aims


def pack(
    docs: DataFrame,
    tokenizer: str,
    end_id: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Mapping[str | None, float] | None = None,
    length: int = LENGTH,
    block: int = BLOCK,
    slack: int = SLACK,
) -> DataFrame:
    """A row for each piece: ``doc_id, source, start, length, doc_tokens, sequence_id, offset, ids``.

    ``start`` is the piece's place in its document, ``offset`` in its sequence; ``ids`` are
    little-endian unsigned 32-bit integers. Every document is closed by ``end_id``, so null and
    empty texts have one token. ``weights`` are target proportions by source (null is a source
    too); without them each source has its share in all tokens. Sources without a weight, or with
    too few tokens, form one queue together. Null ids and rows of equal id are documents of their
    own, whose rows cannot be told apart by id. An empty table gives no pieces. Other columns are
    not read.
    """
    spark = docs.sparkSession
    encoded = encode(docs, tokenizer, end_id, id_col, text_col, source_col)
    totals = encoded.groupBy("source").agg(F.sum("n").alias("n"))
    tokens = totals.agg(F.sum("n")).first()[0] or 0
    if weights is None:
        big = F.col("n") >= F.lit(MIN_SHARE * tokens)
    else:
        big = F.col("source").isin(["" if k is None else f"={k}" for k in weights])
    # at most 1 / MIN_SHARE rows, or one per weight
    own = {r["source"]: r["n"] for r in totals.where(big).collect()}
    names, queue_tokens, aims = queue_weights(own, tokens - sum(own.values()), weights)
    mixture = Mixture(queue_tokens, aims, length, block)

    place = F.lit(len(names))
    if names:
        pairs = (F.lit(x) for pair in zip(names, range(len(names)), strict=True) for x in pair)
        place = F.coalesce(F.try_element_at(F.create_map(*pairs), F.col("source")), place)
    narrow = encoded.select(
        "at", "source", "before", "n", F.shiftright("at", 33).alias("part"), place.alias("queue")
    )
    # a task's tokens of a source, then of a queue, then the tasks of a queue one after the other
    by_task = narrow.groupBy("queue", "part", "source").agg(F.sum("n").alias("n"))
    sums = by_task.groupBy("queue", "part").agg(F.sum("n").alias("n"))
    so_far = Window.rowsBetween(Window.unboundedPreceding, -1)
    ahead = F.coalesce(F.sum("n").over(so_far.partitionBy("queue").orderBy("part")), F.lit(0))
    inside = so_far.partitionBy("queue", "part").orderBy("source")
    bases = by_task.withColumn("inside", F.coalesce(F.sum("n").over(inside), F.lit(0))).drop("n")
    bases = bases.join(sums.select("queue", "part", ahead.alias("ahead")), ["queue", "part"])
    placed = narrow.join(bases, ["queue", "part", "source"]).select(
        "queue", (F.col("ahead") + F.col("inside") + F.col("before")).alias("position"), "n", "at"
    )

    names_of = ["block", "queue", "position", "row", "place", "n"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        near: dict[int, int] = {}
        for batch in batches:
            out = []
            for queue, position, n, row in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                for at, place, size in mixture.cut(queue, position, n, near.get(queue, 0)):
                    out.append((at, queue, position + place, row, place, size))
                    near[queue] = at
            if out:
                yield longs(out, names_of)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for at, rows in whole_blocks(batches):
            queues: dict[int, list[tuple[int, int, int]]] = {}
            for queue, row, place, n in rows:
                queues.setdefault(queue, []).append((row, place, n))
            found = [
                (row, place, n, at * block + window, offset)
                for row, place, n, window, offset in fill(list(queues.values()), length, slack)
            ]
            yield longs(found, ["row", "place", "length", "sequence_id", "offset"])

    if not tokens:
        mixture = Mixture([1], [1], length, block)
    parts = arrow_map(placed, cut, ", ".join(f"{x} long" for x in names_of))
    parts = parts.repartition("block").sortWithinPartitions("block", "queue", "position", "row")
    found = arrow_map(parts, run, "row long, place long, length long, sequence_id long, offset long")
    joined = encoded.join(found, F.col("at") == F.col("row"))
    return joined.select(
        "doc_id",
        F.when(F.col("source") != "", F.expr("substring(source, 2)")).alias("source"),
        (F.col("start") + F.col("place")).alias("start"),
        "length",
        "doc_tokens",
        "sequence_id",
        "offset",
        F.expr("substring(ids, CAST(4 * place + 1 AS INT), CAST(4 * length AS INT))").alias("ids"),
    )


def longs(rows: list[tuple[int, ...]], names: list[str]) -> pa.RecordBatch:
    table = np.array(rows, np.int64).reshape(-1, len(names))
    return pa.RecordBatch.from_arrays([pa.array(x) for x in table.T.copy()], names)


def whole_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[tuple]]]:
    """The rows (queue, row, place, n) of one block after the other."""
    held: list[tuple] = []
    last = None
    for batch in batches:
        own = (batch.column(k).to_pylist() for k in (0, 1, 3, 4, 5))
        for at, *row in zip(*own, strict=True):
            if held and at != last:
                yield last, held
                held = []
            last = at
            held.append(row)
    if held:
        yield last, held


def sequences(packed: DataFrame, length: int = LENGTH, pad_id: int = 0) -> DataFrame:
    """``sequence_id, ids, n_tokens, pieces``: the padded sequences, each of its pieces in order."""
    whole = packed.groupBy("sequence_id").agg(
        F.array_sort(F.collect_list(F.struct("offset", "doc_id", "start", "length", "ids"))).alias("own")
    )
    joined = F.aggregate("own", F.lit(b""), lambda a, x: F.concat(a, x["ids"]))
    n = F.aggregate("own", F.lit(0).cast("long"), lambda a, x: a + x["length"])
    pad = F.repeat(F.lit(int(pad_id).to_bytes(4, "little").hex()), (F.lit(length) - n).cast("int"))
    return whole.select(
        "sequence_id",
        F.concat(joined, F.unhex(pad)).alias("ids"),
        n.alias("n_tokens"),
        F.transform("own", lambda x: x.dropFields("ids")).alias("pieces"),
    )

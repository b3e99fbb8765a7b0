"""Removal of long repeats through suffix arrays of the places where texts may repeat.

A byte goes if some ``length``-byte string that covers it also starts elsewhere, in the same
document or another. Windows of ``length`` bytes are judged, never across documents.

1. *Anchors.* Each window has an anchor: the place of the least hash among its ``GRAM``-byte
   strings. Equal windows have it at the same offset, so a window can only repeat within the
   windows that share its anchor's hash. Neighbouring windows share an anchor; such a run with
   its bytes is a *context*. One in about eighty places is an anchor.
2. *Copies.* Contexts of equal anchor and equal 64-bit digest are copies; all their windows
   repeat. Copies in one text are told at once, and one of them stands for all from there on, so
   that a text of one phrase over and over adds one row to its anchor. An anchor with one context
   only has no repeats.
3. *Suffix arrays.* What is left are contexts that share an anchor but differ, at the edges of
   shared passages. Each task takes the contexts of some anchors, sorts the suffixes that begin
   at their windows - multikey quicksort down to a shallow depth, blind tries for the groups with
   a longer common prefix - and marks neighbours whose common prefix reaches ``length``.
4. *Hot anchors.* An anchor with more than ``HOT`` contexts is not one task's work: its windows
   are dealt out by a 128-bit digest of their bytes, equal ones combined before the shuffle.
5. *Cut.* The repeated spans of a document come back to its text.

Documents are kept in a table bucketed by row, so their texts are shuffled once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import arrow_map, pieces, scratch_table, stage

LENGTH = 200
#: Bytes of an anchor's string.
GRAM = 32
#: Contexts of one anchor up to which they are sorted in one task.
HOT = 4_096
#: Bytes of contexts that a task sorts at once, if anchors allow.
SORT_BYTES = 1 << 19
#: Bytes whose contexts are found at once; it divides the work and changes no result.
STRIP = 1 << 20
#: Depth of the multikey quicksort, in steps of eight bytes.
SHALLOW = 3


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the ``GRAM`` bytes from each place on, by doubling."""
    h = data.astype(np.uint64)
    h *= np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    size = 1
    while size < GRAM:
        left = h[: len(h) - size] * np.uint64(0xBF58476D1CE4E5B9)
        left ^= left >> np.uint64(32)
        left += h[size:]
        left *= np.uint64(0x94D049BB133111EB)
        left ^= left >> np.uint64(31)
        h = left
        size *= 2
    return h


def window_least(keys: np.ndarray, width: int) -> np.ndarray:
    """Least key of every ``width`` neighbours: least up to a block's end and from its start."""
    n = len(keys) - width + 1
    fill = np.full(-len(keys) % width, np.iinfo(keys.dtype).max, keys.dtype)
    blocks = np.concatenate([keys, fill]).reshape(-1, width)
    before = np.minimum.accumulate(blocks, axis=1).ravel()
    after = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(after[:n], before[width - 1 : width - 1 + n])


def contexts(texts: list[bytes], length: int) -> tuple[np.ndarray, ...]:
    """Text index, anchor hash, first and last window of every context.

    More than ``STRIP`` bytes are taken in strips that overlap by ``length - 1``. A context that
    an end of a strip parts comes as two; each window is in one of them.
    """
    if sum(map(len, texts)) <= STRIP:
        return strip_contexts(texts, length)
    found = [(np.zeros(0, np.int64),) * 4]
    for k, text in enumerate(texts):
        for a in range(0, len(text) - length + 1, STRIP):
            own, h, lo, hi = strip_contexts([text[a : a + STRIP + length - 1]], length)
            found.append((own + k, h, lo + a, hi + a))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def strip_contexts(texts: list[bytes], length: int) -> tuple[np.ndarray, ...]:
    """The contexts of texts that are short enough to be taken at once."""
    width = length - GRAM + 1
    data = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.array([len(x) for x in texts])
    if len(data) < length:
        return (np.zeros(0, np.int64),) * 4
    h = gram_hashes(data)
    # the low bits make the first of equal hashes the least
    low = np.uint64((1 << 28) - 1)
    least = window_least((h & ~low) | np.arange(len(h), dtype=np.uint64), width)
    anchor = (least & low).astype(np.int64)
    ends = np.cumsum(sizes)
    owner = np.repeat(np.arange(len(texts)), sizes)[: len(anchor)]
    whole = np.nonzero(np.arange(len(anchor)) + length <= ends[owner])[0]
    if not len(whole):
        return (np.zeros(0, np.int64),) * 4
    first = np.nonzero(
        (np.diff(anchor[whole], prepend=-1) != 0) | (np.diff(owner[whole], prepend=-1) != 0)
    )[0]
    last = np.append(first[1:], len(whole)) - 1
    base = (ends - sizes)[owner[whole[first]]]
    return (
        owner[whole[first]],
        h[anchor[whole[first]]].view(np.int64),
        whole[first] - base,
        whole[last] - base,
    )


def keep_rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``rid, doc, id, text``: a table bucketed by a row number of its own."""
    spark = docs.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name, path = scratch_table(spark, "rows")
    rows = docs.select(
        F.monotonically_increasing_id().alias("rid"),
        F.struct(*(x for x in docs.columns if x != text_col)).alias("doc"),
        F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("text"),
    )
    writer = rows.repartition(buckets, "rid").write.bucketBy(buckets, "rid")
    writer.option("path", path).option("compression", "zstd").saveAsTable(name)
    return spark.table(name)


def combine_copies(
    own: np.ndarray, h: np.ndarray, c: np.ndarray, lo: np.ndarray, hi: np.ndarray, length: int
) -> tuple[np.ndarray, np.ndarray, tuple[np.ndarray, ...]]:
    """Places of the first of equal contexts of a text, how many they are, and the others' runs.

    Contexts come in order of text and place. The others repeat, whatever stands elsewhere: they
    are given as text, first and last window of the runs that their bytes form.
    """
    order = np.lexsort((c, h, own))
    keys = [x[order] for x in (own, h, c)]
    new = np.append(True, np.logical_or.reduce([x[1:] != x[:-1] for x in keys]))[: len(order)]
    firsts = np.nonzero(new)[0]
    n = np.diff(np.append(firsts, len(order)))
    others = np.sort(order[~new])
    o, a, b = own[others], lo[others], hi[others]
    parted = np.append(True, (o[1:] != o[:-1]) | (a[1:] > b[:-1] + length))[: len(others)]
    starts = np.nonzero(parted)[0]
    ends = np.append(starts[1:], len(others))[: len(starts)] - 1
    return order[firsts], n, (o[starts], a[starts], b[ends])


def find_contexts(rows: DataFrame, length: int) -> DataFrame:
    """``h, c, rid, lo, hi, n``: the different contexts of each text, and how often each is there.

    ``c`` is the digest of a context's bytes. Rows without ``h`` are what its copies in the same
    text cover.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_64_intdigest
        for batch in batches:
            rids = batch.column(0).to_numpy(zero_copy_only=False)
            for first, texts in pieces(batch.column(1)):
                own, h, lo, hi = contexts(texts, length)
                c = [
                    digest(texts[k][a : b + length])
                    for k, a, b in zip(own.tolist(), lo.tolist(), hi.tolist(), strict=True)
                ]
                c = np.array(c, np.uint64).view(np.int64)
                at, n, (o, a, b) = combine_copies(own, h, c, lo, hi, length)
                none = pa.nulls(len(o), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.concat_arrays([pa.array(h[at], pa.int64()), none]),
                        pa.concat_arrays([pa.array(c[at], pa.int64()), none]),
                        pa.array(rids[first + np.append(own[at], o)], pa.int64()),
                        pa.array(np.append(lo[at], a), pa.int32()),
                        pa.array(np.append(hi[at], b), pa.int32()),
                        pa.concat_arrays([pa.array(n, pa.int64()), none]),
                    ],
                    ["h", "c", "rid", "lo", "hi", "n"],
                )

    texts = rows.select("rid", "text").where(F.octet_length("text") >= length)
    return arrow_map(texts, run, "h long, c long, rid long, lo int, hi int, n long")


def sort_shallow(data: np.ndarray, starts: np.ndarray) -> Iterator[np.ndarray]:
    """Multikey quicksort by eight bytes a level; yields groups equal down to ``SHALLOW`` levels.

    Suffixes that differ above that depth have no repeat and are not yielded. ``data`` must
    reach past every start by the depth.
    """
    todo = [(starts, 0)]
    while todo:
        group, level = todo.pop()
        if level == SHALLOW:
            yield group
            continue
        keys = data[group[:, None] + np.arange(8 * level, 8 * level + 8)]
        keys = np.ascontiguousarray(keys).view(">u8").ravel()
        order = np.argsort(keys, kind="stable")
        cuts = np.nonzero(np.diff(keys[order]))[0] + 1
        parts = np.split(group[order], cuts) if len(cuts) < 64 else None
        if parts is None:
            # many parts: go on with all that are not alone at once, their level as first key
            bounds = np.concatenate([[0], cuts, [len(group)]])
            sizes = np.diff(bounds)
            rank = np.repeat(np.arange(len(sizes)), sizes)
            yield from _together(data, group[order], rank, sizes, level + 1)
        else:
            todo += [(x, level + 1) for x in parts if len(x) > 1]


def _together(
    data: np.ndarray, group: np.ndarray, rank: np.ndarray, sizes: np.ndarray, level: int
) -> Iterator[np.ndarray]:
    """The further levels of many groups in one sort each; ``rank`` tells the groups apart."""
    several = sizes[rank] > 1
    group, rank = group[several], rank[several]
    while level < SHALLOW and len(group):
        keys = data[group[:, None] + np.arange(8 * level, 8 * level + 8)]
        keys = np.ascontiguousarray(keys).view(">u8").ravel()
        order = np.lexsort((keys, rank))
        group, rank, keys = group[order], rank[order], keys[order]
        new = (np.diff(rank, prepend=-1) != 0) | (np.diff(keys, prepend=keys[0]) != 0)
        rank = np.cumsum(new)
        several = np.bincount(rank)[rank] > 1
        group, rank = group[several], rank[several]
        level += 1
    if len(group):
        cuts = np.nonzero(np.diff(rank))[0] + 1
        yield from np.split(group, cuts)


class BlindTrie:
    """Order of strings that share a long prefix, by their branching bytes only.

    An inner node is (depth, {byte: child}); a leaf is a list of equal strings' places. A new
    string goes down by its bytes at the branching depths, is compared once with a leaf there,
    and is added where they part.
    """

    def __init__(self, data: bytes, length: int):
        self.data, self.length, self.root = data, length, None

    def add(self, start: int) -> None:
        data, length = self.data, self.length
        own = data[start : start + length]
        if self.root is None:
            self.root = [start]
            return
        node, path = self.root, []
        while type(node) is tuple:
            path.append(node)
            children = node[1]
            child = children.get(own[node[0]])
            node = child if child is not None else next(iter(children.values()))
        other = data[node[0] : node[0] + length]
        if own == other:
            node.append(start)
            return
        low, high = 0, length  # the first place where they part, by halving
        while high - low > 1:
            middle = (low + high) // 2
            if own[low:middle] == other[low:middle]:
                low = middle
            else:
                high = middle
        depth = low
        above = None
        below = self.root
        while type(below) is tuple and below[0] < depth:
            above, below = below, below[1].get(own[below[0]])
        if type(below) is tuple and below[0] == depth:
            below[1][own[depth]] = [start]
            return
        node = (depth, {other[depth]: below, own[depth]: [start]})
        if above is None:
            self.root = node
        else:
            above[1][own[above[0]]] = node

    def leaves(self) -> Iterator[list[int]]:
        """The groups of equal strings in order."""
        todo = [self.root] if self.root is not None else []
        while todo:
            node = todo.pop()
            if type(node) is tuple:
                todo += [node[1][k] for k in sorted(node[1], reverse=True)]
            else:
                yield node


def repeated_windows(
    bodies: list[bytes], copies: list[int], length: int
) -> Iterator[tuple[int, int, int]]:
    """Index of a context, first and last window of every run of windows that repeat.

    The bodies are those of whole anchors; ``copies`` tells how often a body stands in the corpus.
    """
    data = b"".join(bodies)
    sizes = np.array([len(x) for x in bodies])
    begins = np.cumsum(sizes) - sizes
    windows = sizes - length + 1
    owner = np.repeat(np.arange(len(bodies)), windows)
    starts = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)
    starts = starts + begins[owner]
    marked = np.zeros(len(data), bool)
    array = np.frombuffer(data, np.uint8)
    single = np.array(copies) == 1
    for group in sort_shallow(array, starts):
        trie = BlindTrie(data, length)
        for start in group.tolist():
            trie.add(start)
        for leaf in trie.leaves():
            if len(leaf) > 1:
                marked[leaf] = True
    marks = marked[starts] & single[owner]
    if not marks.any():
        return
    new = np.diff(owner, prepend=-1) != 0
    edge = np.diff(marks.astype(np.int8), prepend=0)
    firsts = np.nonzero(marks & (new | (edge == 1)))[0]
    ends = np.nonzero(marks & np.append(new[1:] | (edge[1:] == -1), True))[0]
    for a, b in zip(firsts.tolist(), ends.tolist(), strict=True):
        k = int(owner[a])
        yield k, int(starts[a] - begins[k]), int(starts[b] - begins[k])


def sorted_spans(bodies: DataFrame, length: int) -> DataFrame:
    """``rid, lo, hi``: repeated bytes among the contexts of anchors that are not hot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def out(rows: list[tuple]) -> pa.RecordBatch:
            found = [
                (rows[k][1], rows[k][2] + a, rows[k][2] + b + length)
                for k, a, b in repeated_windows(
                    [x[4] for x in rows], [x[3] for x in rows], length
                )
            ]
            return pa.RecordBatch.from_pylist(
                [dict(zip(("rid", "lo", "hi"), x, strict=True)) for x in found],
                schema=pa.schema([("rid", pa.int64()), ("lo", pa.int32()), ("hi", pa.int32())]),
            )

        size = 0
        for batch in batches:
            for row in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                if size > SORT_BYTES and row[0] != held[-1][0]:
                    yield out(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[4])
        if held:
            yield out(held)

    dealt = bodies.select("h", "rid", "lo", "n", "body")
    dealt = dealt.repartition("h").sortWithinPartitions("h")
    return arrow_map(dealt, run, "rid long, lo int, hi int")


def dealt_spans(bodies: DataFrame, length: int) -> DataFrame:
    """The same for hot anchors: windows are dealt out one by one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_128_digest
        for batch in batches:
            for rid, lo, n, body in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                size = len(body) - length + 1
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([digest(body[k : k + length]) for k in range(size)], pa.binary()),
                        pa.array(np.full(size, rid)),
                        pa.array(np.arange(lo, lo + size), pa.int32()),
                        pa.array(np.full(size, n)),
                    ],
                    ["w", "rid", "lo", "n"],
                )

    windows = arrow_map(
        bodies.select("rid", "lo", "n", "body"), run, "w binary, rid long, lo int, n long"
    )
    repeated = windows.groupBy("w").agg(F.sum("n").alias("all")).where("all > 1").select("w")
    # written, so that the join has plain shuffles on both sides and a hot window can be split
    repeated = stage(repeated, "windows")
    found = windows.where("n = 1").join(repeated, "w", "left_semi")
    return found.select("rid", "lo", (F.col("lo") + length).cast("int").alias("hi"))


def spans(rows: DataFrame, length: int, hot: int) -> DataFrame:
    """``rid, lo, hi``: byte ranges whose union is all that repeats in each row's text."""
    found = stage(find_contexts(rows, length), "contexts")
    within = found.where("h IS NULL").select("rid", "lo", (F.col("hi") + length).alias("hi"))
    anchors = found.where("h IS NOT NULL")
    by_hash = anchors.groupBy("h").agg(
        F.sum("n").alias("items"), F.min("c").alias("c0"), F.max("c").alias("c1")
    )
    # written, so that the join has plain shuffles on both sides and a hot anchor can be split
    repeated = stage(by_hash.where("items > 1"), "repeated")
    shared = anchors.join(repeated, "h")
    shared = stage(shared.withColumn("mixed", F.col("c0") != F.col("c1")).drop("items"), "shared")
    whole = shared.where("not mixed").select("rid", "lo", (F.col("hi") + length).alias("hi"))

    mixed = shared.where("mixed")
    classes = mixed.groupBy("h", "c").agg(
        F.sum("n").alias("n"), F.min(F.struct("rid", "lo", "hi")).alias("at")
    )
    classes = stage(classes.select("h", "c", "n", "at.*"), "classes")
    copies = mixed.join(classes.where("n > 1").select("h", "c"), ["h", "c"], "left_semi")
    copies = copies.select("rid", "lo", (F.col("hi") + length).alias("hi"))

    sizes = stage(classes.groupBy("h").agg(F.count("*").alias("kinds")), "kinds")
    asked = classes.join(sizes, "h").groupBy("rid").agg(
        F.collect_list(F.struct("h", "n", "lo", "hi", (F.col("kinds") > hot).alias("hot"))).alias("asked")
    )
    held = rows.select("rid", "text").join(asked.hint("shuffle_hash"), "rid")
    held = held.select("rid", "text", F.explode("asked").alias("x"))
    bodies = held.select(
        "rid",
        "x.h",
        "x.n",
        "x.lo",
        "x.hot",
        F.expr(f"substring(text, x.lo + 1, x.hi - x.lo + {length})").alias("body"),
    )
    bodies = stage(bodies, "bodies")
    edges = sorted_spans(bodies.where("not hot"), length)
    edges = edges.union(dealt_spans(bodies.where("hot"), length))
    return whole.union(within).union(copies).union(edges)


def merged(found: DataFrame) -> DataFrame:
    """``rid, ranges``: the maximal ranges of each row, far fewer than its text has bytes.

    A text of one byte over and over repeats at every place, so ranges are merged as they are
    sorted, before any are collected.
    """
    order = Window.partitionBy("rid").orderBy("lo", "hi")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    new = F.coalesce(F.col("lo") > F.max("hi").over(earlier), F.lit(True)).cast("int")
    placed = found.withColumn("new", new)
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = placed.withColumn("run", F.sum("new").over(so_far))
    runs = placed.groupBy("rid", "run").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    return runs.groupBy("rid").agg(F.collect_list(F.struct("lo", "hi")).alias("ranges"))


def cut(text: bytes, ranges: list[tuple[int, int]]) -> tuple[bytes, int]:
    """What is left of a text without the ranges, and the number of maximal runs cut."""
    left, at, runs = [], 0, 0
    end = -1
    for lo, hi in sorted(ranges):
        if lo > end:
            runs += 1
            left.append(text[at:lo])
        end = max(end, hi)
        at = end
    left.append(text[at:])
    return b"".join(left), runs


def remove_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = LENGTH,
    hot: int = HOT,
    as_text: bool = False,
) -> DataFrame:
    """``doc, kept, n_bytes, n_removed, n_spans`` for every row of ``docs``.

    ``doc`` is the row without its text, as a struct; ``kept`` are the bytes left, or
    with ``as_text`` their text, without bytes of characters that a cut has parted. Texts are
    judged as UTF-8 bytes; null counts as empty, texts shorter than ``length`` stay whole. Every
    place of a repeat goes, the first one too. Rows of equal id are separate documents, and so
    copies of a row cut each other. ``hot`` bounds the contexts that one task sorts and does not
    change the result.
    """
    if length < 2 * GRAM or length < 8 * SHALLOW:
        raise ValueError(f"length must be at least {2 * GRAM}")
    rows = keep_rows(docs, id_col, text_col)
    ranges = merged(spans(rows, length, hot))
    joined = rows.join(ranges.hint("shuffle_hash"), "rid", "left").select("doc", "text", "ranges")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.string() if as_text else pa.binary()
        for batch in batches:
            kept, n_bytes, n_removed, n_spans = [], [], [], []
            for text, found in zip(batch.column(1), batch.column(2), strict=True):
                text, found = text.as_py(), found.as_py() or ()
                left, runs = cut(text, [(x["lo"], x["hi"]) for x in found])
                kept.append(left.decode("utf-8", "ignore") if as_text else left)
                n_bytes.append(len(text))
                n_removed.append(len(text) - len(left))
                n_spans.append(runs)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(kept, kind), pa.array(n_bytes, pa.int64()),
                 pa.array(n_removed, pa.int64()), pa.array(n_spans, pa.int64())],
                ["doc", "kept", "n_bytes", "n_removed", "n_spans"],
            )

    schema = joined.select("doc").schema.add("kept", "string" if as_text else "binary")
    for name in ("n_bytes", "n_removed", "n_spans"):
        schema = schema.add(name, "long")
    return arrow_map(joined, run, schema)


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the repeats cut from their texts.

    Bytes of a character that a cut has parted go with it. ``n_chars``, if there, is counted
    anew. A document of which nothing is left goes; one that was empty before stays.
    """
    found = remove_repeats(docs, id_col, text_col, as_text=True)
    found = found.where((F.col("n_removed") == 0) | (F.col("kept") != ""))
    columns = []
    for field in docs.schema:
        column = F.col(f"doc.`{field.name}`") if field.name != text_col else F.col("kept")
        if field.name == "n_chars":
            column = F.length("kept").cast(field.dataType)
        columns.append(column.alias(field.name))
    return found.select(*columns)


#: The query in SQL: every window of every text by its hash, texts as hexadecimal digits.
ORACLE = """
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
w AS (
    SELECT r, i, md5(substr(x, 2 * i + 1, 400)) AS h
    FROM (SELECT r, x, unnest(range(0, len(x) // 2 - 199)) AS i FROM d WHERE len(x) >= 400)),
again AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY h) AS n FROM w) WHERE n > 1),
edge AS (
    SELECT r, i,
           CASE WHEN i <= lag(i) OVER (PARTITION BY r ORDER BY i) + 200 THEN 0 ELSE 1 END AS new
    FROM again),
run AS (SELECT r, i, sum(new) OVER (PARTITION BY r ORDER BY i) AS k FROM edge),
span AS (SELECT r, k, min(i) AS lo, max(i) + 200 AS hi FROM run GROUP BY r, k),
gap AS (
    SELECT r, coalesce(lag(hi) OVER (PARTITION BY r ORDER BY lo), 0) AS lo, lo AS hi FROM span
    UNION ALL SELECT r, max(hi), NULL FROM span GROUP BY r),
kept AS (
    SELECT d.r, string_agg(substr(x, CAST(2 * lo + 1 AS BIGINT),
                                  CAST(2 * (coalesce(hi, len(x) // 2) - lo) AS BIGINT)),
                           '' ORDER BY lo) AS x
    FROM d JOIN gap USING (r) GROUP BY d.r),
n AS (SELECT r, count(*) AS n_spans, sum(hi - lo) AS n_removed FROM span GROUP BY r)
SELECT doc_id, CAST(len(d.x) // 2 AS BIGINT) AS n_bytes,
       CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(coalesce(kept.x, d.x))) AS kept_sha256
FROM d LEFT JOIN n USING (r) LEFT JOIN kept USING (r)
"""

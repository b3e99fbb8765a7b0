"""SimHash near-duplicates, joined exactly through vantage-point trees.

Fingerprints within ``radius`` bits are linked; linked fingerprints, over any number of links,
form a component. Two fingerprints within the radius agree in one of ``radius + 1`` blocks of bits,
so a fingerprint goes to one part for each block, named by some of the block's bits. Their number
grows with the table: parts keep their size, and a fingerprint has ``radius + 1`` copies however
many there are. A tree of vantage points splits a part by the distance to a vantage point. By the
triangle inequality two fingerprints within the radius can only be parted by a split at distance
``cut`` if the farther one lies in ``[cut, cut + radius)``; those boundary fingerprints go to both
sides, so every linked pair meets in some leaf, where it is compared exactly. Parts that are much
larger than the others are split that way into shards before they are shuffled. These trees are
made from a sample, which decides how even the shards are and nothing else.

Where fingerprints crowd together a spanning forest is searched, and a shard hands on one link from
each fingerprint to the least that it reaches there, so the number of links stays in proportion to
the number of fingerprints, never to its square. Copies of a text have one
fingerprint and are joined back to its component at the end.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import arrow_map, pieces, stage, utf8

#: Members of a part aimed at, and the size up to which a task compares all with all.
SHARD, BUCKET = 65_536, 1024
#: Times that size, from which a part is split into shards before it is shuffled.
UNEVEN = 2
GROWTH = 1.7
#: Fingerprints from which the trees of shards are made: this many per part, and at most.
SAMPLE_PER_SHARD, SAMPLE_MOST = 64, 1_000_000
#: Hashes that a task turns into bits at once.
HASHES = 32_768
#: Bytes of a text whose words are taken at once.
STRIP = 1 << 18
SPACE = re.compile(rb"[\x20\x09-\x0D]")


def _bit_counts(hashes: list[int], starts: list[int]) -> np.ndarray:
    raw = np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8)
    bits = np.unpackbits(raw, axis=1, bitorder="little")
    return np.add.reduceat(bits, starts, axis=0, dtype=np.int64)


def _pack(counts: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """Bits set in over half of the hashes, as signed longs."""
    bits = (2 * counts > totals[:, None]).astype(np.uint8)
    return np.packbits(bits, axis=1, bitorder="little").view("<i8").ravel()


def shingles(text: bytes, length: int) -> list[bytes]:
    """Space-joined word shingles with A-Z lower-cased; short texts are one shingle."""
    words = text.lower().split()
    if len(words) <= length:
        return [b" ".join(words)] if words else []
    return list(map(b" ".join, zip(*(words[k:] for k in range(length)), strict=False)))


def shingle_runs(text: bytes, length: int) -> Iterator[list[bytes]]:
    """The shingles of a text in runs, so that a long one is never held as words."""
    if len(text) <= STRIP:
        yield shingles(text, length)
        return
    at, held, many = 0, [], False
    while at < len(text):
        gap = SPACE.search(text, at + STRIP)
        end = gap.start() if gap else len(text)
        held += text[at:end].lower().split()
        if len(held) >= length:
            yield list(map(b" ".join, zip(*(held[k:] for k in range(length)), strict=False)))
            many, held = True, held[len(held) - length + 1 :]
        at = end
    if not many and held:
        yield [b" ".join(held)]


def simhashes(texts: list[bytes], length: int, seed: int) -> np.ndarray:
    """SimHash of each text over XXH64 of its shingles; 0 for a text without words."""
    digest = xxhash.xxh64_intdigest
    out = np.zeros(len(texts), dtype=np.int64)
    rows: list[int] = []
    starts: list[int] = []
    hashes: list[int] = []

    def flush() -> None:
        if rows:
            totals = np.diff([*starts, len(hashes)])
            out[rows] = _pack(_bit_counts(hashes, starts), totals)
            rows.clear()
            starts.clear()
            hashes.clear()

    for row, text in enumerate(texts):
        if len(text) > STRIP:
            count, total = np.zeros((1, 64), dtype=np.int64), 0
            for parts in shingle_runs(text, length):
                for k in range(0, len(parts), HASHES):
                    count += _bit_counts([digest(x, seed) for x in parts[k : k + HASHES]], [0])
                total += len(parts)
            out[row] = _pack(count, np.array([total]))[0]
        elif parts := shingles(text, length):
            rows.append(row)
            starts.append(len(hashes))
            hashes += [digest(x, seed) for x in parts]
            if len(hashes) > HASHES:
                flush()
    flush()
    return out


def fingerprints(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = 3,
    seed: int = 42,
    carried: Mapping[str, Column] | None = None,
) -> DataFrame:
    """``doc_id, fp``: the fingerprint of every row as a long; null texts count as empty.

    ``carried`` names further longs that go along with each row.
    """
    more = carried or {}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [simhashes(texts, length, seed) for _, texts in pieces(batch.column(1))]
            fps = np.concatenate(fps or [np.zeros(0, np.int64)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(fps), *batch.columns[2:]], ["doc_id", "fp", *names]
            )

    names = list(more)
    kept = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        utf8(text_col).alias("text"),
        *(x.alias(name) for name, x in more.items()),
    )
    schema = ", ".join(f"{x} long" for x in ("doc_id", "fp", *names))
    return arrow_map(kept, run, schema)


def distances(points: np.ndarray, vantage: np.uint64) -> np.ndarray:
    return np.bitwise_count(points ^ vantage).astype(np.int16)


def choose_split(points: np.ndarray, radius: int) -> tuple[np.uint64, int] | None:
    """Vantage point and cut that part the points best, boundary included, or None.

    The work of a subtree grows with about the 1.7th power of its members; that sum is
    minimised over a few vantage points and all cuts.
    """
    some = points[:: max(1, len(points) // 1024)]
    best, found = 0.99 * len(some) ** GROWTH, None
    for vantage in some[:: max(1, len(some) // 8)]:
        tally = np.bincount(distances(some, vantage), minlength=66 + radius)
        below = np.concatenate([[0], np.cumsum(tally)])
        cuts = np.arange(1, 65)
        left, right = below[cuts + radius], len(some) - below[cuts]
        cost = left**GROWTH + right**GROWTH
        cost[(left >= len(some)) | (right >= len(some))] = np.inf
        k = int(np.argmin(cost))
        if cost[k] < best:
            best, found = cost[k], (vantage, int(cuts[k]))
    return found


def shard_tree(sample: np.ndarray, members: int, radius: int) -> list[tuple[int, int, int, int]]:
    """Nodes (vantage, cut, left, right); a child below 0 is the shard ``-child - 1``."""
    if members <= 1:
        return []
    nodes: list[tuple[int, int, int, int]] = []
    shards = 0

    def grow(points: np.ndarray) -> int:
        nonlocal shards
        split = choose_split(points, radius) if len(points) > members else None
        if split is None:
            shards += 1
            return -shards
        at = len(nodes)
        nodes.append((0, 0, 0, 0))
        far = distances(points, split[0])
        left = grow(points[far < split[1] + radius])
        right = grow(points[far >= split[1]])
        nodes[at] = (int(split[0]), split[1], left, right)
        return at

    grow(sample)
    return nodes


def to_shards(
    points: np.ndarray, nodes: list[tuple[int, int, int, int]], radius: int
) -> tuple[np.ndarray, np.ndarray]:
    """Index of a point and shard, for every shard that the point belongs to."""
    done = []
    todo = [(np.arange(len(points)), 0 if nodes else -1)]
    while todo:
        which, node = todo.pop()
        if not len(which):
            continue
        if node < 0:
            done.append((which, np.full(len(which), -node - 1)))
            continue
        vantage, cut, left, right = nodes[node]
        far = distances(points[which], np.uint64(vantage))
        todo += [(which[far < cut + radius], left), (which[far >= cut], right)]
    if not done:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*done, strict=True))


def part_bits(n: int, radius: int) -> int:
    """Bits that tell the parts of one block from each other; 0 where one part holds all."""
    return min(64 // (radius + 1), (-(-n // SHARD) - 1).bit_length() if n else 0)


def naming_bits(sample: np.ndarray, bits: int, radius: int) -> np.ndarray:
    """The bits of every block that name its parts: those nearest to being set in half."""
    width = 64 // (radius + 1)
    places = np.arange(width * (radius + 1), dtype=np.uint64)
    share = [float(np.mean(sample >> k & np.uint64(1))) if len(sample) else 0.5 for k in places]
    far = np.abs(np.array(share) - 0.5).reshape(radius + 1, width)
    first = np.argsort(far, axis=1, kind="stable")[:, :bits]
    return first.astype(np.uint64) + np.arange(radius + 1, dtype=np.uint64)[:, None] * np.uint64(width)


def part_keys(points: np.ndarray, naming: np.ndarray) -> Iterator[np.ndarray]:
    """The part of each point in one block after the other."""
    for block, places in enumerate(naming):
        keys = np.full(len(points), block, np.uint64)
        for k in places:
            keys = keys << np.uint64(1) | points >> k & np.uint64(1)
        yield keys.view(np.int64)
        if not len(places):
            break


def by_key(keys: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each key and the places where it stands."""
    order = np.argsort(keys, kind="stable")
    cuts = np.nonzero(np.diff(keys[order]))[0] + 1
    for own in np.split(order, cuts) if len(order) else ():
        yield int(keys[own[0]]), own


def part_trees(
    sample: np.ndarray, members: int, naming: np.ndarray, radius: int
) -> dict[int, list[tuple[int, int, int, int]]]:
    """The trees of the parts that hold more than ``members`` of the sample."""
    trees = {}
    for keys in part_keys(sample, naming):
        for key, own in by_key(keys):
            if nodes := shard_tree(sample[own], members, radius):
                trees[key] = nodes
    return trees


def to_parts(
    points: np.ndarray,
    trees: dict[int, list[tuple[int, int, int, int]]],
    naming: np.ndarray,
    radius: int,
) -> tuple[np.ndarray, np.ndarray]:
    """Index of a point and shard, for every shard of every part that the point belongs to."""
    split = np.array(list(trees), np.int64)
    done = [(np.zeros(0, np.int64),) * 2]
    for keys in part_keys(points, naming):
        uneven = np.isin(keys, split)
        even = np.nonzero(~uneven)[0]
        done.append((even, keys[even] << 32))
        rest = np.nonzero(uneven)[0]
        for key, at in by_key(keys[rest]):
            which, shard = to_shards(points[rest[at]], trees[key], radius)
            done.append((rest[at][which], (key << 32) + shard))
    return tuple(np.concatenate(x) for x in zip(*done, strict=True))


def _crowd(points: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """A spanning forest by search from point to point over those not yet reached."""
    left = points
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            at = queue.pop()
            near = distances(left, at) <= radius
            if near.any():
                yield np.full(int(near.sum()), at), left[near]
                queue += list(left[near])
                left = left[~near]


def _compare(points: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs within the radius, or a forest where there are many, block by block."""
    found, n = [], 0
    for k in range(0, len(points), 64):
        rows = points[k : k + 64]
        bits = np.bitwise_count(rows[:, None] ^ points[None, k:])
        a, b = np.nonzero(bits <= radius)
        later = b > a
        if later.any():
            found.append((rows[a[later]], points[k:][b[later]]))
            n += len(found[-1][0])
            if n > 8 * len(points):
                yield from _crowd(points, radius)
                return
    yield from found


def links(points: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs within the radius: all of them, or a forest of them where points crowd together."""
    todo = [points]
    while todo:
        points = todo.pop()
        if len(points) <= BUCKET:
            yield from _compare(points, radius)
            continue
        split = choose_split(points, radius)
        if split is None:
            yield from _crowd(points, radius)
            continue
        far = distances(points, split[0])
        parts = [points[far < split[1] + radius], points[far >= split[1]]]
        if max(map(len, parts)) == len(points):
            yield from _crowd(points, radius)
        else:
            todo += parts


def stars(links: Iterator[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """What the links join, as a link from each point to the least that it reaches."""
    above: dict[int, int] = {}

    def least(x: int) -> int:
        top = x
        while above[top] != top:
            top = above[top]
        while above[x] != top:
            above[x], x = top, above[x]
        return top

    for a, b in links:
        for x, y in zip(a.tolist(), b.tolist(), strict=True):
            above.setdefault(x, x)
            above.setdefault(y, y)
            x, y = least(x), least(y)
            if x != y:
                above[max(x, y)] = min(x, y)
    members = [x for x in above if least(x) != x]
    return np.array(members, np.int64), np.array([above[x] for x in members], np.int64)


def fingerprint_links(distinct: DataFrame, radius: int = 3) -> DataFrame:
    """``u, v``: links between distinct fingerprints (column ``fp``) that give all components.

    A shard hands on what its links join as stars, so that only groups that span shards are left
    to be put together.
    """
    spark = distinct.sparkSession
    n = distinct.count()
    bits = part_bits(n, radius)
    sample = np.zeros(0, np.uint64)
    if bits:
        size = min(SAMPLE_MOST, SAMPLE_PER_SHARD * -(-n // SHARD))
        drawn = distinct.select("fp").where(
            F.pmod(F.xxhash64("fp"), F.lit(1_000_000_000)) <= int(1_000_000_000 * size / n) + 1
        )
        sample = drawn.toArrow().column("fp").to_numpy().view(np.uint64)
    naming = naming_bits(sample, bits, radius)
    members = max(8, UNEVEN * len(sample) * SHARD // max(n, 1))
    trees = spark.sparkContext.broadcast(part_trees(sample, members, naming, radius))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            which, shard = to_parts(points, trees.value, naming, radius)
            yield pa.RecordBatch.from_arrays(
                [pa.array(shard, pa.int64()), pa.array(points[which].view(np.int64))],
                ["shard", "fp"],
            )

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in whole_shards(batches):
            found = links(shard.view(np.uint64), radius)
            u, v = stars((a.view(np.int64), b.view(np.int64)) for a, b in found)
            if len(u):
                yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

    dealt = arrow_map(distinct.select("fp"), deal, "shard long, fp long")
    dealt = dealt.repartition("shard").sortWithinPartitions("shard")
    return arrow_map(dealt, join, "u long, v long")


def whole_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """The fingerprints of one shard after the other, from rows in order of their shard."""
    held: list[np.ndarray] = []
    last = None
    for batch in batches:
        shards = batch.column(0).to_numpy(zero_copy_only=False)
        fps = batch.column(1).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.nonzero(np.diff(shards))[0] + 1), len(shards)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if a == b:
                continue
            if held and shards[a] != last:
                yield np.concatenate(held)
                held = []
            last = shards[a]
            held.append(fps[a:b].copy())
    if held:
        yield np.concatenate(held)


def components(edges: DataFrame) -> DataFrame:
    """``fp, root``: every linked vertex and the least vertex it reaches.

    Large-star and small-star steps in turn until the edges no longer change. Each step is a
    partial aggregate and a join; what it leaves is written to the shared folder.
    """
    edges = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    edges = stage(edges.where("u != v").distinct(), "stars")
    seen = None
    while True:
        state = edges.agg(
            F.count("*").alias("n"),
            F.bit_xor(F.xxhash64("u", "v")).alias("x"),
            F.sum(F.pmod(F.xxhash64("v", "u"), F.lit(1 << 30))).alias("s"),
        ).first()
        if state["n"] == 0 or state == seen:
            break
        seen = state
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # written, so that the join has plain shuffles on both sides and a hot star can be split
        least = stage(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")), "least")
        large = both.join(least, "u").where("v > u")
        large = stage(
            large.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "stars"
        )
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v != m")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stage(small.union(least.select("u", F.col("m").alias("v"))).distinct(), "stars")
    roots = edges.select(F.col("v").alias("fp"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("fp"), F.col("v").alias("root")).union(roots)


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = 3,
    radius: int = 3,
    seed: int = 42,
) -> DataFrame:
    """``doc_id, fp, component_id`` for every row of ``docs``.

    ``component_id`` is the smallest id that links reach, the row's own included. Texts without
    words, null and empty ones too, have fingerprint 0, linked like any other. Rows of equal id
    stay separate rows. Null ids are no candidates for ``component_id``; it is null where a
    component has no other. An empty table gives an empty result. Other columns are not read.
    """
    rows = stage(fingerprints(docs, id_col, text_col, length, seed), "fingerprints")
    return rows.join(named(rows, radius), "fp").select("doc_id", "fp", "component_id")


def named(rows: DataFrame, radius: int = 3) -> DataFrame:
    """``fp, root, component_id`` of each fingerprint of ``rows``; a component has one ``root``."""
    distinct = stage(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct")
    linked = components(fingerprint_links(distinct, radius))
    members = linked.join(distinct, "fp")
    lowest = members.groupBy("root").agg(F.min("first").alias("lowest"))
    members = members.join(lowest, "root").select("fp", "root", "lowest")
    found = distinct.join(members, "fp", "left").select(
        "fp",
        F.coalesce("root", "fp").alias("root"),
        F.coalesce("lowest", "first").alias("component_id"),
    )
    # written for the same reason: copies of one text may be a third of the rows
    return stage(found, "named")


def hexadecimal(fp: str = "fp"):
    return F.lpad(F.lower(F.hex(F.col(fp))), 16, "0")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents without near-duplicates: one row of each component.

    It is the row of the smallest id, null ids last; of rows that share this id the one that
    comes first by a hash of the whole row. Rows of equal id, or without any, that lie in
    different components all stay.
    """
    # written, so that a row has the same number whenever it is read
    numbered = stage(
        docs.select(F.struct("*").alias("doc"), F.monotonically_increasing_id().alias("at")),
        "numbered",
    )
    own = numbered.select(
        F.col(f"doc.{id_col}").alias("id"),
        F.col(f"doc.{text_col}").alias("text"),
        F.xxhash64("doc").alias("tie"),
        "at",
    )
    carried = {x: F.col(x) for x in ("tie", "at")}
    rows = stage(fingerprints(own, "id", "text", carried=carried), "fingerprints")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "tie", "at"))
    kept = rows.join(named(rows), "fp").groupBy("root").agg(first.alias("first"))
    return numbered.join(kept.select("first.at"), "at", "left_semi").select("doc.*")

"""Repair of conversation structure by a grammar-compressed shortest-edit search.

A conversation is a string of symbols, one per row: what its role allows and whether it is at
fault. The cheapest edits that give it the structure ``(s?(ua)+)?`` are a shortest path, and rows
act on paths as matrices over (min, +): entry (p, q) is the cheapest way to bring the automaton
from state p to state q, with its audit, the string of the edits' initials. Matrices of
neighbouring rows multiply, so equal strings of rows are multiplied once:

1. Rows are ordered and cut into segments of at most ``2 ** SEGMENT_BITS`` rows; a long conversation has many.
2. Distinct symbol strings of segments are compressed by Re-Pair: the most frequent pair of
   neighbouring symbols becomes a rule, again and again. One matrix per rule is the product of its
   two sides, made bottom-up and shared by all strings. Audits are ropes: a rule's rope only points
   to those of its sides.
3. The matrices of a conversation's segments are applied one after the other to the vector of its
   start. The path chosen says how each segment is edited, so rows are edited segment by segment.

Ties go to the audit that is least as a string. Of two audits of the same rows and cost neither
begins with the other (what is longer has one more insertion, which costs), so the order of two
audits is not changed by what follows, and matrices may keep the least one only.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tidemark.llm.common import arrow_map, stage

#: Rows of a segment as a power of two.
SEGMENT_BITS = 12
#: Symbols that Re-Pair takes at once, of one or many strings.
TOGETHER = 1 << 16
#: States of the automaton, by what was written last: nothing, s, u or a.
START, SYSTEM, USER, ASSISTANT = range(4)
#: Costs of edits.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: Symbols: roles s, u, a and others (o) that are in order; capitals are truncated; X must go.
SYMBOLS = "suaoSUAOX"
BLANKS = " \t\n\x0b\x0c\r"
MODULUS, BASE = (1 << 61) - 1, 1_000_003


class Rope:
    """A string as a tree over shared parts, with a hash to tell equal parts without reading them."""

    __slots__ = ("hash", "left", "power", "right", "size", "text")

    def __init__(self, text: str = "", left: Rope | None = None, right: Rope | None = None):
        self.text, self.left, self.right = text, left, right
        if left is None:
            self.size, self.hash = len(text), 0
            for c in text:
                self.hash = (self.hash * BASE + ord(c)) % MODULUS
            self.power = pow(BASE, self.size, MODULUS)
        else:
            self.size = left.size + right.size
            self.hash = (left.hash * right.power + right.hash) % MODULUS
            self.power = left.power * right.power % MODULUS

    def __add__(self, other: Rope) -> Rope:
        if not other.size:
            return self
        if not self.size:
            return other
        return Rope("", self, other)

    def __str__(self) -> str:
        out, todo = [], [self]
        while todo:
            at = todo.pop()
            if at.left is None:
                out.append(at.text)
            else:
                todo += (at.right, at.left)
        return "".join(out)

    def __lt__(self, other: Rope) -> bool:
        mine, theirs = [self], [other]
        while mine and theirs:
            a, b = mine.pop(), theirs.pop()
            if a is b or (a.size == b.size and a.hash == b.hash):
                continue
            if a.left is None and b.left is None:
                n = min(a.size, b.size)
                if a.text[:n] != b.text[:n]:
                    return a.text[:n] < b.text[:n]
                if a.size > n:
                    mine.append(Rope(a.text[n:]))
                if b.size > n:
                    theirs.append(Rope(b.text[n:]))
            elif a.left is not None and (a.size >= b.size or b.left is None):
                mine += (a.right, a.left)
                theirs.append(b)
            else:
                theirs += (b.right, b.left)
                mine.append(a)
        return bool(theirs)


#: (cost, audit) for every pair of states that a path joins.
Matrix = dict[tuple[int, int], tuple[int, Rope]]
EMPTY = Rope()


def better(a: tuple[int, Rope], b: tuple[int, Rope] | None) -> bool:
    return b is None or a[0] < b[0] or (a[0] == b[0] and a[1] < b[1])


def times(first: Matrix, second: Matrix) -> Matrix:
    """The matrix of one string of rows followed by another."""
    out: Matrix = {}
    onward: dict[int, list] = {}
    for (p, q), x in second.items():
        onward.setdefault(p, []).append((q, x))
    for (p, q), (cost, audit) in first.items():
        for r, (more, rest) in onward.get(q, ()):
            old = out.get((p, r))
            if old is None or cost + more <= old[0]:
                found = (cost + more, audit + rest)
                if better(found, old):
                    out[p, r] = found
    return out


def insertions() -> Matrix:
    """Any number of inserted rows; more than two between two rows never pay."""
    one = {(p, USER): (INSERT, Rope("I")) for p in (START, SYSTEM, ASSISTANT)}
    one[USER, ASSISTANT] = (INSERT, Rope("I"))
    out: Matrix = {(p, p): (0, EMPTY) for p in range(4)}
    for _ in range(2):
        for at, x in times(out, one).items():
            if better(x, out.get(at)):
                out[at] = x
    return out


INSERTED = insertions()


def row_matrix(symbol: str) -> Matrix:
    """The edits of one row, and any insertions after it."""
    own: Matrix = {(p, p): (DELETE, Rope("D")) for p in range(4)}
    if symbol != "X":
        more = TRUNCATED if symbol.isupper() else 0
        role = symbol.lower()
        for p, q, writes in (
            (START, SYSTEM, "s"),
            (START, USER, "u"),
            (SYSTEM, USER, "u"),
            (ASSISTANT, USER, "u"),
            (USER, ASSISTANT, "a"),
        ):
            if role == writes:
                own[p, q] = (more, Rope("K"))
            elif writes != "s":
                own[p, q] = (REROLE + more, Rope("R"))
    return times(own, INSERTED)


ROWS = {x: row_matrix(x) for x in SYMBOLS}


def re_pair(strings: list[str]) -> tuple[list[list[int]], list[tuple[int, int]]]:
    """The strings over symbols and rules, and the rules.

    A symbol's number is its place in ``SYMBOLS``, a rule's its place among the rules after them.
    The most frequent pair is replaced as long as any occurs twice; ties go to the older pair.
    """
    # one row of cells for all strings, closed by cells that never pair
    cells: list[int] = []
    first: list[int] = []
    for s in strings:
        first.append(len(cells))
        cells += map(SYMBOLS.index, s)
        cells.append(-1)
    after = list(range(1, len(cells) + 1))
    before = list(range(-1, len(cells) - 1))
    places: dict[tuple[int, int], set[int]] = {}

    def note(k: int) -> tuple[int, int] | None:
        """The pair that begins at a cell, if it may be replaced there."""
        if k < 0 or cells[k] < 0 or cells[after[k]] < 0:
            return None
        return cells[k], cells[after[k]]

    for k in range(len(cells)):
        pair = note(k)
        if pair:
            places.setdefault(pair, set()).add(k)
    rules: list[tuple[int, int]] = []
    queue = [(-len(x), pair) for pair, x in places.items()]
    heapq.heapify(queue)
    while queue:
        n, pair = heapq.heappop(queue)
        own = places.get(pair, ())
        if len(own) != -n:
            if len(own) > 1:
                heapq.heappush(queue, (-len(own), pair))
            continue
        if len(own) < 2:
            break
        made = len(SYMBOLS) + len(rules)
        grown = set()
        for k in sorted(own):
            if note(k) != pair:  # overlapped by the replacement before it
                continue
            right = after[k]
            for x in (before[k], k, right):
                old = note(x)
                if old and old in places:
                    places[old].discard(x)
            cells[k], cells[right] = made, -2
            after[k] = after[right]
            before[after[k]] = k
            for x in (before[k], k):
                new = note(x)
                if new:
                    places.setdefault(new, set()).add(x)
                    grown.add(new)
        rules.append(pair)
        for new in grown:
            if len(places[new]) > 1:
                heapq.heappush(queue, (-len(places[new]), new))
    out = []
    for k in first:
        own = []
        while cells[k] != -1:
            own.append(cells[k])
            k = after[k]
        out.append(own)
    return out, rules


def segment_matrices(strings: list[str]) -> list[Matrix]:
    """The matrix of each string, by way of a grammar that they share."""
    compressed, rules = re_pair(strings)
    made = [ROWS[x] for x in SYMBOLS]
    for a, b in rules:
        made.append(times(made[a], made[b]))
    out = []
    for own in compressed:
        matrix: Matrix = {(p, p): (0, EMPTY) for p in range(4)}
        for x in own:
            matrix = times(matrix, made[x])
        out.append(matrix)
    return out


def best_path(matrices: Iterator[list[tuple[int, int, int, str]]]) -> tuple[int, str, list[tuple[int, str]]]:
    """Cost and audit of a conversation, and the state before and the audit of each segment.

    What stands before the first row is told apart as a segment of its own, the first.
    """
    # for each state: cost, audit, and the chain of (state before, audit) that led there
    now: dict[int, tuple[int, Rope, tuple | None]] = {}
    for (p, q), (cost, audit) in INSERTED.items():
        if p == START:
            now[q] = (cost, audit, (None, START, str(audit)))
    for entries in matrices:
        after: dict[int, tuple[int, Rope, tuple | None]] = {}
        for p, q, cost, audit in entries:
            if p not in now:
                continue
            had, so_far, chain = now[p]
            old = after.get(q)
            if old is not None and had + cost > old[0]:
                continue
            found = (had + cost, so_far + Rope(audit))
            if old is None or better(found, old[:2]):
                after[q] = (*found, (chain, p, audit))
        now = after
    cost, audit, chain = min(
        (now[q] for q in (START, ASSISTANT) if q in now), key=lambda x: (x[0], Ordered(x[1]))
    )
    steps = []
    while chain:
        chain, state, own = chain
        steps.append((state, own))
    return cost, str(audit), steps[::-1]


class Ordered:
    def __init__(self, rope: Rope):
        self.rope = rope

    def __lt__(self, other: Ordered) -> bool:
        return self.rope < other.rope


def written(symbols: str, state: int, audit: str, opening: str) -> list[dict]:
    """The rows that a segment's edits write, each with the row that it is or follows.

    ``opening`` are the insertions before the segment's first row. ``place`` is 1 for the row
    itself, more for insertions after it and less for those before; the role of a kept row is null.
    """
    out = []
    row, place = 0, -len(opening)
    at = START if opening else state
    began = False
    for c in opening + audit:
        place += 1
        if c != "I":
            row, place, began = row + began, 1, True
        if c == "D":
            continue
        if c == "K" and at == START and symbols[row] in "sS":
            at, role = SYSTEM, None
        else:
            at, role = (ASSISTANT, "assistant") if at == USER else (USER, "user")
        out.append({"row": row, "place": place, "role": None if c == "K" else role, "own": c != "I"})
    return out


def damage(turns: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """The rows after damage: null roles and texts are one space, as are null parts of the key.

    ``crc32('conv_id:turn') % 20`` drops a row (0), empties its text (1), takes its full stops,
    exclamation and question marks (2), repeats it (3) or makes its role user (4).
    """
    text_of = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    code = F.crc32(F.concat(text_of(conv_col), F.lit(":"), text_of(turn_col)).cast("binary")) % 20
    rows = turns.select(
        F.col(conv_col).alias("conv_id"),
        F.col(turn_col).alias("turn"),
        text_of(role_col).alias("role"),
        text_of(text_col).alias("text"),
        code.alias("code"),
    )
    text = F.when(F.col("code") == 1, "").when(
        F.col("code") == 2, F.translate("text", ".!?", "")
    ).otherwise(F.col("text"))
    return (
        rows.where("code != 0")
        .select(
            "conv_id",
            "turn",
            F.when(F.col("code") == 4, "user").otherwise(F.col("role")).alias("role"),
            text.alias("text"),
            F.explode(F.when(F.col("code") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
        )
    )


def ordered(rows: DataFrame) -> DataFrame:
    """``at`` added: numbers that follow conversation, turn (nulls first), role, text and copy.

    Ranges may part a conversation anywhere, so none is too long for a task. Staged.
    """
    keys = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "text"]
    if "copy" in rows.columns:
        keys.append("copy")
    placed = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    return stage(
        placed.select(
            "conv_id", "turn", "role", "text", F.monotonically_increasing_id().alias("at")
        ),
        "ordered-turns",
    )


def first_fault(text: str, role: str, seen: Column) -> Column:
    """``blank``, ``duplicate``, ``truncated`` or an empty string; ``seen`` tells the second."""
    bare = F.rtrim(F.col(text), F.lit(BLANKS))
    return (
        F.when(bare == "", "blank")
        .when(seen, "duplicate")
        .when(~F.right(bare, F.lit(1)).isin(".", "!", "?"), "truncated")
        .otherwise("")
    )


def symbol_of(role: str, fault: str) -> Column:
    own = F.left(F.col(role), F.lit(1))
    own = F.when(own.isin("s", "u", "a"), own).otherwise("o")
    return (
        F.when(F.col(fault).isin("blank", "duplicate"), "X")
        .when(F.col(fault) == "truncated", F.upper(own))
        .otherwise(own)
    )


def repair(
    turns: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    damaged: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """The report on each conversation, and the repaired rows.

    The report has ``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256`` for every conversation of the table, the null one included; one without rows
    has zeros, an empty audit and the digest of the empty string. Repaired rows are ``conv_id, at,
    place, role, text``, in order of ``at`` and ``place``; ``at`` is the row that they come from or
    follow, ``place`` 0 for an inserted row before the first, 1 for the row, 2 on for insertions.

    Null roles and texts are one space. Turns are in order of number, nulls first; rows of equal
    turn in order of role and text; repeated rows follow each other and are duplicates.
    ``damaged`` damages the rows first (see :func:`damage`), as a test of what repair can do. An
    empty table gives two empty ones. Other columns are not read. The digest of a conversation is
    sequential by nature: one task streams a conversation's repaired rows, holding none of them.
    """
    plain = damage(turns, conv_col, turn_col, role_col, text_col)
    if not damaged:
        plain = turns.select(
            F.col(conv_col).alias("conv_id"),
            F.col(turn_col).alias("turn"),
            F.coalesce(F.col(role_col).cast("string"), F.lit(" ")).alias("role"),
            F.coalesce(F.col(text_col).cast("string"), F.lit(" ")).alias("text"),
        )
    rows = ordered(plain)
    same = [F.col("conv_id"), F.col("role"), F.sha2("text", 256).alias("digest")]
    firsts = rows.groupBy(*same).agg(F.min("at").alias("at")).select("at", F.lit(True).alias("first"))
    marked = rows.join(firsts, "at", "left").withColumn(
        "fault", first_fault("text", "role", F.col("first").isNull())
    )
    segment = F.shiftright("at", SEGMENT_BITS).alias("segment")
    signs = F.array_sort(
        F.collect_list(
            F.struct("at", symbol_of("role", "fault").alias("symbol"), F.left("role", F.lit(1)).alias("initial"))
        )
    )
    joined = lambda field: F.array_join(F.transform("signs", lambda x: x[field]), "")
    adjacent = F.zip_with(
        F.slice("signs", F.lit(1), F.size("signs") - 1),
        F.slice("signs", F.lit(2), F.size("signs") - 1),
        lambda a, b: F.concat(a["initial"], b["initial"]),
    )
    n_of = lambda fault: F.count_if(F.col("fault") == fault).alias(fault)
    segments = stage(
        marked.groupBy("conv_id", segment)
        .agg(signs.alias("signs"), F.max("turn").alias("high"), F.min("turn").alias("low"),
             *map(n_of, ("blank", "duplicate", "truncated")))
        .select(
            "conv_id", "segment", "blank", "duplicate", "truncated", "high", "low",
            F.col("signs")[0]["at"].alias("at"),
            joined("symbol").alias("symbols"),
            F.col("signs")[0]["initial"].alias("opens"),
            F.element_at("signs", -1)["initial"].alias("closes"),
            F.size(F.filter(adjacent, lambda x: ~x.isin("su", "ua", "au"))).cast("long").alias("illegal"),
        ),
        "conversation-segments",
    )
    matrices = stage(matrices_of(segments.select("symbols").distinct()), "segment-matrices")
    paths = stage(paths_of(segments.join(matrices, "symbols")), "conversation-paths")

    writes = paths.where("at IS NOT NULL").select("at", F.explode("writes").alias("w"))
    writes = writes.select((F.col("at") + F.col("w.row")).alias("at"), "w.place", F.col("w.role").alias("new"), "w.own")
    repaired = rows.join(writes, "at").select(
        "conv_id",
        "at",
        "place",
        F.coalesce("new", "role").alias("role"),
        F.when(F.col("own"), F.col("text")).otherwise("").alias("text"),
    )

    turns_of = rows.groupBy("conv_id").agg(
        (F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")).alias("gaps")
    )
    counted = segments.groupBy("conv_id").agg(*(F.sum(x).alias(x) for x in ("blank", "duplicate", "truncated")))
    report = turns.select(F.col(conv_col).alias("conv_id")).distinct()
    for part in (
        turns_of,
        counted,
        paths.where("at IS NULL").select("conv_id", "illegal", "cost", "audit"),
        digests_of(repaired),
    ):
        part = part.withColumnRenamed("conv_id", "own")
        report = report.join(part, F.col("conv_id").eqNullSafe(F.col("own")), "left").drop("own")
    zero = lambda name: F.coalesce(F.col(name), F.lit(0)).cast("long").alias(name)
    report = report.select(
        "conv_id",
        *map(zero, ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"),
    )
    return report, repaired


MATRIX = "array<struct<p: int, q: int, cost: long, audit: string>>"


def matrices_of(strings: DataFrame) -> DataFrame:
    """``symbols, matrix`` for distinct symbol strings; a task compresses many of them at once."""

    def some(batches: Iterator[pa.RecordBatch]) -> Iterator[list[str]]:
        held, size = [], 0
        for batch in batches:
            for s in batch.column(0).to_pylist():
                held.append(s)
                size += len(s) + 1
                if size >= TOGETHER:
                    yield held
                    held, size = [], 0
        if held:
            yield held

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entry = pa.struct([("p", pa.int32()), ("q", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])
        for held in some(batches):
            made = [
                [{"p": p, "q": q, "cost": cost, "audit": str(audit)} for (p, q), (cost, audit) in m.items()]
                for m in segment_matrices(held)
            ]
            for k in range(0, len(held), 256):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(held[k : k + 256], pa.string()), pa.array(made[k : k + 256], pa.list_(entry))],
                    ["symbols", "matrix"],
                )

    return arrow_map(strings, run, f"symbols string, matrix {MATRIX}")


WRITES = "array<struct<row: int, place: int, role: string, own: boolean>>"


def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, Iterator[tuple]]]:
    """The rows of one value of the first column after the other, as they come."""
    rows = (row for batch in batches for row in zip(*(x.to_pylist() for x in batch.columns), strict=True))
    return groupby(rows, key=lambda row: row[0])


def paths_of(segments: DataFrame) -> DataFrame:
    """For each conversation a row with ``illegal, cost, audit``, and one with ``at, writes`` for
    each of its segments."""
    kept = segments.select("conv_id", "segment", "at", "symbols", "opens", "closes", "illegal", "matrix")
    kept = kept.repartition("conv_id").sortWithinPartitions("conv_id", "segment")
    kind = kept.schema["conv_id"].dataType
    schema = f"conv_id {kind.simpleString()}, illegal long, cost long, audit string, at long, writes {WRITES}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        write = pa.struct(
            [("row", pa.int32()), ("place", pa.int32()), ("role", pa.string()), ("own", pa.bool_())]
        )
        kinds = [to_arrow_type(kind), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.list_(write)]
        names = ["conv_id", "illegal", "cost", "audit", "at", "writes"]
        held: list[tuple] = []

        def flush() -> pa.RecordBatch:
            columns = zip(*held, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(columns, kinds, strict=True)], names)

        for conv, own in runs(batches):
            illegal, last = 0, None
            places: list[tuple[int, str]] = []

            def entries() -> Iterator[list[tuple[int, int, int, str]]]:
                nonlocal illegal, last
                for _, _, at, symbols, opens, closes, n, matrix in own:
                    illegal += n + (last is not None and last + opens not in ("su", "ua", "au"))
                    last = closes
                    places.append((at, symbols))
                    yield [(x["p"], x["q"], x["cost"], x["audit"]) for x in matrix]

            cost, audit, steps = best_path(entries())
            held.append((conv, illegal, cost, audit, None, None))
            opening = steps[0][1]
            for (at, symbols), (state, edits) in zip(places, steps[1:], strict=True):
                held.append((conv, None, None, None, at, written(symbols, state, edits, opening)))
                opening = ""
                if len(held) >= 1000:
                    yield flush()
                    held.clear()
        if held:
            yield flush()

    return arrow_map(kept, run, schema)


def digests_of(repaired: DataFrame) -> DataFrame:
    """``conv_id, repaired_sha256``: of the rows as ``role:text``, joined by line feeds."""
    kept = repaired.select("conv_id", "at", "place", F.concat("role", F.lit(":"), "text").alias("line"))
    kept = kept.repartition("conv_id").sortWithinPartitions("conv_id", "at", "place")
    kind = kept.schema["conv_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        convs, digests = [], []
        for conv, own in runs(batches):
            made, between = hashlib.sha256(), b""
            for *_, line in own:
                made.update(between)
                made.update(line.encode())
                between = b"\n"
            convs.append(conv)
            digests.append(made.hexdigest())
        yield pa.RecordBatch.from_arrays(
            [pa.array(convs, to_arrow_type(kind)), pa.array(digests, pa.string())],
            ["conv_id", "repaired_sha256"],
        )

    return arrow_map(kept.select("conv_id", "line"), run, f"conv_id {kind.simpleString()}, repaired_sha256 string")

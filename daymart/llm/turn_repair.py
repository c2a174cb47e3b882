"""Conversation structure repair: the cheapest edits that make the roles of a conversation ``(s?(ua)+)?``.

Method. Four-Russians block tables. A row is one of nine symbols: its role's class (system, user, assistant, other) and
whether it is cut off, or that it must go (blank, or a repeat). Four states tell what has been written: nothing, a
system row, a user row, an assistant row. The cost of finishing from each state is a vector of four numbers; less its
smallest entry only ``len(tables().vectors)`` vectors exist, because inserting a row leads from any state to any other
at bounded cost. So the step over every block of ``BLOCK`` symbols is tabled beforehand for every vector: the vector on
its left, the cost, and the state in which the tie-safe trace leaves it. A conversation is then read block by block
from its end; blocks are expanded backward, symbol by symbol, only to write their edits, in which the letter least in
ASCII is taken of those that keep the cost least.

Spark. Damaged rows are counted (equal rows are one row with a count), range-sorted by conversation and turn and cut
into chunks of at most ``CHUNK`` rows or ``CHUNK_BYTES`` of text, so one conversation, or all rows without an id, can
lie in many partitions. A chunk's summary is the table's step over the whole chunk, for every vector on its right and
every state on its left: a few hundred bytes. Only summaries are gathered by conversation, as a sorted stream from the
last chunk to the first; each chunk gets its own vector and state back and writes its edits alone. First occurrences of
a text are an aggregate and an equi join. Every step is a table in the shared folder. The digest of a whole conversation
(the query's ``audit`` and hash) is sequential by nature: its rows pass one task as a stream.

Defined results. A null role or text is one space, and so is a null id or turn in the damage rule; rows with a null id
are one conversation, null turns come first. Rows of one turn are taken by role, then text; equal rows are repeats of the
first. A conversation that loses all rows has zeros and an empty repair. Extra columns, whatever their names, are not
read; texts of any length are kept whole. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache
from itertools import product
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymart.llm.common import batches, materialize

BLOCK = 4
CHUNK, CHUNK_BYTES = 1024, 4 << 20
COPIES = 1024
BLANKS = " \t\n\x0b\x0c\r"
DELETE, INSERT, REROLE, CUT = 2, 5, 1, 5  # costs
SYMBOLS, GONE = 9, 8  # 2 * class + cut off, or a row that must go
KEEP = ({0: 1, 1: 2}, {1: 2}, {2: 3}, {1: 2})  # state -> class -> state
ADD = (2, 2, 3, 2)  # state after the only row that can be inserted, or to which a row can be changed
ROLES = {"s": 0, "u": 1, "a": 2}  # initial -> class; other initials are class 3
ROLE = {2: "user", 3: "assistant"}
END = (0, 10, 5, 0)
KEYS = ["conv_id", "turn", "role", "text"]

ROW = pa.schema([("conv_id", pa.int64()), ("part", pa.int32()), ("chunk", pa.int32()), ("symbols", pa.binary()),
                 ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string())), ("left", pa.binary()),
                 ("cost", pa.binary()), ("exits", pa.binary()), ("stats", pa.list_(pa.int64())),
                 ("turns", pa.list_(pa.int64())), ("ends", pa.list_(pa.string()))])
ROW_DDL = ("conv_id long, part int, chunk int, symbols binary, roles array<string>, texts array<string>, left binary, "
           "cost binary, exits binary, stats array<long>, turns array<long>, ends array<string>")
SOLVED = pa.schema([("conv_id", pa.int64()), ("part", pa.int32()), ("chunk", pa.int32()), ("vector", pa.int32()),
                    ("state", pa.int32()), ("last", pa.bool_()), ("total", pa.list_(pa.int64()))])
SOLVED_DDL = "conv_id long, part int, chunk int, vector int, state int, last boolean, total array<long>"
EDIT = pa.schema([("conv_id", pa.int64()), ("part", pa.int32()), ("chunk", pa.int32()), ("place", pa.int32()),
                  ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())])
EDIT_DDL = "conv_id long, part int, chunk int, place int, edit string, role string, text string"
DIGEST = pa.schema([("conv_id", pa.int64()), ("audit", pa.string()), ("repaired_sha256", pa.string())])


# ------------------------------------------------------------------- tables --
def _options(after: tuple, symbol: int, state: int):
    """(letter, cost, state) of what can be done with a row, given the costs of finishing behind it."""
    yield "D", DELETE + after[state], state
    if symbol != GONE:
        cut = CUT * (symbol & 1)
        to = KEEP[state].get(symbol >> 1)
        if to is not None:
            yield "K", cut + after[to], to
        yield "R", REROLE + cut + after[ADD[state]], ADD[state]


def _before(after: tuple, symbol: int) -> tuple:
    """Costs of finishing before a row, inserted rows ahead of it included."""
    here = [min(cost for _, cost, _ in _options(after, symbol, q)) for q in range(4)]
    return tuple(min(here[q], INSERT + here[ADD[q]], 2 * INSERT + here[ADD[ADD[q]]]) for q in range(4))


def _walk(after: tuple, symbol: int, state: int):
    """(letters, state) over one row: each letter the least in ASCII that keeps the cost least."""
    before, letters = _before(after, symbol), ""
    while True:
        fits = [(letter, to) for letter, cost, to in _options(after, symbol, state) if cost == before[state]]
        if INSERT + before[ADD[state]] == before[state]:
            fits.append(("I", ADD[state]))
        letter, state = min(fits)
        letters += letter
        if letter != "I":
            return letters, state


@lru_cache(1)
def tables() -> SimpleNamespace:
    """All vectors that occur, and for each vector on the right of a symbol, or of a block of symbols (numbered to
    base 9, leftmost first): the vector on the left, the cost, and the state that the trace reaches from each state."""
    vectors, at = [END], {END: 0}
    left, cost = [], []
    for vector in vectors:  # grows while it is read
        steps = [_before(vector, s) for s in range(SYMBOLS)]
        cost.append([min(v) for v in steps])
        left.append([])
        for v in steps:
            v = tuple(x - min(v) for x in v)
            if v not in at:
                at[v] = len(vectors)
                vectors.append(v)
            left[-1].append(at[v])
    left, cost = np.array(left, np.uint8), np.array(cost, np.int64)
    letters = {(v, s, q): _walk(vectors[v], s, q) for v, s, q in product(range(len(vectors)), range(SYMBOLS), range(4))}
    exits = np.array([[[letters[v, s, q][1] for q in range(4)] for s in range(SYMBOLS)] for v in range(len(vectors))], np.uint8)
    b_left, b_cost, b_exits = left, cost, exits
    for _ in range(BLOCK - 1):  # a symbol more on the left
        n = len(vectors)
        first = exits[b_left[:, None, :], np.arange(SYMBOLS)[None, :, None]]  # vector, symbol, block -> 4 states
        b_exits = np.take_along_axis(np.broadcast_to(b_exits[:, None], first.shape), first.astype(np.int64), 3).reshape(n, -1, 4)
        b_cost = (b_cost[:, None, :] + cost[b_left[:, None, :], np.arange(SYMBOLS)[None, :, None]]).reshape(n, -1)
        b_left = left[b_left[:, None, :], np.arange(SYMBOLS)[None, :, None]].reshape(n, -1)
    return SimpleNamespace(vectors=vectors, left=left, cost=cost, exits=exits, letters=letters,
                           block_left=b_left, block_cost=b_cost, block_exits=b_exits)


def _blocks(symbols: np.ndarray):
    """The symbols ahead of the first whole block, and the numbers of the blocks."""
    head = len(symbols) % BLOCK
    return symbols[:head], symbols[head:].reshape(-1, BLOCK) @ SYMBOLS ** np.arange(BLOCK - 1, -1, -1)


def summary(symbols: np.ndarray):
    """Of a chunk, for every vector on its right: the vector on its left, the cost, and the state reached from each."""
    t = tables()
    head, blocks = _blocks(symbols)
    at, cost, trail = np.arange(len(t.vectors)), np.zeros(len(t.vectors), np.int64), []
    for codes, left, costs, exits in ((blocks, t.block_left, t.block_cost, t.block_exits), (head, t.left, t.cost, t.exits)):
        for code in codes[::-1]:
            trail.append((exits, at, code))
            cost += costs[at, code]
            at = left[at, code]
    states = np.broadcast_to(np.arange(4), (len(t.vectors), 4))
    for exits, right, code in reversed(trail):
        states = exits[right[:, None], code, states]
    return at.astype(np.uint8), cost, states.astype(np.uint8)


def trace(symbols: np.ndarray, vector: int, state: int, last: bool):
    """(letters for each symbol, those behind the last one): blocks are expanded backward, then read forward."""
    t = tables()
    head, blocks = _blocks(symbols)
    right = []  # the vector behind each block
    for code in blocks[::-1]:
        right.append(vector)
        vector = int(t.block_left[vector, code])
    spans = [(head, vector), *zip(symbols[len(head):].reshape(-1, BLOCK), reversed(right))]
    out = []
    for span, behind in spans:
        own = []
        for s in span[::-1]:
            own.append(behind)
            behind = int(t.left[behind, s])
        for s, v in zip(span, reversed(own)):
            letters, after = t.letters[v, int(s), state]
            out.append((letters, state))
            state = after
    return out, ("" if not last else {0: "", 1: "II", 2: "I", 3: ""}[state], state)


# --------------------------------------------------------------------- rows --
def damage(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copies): the rows that the damage rule leaves."""
    c = conversations
    rows = c.select(c["conv_id"].cast("long").alias("conv_id"), c["turn"].cast("long").alias("turn"),
                    F.coalesce(c["role"].cast("string"), F.lit(" ")).alias("role"),
                    F.coalesce(c["text"].cast("string"), F.lit(" ")).alias("text"))
    conv_id, turn = (F.coalesce(F.col(x).cast("string"), F.lit(" ")) for x in ("conv_id", "turn"))
    return rows.withColumn("rule", F.crc32(F.concat(conv_id, F.lit(":"), turn)) % 20).where("rule <> 0").select(
        "conv_id", "turn", F.when(F.col("rule") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("rule") == 1, "").when(F.col("rule") == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text")).alias("text"), F.when(F.col("rule") == 3, 2).otherwise(1).alias("copies"))


def counted(rows: DataFrame) -> DataFrame:
    """Equal rows as one row with ``copies`` (blocks of at most ``COPIES``); ``first`` where the first of them is the
    conversation's first row with its role and text."""
    once = rows.groupBy(*KEYS).agg(F.sum("copies").alias("copies")) \
        .withColumn("said", F.sha2(F.concat_ws("\n", "role", "text"), 256))
    once = materialize(once, "repair-rows")
    opening = once.groupBy("conv_id", "said").agg(F.min(F.struct("turn")).alias("opening")) \
        .withColumnsRenamed({"conv_id": "own", "said": "own_said"})
    joined = once.join(opening, once["conv_id"].eqNullSafe(opening["own"]) & (once["said"] == opening["own_said"]))
    return joined.select(*KEYS, "copies", F.col("turn").eqNullSafe(F.col("opening.turn")).alias("first"),
                         F.explode(F.sequence(F.lit(0), F.floor((F.col("copies") - 1) / COPIES))).alias("block")) \
        .select(*KEYS, "block", (F.col("first") & (F.col("block") == 0)).alias("first"),
                F.least(F.lit(COPIES), F.col("copies") - F.col("block") * COPIES).cast("int").alias("copies"))


def symbol_of(role: str, text: str, first: bool) -> tuple[int, int]:
    """(symbol, fault): fault 0 blank, 1 duplicate, 2 truncated, -1 none."""
    text = text.strip(BLANKS)
    if not text:
        return GONE, 0
    if not first:
        return GONE, 1
    cut = text[-1] not in ".!?"
    return 2 * ROLES.get(role[:1], 3) + cut, 2 if cut else -1


class _Chunk:
    def __init__(self, conv_id):
        self.conv_id, self.symbols, self.roles, self.texts, self.size = conv_id, bytearray(), [], [], 0
        self.stats, self.turns, self.ends = [0, 0, 0, 0], [None, None, 0], None  # faults, illegal; first, last, distinct

    def add(self, turn, role, text, first):
        symbol, fault = symbol_of(role, text, first)
        self.symbols.append(symbol)
        if fault >= 0:
            self.stats[fault] += 1
        if self.ends is None:
            self.ends = [role[:1], role[:1]]
        else:
            self.stats[3] += illegal(self.ends[1], role[:1])
            self.ends[1] = role[:1]
        if turn is not None and turn != self.turns[1]:
            self.turns = [turn if self.turns[0] is None else self.turns[0], turn, self.turns[2] + 1]
        kept = symbol != GONE
        self.roles.append(role if kept else None)
        self.texts.append(text if kept else None)
        self.size += len(text) if kept else 0

    def full(self) -> bool:
        return len(self.symbols) >= CHUNK or self.size >= CHUNK_BYTES

    def row(self, part: int, chunk: int) -> tuple:
        left, cost, exits = summary(np.frombuffer(bytes(self.symbols), np.uint8).astype(np.int64))
        return (self.conv_id, part, chunk, bytes(self.symbols), self.roles, self.texts, left.tobytes(),
                cost.astype("<i8").tobytes(), exits.tobytes(), self.stats, self.turns, self.ends)


def illegal(one: str, other: str) -> int:
    return one + other not in ("su", "ua", "au")


def _cut(sorted_rows):
    """Sorted rows -> chunks of one conversation each."""
    part, n, chunk = TaskContext.get().partitionId(), 0, None

    def rows():
        nonlocal n, chunk
        for batch in sorted_rows:
            for conv_id, turn, role, text, first, copies in zip(*(c.to_pylist() for c in batch.columns)):
                for k in range(copies):
                    if chunk is not None and (chunk.conv_id != conv_id or chunk.full()):
                        yield chunk.row(part, n)
                        n, chunk = n + 1, None
                    chunk = chunk or _Chunk(conv_id)
                    chunk.add(turn, role, text, first and k == 0)
        if chunk is not None:
            yield chunk.row(part, n)

    yield from batches(rows(), ROW, 64)


def _solve(sorted_chunks):
    """Summaries of chunks, last chunk of a conversation first -> vector and state of each chunk, totals at its first."""
    t = tables()
    own, held, vector, cost = None, [], 0, 0
    stats, turns, first_role = [0, 0, 0, 0], [None, None, 0], None

    def ended():
        state, out = 0, []
        for k, (part, chunk, right, exits) in enumerate(reversed(held)):
            total = None
            if k == 0:
                gaps = 0 if turns[0] is None else turns[1] - turns[0] + 1 - turns[2]
                total = [gaps, *stats, cost + t.vectors[vector][0]]
            out.append((own[0], part, chunk, right, state, k == len(held) - 1, total))
            state = exits[state]
        return out

    def rows():
        nonlocal own, held, vector, cost, stats, turns, first_role
        for batch in sorted_chunks:
            for conv_id, part, chunk, left, costs, exits, s, u, ends in zip(*(c.to_pylist() for c in batch.columns)):
                if own is None or own[0] != conv_id:
                    if own is not None:
                        yield from ended()
                    own, held, vector, cost = (conv_id,), [], 0, 0
                    stats, turns, first_role = [0, 0, 0, 0], [None, None, 0], None
                held.append((part, chunk, vector, exits[4 * vector:4 * vector + 4]))
                cost += int(np.frombuffer(costs, "<i8")[vector])
                vector = left[vector]
                stats = [a + b for a, b in zip(stats, s)]
                if first_role is not None:
                    stats[3] += illegal(ends[1], first_role)
                first_role = ends[0]
                if u[0] is not None:
                    turns = u if turns[0] is None else [u[0], turns[1], turns[2] + u[2] - (u[1] == turns[0])]
        if own is not None:
            yield from ended()

    yield from batches(rows(), SOLVED)


def _write(chunks):
    """Chunks with their vector and state -> edits in order."""
    def rows():
        for batch in chunks:
            for conv_id, part, chunk, symbols, roles, texts, vector, state, last in zip(*(c.to_pylist() for c in batch.columns)):
                place = 0
                steps, (tail, state) = trace(np.frombuffer(symbols, np.uint8).astype(np.int64), vector, state, last)
                for (letters, at), role, text in zip(steps, roles, texts):
                    for letter in letters:
                        if letter == "D":
                            new = (None, None)
                        elif letter == "K":
                            new, at = (role, text), KEEP[at][ROLES[role[:1]]]
                        else:
                            at = ADD[at]
                            new = ROLE[at], text if letter == "R" else ""
                        yield conv_id, part, chunk, place, letter, *new
                        place += 1
                for letter in tail:
                    state = ADD[state]
                    yield conv_id, part, chunk, place, letter, ROLE[state], ""
                    place += 1

    yield from batches(rows(), EDIT, 1024)


def repair(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of rows (conv_id, turn, role, text, copies): the edits (conv_id, part, chunk, place, edit, role, text), in order
    of (part, chunk, place) and with null role and text where a row is deleted; and (conv_id, gaps, blank, duplicate,
    truncated, illegal, cost), one row per conversation."""
    order = [*KEYS, "block"]
    ready = materialize(counted(rows), "repair-counted")
    chunks = materialize(ready.repartitionByRange(*order).sortWithinPartitions(*order).select(*KEYS, "first", "copies")
                         .mapInArrow(_cut, ROW_DDL), "repair-chunks")
    solved = materialize(chunks.select("conv_id", "part", "chunk", "left", "cost", "exits", "stats", "turns", "ends")
                         .repartition("conv_id").sortWithinPartitions("conv_id", F.desc("part"), F.desc("chunk"))
                         .mapInArrow(_solve, SOLVED_DDL), "repair-solved")
    edits = chunks.join(solved.drop("conv_id"), ["part", "chunk"]) \
        .select("conv_id", "part", "chunk", "symbols", "roles", "texts", "vector", "state", "last").mapInArrow(_write, EDIT_DDL)
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    totals = solved.where("total IS NOT NULL").select("conv_id", *[F.col("total")[k].alias(n) for k, n in enumerate(names)])
    return edits, totals


def _digest(sorted_edits):
    """Edits in order -> audit and hash of each conversation, as a stream."""
    own, letters, sha, any_row = None, [], None, False

    def rows():
        nonlocal own, letters, sha, any_row
        for batch in sorted_edits:
            for conv_id, letter, role, text in zip(*(c.to_pylist() for c in batch.columns)):
                if own is None or own[0] != conv_id:
                    if own is not None:
                        yield own[0], "".join(letters), sha.hexdigest()
                    own, letters, sha, any_row = (conv_id,), [], hashlib.sha256(), False
                letters.append(letter)
                if letter != "D":
                    sha.update(f"{chr(10) if any_row else ''}{role}:{text}".encode("utf-8", "surrogatepass"))
                    any_row = True
        if own is not None:
            yield own[0], "".join(letters), sha.hexdigest()

    yield from batches(rows(), DIGEST, 1024)


def report(conversations: DataFrame) -> DataFrame:
    """One row per conversation of the undamaged table: its faults, the cost, the edits' letters and the hash of the
    repaired rows."""
    edits, totals = repair(damage(conversations))
    place = ["conv_id", "part", "chunk", "place"]
    digests = edits.select(*place, "edit", "role", "text").repartition("conv_id").sortWithinPartitions(*place) \
        .select("conv_id", "edit", "role", "text") \
        .mapInArrow(_digest, "conv_id long, audit string, repaired_sha256 string").withColumnRenamed("conv_id", "d_id")
    totals = totals.withColumnRenamed("conv_id", "t_id")
    ids = conversations.select(conversations["conv_id"].cast("long").alias("conv_id")).distinct()
    joined = ids.join(totals, ids["conv_id"].eqNullSafe(totals["t_id"]), "left") \
        .join(digests, ids["conv_id"].eqNullSafe(digests["d_id"]), "left")
    zero = [F.coalesce(n, F.lit(0)).cast("long").alias(n) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return joined.select("conv_id", *zero, F.coalesce("audit", F.lit("")).alias("audit"),
                         F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))

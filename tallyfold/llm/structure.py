"""Repair of conversation structure at least cost, and of all such repairs the least in letters.

A grammar over role initials says which turns may follow which. Every turn is kept, given another
role or deleted, and empty turns may be inserted; a cost is put on each. The states of the grammar
between any two turns are nodes, edits are arcs, and a backward pass gives each node its cost to the end.
Arcs that keep to that cost are the optimal ones, and the audit of a repair is the letters along its path.

The least audit is found by prefix doubling. Nodes are ranked by the first letter of their least audit,
then by its first two, four, eight letters: the rank over twice the length is the pair of a node's
rank and the best rank among the nodes its prefix leads to, and the doubled pointers are those nodes'
pointers. Final ranks tell arcs with one letter apart, which leaves one arc per node, and doubled
pointers along those arcs list the nodes of every path at once.

A conversation's turns are read by one task, last turn first, in blocks: of a block behind it, a block needs
the cost and rank of the few states at their border. Memory holds one block, and two bytes per edit of
the conversation at hand. Texts take no part; they come in again, in order, when edits are applied.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator, Mapping
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyfold.llm.common import SLICE_BYTES, columns, record_batch, stored, texts_of

DELETE, INSERT, KEEP, REROLE = range(4)  # in the order of their letters
LETTERS = np.frombuffer(b"DIKR", np.uint8)
NO_ROLE = 255
BLOCK = 4096
FAULTS = ("", "blank", "duplicate", "truncated")
SPACE = " \t\n\x0b\x0c\r"


@dataclass(frozen=True)
class Grammar:
    """steps: for each state the next one by role initial; state 0 is the start. accept: states in which a
    conversation may end. roles: those that can be given to a turn or inserted."""

    steps: tuple[Mapping[str, int], ...]
    accept: frozenset[int]
    roles: tuple[str, ...] = ("user", "assistant")


# (s?(ua)+)?
CHAT = Grammar(({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2}), frozenset({0, 3}))


@dataclass(frozen=True)
class Costs:
    """truncated: for a truncated turn that is not deleted."""

    rerole: int = 1
    delete: int = 2
    insert: int = 5
    truncated: int = 5


@dataclass
class Arcs:
    """The optimal arcs at the border before one turn, the same for many turns."""

    source: list[int] = field(default_factory=list)
    kind: list[int] = field(default_factory=list)
    role: list[int] = field(default_factory=list)
    turns: list[int] = field(default_factory=list)  # 0 for an insertion, else 1
    target: list[int] = field(default_factory=list)

    def add(self, source: int, kind: int, role: int, turns: int, target: int) -> None:
        for values, x in zip((self.source, self.kind, self.role, self.turns, self.target), (source, kind, role, turns, target)):
            values.append(x)


class Backward:
    """Costs to the end, border by border. Borders are told apart by cost differences between states
    only, of which there are few, so each combination is worked out once."""

    def __init__(self, grammar: Grammar, costs: Costs):
        self.grammar, self.costs = grammar, costs
        self.size = len(grammar.steps)
        # Moves by (state, role given): insertions and changes of role.
        self.moves = [
            [(r, step[role[:1]]) for r, role in enumerate(grammar.roles) if role[:1] in step]
            for step in grammar.steps
        ]
        end = [0 if q in grammar.accept else None for q in range(self.size)]
        self.tail: list[list[int]] = [[] for _ in end]  # roles inserted behind the last turn
        for _ in end:
            for q, moves in enumerate(self.moves):
                for r, to in moves:
                    if end[to] is not None and (end[q] is None or costs.insert + end[to] < end[q]):
                        end[q], self.tail[q] = costs.insert + end[to], [r, *self.tail[to]]
        if None in end:
            raise ValueError("some state of the grammar leads to no end")
        self.end = tuple(end)
        self.initials = {x for step in grammar.steps for x in step}
        self.known: dict[tuple, tuple[tuple[int, ...], int, int]] = {}
        self.arcs: list[Arcs] = []

    def step(self, initial: str, fault: int, after: tuple[int, ...]) -> tuple[tuple[int, ...], int, int]:
        """(costs before the turn less their minimum, that minimum, number of its arcs)."""
        key = (initial if initial in self.initials else "", fault, after)
        if key not in self.known:
            self.known[key] = self._step(*key)
        return self.known[key]

    def _step(self, initial: str, fault: int, after: tuple[int, ...]):
        costs, options = self.costs, []
        left = costs.truncated if FAULTS[fault] == "truncated" else 0
        for q, step in enumerate(self.grammar.steps):
            options.append([(costs.delete + after[q], DELETE, NO_ROLE, 1, q)])
            if FAULTS[fault] in ("blank", "duplicate"):
                continue
            if initial in step:
                options[q].append((left + after[step[initial]], KEEP, NO_ROLE, 1, step[initial]))
            options[q] += [(costs.rerole + left + after[to], REROLE, r, 1, to) for r, to in self.moves[q]]
        best = [min(o)[0] for o in options]
        for _ in best:
            for q, moves in enumerate(self.moves):
                best[q] = min([best[q], *(costs.insert + best[to] for _, to in moves)])
        arcs = Arcs()
        for q, moves in enumerate(self.moves):
            options[q] += [(costs.insert + best[to], INSERT, r, 0, to) for r, to in moves]
            for cost, *rest in options[q]:
                if cost == best[q]:
                    arcs.add(q, *rest)
        self.arcs.append(arcs)
        least = min(best)
        return tuple(b - least for b in best), least, len(self.arcs) - 1

    def tables(self) -> tuple[np.ndarray, ...]:
        """(first arc of each number, and the concatenated arcs)."""
        first = np.cumsum([0, *(len(a.source) for a in self.arcs)])
        return first, *(
            np.array([x for a in self.arcs for x in getattr(a, name)], np.int64)
            for name in ("source", "kind", "role", "turns", "target")
        )


def dense(*keys: np.ndarray) -> np.ndarray:
    """Ranks of rows by the given keys, equal rows alike."""
    whole = keys[0].astype(np.int64)
    for key in keys[1:]:
        whole = whole * (int(key.max(initial=0)) + 1) + key
    return np.unique(whole, return_inverse=True)[1]


def audit_ranks(source: np.ndarray, kind: np.ndarray, target: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Ranks of all nodes by their least audit. Arcs are sorted by source; `last` is the rank of nodes
    without arcs among themselves, and -1 elsewhere."""
    ends = np.flatnonzero(last >= 0)
    rank = np.zeros(len(last), np.int64)
    rank[ends] = 1 + REROLE + last[ends]
    first = np.flatnonzero(np.diff(source, prepend=-1))
    least = np.minimum.reduceat(kind, first) if len(first) else kind
    rank[source[first]] = least
    keep = kind == rank[source]
    # Where the prefix of the present length leads: ends lead to themselves.
    a, b = pairs(np.concatenate((source[keep], ends)), np.concatenate((target[keep], ends)))
    while True:
        done = bool((last[b] >= 0).all())
        first = np.flatnonzero(np.diff(a, prepend=-1))
        best = np.minimum.reduceat(rank[b], first)
        keep = rank[b] == np.repeat(best, np.diff(np.append(first, len(a))))
        longer = dense(rank, best)  # every node is the source of a pair
        if done:
            return longer
        # Pointers of the nodes that the best prefixes lead to.
        count = np.diff(np.append(first, len(a)))
        many = count[b[keep]]
        at = np.repeat(first[b[keep]] - np.cumsum(many) + many, many) + np.arange(many.sum())
        a, b = pairs(np.repeat(a[keep], many), b[at])
        rank = longer


def pairs(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs in order."""
    base = int(b.max(initial=0)) + 1
    both = np.unique(a.astype(np.int64) * base + b)
    return both // base, both % base


Piece = tuple[bytes, bytes, int]  # letters, roles given, state at the end


@dataclass
class Conversation:
    """pieces: by state at their start, last piece first; rank: of the states at the present border."""

    id: object
    after: tuple[int, ...]
    cost: int
    rank: np.ndarray
    pieces: list[dict[int, Piece]] = field(default_factory=list)


class Repairer:
    """Takes turns of conversations, last turn first, and gives (id, cost, letters, roles given)."""

    def __init__(self, grammar: Grammar = CHAT, costs: Costs = Costs(), block: int = BLOCK):
        self.back, self.block = Backward(grammar, costs), block
        self.parts: list[tuple[Conversation, int]] = []  # with their first row in the block
        self.rows: list[int] = []

    def add(self, conv: object, initial: str, fault: int) -> Iterator[tuple]:
        if not self.parts or self.parts[-1][0].id != conv:
            tail = np.array([len(t) for t in self.back.tail])  # "", "I", "II"
            self.parts.append((Conversation(conv, self.back.end, 0, dense(tail)), len(self.rows)))
        c = self.parts[-1][0]
        c.after, cost, arcs = self.back.step(initial, fault, c.after)
        c.cost += cost
        self.rows.append(arcs)
        if len(self.rows) >= self.block:
            yield from self.close()

    def close(self, end: bool = False) -> Iterator[tuple]:
        """Work out the block; all but the last conversation are complete, and at the end that one too."""
        if self.rows:
            self.solve()
        kept = self.parts if end else self.parts[:-1]
        for c, _ in kept:
            yield self.complete(c)
        self.parts = [] if end else [(c, 0) for c, _ in self.parts[-1:]]
        self.rows = []

    def complete(self, c: Conversation) -> tuple:
        state, letters, roles = 0, [], []
        for piece in reversed(c.pieces):
            a, b, state = piece[state]
            letters.append(a)
            roles.append(b)
        tail = self.back.tail[state]
        letters.append(b"I" * len(tail))
        roles.append(bytes(tail))
        return c.id, c.cost + c.after[0], b"".join(letters), b"".join(roles)

    def solve(self) -> None:
        """Adds a piece to each conversation of the block."""
        size, number = self.back.size, np.array(self.rows)
        start = np.array([first for _, first in self.parts])
        part = np.searchsorted(start, np.arange(len(number)), side="right") - 1
        border = np.arange(len(number)) + part + 1  # a part's first border lies behind its last turn
        nodes = size * (len(number) + len(start))
        first, source, kind, role, turns, target = self.back.tables()
        many = np.diff(first)[number]
        at = np.repeat(first[number] - np.cumsum(many) + many, many) + np.arange(many.sum())
        where = np.repeat(border, many)
        source, target = where * size + source[at], (where - turns[at]) * size + target[at]
        kind, role = kind[at], role[at]
        order = np.argsort(source, kind="stable")
        source, target, kind, role = source[order], target[order], kind[order], role[order]
        last = np.full(nodes, -1)
        for i, (c, begin) in enumerate(self.parts):
            last[(begin + i) * size : (begin + i + 1) * size] = c.rank
        rank = audit_ranks(source, kind, target, last)

        # One arc per node, by letter and then by the rank of what follows.
        order = np.lexsort((target, rank[target], kind, source))
        chosen = order[np.flatnonzero(np.diff(source[order], prepend=-1))]
        following = np.arange(nodes)
        following[source[chosen]] = target[chosen]
        letter, given = np.zeros(nodes, np.uint8), np.zeros(nodes, np.uint8)
        letter[source[chosen]], given[source[chosen]] = LETTERS[kind[chosen]], role[chosen]
        jumps, steps = [following], (last < 0).astype(np.int64)
        while (last[jumps[-1]] < 0).any():
            steps = steps + steps[jumps[-1]]
            jumps.append(jumps[-1][jumps[-1]])

        stop = np.append(start[1:], len(number))
        wanted = [
            (i, q, (stop[i] + i) * size + q)
            for i in range(len(start)) if stop[i] > start[i]
            for q in range(size if i == len(start) - 1 else 1)
        ]
        found: list[dict[int, Piece]] = [{} for _ in start]
        source = np.array([node for _, _, node in wanted])
        level = np.ceil(np.log2(np.maximum(steps[source], 1))).astype(int)
        for k in np.unique(level):
            some = np.flatnonzero(level == k)
            path = source[some, None]
            for jump in jumps[:k]:
                path = np.concatenate((path, jump[path]), axis=1)
            for line, w in zip(path, some):
                i, q, node = wanted[w]
                line = line[: steps[node]]
                found[i][q] = letter[line].tobytes(), given[line].tobytes(), int(jumps[-1][node] % size)
        for i, (c, _) in enumerate(self.parts):
            if found[i]:
                c.pieces.append(found[i])
                begin = (stop[i] + i) * size
                c.rank = dense(rank[begin : begin + size])


def in_streams(df: DataFrame, *order: Column) -> DataFrame:
    """Each conversation in one task, its rows in order."""
    return df.repartition("conv_id").sortWithinPartitions("conv_id", *order)


def examined(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text with position (from 1), initial, fault (its number), illegal and new_turn.

    Order: turn (nulls first), then role and text. A turn's first fault counts: blank, duplicate (role and
    text stood earlier), truncated (the last character other than white space is none of . ! ?).
    illegal: the initials of this turn and the one before are not su, ua or au.
    """
    rows = turns.select("conv_id", "turn", "role", "text")
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    within = Window.partitionBy("conv_id").orderBy(*order)
    same = Window.partitionBy("conv_id", "role", "text").orderBy("position")
    text = F.rtrim("text", F.lit(SPACE))
    initial = F.substring("role", 1, 1)
    rows = rows.withColumns({
        "position": F.row_number().over(within).cast("bigint"), "initial": initial,
        "_pair": F.concat(F.lag(initial).over(within), initial),
        "_before": F.lag("turn").over(within),
    })
    again = F.row_number().over(same) > 1
    fault = (
        F.when(text == "", F.lit(1)).when(again, F.lit(2))
        .when(~F.substring(text, -1, 1).isin(".", "!", "?"), F.lit(3)).otherwise(F.lit(0))
    )
    return rows.select(
        "conv_id", "turn", "role", "text", "position", "initial", fault.alias("fault"),
        F.coalesce(~F.col("_pair").isin("su", "ua", "au"), F.lit(False)).alias("illegal"),
        (F.col("turn").isNotNull() & ~F.col("turn").eqNullSafe(F.col("_before"))).alias("new_turn"),
    )


def edits(found: DataFrame, grammar: Grammar = CHAT, costs: Costs = Costs(), block: int = BLOCK) -> DataFrame:
    """One row per conversation of `examined` turns: conv_id, cost, audit (the edits' initials in order)
    and given (for each edit the number of the role it gives, as a byte)."""
    kind = found.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work, schema = Repairer(grammar, costs, block), None
        for batch in batches:
            ids, initials, faults = columns(batch, "conv_id", "initial", "fault")
            schema = pa.schema([
                ("conv_id", ids.type), ("cost", pa.int64()), ("audit", pa.string()), ("given", pa.binary()),
            ])
            done: list[tuple] = []
            for i, initial, fault in zip(ids.to_pylist(), texts_of(initials), faults.to_pylist()):
                done += work.add(i, initial.decode(errors="replace"), fault)
            if done:
                yield to_batch(schema, done)
        if schema is not None:
            yield to_batch(schema, list(work.close(end=True)))

    def to_batch(schema: pa.Schema, done: list[tuple]) -> pa.RecordBatch:
        rows = [(i, cost, letters.decode(), roles) for i, cost, letters, roles in done]
        return record_batch(schema, *(zip(*rows) if rows else [[]] * 4))

    narrow = found.select("conv_id", "position", "initial", "fault")
    return in_streams(narrow, F.desc("position")).mapInArrow(
        run, f"conv_id {kind}, cost long, audit string, given binary"
    )


def _applied(rows: Iterable[tuple], grammar: Grammar) -> Iterator[tuple]:
    """(conv_id, role, text, edit) of what is left and inserted, in bytes. Rows are (conv_id, role, text,
    audit, given); a conversation's first row has its audit, the others are its turns."""
    roles = [r.encode() for r in grammar.roles]
    conv, audit, given, k = None, "", b"", 0
    for i, role, text, letters, numbers in rows:
        if letters is not None:
            yield from ((conv, roles[r], b"", b"I") for r in given[k:])  # behind the last turn
            conv, audit, given, k = i, letters, numbers, 0
            continue
        while audit[k] == "I":
            yield conv, roles[given[k]], b"", b"I"
            k += 1
        if audit[k] != "D":
            yield conv, roles[given[k]] if audit[k] == "R" else role, text, audit[k].encode()
        k += 1
    yield from ((conv, roles[r], b"", b"I") for r in given[k:])


def _in_order(found: DataFrame, repair: DataFrame) -> DataFrame:
    heads = repair.select("conv_id", F.lit(0).cast("bigint").alias("position"), "audit", "given")
    turns = found.select("conv_id", "position", "role", "text")
    return in_streams(turns.unionByName(heads, allowMissingColumns=True), F.col("position"))


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        ids, role, text, audit, given = columns(batch, "conv_id", "role", "text", "audit", "given")
        yield from zip(
            ids.to_pylist(), texts_of(role), texts_of(text), audit.to_pylist(), given.to_pylist()
        )


def _batches(rows: Iterable[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Strings come as bytes, which need not be valid UTF-8."""
    def made(part: list[tuple]) -> pa.RecordBatch:
        arrays = [
            pa.array(values, pa.binary()).view(pa.string()) if f.type == pa.string() and f.name != "conv_id"
            else pa.array(values, f.type) for values, f in zip(zip(*part), schema)
        ]
        return pa.RecordBatch.from_arrays(arrays, schema=schema)

    part, size = [], 0
    for row in rows:
        part.append(row)
        size += 100 + sum(len(x) for x in row if isinstance(x, bytes))
        if size > SLICE_BYTES:
            yield made(part)
            part, size = [], 0
    if part:
        yield made(part)


def _id_type(df: DataFrame) -> tuple[str, pa.DataType]:
    from pyspark.sql.pandas.types import to_arrow_type

    kind = df.schema["conv_id"].dataType
    return kind.simpleString(), to_arrow_type(kind)


def repaired(found: DataFrame, repair: DataFrame, grammar: Grammar = CHAT) -> DataFrame:
    """The repaired conversations: conv_id, position (from 0), role, text, edit (K, R or I)."""
    name, kind = _id_type(found)
    schema = pa.schema([
        ("conv_id", kind), ("position", pa.int64()), ("role", pa.string()), ("text", pa.string()),
        ("edit", pa.string()),
    ])

    def numbered(rows: Iterable[tuple]) -> Iterator[tuple]:
        conv, position = object(), 0
        for i, role, text, edit in rows:
            position = position + 1 if i == conv else 0
            conv = i
            yield i, position, role, text, edit

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches(numbered(_applied(_rows(batches), grammar)), schema)

    return _in_order(found, repair).mapInArrow(
        run, f"conv_id {name}, position long, role string, text string, edit string"
    )


def repaired_digests(found: DataFrame, repair: DataFrame, grammar: Grammar = CHAT) -> DataFrame:
    """conv_id, repaired_sha256 over `role:text` lines, of conversations with a turn left. The repaired
    turns are those of `repaired`, digested as they come."""
    name, kind = _id_type(found)
    schema = pa.schema([("conv_id", kind), ("repaired_sha256", pa.string())])

    def digested(rows: Iterable[tuple]) -> Iterator[tuple]:
        conv, digest = None, None
        for i, role, text, _ in rows:
            if digest is None or i != conv:
                if digest is not None:
                    yield conv, digest.hexdigest().encode()
                conv, digest = i, hashlib.sha256()
            else:
                digest.update(b"\n")
            digest.update(role + b":" + text)
        if digest is not None:
            yield conv, digest.hexdigest().encode()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches(digested(_applied(_rows(batches), grammar)), schema)

    return _in_order(found, repair).mapInArrow(run, f"conv_id {name}, repaired_sha256 string")


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text with seeded faults: by crc32 of `conv_id:turn` modulo 20, a row goes (0),
    loses its text (1) or its sentence ends (2), comes twice (3) or from the user (4). Null counts as one
    space, in that key as in role and text."""
    blank = F.lit(" ")
    key = F.concat(
        F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"),
        F.coalesce(F.col("turn").cast("string"), blank),
    )
    draw = F.col("_draw")
    role, text = F.coalesce("role", blank), F.coalesce("text", blank)
    rows = conversations.select("conv_id", "turn", "role", "text", (F.crc32(key) % 20).alias("_draw"))
    return rows.where(draw != 0).select(
        "conv_id", "turn", F.when(draw == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(draw == 1, F.lit("")).when(draw == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.explode(F.sequence(F.lit(1), F.when(draw == 3, F.lit(2)).otherwise(F.lit(1)))).alias("_copy"),
    ).drop("_copy")


def repair(
    turns: DataFrame, every: DataFrame | None = None, grammar: Grammar = CHAT, costs: Costs = Costs(),
    block: int = BLOCK,
) -> DataFrame:
    """One row per conversation: conv_id, gaps, blank, duplicate, truncated, illegal (counts before the
    repair), cost, audit, repaired_sha256.

    `every` names conversations (conv_id) that get a row even if `turns` has none of them: zeros, an
    empty audit and the digest of an empty string, as have conversations of which no turn is left. Null role or
    text counts as one space, an empty role has no initial. Rows without conv_id form one
    conversation. Turns that are equal or null go by role and text; repeated rows are turns like others,
    duplicates of the first. gaps counts missing numbers between the least and largest turn, 0 without
    any. Other columns are ignored; an empty table gives an empty result. One task reads a conversation's
    turns, as its digest is sequential, but never holds its texts.
    """
    rows = turns.withColumns({c: F.coalesce(c, F.lit(" ")) for c in ("role", "text")})
    found = stored(examined(rows), "examined")
    done = stored(edits(found, grammar, costs, block), "edits")
    counts = found.groupBy("conv_id").agg(
        (F.max("turn") - F.min("turn") + 1 - F.count_if("new_turn")).cast("bigint").alias("gaps"),
        *[F.count_if(F.col("fault") == k).alias(name) for k, name in enumerate(FAULTS) if name],
        F.count_if("illegal").alias("illegal"),
    )
    named = (turns if every is None else every).select("conv_id").distinct()
    parts = named
    for part in (counts, done.select("conv_id", "cost", "audit"), repaired_digests(found, done, grammar)):
        parts = parts.unionByName(part, allowMissingColumns=True)
    zero, empty = F.lit(0).cast("bigint"), F.lit(hashlib.sha256().hexdigest())
    numbers = ("gaps", *FAULTS[1:], "illegal", "cost")
    return parts.groupBy("conv_id").agg(
        *[F.coalesce(F.max(c), zero).alias(c) for c in numbers],
        F.coalesce(F.max("audit"), F.lit("")).alias("audit"),
        F.coalesce(F.max("repaired_sha256"), empty).alias("repaired_sha256"),
    )

"""Mixing of overlapping sources to target weights.

A document may belong to several sources. Documents are first counted by membership pattern, the set
of their sources, so the flow that follows has as many supplies as there are patterns, however many
documents there are. Each pattern offers its words once per repetition, and every further
repetition costs more (convex costs); each source takes words up to its target from the patterns it is
part of. A minimum-cost flow routes as many words as the targets allow and repeats as little as it
can. What a pattern has to give is then drawn: every document as often as the flow goes round whole, and
for the rest documents in a seeded order, found by radix selection, until the words are reached.

The driver sees one row per pattern: that number depends on the memberships, not on the documents.
Texts are read once, to count words; all later steps read a stored table of ids and sizes.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.llm.common import stored
from tallyfold.operators.selection import radix_edge

WEIGHTS = (5, 2, 1)
MOST_REPEATS = 3
# Cost of reading a word for the first, second and third time.
COSTS = (0, 1, 3)
SEED = 42
# Rounds that fill what whole documents leave open, and the share of the words wanted at which they stop.
ROUNDS = 4
TOLERANCE = 0.0005


def word_count(text: str | Column) -> Column:
    """Runs of characters other than ASCII white space; null text has none."""
    found = F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+"))
    return F.coalesce(found, F.lit(0)).cast("bigint")


def in_order(sources) -> list[str | None]:
    """By code point, null last."""
    return sorted(sources, key=lambda s: (s is None, s or ""))


def repeating(sources: Sequence[str | None], weights: Sequence[float] = WEIGHTS) -> dict[str | None, float]:
    return {s: weights[i % len(weights)] for i, s in enumerate(in_order(sources))}


def targets(
    sizes: Mapping[str | None, int], weights: Mapping[str | None, float], total: int,
    most: float = MOST_REPEATS,
) -> dict[str | None, float]:
    """`total` shared by weight; a share stops at `most` times its source's size, and what is above goes
    to the others by weight, until none is above. Sources of weight 0 get nothing."""
    out = dict.fromkeys(sizes, 0.0)
    open_ = [s for s in sizes if weights[s] > 0]
    left = float(total)
    while open_:
        unit = left / sum(weights[s] for s in open_)
        above = [s for s in open_ if unit * weights[s] > most * sizes[s]]
        for s in above or open_:
            out[s] = float(most * sizes[s]) if above else unit * weights[s]
        left -= sum(out[s] for s in above)
        open_ = [s for s in open_ if s not in above] if above else []
    return out


@dataclass
class Network:
    """Arcs with whole capacities; arc i ^ 1 is the reverse of arc i."""

    size: int
    to: list[int] = field(default_factory=list)
    room: list[int] = field(default_factory=list)
    arcs: list[list[int]] = field(init=False)

    def __post_init__(self):
        self.arcs = [[] for _ in range(self.size)]

    def add(self, a: int, b: int, room: int) -> int:
        for end, way, r in ((a, b, room), (b, a, 0)):
            self.arcs[end].append(len(self.to))
            self.to.append(way)
            self.room.append(r)
        return len(self.to) - 2

    def levels(self, start: int) -> list[int]:
        level = [-1] * self.size
        level[start] = 0
        queue = deque([start])
        while queue:
            v = queue.popleft()
            for arc in self.arcs[v]:
                w = self.to[arc]
                if self.room[arc] and level[w] < 0:
                    level[w] = level[v] + 1
                    queue.append(w)
        return level

    def fill(self, start: int, end: int) -> None:
        """Add flow along shortest paths until there is no path (Dinic)."""
        while (level := self.levels(start))[end] >= 0:
            tried = [0] * self.size
            path: list[int] = []
            v = start
            while True:
                if v == end:
                    least = min(self.room[arc] for arc in path)
                    for arc in path:
                        self.room[arc] -= least
                        self.room[arc ^ 1] += least
                    path, v = [], start
                    continue
                while tried[v] < len(self.arcs[v]):
                    arc = self.arcs[v][tried[v]]
                    if self.room[arc] and level[self.to[arc]] == level[v] + 1:
                        path.append(arc)
                        v = self.to[arc]
                        break
                    tried[v] += 1
                else:
                    if not path:
                        break
                    v = self.to[path.pop() ^ 1]
                    tried[v] += 1


Pattern = tuple[str | None, ...]


def route(
    supplies: Mapping[Pattern, int], quotas: Mapping[str | None, int],
    costs: Sequence[float] = COSTS,
) -> dict[tuple[Pattern, str | None], int]:
    """Words from each pattern to each of its sources: as many as possible, at least cost.

    A pattern's words can be read once per entry of `costs`, which must not decrease. Costs lie on the
    arcs into the patterns only, and no augmenting path leaves such an arc backwards, so the paths
    of successive shortest-path search go through the repetitions one after the other: each is opened
    in turn, and the flow is filled up before the next one.
    """
    if any(b < a for a, b in zip(costs, costs[1:])):
        raise ValueError("costs of repetitions must not decrease")
    patterns, sources = list(supplies), list(quotas)
    place = {s: 1 + len(patterns) + i for i, s in enumerate(sources)}
    end = 1 + len(patterns) + len(sources)
    net = Network(end + 1)
    most = sum(quotas.values())
    routes = {
        (p, s): net.add(1 + i, place[s], most) for i, p in enumerate(patterns) for s in p if s in place
    }
    for s in sources:
        net.add(place[s], end, quotas[s])
    for _ in costs:
        for i, p in enumerate(patterns):
            net.add(0, 1 + i, supplies[p])
        net.fill(0, end)
    return {key: net.room[arc ^ 1] for key, arc in routes.items()}


def _chosen(frame: pd.DataFrame) -> pd.DataFrame:
    """Of the rows at the edge, in order, those that still fit."""
    room, fits = int(frame["room"].iloc[0]), []
    frame = frame.sort_values("key")
    for size in frame["size"]:
        fits.append(size <= room)
        room -= size * fits[-1]
    return frame.loc[fits, ["pattern", "key"]]


def drawn(sized: DataFrame, rounds: Mapping[str, tuple[int, int]], most: int) -> DataFrame:
    """`sized` (pattern, key, size and others) with `times`: how often each document is read.

    `rounds` gives for each pattern how often all of it is read, and how many words are wanted beyond
    that. Whatever comes first in the order of keys is read once more while it fits. What is open after
    that is filled by documents small enough, in the same order, which may then be read once more than
    others, but `most` times at most. The words stay hardly below what is wanted, never above. Rows
    with one key are drawn together or not at all.
    """
    spark = sized.sparkSession

    def known(values: Mapping[str, int], schema: str) -> DataFrame:
        """Written, so that Spark knows its size and chooses between broadcast and shuffle by it."""
        return stored(spark.createDataFrame(list(values.items()), schema), "patterns")

    whole = known({p: k for p, (k, _) in rounds.items()}, "_w string, times long")
    out = sized.join(whole, F.col("pattern") == F.col("_w")).drop("_w")
    wanted = {p: rest for p, (_, rest) in rounds.items() if rest > 0}
    rooms, missing = dict(wanted), dict(wanted)
    for _ in range(ROUNDS):
        if not rooms:
            break
        limits = known(rooms, "pattern string, room long")
        bound = limits.select(F.col("pattern").alias("_r"), F.col("room").alias("_most"))
        fits = (F.col("size") > 0) & (F.col("size") <= F.col("_most")) & (F.col("times") < most)
        open_ = out.join(bound, F.col("pattern") == F.col("_r")).where(fits).select("pattern", "key", "size")
        edge = radix_edge(open_, "pattern", "key", limits, 63, F.col("size"))
        # One row per key: as many as ENOUGH of them for a pattern at most.
        units = open_.join(edge.plan, "pattern").where(edge.at(F.col("key"))).groupBy(
            "pattern", "key", "room"
        ).agg(F.sum("size").alias("size"))
        few = stored(units.groupBy("pattern").applyInPandas(_chosen, "pattern string, key long"), "edge-picks")
        picks = few.select(F.col("pattern").alias("_p"), F.col("key").alias("_k"), F.lit(True).alias("_hit"))
        plan = edge.plan.select(F.col("pattern").alias("_q"), "edge")
        placed = (
            out.join(plan, F.col("pattern") == F.col("_q"), "left")
            .join(bound, F.col("pattern") == F.col("_r"), "left")
            .join(picks, (F.col("pattern") == F.col("_p")) & (F.col("key") == F.col("_k")), "left")
        )
        more = F.coalesce(fits & (edge.below(F.col("key")) | F.col("_hit")), F.lit(False))
        placed = placed.withColumn("_more", more.cast("bigint"))
        after = stored(
            placed.select(*sized.columns, (F.col("times") + F.col("_more")).alias("times"), "_more"), "drawn"
        )
        got = after.where("_more > 0").groupBy("pattern").agg(F.sum("size").alias("n"))
        for r in got.collect():  # one row per pattern at most
            missing[r["pattern"]] -= r["n"]
        out = after.drop("_more")
        rooms = {
            p: missing[p] for p in rooms
            if missing[p] > max(1, TOLERANCE * wanted[p]) and missing[p] < rooms[p]
        }
    return out


@dataclass(frozen=True)
class Mix:
    """documents: doc_id, size, members (array of sources), taken (words, repeats counted); sources:
    source, source_size, weight, target, routed (words that the flow gives it); routes: words by
    (pattern, source)."""

    documents: DataFrame
    sources: DataFrame
    routes: dict[tuple[Pattern, str | None], int]


def mix(
    docs: DataFrame, members: Column,
    weigh: Callable[[Sequence[str | None]], Mapping[str | None, float]] = repeating,
    costs: Sequence[float] = COSTS, share: float = 1.0, seed: int = SEED,
) -> Mix:
    """Mix `docs` so that each source's words come near its target.

    `members` gives the sources of a document as an array of strings; null in it is a source like any other,
    repeated entries count once, and a document of no source (null or empty array) is not taken.
    `weigh` gives the weights of the sources found; their targets share `share` times all words. A
    document is read as often as `costs` has entries at most. Null and empty texts have size 0 and are never
    taken. The seeded order is a hash of doc_id: rows that repeat a doc_id are drawn together, null ids
    among them. Other columns are ignored; an empty table gives an empty mix.
    """
    spark = docs.sparkSession
    none = F.array().cast("array<string>")
    sets = F.coalesce(F.array_sort(F.array_distinct(members.cast("array<string>"))), none)
    rows = docs.select(
        "doc_id", word_count("text").alias("size"), sets.alias("members"),
        F.shiftrightunsigned(F.xxhash64(F.lit(seed), "doc_id"), 1).alias("key"),
    )
    sized = stored(rows.withColumn("pattern", F.to_json("members")), "sized")
    counted = sized.groupBy("pattern", "members").agg(F.sum("size").alias("size")).orderBy("pattern")
    found = [(r["pattern"], tuple(in_order(r["members"])), r["size"]) for r in counted.collect()]
    supplies = {p: n for _, p, n in found}
    sizes = {s: sum(n for p, n in supplies.items() if s in p) for s in in_order({s for p in supplies for s in p})}
    weights = weigh(list(sizes))
    wanted = targets(sizes, weights, int(share * sum(supplies.values())), len(costs))
    routes = route(supplies, {s: round(t) for s, t in wanted.items()}, costs)
    flow = dict.fromkeys(supplies, 0)
    routed = dict.fromkeys(sizes, 0)
    for (p, s), n in routes.items():
        flow[p] += n
        routed[s] += n
    rounds = {name: divmod(flow[p], n) if n else (0, 0) for name, p, n in found}
    taken = (F.col("times") * F.col("size")).alias("taken")
    documents = drawn(sized, rounds, len(costs)).select("doc_id", "size", "members", taken)
    sources = spark.createDataFrame(
        [(s, sizes[s], float(weights[s]), wanted[s], routed[s]) for s in sizes],
        "source string, source_size long, weight double, target double, routed long",
    )
    return Mix(documents, stored(sources, "sources"), routes)


def by_source(docs: DataFrame) -> DataFrame:
    """The mix of documents with one `source` each: doc_id, size, source, source_size, target, taken."""
    mixed = mix(docs, F.array("source"))
    source = F.element_at("members", 1)
    sources = mixed.sources.select(F.col("source").alias("_s"), "source_size", "target")
    return mixed.documents.join(sources, source.eqNullSafe(F.col("_s"))).select(
        "doc_id", "size", source.alias("source"), "source_size", "target", "taken"
    )

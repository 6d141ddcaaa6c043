"""Packing of token sequences into as few rows of fixed capacity as possible.

Documents become pieces of at most `capacity` tokens. What decides the packing is only how many
pieces of each length there are, at most `capacity` numbers however large the table is. On this
histogram a bin completion search runs on the driver: around the largest remaining length it
enumerates undominated fillings of the gap, least waste first, uses one as often as the counts
allow, and goes back to others while the waste so far still allows fewer rows than the best packing
known. Best-fit completion gives the first such incumbent; the search ends at the lower bound or
after `effort` nodes (it bounds the search for better packings, never the result).

The plan says which ranks of each length go where. Ranks are given without a window over a whole
length: pieces are dealt to hash buckets, counts of (length, bucket) become offsets, and rows are
numbered within (length, bucket).
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyfold.llm.common import (
    Words, columns, handing_back, in_slices, over_texts, record_batch, span_hashes, stored, to_python,
)

CAPACITY = 2048
BUCKET_ROWS = 20_000
CACHE_WORDS = 1_000_000  # some 35 MB
GROUP = 256
FINAL_MARKS, LETTERS = np.zeros(256, bool), np.zeros(256, bool)
FINAL_MARKS[list(b".,;:!?")] = True
LETTERS[[*range(48, 58), *range(65, 91), *range(97, 123)]] = True
PIECES = "doc_id {kind}, piece int, start long, length long, ids_crc32 long"


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class Encoder:
    """Ids of texts as arrays of 32-bit integers; words are tokenized once and remembered.

    For tokenizers that drop white space and never join across it, the ids of a text are those of
    its white-space separated words in turn. Only the separators common to all such tokenizers (ASCII
    white space) are split at here; whatever else is white space is left to the tokenizer. Where its
    own description says so, words are brought into fewer forms first: its lower case applies to
    ASCII letters, and a final run of punctuation after a letter or digit is a word of its own.
    Words of a slice are told apart by a 64-bit hash, all at once; the distinct ones are looked up, new
    ones are tokenized many at a time, and the ids are gathered by position. Bytes that are no valid
    UTF-8 count as U+FFFD. Of more than CACHE_WORDS words, those seen longest ago are forgotten.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        about = json.loads(self.tokenizer.to_str())
        steps = about["normalizer"] or {}
        self.lowers = {"type": "Lowercase"} in steps.get("normalizers", [steps])
        cuts = about["pre_tokenizer"] or {}
        self.cuts_marks = any(
            "[^\\s\\p{L}\\p{N}]+" in cut.get("pattern", {}).get("Regex", "")
            for cut in cuts.get("pretokenizers", [cuts])
        )
        self.added = [t["content"].lower().encode() for t in about["added_tokens"]]
        # A word that becomes one id, which nothing else becomes: it stands between words tokenized at once.
        coded = ((mark, self._ids(f"a {mark} b"), self._ids(mark)) for mark in "|~^")
        self.mark, self.mark_id = next(
            ((mark, own[0]) for mark, among, own in coded if len(own) == 1 and among.count(own[0]) == 1),
            (None, None),
        )
        # Words by sorted hash: where their ids begin in one array, how many, and the last slice with them.
        self.keys = np.zeros(0, np.uint64)
        self.begin, self.size, self.seen = (np.zeros(0, np.uint32) for _ in range(3))
        self.ids, self.used, self.slices = np.zeros(1 << 12, "<u4"), 0, 0

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def tokenize(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word in little-endian bytes."""
        texts = [w.decode(errors="replace") for w in words]
        out = [b""] * len(texts)
        alone = [i for i, t in enumerate(texts) if self.mark is None or self.mark in t]
        apart = set(alone)
        rest = [i for i in range(len(texts)) if i not in apart]
        groups = [rest[k : k + GROUP] for k in range(0, len(rest), GROUP)]
        between = f" {self.mark} "
        lines = [between.join(texts[i] for i in group) for group in groups]
        for group, line in zip(groups, self.tokenizer.encode_batch_fast(lines, add_special_tokens=False)):
            ids = np.array(line.ids, "<u4")
            marks = np.flatnonzero(ids == self.mark_id)
            if len(marks) != len(group) - 1:
                alone += group
                continue
            coded, begin = ids.tobytes(), 0
            for i, at in zip(group, [*marks.tolist(), len(ids)]):
                out[i] = coded[4 * begin : 4 * at]
                begin = at + 1
        single = self.tokenizer.encode_batch_fast([texts[i] for i in alone], add_special_tokens=False)
        for i, line in zip(alone, single):
            out[i] = np.array(line.ids, "<u4").tobytes()
        return out

    def look_up(self, keys: np.ndarray, words: Callable[[np.ndarray], list[bytes]]) -> np.ndarray:
        """Places of sorted hashes among the known ones; `words` gives the bytes of those that are new."""
        self.slices += 1
        at = np.searchsorted(self.keys, keys)
        hit = np.zeros(len(keys), bool)
        if len(self.keys):
            hit = self.keys[np.minimum(at, len(self.keys) - 1)] == keys
        self.seen[at[hit]] = self.slices
        new = np.flatnonzero(~hit)
        if len(new):
            self.forget(len(new))
            coded = self.tokenize(words(new))
            size = np.fromiter(map(len, coded), np.int64, len(coded)) // 4
            ids = np.frombuffer(b"".join(coded), "<u4")
            while self.used + len(ids) > len(self.ids):
                self.ids = np.concatenate((self.ids, np.zeros_like(self.ids)))
            self.ids[self.used : self.used + len(ids)] = ids
            begin = self.used + np.cumsum(size) - size
            self.used += len(ids)
            at = np.searchsorted(self.keys, keys[new])
            self.keys = np.insert(self.keys, at, keys[new])
            self.begin = np.insert(self.begin, at, begin.astype(np.uint32))
            self.size = np.insert(self.size, at, size.astype(np.uint32))
            self.seen = np.insert(self.seen, at, np.uint32(self.slices))
            at = np.searchsorted(self.keys, keys)
        return at

    def forget(self, more: int) -> None:
        """Keep the half that was seen last, if there is no room for so many more, and this slice's words."""
        if len(self.keys) + more <= CACHE_WORDS:
            return
        kept = max(CACHE_WORDS // 2, int((self.seen == self.slices).sum()))
        keep = np.sort(np.argsort(self.seen, kind="stable")[-kept:])
        size = self.size[keep].astype(np.int64)
        until = np.cumsum(size)
        where = np.repeat(self.begin[keep].astype(np.int64) - (until - size), size)
        ids = self.ids[where + np.arange(len(where))]
        self.keys, self.size, self.seen = self.keys[keep], self.size[keep], self.seen[keep]
        self.begin, self.used = (until - size).astype(np.uint32), len(ids)
        self.ids = np.concatenate((ids, np.zeros(1 << 12, "<u4")))

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        """Ids of each text."""
        special = set()
        if any(a in x for x in (b"\n".join(texts).lower(),) for a in self.added):
            special = {i for i, t in enumerate(texts) if any(a in t.lower() for a in self.added)}
        w = Words([b"" if i in special else t for i, t in enumerate(texts)], lower=self.lowers)
        start, end = w.start, w.end
        if self.cuts_marks:
            start, end = cut_marks(w.data, start, end)
        keys, at, back = np.unique(span_hashes(w.data, start, end), return_index=True, return_inverse=True)
        place = self.look_up(
            keys, lambda new: [w.data[a:b].tobytes() for a, b in zip(start[at[new]], end[at[new]])]
        )[back]
        each = self.size[place].astype(np.int64)
        until = np.concatenate(([0], np.cumsum(each)))
        where = np.repeat(self.begin[place] - until[:-1], each)
        ids = self.ids[where + np.arange(until[-1])]
        bounds = until[np.searchsorted(start, w.bounds)]
        out = [ids[a:b] for a, b in zip(bounds[:-1], bounds[1:])]
        for i in special:  # an added token is found before anything else happens
            out[i] = np.array(self._ids(texts[i].decode(errors="replace")), "<u4")
        return out


def cut_marks(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words with a final run of punctuation behind an ASCII letter or digit become two."""
    cut, some = end.copy(), np.arange(len(end))
    while len(some):
        some = some[(cut[some] > start[some]) & FINAL_MARKS[data[cut[some] - 1]]]
        cut[some] -= 1
    two = np.flatnonzero((cut < end) & (cut > start))
    two = two[LETTERS[data[cut[two] - 1]]]
    return np.sort(np.concatenate((start, cut[two]))), np.sort(np.concatenate((end, cut[two])))


@lru_cache(maxsize=1)
def worker_encoder(path: str) -> Encoder:
    """Kept from task to task, with the words it knows."""
    return Encoder(path)


def pieces(
    docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, end_id: int = 0
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32: every document's ids and `end_id`, cut only where
    longer than `capacity`. Null and empty texts are one piece holding `end_id`."""
    path = tokenizer or default_tokenizer()
    kind = docs.schema["doc_id"].dataType.simpleString()
    end = int(end_id).to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(path)
        for batch in in_slices(batches):
            ids, texts = columns(batch, "doc_id", "text")
            for lo, hi, part in over_texts(texts):
                at, no, start, size, crc = [], [], [], [], []
                for i, coded in enumerate(encoder.encode(part), lo):
                    for k, a in enumerate(range(0, len(coded) + 1, capacity)):
                        cut = coded[a : a + capacity]
                        last = a + capacity > len(coded)
                        at.append(i)
                        no.append(k)
                        start.append(a)
                        size.append(len(cut) + last)
                        crc.append(zlib.crc32(end, zlib.crc32(cut)) if last else zlib.crc32(cut))
                schema = pa.schema([
                    ("doc_id", ids.type), ("piece", pa.int32()), ("start", pa.int64()),
                    ("length", pa.int64()), ("ids_crc32", pa.int64()),
                ])
                yield record_batch(schema, ids.take(pa.array(at, pa.int64())), no, start, size, crc)

    return to_python(docs).select("doc_id", "text").mapInArrow(handing_back(run), PIECES.format(kind=kind))


Filling = tuple[tuple[int, int], ...]  # (length, how many), largest first


@dataclass(frozen=True)
class Run:
    """`copies` rows that all hold `filling`."""

    filling: Filling
    copies: int


def lower_bound(counts: np.ndarray, capacity: int) -> int:
    """Rows needed for the tokens in total, and for pieces of which no two share a row."""
    sizes = np.arange(len(counts))
    return int(max(-(-int((counts * sizes).sum()) // capacity), counts[sizes > capacity // 2].sum()))


def dominates(a: list[int], b: list[int]) -> bool:
    """Whether the items of `b` can be grouped into the items of `a` (each item's group fits)."""
    if sum(b) > sum(a):
        return False
    room = sorted(a, reverse=True)
    for item in sorted(b, reverse=True):
        k = min((k for k, r in enumerate(room) if r >= item), key=lambda k: room[k], default=None)
        if k is None:
            return False
        room[k] -= item
    return True


def fillings(counts: np.ndarray, gap: int, width: int) -> list[tuple[int, list[int]]]:
    """Up to `width` undominated fillings of `gap` as (waste, items), least waste first."""
    have = np.flatnonzero(counts[: gap + 1])
    if not len(have):
        return [(gap, [])]
    base: list[int] = []
    left = counts.copy()
    while len(have) and gap > 4 * have[-1]:  # far from full: the largest ones first
        n = int(min(left[have[-1]], (gap - 3 * have[-1]) // have[-1]))
        base += [int(have[-1])] * n
        gap -= n * int(have[-1])
        left[have[-1]] -= n
        have = np.flatnonzero(left[: gap + 1])
    found: list[tuple[int, list[int]]] = []
    exact = 0
    for a in have[::-1].tolist():
        rest, items = gap - a, [a]
        left[a] -= 1
        if rest and left[rest]:
            items, rest = [a, rest], 0
        elif rest:
            b = np.flatnonzero(left[: rest + 1])
            ok = b[(left[rest - b] > (2 * b == rest)) & (left[b] > 0)]
            if len(ok):
                b = int(ok[-1])
                items, rest = [a, b, rest - b], 0
            else:  # best fit, again and again
                taken: dict[int, int] = {}
                while rest:
                    fits = [x for x in b[b <= rest][::-1].tolist() if left[x] > taken.get(x, 0)][:1]
                    if not fits:
                        break
                    taken[fits[0]] = taken.get(fits[0], 0) + 1
                    items.append(fits[0])
                    rest -= fits[0]
        left[a] += 1
        if not any(w <= rest and dominates(f, items) for w, f in found):
            found.append((rest, items))
            exact += rest == 0
        if exact >= width:
            break
    found.sort(key=lambda x: (x[0], len(x[1])))
    return [(w, base + f) for w, f in found[:width]] or [(gap, base)]


def bin_completion(counts: np.ndarray, capacity: int, effort: int = 4000, width: int = 3) -> list[Run]:
    """Runs that use up `counts` (index = length); as few rows as the search finds."""
    counts = np.asarray(counts, np.int64)
    total = int((counts * np.arange(len(counts))).sum())
    bound = lower_bound(counts, capacity)
    best: list[Run] | None = None
    best_rows = np.iinfo(np.int64).max
    nodes = 0
    # A stack of (counts, runs so far, rows so far, waste so far); the best child is taken first.
    stack: list[tuple[np.ndarray, tuple, int, int]] = [(counts, (), 0, 0)]
    while stack:
        left, runs, rows, waste = stack.pop()
        if best is not None:
            if waste > (best_rows - 1) * capacity - total or nodes >= effort:
                continue
        large = np.flatnonzero(left)
        if not len(large):
            if rows < best_rows:
                chain, node = [], runs
                while node:
                    chain.append(node[0])
                    node = node[1]
                best, best_rows = chain[::-1], rows
                if rows <= bound:
                    break
            continue
        nodes += 1
        top = int(large[-1])
        left[top] -= 1
        options = fillings(left, capacity - top, width if best is None or nodes < effort else 1)
        left[top] += 1
        for lost, items in reversed(options):
            sizes, many = np.unique([top, *items], return_counts=True)
            copies = int((left[sizes] // many).min())
            after = left.copy()
            after[sizes] -= copies * many
            filling = tuple(zip(sizes[::-1].tolist(), many[::-1].tolist()))
            stack.append((after, (Run(filling, copies), runs), rows + copies, waste + copies * lost))
    return best or []


@dataclass
class Places:
    """Ranks of each length as sorted intervals: key = length << 40 | first rank."""

    key: np.ndarray
    first: np.ndarray
    per_row: np.ndarray
    row: np.ndarray
    offset: np.ndarray


def places(runs: list[Run], capacity: int) -> Places:
    used = np.zeros(capacity + 1, np.int64)
    out, row = [], 0
    for run in runs:
        offset = 0
        for length, many in run.filling:
            out.append((length << 40 | int(used[length]), int(used[length]), many, row, offset))
            used[length] += many * run.copies
            offset += length * many
        row += run.copies
    table = np.array(sorted(out), np.int64).reshape(-1, 5)
    return Places(*table.T)


def place(ranked: DataFrame, plan: Places) -> DataFrame:
    """Adds sequence_id and offset to rows with (length, rank). The plan's size is bounded by the
    capacity, not by the table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (c.to_numpy(zero_copy_only=False) for c in columns(batch, "length", "rank"))
            k = np.searchsorted(plan.key, length << 40 | rank, side="right") - 1
            copy, slot = np.divmod(rank - plan.first[k], plan.per_row[k])
            kept = batch.drop_columns(["rank"])
            kept = kept.append_column("sequence_id", pa.array(plan.row[k] + copy, pa.int64()))
            yield kept.append_column("offset", pa.array(plan.offset[k] + slot * length, pa.int64()))

    kinds = [f"{n} {k}" for n, k in ranked.dtypes if n != "rank"]
    return ranked.mapInArrow(run, ", ".join([*kinds, "sequence_id long", "offset long"]))


def pack(
    docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, end_id: int = 0,
    effort: int = 4000,
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Every row of `docs` is packed, repeated rows each; ties between equal lengths go by doc_id and
    piece. Other columns are ignored. An empty table gives an empty result.
    """
    cut = stored(pieces(docs, tokenizer, capacity, end_id), "pieces")
    buckets = max(1, -(-cut.count() // BUCKET_ROWS))
    cut = cut.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(buckets)))
    sizes = stored(cut.groupBy("length", "bucket").agg(F.count("*").alias("n")), "piece-counts")
    counts = np.zeros(capacity + 1, np.int64)
    for row in sizes.groupBy("length").agg(F.sum("n").alias("n")).collect():  # capacity rows at most
        counts[row["length"]] = row["n"]
    before = Window.partitionBy("length").orderBy("bucket")
    offsets = sizes.select(
        "length", "bucket", (F.sum("n").over(before) - F.col("n")).alias("before")
    )
    within = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "start", "ids_crc32")
    ranked = cut.withColumn("k", F.row_number().over(within)).join(offsets, ["length", "bucket"])
    ranked = ranked.select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.col("before") + F.col("k") - 1).alias("rank"),
    )
    return place(ranked, places(bin_completion(counts, capacity, effort), capacity))

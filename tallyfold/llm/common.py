"""Helpers shared by the operators: table access, text slices and vectorised word hashes.

Texts reach Python in Arrow batches. A batch is cut into slices of bounded size, every slice is one
byte array in which documents are separated by a line feed, and words, windows and hashes are numpy
operations over that array. A single longer text forms a slice of its own; texts are never cut.
"""

from __future__ import annotations

import ctypes
import gc
import sys
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold.functions.text import let  # noqa: F401  (used by the operators)
from tallyfold.session import scratch_path

SLICE_BYTES = 1 << 20
SPACES = np.zeros(256, bool)
SPACES[[9, 10, 11, 12, 13, 32]] = True
# Runs of ASCII letters, digits and any other characters beyond ASCII count as one word.
MARKS = np.ones(256, bool)
MARKS[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write below the shared folder and read back: evaluated once, and its lineage is cut."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def columns(batch: pa.RecordBatch, *names: str) -> list[pa.Array]:
    return [batch.column(batch.schema.get_field_index(n)) for n in names]


def texts_of(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes, null as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def slices(sizes: list[int], limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Index ranges whose sizes add up to `limit` at most, or hold a single item."""
    start = total = 0
    for i, size in enumerate(sizes):
        if i > start and total + size > limit:
            yield start, i
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield start, len(sizes)


def in_slices(
    batches: Iterator[pa.RecordBatch], name: str = "text", limit: int = 4 * SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """The batches in parts whose texts add up to `limit` at most, or hold a single row: what a task
    keeps of a batch besides the batch itself stays small."""
    for batch in batches:
        (texts,) = columns(batch, name)
        sizes = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
        for lo, hi in slices(sizes, limit):
            yield batch.slice(lo, hi - lo)


def over_texts(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, list[bytes]]]:
    texts = texts_of(column)
    for lo, hi in slices([len(t) for t in texts], limit):
        yield lo, hi, texts[lo:hi]


class Words:
    """The words of some texts as arrays: runs of bytes outside `blank`, ASCII white space at first.

    data: bytes, lower-cased A-Z; start, end: byte range of each word; doc: index of its text;
    first: index of the first word of each text, with the total at the end.
    """

    def __init__(self, texts: list[bytes], lower: bool = True, blank: np.ndarray = SPACES):
        raw = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        self.data = LOWER[raw] if lower else raw
        sizes = np.fromiter((len(t) for t in texts), np.int64, len(texts)) + 1
        self.bounds = np.concatenate(([0], np.cumsum(sizes)))
        blank = blank[raw]
        edges = np.flatnonzero(np.diff(np.concatenate(([True], blank)).view(np.int8)))
        self.start, self.end = edges[0::2], edges[1::2]
        self.first = np.searchsorted(self.start, self.bounds)
        self.doc = np.repeat(np.arange(len(texts)), np.diff(self.first))
        self.counts = np.diff(self.first)

    def hashes(self) -> np.ndarray:
        return span_hashes(self.data, self.start, self.end)


@lru_cache(maxsize=1)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    base = np.uint64(0x9E3779B97F4A7C15)
    inverse = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
    up, down = np.full(size, base), np.full(size, inverse)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


BYTE_CODES = np.random.default_rng(20240501).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte range, from one running sum: sum(code[byte] * base^i) / base^start."""
    size = 1 << max(20, int(len(data)).bit_length())
    up, down = _powers(size)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE_CODES[data] * up[: len(data)], out=sums[1:])
    return mixed((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))


def window_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of `width` word hashes; order matters."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = np.zeros(n, np.uint64)
    for j in range(width):
        h = mixed(h * np.uint64(0x100000001B3) + words[j : j + n])
    return h


def inside(first: np.ndarray, width: int, total: int) -> np.ndarray:
    """Which runs of `width` words stay inside one text."""
    n = max(0, total - width + 1)
    last = np.repeat(first[1:], np.diff(first))[:n]
    return np.arange(n) + width <= last


def sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of `values` over each range of `first`, empty ranges 0."""
    total = np.concatenate(([0], np.cumsum(values, dtype=np.float64 if values.dtype.kind == "f" else np.int64)))
    return total[first[1:]] - total[first[:-1]]


def record_batch(schema: pa.Schema, *arrays) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [a if isinstance(a, pa.Array) else pa.array(a, f.type) for a, f in zip(arrays, schema)],
        schema=schema,
    )


Batches = Iterator[pa.RecordBatch]


def hand_back() -> None:
    """Give this process's free memory back. Workers stay for later tasks, and what one stage has freed
    would otherwise still count against the executor while the next one runs."""
    _powers.cache_clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        ctypes.CDLL(None).malloc_trim(0)


def handing_back(run: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """`run`, after which the worker gives its free memory back."""
    def wrapped(batches: Batches) -> Batches:
        yield from run(batches)
        hand_back()

    return wrapped


ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def to_python(df: DataFrame) -> DataFrame:
    """`df`, whose texts are about to go to Python, with batches of 1,000 rows where the session has
    Spark's default of 10,000: a batch of that many texts takes a hundred MB on both sides."""
    conf = df.sparkSession.conf
    if conf.get(ARROW_ROWS) == "10000":
        conf.set(ARROW_ROWS, "1000")
    return df


SMALL_ROWS = 500_000


def small(df: DataFrame, rows: int = SMALL_ROWS) -> DataFrame:
    """A stored table, to be broadcast if it has at most `rows` rows; a larger one is joined by a
    shuffle with the same result. For narrow rows: the bound keeps a broadcast below some 100 MB."""
    return F.broadcast(df) if df.count() <= rows else df

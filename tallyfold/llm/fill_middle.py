"""Fill-in-middle: two cuts make a document prefix, middle and suffix, written out of order.

Cuts lie between units: a word with the white space before it, and white space at the very end. They
are found without cutting the text into units. A rolling hash over 16 bytes splits the text into
chunks where its content says so, so that equal passages fall into equal chunks wherever they stand.
For a chunk, a cache keyed by its bytes (equal hashes never suffice) holds its boundary summary: word
ends inside, characters, and whether it begins and ends within white space. Word ends between chunks
follow from two neighbouring summaries; running sums over the chunks of a document say which chunk a
cut falls into, and only that one is looked through.

Nothing is shuffled, and a task holds one slice of texts and two generations of the cache, bounded
in bytes. The cache saves work only; results don't depend on it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.llm.common import SPACES, columns, in_slices, over_texts, record_batch, to_python

CHUNK_BITS = 8  # chunks of 256 bytes on average
CACHE_BYTES = 8 << 20
ROLL = np.random.default_rng(20240613).integers(1, 1 << 32, 256, dtype=np.uint32) | np.uint32(1)
STEPS = (1, 2, 4, 8)  # widths that double up to the window of 16
WINDOW = 16


@dataclass(frozen=True)
class Plan:
    """prefix, suffix, middle: the marks; rate: percent of documents transformed; suffix_first: percent
    of those with the suffix in front; seed: of the draws."""

    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"
    rate: int = 50
    suffix_first: int = 80
    seed: int = 42


def rolling_hashes(data: np.ndarray) -> np.ndarray:
    """For every position the hash of the 16 bytes that end there, by doubling the window."""
    base = 0x01000193
    h = ROLL[data]
    for width in STEPS:
        weight = np.uint32(pow(base, width, 1 << 32))
        longer = h.copy()
        longer[width:] += h[:-width] * weight if len(h) > width else np.uint32(0)
        h = longer
    return h


def chunk_starts(data: np.ndarray, bounds: np.ndarray, bits: int = CHUNK_BITS) -> np.ndarray:
    """Starts of chunks: of every text, and behind windows whose hash has `bits` leading zeros. Windows
    never reach across texts."""
    hits = np.flatnonzero(rolling_hashes(data) >> np.uint32(32 - bits) == 0) + 1
    text = np.searchsorted(bounds, hits, side="right") - 1
    hits = hits[(hits < bounds[-1]) & (hits - bounds[np.minimum(text, len(bounds) - 1)] >= WINDOW)]
    return np.union1d(bounds[:-1][np.diff(bounds) > 0], hits)


def word_ends(data: np.ndarray) -> np.ndarray:
    """Whether a word ends before this byte, within `data`."""
    blank = SPACES[data]
    ends = np.zeros(len(data), bool)
    ends[1:] = blank[1:] & ~blank[:-1]
    return ends


def summaries(chunks: list[bytes]) -> list[tuple[int, int, bool, bool]]:
    """(word ends inside, characters, begins blank, ends blank) of each chunk."""
    data = np.frombuffer(b"".join(chunks), np.uint8)
    start = np.cumsum([0, *map(len, chunks)])
    ends = word_ends(data)
    ends[start[:-1]] = False
    inside = np.add.reduceat(ends, start[:-1], dtype=np.int64)
    chars = np.add.reduceat(data & 0xC0 != 0x80, start[:-1], dtype=np.int64)
    opens, closes = SPACES[data[start[:-1]]], SPACES[data[start[1:] - 1]]
    return list(zip(inside.tolist(), chars.tolist(), opens.tolist(), closes.tolist()))


class Memory:
    """Summaries by content. What has not come again for a whole generation is forgotten."""

    def __init__(self, limit: int = CACHE_BYTES):
        self.limit, self.size = limit, 0
        self.known: dict[bytes, tuple] = {}
        self.older: dict[bytes, tuple] = {}

    def __call__(self, chunks: list[bytes]) -> np.ndarray:
        if self.size > self.limit:
            self.known, self.older, self.size = {}, self.known, 0
        new = []
        for c in set(chunks) - self.known.keys():
            if c in self.older:
                self.known[c] = self.older[c]
            else:
                new.append(c)
            self.size += len(c)
        if new:
            self.known.update(zip(new, summaries(new), strict=True))
        return np.array([self.known[c] for c in chunks], np.int64).reshape(-1, 4)


class Chunked:
    """Units of some texts, by chunks."""

    def __init__(self, texts: list[bytes], memory: Memory, bits: int = CHUNK_BITS):
        raw = b"".join(texts)
        self.data = np.frombuffer(raw, np.uint8)
        self.bounds = np.cumsum([0, *map(len, texts)])
        self.start = chunk_starts(self.data, self.bounds, bits)
        self.stop = np.append(self.start[1:], len(raw))
        inside, chars, opens, closes = memory([raw[a:b] for a, b in zip(self.start, self.stop)]).T
        last = np.isin(self.stop, self.bounds)
        follows = np.append(opens[1:], 1)
        # A word ends with its chunk if the text does too or the next chunk begins blank.
        self.ends = np.concatenate(([0], np.cumsum(inside + ((closes == 0) & (last | (follows == 1))))))
        self.chars = np.concatenate(([0], np.cumsum(chars)))
        self.first = np.searchsorted(self.start, self.bounds)  # the first chunk of each text
        tail = np.zeros(len(texts), np.int64)
        full = np.flatnonzero(np.diff(self.bounds))
        tail[full] = closes[self.first[full + 1] - 1]
        self.units = self.ends[self.first[1:]] - self.ends[self.first[:-1]] + tail

    def cut(self, text: int, units: int) -> tuple[int, int]:
        """(bytes, characters) of the first so many units of a text."""
        a, b = self.first[text], self.first[text + 1]
        if units == 0:
            return 0, 0
        if units == self.units[text]:
            return int(self.bounds[text + 1] - self.bounds[text]), int(self.chars[b] - self.chars[a])
        k = int(np.searchsorted(self.ends[a : b + 1], self.ends[a] + units)) + a - 1
        part = self.data[self.start[k] : self.stop[k]]
        inside = np.flatnonzero(word_ends(part))
        nth = units - (self.ends[k] - self.ends[a]) - 1
        at = int(inside[nth]) if nth < len(inside) else len(part)
        chars = self.chars[k] - self.chars[a] + np.count_nonzero(part[:at] & 0xC0 != 0x80)
        return int(self.start[k] + at - self.bounds[text]), int(chars)


def draws(doc_id: object, seed: int) -> list[int]:
    key = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(key[i : i + 8], 16) for i in range(0, 32, 8)]


OUT = "doc_id {kind}, n long, form string, prefix_chars long, middle_chars long, output string"


def fill_in_middle(docs: DataFrame, plan: Plan = Plan(), bits: int = CHUNK_BITS) -> DataFrame:
    """doc_id, n (units), form (plain, psm or spm), prefix_chars, middle_chars, output.

    Draws come from the seed and doc_id alone (a null doc_id counts as empty), so repeated rows agree.
    Null text: empty. Empty texts, and texts that hold a mark, stay plain. Bytes that are no valid
    UTF-8 stay as they are; characters are bytes that don't continue one. Other columns are ignored;
    an empty table gives an empty result.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    p, s, m = (x.encode() for x in (plan.prefix, plan.suffix, plan.middle))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = Memory()
        for batch in in_slices(batches):
            ids, texts = columns(batch, "doc_id", "text")
            schema = pa.schema([
                ("doc_id", ids.type), ("n", pa.int64()), ("form", pa.string()),
                ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("output", pa.string()),
            ])
            for lo, hi, part in over_texts(texts):
                chunked = Chunked(part, memory, bits)
                forms, before, within, out = [], [], [], []
                for i, (doc_id, text) in enumerate(zip(ids[lo:hi].to_pylist(), part)):
                    h = draws(doc_id, plan.seed)
                    if not text or h[2] % 100 >= plan.rate or any(x in text for x in (p, s, m)):
                        forms.append("plain")
                        before.append(None)
                        within.append(None)
                        out.append(text)
                        continue
                    one, two = sorted(x % (int(chunked.units[i]) + 1) for x in h[:2])
                    (a, a_chars), (b, b_chars) = chunked.cut(i, one), chunked.cut(i, two)
                    before.append(a_chars)
                    within.append(b_chars - a_chars)
                    if h[3] % 100 < plan.suffix_first:
                        forms.append("spm")
                        out.append(b"".join((s, text[b:], p, text[:a], m, text[a:b])))
                    else:
                        forms.append("psm")
                        out.append(b"".join((p, text[:a], s, text[b:], m, text[a:b])))
                written = pa.array(out, pa.binary()).view(pa.string())
                yield record_batch(schema, ids[lo:hi], chunked.units, forms, before, within, written)

    return to_python(docs).select("doc_id", "text").mapInArrow(run, OUT.format(kind=kind))


def restored(output: Column, form: Column, plan: Plan = Plan()) -> Column:
    """The text again, from the output and its form. A mark never overlaps a neighbouring text, as it
    begins with its only `<`, so the first of each kind is the one that was written."""
    at = {k: F.locate(x, output) for k, x in (("p", plan.prefix), ("s", plan.suffix), ("m", plan.middle))}
    size = {"p": len(plan.prefix), "s": len(plan.suffix), "m": len(plan.middle)}

    def between(a: str, b: str) -> Column:
        return F.substring(output, at[a] + size[a], at[b] - at[a] - size[a])

    middle = F.substring(output, at["m"] + size["m"], F.length(output))
    return (
        F.when(form == "psm", F.concat(between("p", "s"), middle, between("s", "m")))
        .when(form == "spm", F.concat(between("p", "m"), middle, between("s", "p")))
        .otherwise(output)
    )


def digests(docs: DataFrame, plan: Plan = Plan()) -> DataFrame:
    """`fill_in_middle` with the digests of the output and of the text restored from it."""
    made = fill_in_middle(docs, plan)
    text = restored(F.col("output"), F.col("form"), plan)
    return made.select(
        *[c for c in made.columns if c != "output"],
        F.sha2("output", 256).alias("output_sha256"), F.sha2(text, 256).alias("restored_sha256"),
    )


def oracle() -> str:
    return r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents
), k AS (
  SELECT doc_id, t,
    regexp_extract_all(t, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS w,
    ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2,
    ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4
  FROM d
), c AS (
  SELECT *, len(w) AS n, least(h1 % (len(w) + 1), h2 % (len(w) + 1)) AS a,
    greatest(h1 % (len(w) + 1), h2 % (len(w) + 1)) AS b,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 50 THEN 'plain'
      WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM k
), s AS (
  SELECT *, array_to_string(w[1:a], '') AS p, array_to_string(w[a + 1:b], '') AS m,
    array_to_string(w[b + 1:n], '') AS f
  FROM c
)
SELECT doc_id, n::BIGINT AS n, form,
  CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || f || '<M>' || m
    ELSE '<S>' || f || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM s
"""

"""Secret scan: keyword automaton, anchored expressions near its hits, embedded checksums.

An Aho-Corasick automaton over the lower-cased text finds all keywords in one pass. Only where a
keyword ends is an anchored expression tried, from left to right and never inside the previous
match of its kind, which is the order in which a scan of the whole text would match. Runs of hex
digits have no keyword: every 32nd character is probed instead, since a run of 32 must cover one.

Kinds of its own are reported only if the token's embedded checksum is right: tokens with a known
prefix whose last six characters are the base-62 CRC-32 of the characters before.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.llm.common import columns, in_slices, record_batch, to_python

# Words, prefixes and patterns of the kinds.
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ASSIGN = re.compile(
    r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([a-z0-9+/_.=-]+)"""
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
CHECKED_PREFIXES = ("ghp_", "gho_", "ghu_", "ghs_", "ghr_", "npm_")
CHECKED = re.compile(r"(?:gh[pousr]|npm)_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
KINDS = ("assign", "access", "hex", "checked")
MIN_VALUE, MIN_ACCESS, MIN_HEX = 8, 16, 32

_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_HEX_POINT = np.zeros(128, bool)
_HEX_POINT[[ord(c) for c in "0123456789abcdef"]] = True

Span = tuple[int, int, int]


def automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for kind, words in ((0, ASSIGN_WORDS), (1, ("akia",)), (3, CHECKED_PREFIXES)):
        for word in words:
            found.add_word(word, (kind, len(word)))
    found.make_automaton()
    return found


def checksum(body: str) -> str:
    """CRC-32 of the token's body, six base-62 digits."""
    value, digits = zlib.crc32(body.encode()), ""
    for _ in range(6):
        value, digit = divmod(value, 62)
        digits = BASE62[digit] + digits
    return digits


def lowered(text: str) -> str:
    """A-Z only, so that positions stay those of the text."""
    return text.lower() if text.isascii() else text.encode().translate(_LOWER).decode()


def hex_runs(text: str) -> Iterator[Span]:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)[MIN_HEX - 1 :: MIN_HEX]
    hits = np.flatnonzero((points < 128) & _HEX_POINT[np.minimum(points, 127)])
    done = 0
    for at in (hits * MIN_HEX + MIN_HEX - 1).tolist():
        if at < done:
            continue
        start = at
        while start > done and text[start - 1] in "0123456789abcdef":
            start -= 1
        done = HEX.match(text, start).end()
        if done - start >= MIN_HEX:
            yield start, 2, done


def spans(text: str, words: ahocorasick.Automaton) -> list[Span]:
    """(start, kind, end) of everything found, by start and kind; code points, end exclusive."""
    low, out, done = lowered(text), [], [0] * len(KINDS)
    hits = sorted((end - size + 1, kind) for end, (kind, size) in words.iter(low))
    for start, kind in hits:
        if start < done[kind]:
            continue
        if kind == 0:
            if m := ASSIGN.match(low, start):
                done[0] = m.end()
                if m.end(1) - m.start(1) >= MIN_VALUE:
                    out.append((start, 0, m.end()))
        elif kind == 1:
            if m := ACCESS.match(text, start):
                done[1] = m.end()
                if m.end() - start >= MIN_ACCESS:
                    out.append((start, 1, m.end()))
        elif (m := CHECKED.match(text, start)) and checksum(m[1]) == m[2]:
            done[3] = m.end()
            out.append((start, 3, m.end()))
    out.extend(hex_runs(text))
    return sorted(out)


def named(found: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in found)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: counts by kind, a digest of the base spans, and all spans.

    Null and empty texts have no spans; repeated rows are scanned each. Columns other than the id
    and the text are ignored, so their names cannot clash. No shuffle.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = automaton()
        for batch in in_slices(batches):
            ids, texts = columns(batch, "id", "text")
            rows = []
            for text in texts:
                found = spans(text.as_py() or "", words)
                base = named([x for x in found if x[1] < 3])
                counts = [sum(k == j for _, k, _ in found) for j in range(len(KINDS))]
                rows.append((*counts, hashlib.sha256(base.encode()).hexdigest(), named(found)))
            yield record_batch(
                pa.schema([
                    ("doc_id", ids.type), ("n_assign", pa.int64()), ("n_access", pa.int64()),
                    ("n_hex", pa.int64()), ("n_checked", pa.int64()), ("base_sha256", pa.string()),
                    ("spans", pa.string()),
                ]),
                ids, *(zip(*rows) if rows else [[]] * 6),
            )

    return to_python(docs).select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        run,
        f"doc_id {kind}, n_assign long, n_access long, n_hex long, n_checked long, "
        "base_sha256 string, spans string",
    )


def redacted(text: str, words: ahocorasick.Automaton, mark: str) -> str:
    out, at = [], 0
    for start, _, end in spans(text, words):
        if end > at:
            if start >= at:
                out += [text[at:start], mark]
            at = end
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """The documents with every found span (overlapping ones together) replaced by `mark`.

    Columns stay as they are; n_chars, where present, counts the new text's code points. Null texts
    stay null. Nothing else changes, and no document is dropped.
    """
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = automaton()
        for batch in in_slices(batches):
            (texts,) = columns(batch, "text")
            new = [None if t is None else redacted(t, found, mark) for t in texts.to_pylist()]
            yield batch.set_column(names.index("text"), "text", pa.array(new, texts.type))

    out = to_python(docs).mapInArrow(run, docs.schema)
    if "n_chars" in names:
        size = F.length("text").cast(docs.schema["n_chars"].dataType)
        changed = F.when(F.col("text").isNotNull(), size).otherwise(F.col("n_chars"))
        out = out.select(*[changed.alias(c) if c == "n_chars" else F.col(c) for c in names])
    return out

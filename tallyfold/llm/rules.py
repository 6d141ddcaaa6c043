"""Quality rules: base counts and a hashed n-gram logistic regression, in one pass over the text.

Features are the shares of hashed words, word pairs and character triples. The score of a text is
then an average of learned weights, so a batch is scored by table lookups and running sums. The
regression is fitted on a bounded labelled sample, calibrated on a part of it that it has not seen,
with class weights that restore the frequencies of the labels, and compared with fixed thresholds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tallyfold.llm.common import (
    SPACES, Words, columns, in_slices, inside, mixed, over_texts, record_batch, span_hashes, sums, window_hashes, to_python,
)
from tallyfold.llm.labels import Model, fit, labelled_sample, platt, sigmoid

PER_CLASS = 2000  # rows of each class in the training sample
BITS = 15
MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW = 20, 30, 8
MIN_QUALITY = 0.5
SYMBOLS = np.zeros(256, bool)
SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True


def again(keys: np.ndarray) -> np.ndarray:
    """Which keys occur more than once."""
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    out = np.zeros(len(keys), bool)
    out[order[1:]] |= same
    out[order[:-1]] |= same
    return out


def base_counts(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of each text."""
    w = Words(texts, lower=False)
    data, n = w.data, len(texts)
    blank = SPACES[data]
    chars = sums(((data & 0xC0) != 0x80) & ~blank, w.bounds)
    symbols = sums(SYMBOLS[data], w.bounds)
    # Lines: the separators between texts end lines as well.
    end = np.flatnonzero(data == 10)
    start = np.concatenate(([0], end[:-1] + 1))
    doc = np.searchsorted(w.bounds, start, side="right") - 1
    full = sums(~blank, np.concatenate((start, [len(data)]))) > 0
    lines = mixed(span_hashes(data, start, end) + mixed(doc.astype(np.uint64)))[full]
    _, at = np.unique(lines, return_index=True)
    dup = np.bincount(doc[full], minlength=n) - np.bincount(doc[full][at], minlength=n)
    # Words in windows that occur twice in their text.
    hashes = w.hashes()
    windows = window_hashes(hashes, WINDOW)
    ok = np.flatnonzero(inside(w.first, WINDOW, len(hashes)))
    windows = mixed(windows[ok] + mixed(w.doc[ok].astype(np.uint64)))
    hit = ok[again(windows)]
    cover = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(cover, hit, 1)
    np.add.at(cover, hit + WINDOW, -1)
    repeat = sums(np.cumsum(cover[:-1]) > 0, w.first)
    return w.counts, chars, symbols, dup, repeat


def grams(texts: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
    """For words, word pairs and character triples: bucket of each and first index of each text."""
    shift = np.uint64(64 - BITS)
    w = Words(texts)
    hashes = w.hashes()
    pairs = window_hashes(hashes, 2)
    ok = inside(w.first, 2, len(hashes))
    points = np.frombuffer(w.data.tobytes().decode("utf-8", "surrogatepass").encode("utf-32-le", "surrogatepass"), np.uint32)
    starts = np.concatenate(([0], np.cumsum((w.data & 0xC0) != 0x80)))[w.bounds]
    code = points.astype(np.uint64)
    triples = mixed(code[:-2] | code[1:-1] << np.uint64(21) | code[2:] << np.uint64(42)) if len(code) > 2 else code[:0]
    # A triple may hold the separator that ends its text, nothing beyond.
    whole = np.arange(len(triples)) + 3 <= np.repeat(starts[1:], np.diff(starts))[: len(triples)]
    parts = [(hashes, w.first), within(pairs, ok, w.first), within(triples, whole, starts)]
    return [((h >> shift).astype(np.int64), f) for h, f in parts]


def within(values: np.ndarray, ok: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The values that are ok, and where those of each text begin."""
    before = np.concatenate(([0], np.cumsum(ok)))
    return values[ok], before[np.minimum(first, len(ok))]


def raw_score(texts: list[bytes], weights: np.ndarray) -> np.ndarray:
    total = np.zeros(len(texts))
    for table, (bucket, first) in zip(weights, grams(texts), strict=True):
        total += sums(table[bucket], first) / np.maximum(1, np.diff(first))
    return total


def train(texts: list[bytes], label: np.ndarray, weight: np.ndarray, steps: int = 150) -> Model:
    """Adagrad over the whole sample; every fifth text is kept for the calibration."""
    kinds, size = 3, 1 << BITS
    if len(set(label.tolist())) < 2:  # nothing to tell apart: everything passes
        return {"weights": np.zeros((kinds, size)), "bias": np.array(40.0)}
    row, index, value = [], [], []
    for i, text in enumerate(texts):
        for k, (bucket, _) in enumerate(grams([text])):
            at, n = np.unique(bucket, return_counts=True)
            row.append(np.full(len(at), i, np.int32))
            index.append((at + k * size).astype(np.int32))
            value.append((n / max(1, len(bucket))).astype(np.float32))
    row, index, value = map(np.concatenate, (row, index, value))
    common = np.bincount(index, minlength=kinds * size) >= 3
    keep = common[index]
    row, index, value = row[keep], index[keep], value[keep]
    held = np.arange(len(texts)) % 5 == 4
    share = np.where(label == 1, 0.5 / max(1, (label[~held] == 1).sum()), 0.5 / max(1, (label[~held] == 0).sum()))
    share[held] = 0
    w, bias = np.zeros(kinds * size), 0.0
    past, past_bias = np.full(kinds * size, 1e-12), 1e-12
    for _ in range(steps):
        logit = np.bincount(row, w[index] * value, minlength=len(texts)) + bias
        err = share * (sigmoid(logit) - label)
        grad = np.bincount(index, err[row] * value, minlength=kinds * size) + 1e-7 * w
        past += grad**2
        past_bias += err.sum() ** 2
        w -= 0.5 * grad / np.sqrt(past)
        bias -= 0.5 * err.sum() / np.sqrt(past_bias)
    logit = np.bincount(row, w[index] * value, minlength=len(texts)) + bias
    a, b = platt(logit[held], label[held], weight[held])
    return {"weights": (a * w).reshape(kinds, size), "bias": np.array(a * bias + b)}


def quality_model(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Model:
    return fit(labelled_sample(docs, labels, "quality", per_class), train)


def quality_rules(docs: DataFrame, model: Model, min_quality: float = MIN_QUALITY) -> DataFrame:
    """One row per document: base counts, base_failed, quality (calibrated probability) and kept.

    Null and empty texts count nothing and fail the base. Repeated rows give repeated results; other
    columns are ignored. Without labels of both classes the base alone decides. No shuffle.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    weights, bias = model["weights"], float(model["bias"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            ids, texts = columns(batch, "doc_id", "text")
            schema = pa.schema([
                ("doc_id", ids.type), ("n_words", pa.int64()), ("word_chars", pa.int64()),
                ("n_symbols", pa.int64()), ("n_dup_lines", pa.int64()), ("n_repeat_words", pa.int64()),
                ("quality", pa.float64()), ("base_failed", pa.bool_()), ("kept", pa.bool_()),
            ])
            for lo, hi, part in over_texts(texts):
                counts = base_counts(part)
                n, repeat = counts[0], counts[4]
                score = sigmoid(raw_score(part, weights) + bias)
                failed = (n < MIN_WORDS) | (100 * repeat > MAX_REPEAT_PERCENT * n)
                yield record_batch(
                    schema, ids.slice(lo, hi - lo), *counts, score, failed, ~failed & (score >= min_quality)
                )

    return to_python(docs).select("doc_id", "text").mapInArrow(
        run,
        f"doc_id {kind}, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
        "n_repeat_words long, quality double, base_failed boolean, kept boolean",
    )

"""Quality by attention over passages (multiple-instance learning).

A text is a bag of passages of 64 words. Every passage is encoded by surface shares, by how much of
it repeats, and by a fixed random projection of its hashed character pairs, followed by a learned
layer. Only documents are labelled: gated attention decides how much each passage counts, and a
logistic layer scores the weighted sum. All parts are trained together in numpy on a bounded sample;
the score is calibrated on texts that training has not seen.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame

from tallyfold.llm.common import SPACES, Words, columns, in_slices, mixed, over_texts, record_batch, to_python
from tallyfold.llm.labels import Model, fit, labelled_sample, platt, sigmoid

PER_CLASS = 2500  # rows of each class in the training sample
PASSAGE = 64
PAIRS, PAIR_BITS = 16, 13
HIDDEN, GATES = 16, 8

# Classes of bytes whose shares describe a passage.
CLASSES = (
    range(65, 91), range(97, 123), range(48, 58), range(128, 256), b"#$%&*", b"|<>", b"!?", b".", b",;:",
    b"\n", b"@/\\_=+", b"-'\"()[]{}",
)


def class_table() -> np.ndarray:
    table = np.full(256, len(CLASSES), np.uint8)
    for k, members in enumerate(CLASSES):
        table[list(members)] = k
    return table


CLASS = class_table()
PAIR_CODES = np.random.default_rng(31).normal(0, 1, (1 << PAIR_BITS, PAIRS)).astype(np.float32)
FEATURES = len(CLASSES) + 5 + PAIRS


def passage_features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages, and the first passage of each text. Every text has at least one; the
    passage of a text without words has features 0."""
    w = Words(texts, lower=False)
    per_text = np.maximum(1, -(-w.counts // PASSAGE))
    first = np.concatenate(([0], np.cumsum(per_text)))
    out = np.zeros((first[-1], FEATURES))
    if not len(w.start):
        return out, first
    # Word ranges of the passages that have words, and their byte ranges with the gaps between words.
    doc = np.repeat(np.arange(len(texts)), per_text)
    no = np.arange(first[-1]) - first[doc]
    a = w.first[doc] + no * PASSAGE
    b = np.minimum(a + PASSAGE, w.first[doc + 1])
    full = b > a
    a, b = a[full], b[full]
    lo, hi = w.start[a], w.end[b - 1]
    words, size = b - a, hi - lo

    def total(values: np.ndarray, at: np.ndarray, to: np.ndarray) -> np.ndarray:
        run = np.concatenate((np.zeros((1, *values.shape[1:])), np.cumsum(values, axis=0, dtype=np.float64)))
        return run[to] - run[at]

    kinds = CLASS[w.data]
    for k in range(len(CLASSES)):
        out[full, k] = total(kinds == k, lo, hi) / size
    hashes = w.hashes()
    lengths = np.minimum(w.end - w.start, 40)
    same = np.concatenate(([False], hashes[1:] == hashes[:-1]))
    # Words of a text that it has had before, and words that its passage has had before.
    earlier = seen_before(mixed(hashes + mixed(w.doc.astype(np.uint64))))
    passage = np.repeat(np.flatnonzero(full), words)
    inner = seen_before(mixed(hashes + mixed(passage.astype(np.uint64))))
    for k, values in enumerate((lengths / 10, lengths**2 / 100, same, earlier, inner), len(CLASSES)):
        out[full, k] = total(values, a, b) / words
    data = w.data.astype(np.uint64)
    pair = (mixed(data[:-1] << np.uint64(8) | data[1:]) >> np.uint64(64 - PAIR_BITS)).astype(np.int64)
    pair = np.append(pair, 0)
    inside = ~SPACES[w.data] & np.append(~SPACES[w.data][1:], False)
    weight = np.maximum(1, total(inside, lo, hi))
    for k in range(PAIRS):
        column = np.where(inside, PAIR_CODES[:, k][pair], 0)
        out[full, len(CLASSES) + 5 + k] = total(column, lo, hi) / weight
    return out, first


def seen_before(keys: np.ndarray) -> np.ndarray:
    order = np.argsort(keys, kind="stable")
    out = np.zeros(len(keys), bool)
    out[order[1:]] = keys[order][1:] == keys[order][:-1]
    return out


def attend(x: np.ndarray, first: np.ndarray, m: Model) -> dict[str, np.ndarray]:
    """Hidden passages, attention and the logit of every bag."""
    h = np.tanh(x @ m["encode"] + m["encode_bias"])
    t, g = np.tanh(h @ m["content"]), sigmoid(h @ m["gate"])
    raw = (t * g) @ m["attention"]
    bag = np.repeat(np.arange(len(first) - 1), np.diff(first))
    top = np.maximum.reduceat(raw, first[:-1])
    e = np.exp(raw - top[bag])
    a = e / np.add.reduceat(e, first[:-1])[bag]
    z = np.add.reduceat(a[:, None] * h, first[:-1], axis=0)
    return {"h": h, "t": t, "g": g, "a": a, "z": z, "bag": bag, "logit": z @ m["dense"] + m["bias"]}


def gradients(x: np.ndarray, first: np.ndarray, m: Model, label: np.ndarray, share: np.ndarray) -> Model:
    s = attend(x, first, m)
    err = share * (sigmoid(s["logit"]) - label)
    dz = err[:, None] * m["dense"]
    da = (dz[s["bag"]] * s["h"]).sum(axis=1)
    mean = np.add.reduceat(s["a"] * da, first[:-1])[s["bag"]]
    draw = s["a"] * (da - mean)
    dt = draw[:, None] * m["attention"] * s["g"] * (1 - s["t"] ** 2)
    dg = draw[:, None] * m["attention"] * s["t"] * s["g"] * (1 - s["g"])
    dh = s["a"][:, None] * dz[s["bag"]] + dt @ m["content"].T + dg @ m["gate"].T
    du = dh * (1 - s["h"] ** 2)
    return {
        "dense": s["z"].T @ err, "bias": err.sum(), "attention": (s["t"] * s["g"]).T @ draw,
        "content": s["h"].T @ dt, "gate": s["h"].T @ dg, "encode": x.T @ du, "encode_bias": du.sum(axis=0),
    }


def train(texts: list[bytes], label: np.ndarray, weight: np.ndarray, steps: int = 200) -> Model:
    """Adam over the whole sample; every fifth text is kept for calibration."""
    rng = np.random.default_rng(5)
    m: Model = {
        "encode": rng.normal(0, 0.3, (FEATURES, HIDDEN)), "encode_bias": np.zeros(HIDDEN),
        "content": rng.normal(0, 0.3, (HIDDEN, GATES)), "gate": rng.normal(0, 0.3, (HIDDEN, GATES)),
        "attention": rng.normal(0, 0.3, GATES), "dense": rng.normal(0, 0.3, HIDDEN), "bias": np.array(0.0),
    }
    if len(set(label.tolist())) < 2:  # nothing to tell apart: score 0.5
        m["dense"] *= 0
        return m | {"mean": np.zeros(FEATURES), "scale": np.ones(FEATURES)}
    parts = [passage_features([t]) for t in texts]
    bags = [p for p, _ in parts]
    held = np.arange(len(texts)) % 5 == 4
    own = np.flatnonzero(~held)
    x = np.concatenate([bags[i] for i in own])
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-3
    first = np.concatenate(([0], np.cumsum([len(bags[i]) for i in own])))
    x = np.clip((x - mean) / scale, -8, 8)
    y = label[own]
    share = np.where(y == 1, 0.5 / (y == 1).sum(), 0.5 / (y == 0).sum())
    one, two = {k: np.zeros_like(v) for k, v in m.items()}, {k: np.zeros_like(v) for k, v in m.items()}
    for i in range(1, steps + 1):
        for k, g in gradients(x, first, m, y, share).items():
            g = g + 1e-4 * m[k]
            one[k] = 0.9 * one[k] + 0.1 * g
            two[k] = 0.999 * two[k] + 0.001 * g**2
            m[k] = m[k] - 0.02 * one[k] / (1 - 0.9**i) / (np.sqrt(two[k] / (1 - 0.999**i)) + 1e-8)
    m |= {"mean": mean, "scale": scale}
    logit = np.array([bag_logits([texts[i]], m)[0] for i in np.flatnonzero(held)])
    a, b = platt(logit, label[held], weight[held])
    return m | {"dense": a * m["dense"], "bias": a * m["bias"] + b}


def bag_logits(texts: list[bytes], m: Model) -> np.ndarray:
    x, first = passage_features(texts)
    return attend(np.clip((x - m["mean"]) / m["scale"], -8, 8), first, m)["logit"]


def quality_model(
    docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, learn_from: Column | None = None
) -> Model:
    known = labels if learn_from is None else labels.where(learn_from)
    return fit(labelled_sample(docs, known, "quality", per_class), train)


def quality(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score (calibrated probability of label 1), n_passages, top_attention (largest weight of
    a passage).

    Null and empty texts are one empty passage. Repeated rows give repeated results; other columns are
    ignored. Without labels of both classes the score is 0.5. No shuffle.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            ids, texts = columns(batch, "doc_id", "text")
            schema = pa.schema([
                ("doc_id", ids.type), ("score", pa.float64()), ("n_passages", pa.int64()), ("top_attention", pa.float64()),
            ])
            for lo, hi, part in over_texts(texts):
                x, first = passage_features(part)
                s = attend(np.clip((x - model["mean"]) / model["scale"], -8, 8), first, model)
                top = np.maximum.reduceat(s["a"], first[:-1])
                yield record_batch(schema, ids.slice(lo, hi - lo), sigmoid(s["logit"]), np.diff(first), top)

    return to_python(docs).select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, score double, n_passages long, top_attention double"
    )

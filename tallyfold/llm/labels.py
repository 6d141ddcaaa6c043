"""Labelled samples and models that are trained in one task and used in all.

`labelled_blocks` and `summed` train on every labelled row: blocks of bounded size are read by one task each,
and what tasks found is added up as whole numbers, so that the order of tasks changes nothing.

Otherwise a model is fitted on a bounded sample: of every class the `per_class` rows with the smallest hashes
of doc_id. The ids of the sample are at most twice that many, which bounds the broadcast; the texts
meet in one task, which returns the arrays of the model.
"""

from __future__ import annotations

import io
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyfold.llm.common import columns, small, stored, texts_of, to_python

Model = dict[str, np.ndarray]
Trainer = Callable[[list[bytes], np.ndarray, np.ndarray], Model]


def remainder(column: str, modulus: int) -> Column:
    """crc32 of the value as text, modulo `modulus`."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % modulus


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int) -> DataFrame:
    """doc_id, text, label (0 or 1), weight (rows of the class in `labels` per row of the sample).

    Rows without id or label are left out; a document labelled more than once counts with its
    largest label, one stored more than once with its smallest text.
    """
    known = known_labels(labels, label)
    sizes = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    parts = [
        known.where(F.col("label") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        .withColumn("weight", F.lit(max(1.0, sizes.get(k, 0) / per_class)))
        for k in (0, 1)
    ]
    ids = F.broadcast(parts[0].unionByName(parts[1]))
    found = docs.select("doc_id", "text").join(ids, "doc_id")
    return found.groupBy("doc_id").agg(
        F.min("text").alias("text"), F.max("label").alias("label"), F.max("weight").alias("weight")
    )


def known_labels(labels: DataFrame, label: str) -> DataFrame:
    """doc_id, label (0 or 1): rows without either are left out, of several labels the largest counts."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1))
    return known.groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))


def labelled_blocks(docs: DataFrame, labels: DataFrame, label: str, rows: int) -> DataFrame:
    """block, held, doc_id, text, label of every labelled document, stored: blocks of about `rows` rows by a
    hash of doc_id, of which every fourth row by doc_id is held back. Texts as in `labelled_sample`."""
    known = stored(known_labels(labels, label), "known-labels")
    blocks = max(1, -(-known.count() // rows))
    found = docs.select("doc_id", "text").join(small(known), "doc_id").groupBy("doc_id").agg(
        F.min("text").alias("text"), F.max("label").alias("label")
    )
    found = found.withColumn("block", F.pmod(F.xxhash64("doc_id"), F.lit(blocks)).cast("int"))
    place = F.row_number().over(Window.partitionBy("block").orderBy("doc_id"))
    return stored(found.select("block", (place % 4 == 0).alias("held"), "doc_id", "text", "label"), "labelled")


def summed(found: DataFrame, slots: int) -> DataFrame:
    """Rows (slot, numbers), numbers being the bytes of 64-bit integers, added up per slot."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for slot, numbers in zip(*(c.to_pylist() for c in columns(batch, "slot", "numbers"))):
                value = np.frombuffer(numbers, np.int64)
                total[slot] = total[slot] + value if slot in total else value
        for slot in sorted(total):
            yield slot_batch([slot], [total[slot]])

    tasks = min(slots, found.sparkSession.sparkContext.defaultParallelism)
    return to_python(found).repartition(tasks, "slot").mapInArrow(run, SLOTS)


SLOTS = "slot int, numbers binary"


def slot_batch(slots: list[int], numbers: list[np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(slots, pa.int32()), pa.array([n.tobytes() for n in numbers], pa.binary())], ["slot", "numbers"]
    )


def packed(model: Model) -> bytes:
    out = io.BytesIO()
    np.savez(out, **model)
    return out.getvalue()


def fit(sample: DataFrame, train: Trainer) -> Model:
    """Runs `train(texts, labels, weights)` over the sample in order of doc_id, in one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts: list[bytes] = []
        label: list[int] = []
        weight: list[float] = []
        for batch in batches:
            text, y, w = columns(batch, "text", "label", "weight")
            texts += texts_of(text)
            label += y.to_pylist()
            weight += w.to_pylist()
        model = train(texts, np.array(label, np.float64), np.array(weight, np.float64))
        yield pa.RecordBatch.from_pydict({"model": pa.array([packed(model)], pa.binary())})

    ordered = sample.repartition(1).sortWithinPartitions("doc_id")
    rows = ordered.mapInArrow(run, "model binary").collect()
    # No row at all: there was no partition to train in.
    data = bytes(rows[0]["model"]) if rows else packed(train([], np.zeros(0), np.zeros(0)))
    return dict(np.load(io.BytesIO(data)))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def platt(logit: np.ndarray, label: np.ndarray, weight: np.ndarray, steps: int = 60) -> tuple[float, float]:
    """Slope and intercept that calibrate a score, by Newton steps with a little shrinkage."""
    if len(set(label.tolist())) < 2:
        return 1.0, 0.0
    a, b = 1.0, 0.0
    for _ in range(steps):
        p = sigmoid(a * logit + b)
        g = np.array([(weight * (p - label) * logit).sum() + 0.1 * (a - 1), (weight * (p - label)).sum() + 0.1 * b])
        v = weight * p * (1 - p)
        h = np.array([[(v * logit**2).sum() + 0.1, (v * logit).sum()], [(v * logit).sum(), v.sum() + 0.1]])
        step = np.clip(np.linalg.solve(h, g), -2, 2)
        a, b = max(1e-3, a - step[0]), b - step[1]
    return float(a), float(b)

"""Toxicity: a convolutional text classifier trained in numpy.

A word is the sum of hashed embeddings of itself and of its first 4 to 7 bytes, so that inflected
forms share strength. Filters of several widths run over the words: narrow ones with a weight vector
per position, wide ones that average their window. Every filter is reduced to its maximum over the
text and a logistic layer reads the maxima. Embeddings start with the smoothed log odds of their
bucket, and all layers are trained with Adagrad; the maximum sends gradients to one window only, so
a step touches few embeddings.

All labelled documents are learned from, in blocks of bounded size. The log odds are counted over all of them,
every block then trains from the same start, and a parameter becomes the mean of the blocks that changed it
(parallel stochastic gradient with one average at the end).

The slope is calibrated on texts that training has not seen, and the intercept by language. The
language is guessed from function words of the text; the language column is no input.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.llm.common import (
    MARKS, Words, columns, handing_back, in_slices, mixed, over_texts, record_batch, span_hashes, texts_of,
    to_python,
)
from tallyfold.llm.labels import SLOTS, Model, labelled_blocks, platt, sigmoid, slot_batch, summed

PER_CLASS = 2500  # half the rows of a block
GRID = 4096  # calibration counts logits in steps of one part of this
UNIT = float(1 << 40)  # parameters are added up in whole parts of this
CHUNK = 512  # buckets in one row of a sum
BITS = 16
DIM = 6
FILTERS = 4
NARROW = (1, 2, 3)
WIDE = (24, 96)
PREFIXES = (4, 5, 6, 7)

# Function words that tell the languages apart.
FUNCTION_WORDS = {
    "en": ("the", "of", "and", "to", "is", "was", "that", "for", "with"),
    "fr": ("le", "les", "des", "et", "une", "dans", "que", "qui", "pour", "du", "au"),
    "de": ("der", "die", "und", "den", "das", "ist", "von", "mit", "ein", "zu"),
    "es": ("el", "los", "las", "y", "del", "por", "con", "es", "al", "para"),
}
LANGUAGES = (*FUNCTION_WORDS, "other")


def word_codes(w: Words) -> np.ndarray:
    """Buckets of every word: itself and its prefixes, one row each; kinds have separate buckets."""
    ends = [w.end] + [np.minimum(w.end, w.start + n) for n in PREFIXES]
    shift = np.uint64(64 - BITS)
    return np.stack([
        (mixed(span_hashes(w.data, w.start, e) + np.uint64(k * 0x51ED27)) >> shift).astype(np.int64)
        for k, e in enumerate(ends)
    ])


def language_table() -> tuple[np.ndarray, np.ndarray]:
    hashes, language = [], []
    for k, words in enumerate(FUNCTION_WORDS.values()):
        hashes.append(Words([" ".join(words).encode()], blank=MARKS).hashes())
        language += [k] * len(words)
    order = np.argsort(flat := np.concatenate(hashes))
    return flat[order], np.array(language)[order]


def languages(w: Words, table: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Index into LANGUAGES per text: the one with the most function words, `other` without any."""
    known, language = table
    h = w.hashes()
    at = np.minimum(np.searchsorted(known, h), len(known) - 1)
    hit = known[at] == h
    n = len(w.counts)
    votes = np.bincount(w.doc[hit] * len(LANGUAGES) + language[at[hit]], minlength=n * len(LANGUAGES))
    votes = votes.reshape(n, len(LANGUAGES))
    return np.where(votes.any(axis=1), votes.argmax(axis=1), len(LANGUAGES) - 1)


def embed(codes: np.ndarray, table: np.ndarray) -> np.ndarray:
    out = table[0][codes[0]]
    for k in range(1, len(codes)):
        out = out + table[k][codes[k]]
    return out


def windows(x: np.ndarray, first: np.ndarray, model: Model) -> Iterator[tuple[str, int, np.ndarray]]:
    """For each filter width the responses at every window start; texts are padded with zeros."""
    n = len(x)
    left = np.repeat(first[1:], np.diff(first)) - np.arange(n)  # words to the end of the text
    for width in NARROW:
        z = x @ model[f"w{width}"][0]
        for j in range(1, width):
            z[: n - j] += np.where((left[: n - j] > j)[:, None], x[j:] @ model[f"w{width}"][j], 0)
        yield f"w{width}", width, z
    run = np.concatenate((np.zeros((1, x.shape[1]), x.dtype), np.cumsum(x, axis=0)))
    for width in WIDE:
        stop = np.arange(n) + np.minimum(left, width)
        yield f"w{width}", width, (run[stop] - run[:n]) / width @ model[f"w{width}"][0]


def forward(codes: np.ndarray, first: np.ndarray, model: Model) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """Maxima per text (texts x filters of all widths) and the windows they come from.
    Texts without words have maxima 0."""
    counts = np.diff(first)
    full = np.flatnonzero(counts)
    pooled = np.zeros((len(counts), FILTERS * (len(NARROW) + len(WIDE))))
    best: dict[str, np.ndarray] = {}
    if not len(full):
        return pooled, best
    x = embed(codes, model["table"]).astype(np.float64)
    for k, (name, _, z) in enumerate(windows(x, first, model)):
        top = np.maximum.reduceat(z, first[:-1][full], axis=0)
        pooled[full, k * FILTERS : (k + 1) * FILTERS] = np.maximum(top, 0)
        best[name] = z
    return pooled, best


def logits(codes: np.ndarray, first: np.ndarray, model: Model) -> np.ndarray:
    pooled, _ = forward(codes, first, model)
    return pooled @ model["dense"] + model["bias"]


def log_odds(codes: list[np.ndarray], label: np.ndarray) -> np.ndarray:
    """Smoothed log odds of each bucket from the share of texts of a class that have it."""
    seen = np.zeros((2, 1 + len(PREFIXES), 1 << BITS), np.int64)
    for c, y in zip(codes, label.astype(int)):
        count_buckets(seen, c, y)
    return odds_of(seen, np.array([(label == 0).sum(), (label == 1).sum()]))


def count_buckets(seen: np.ndarray, codes: np.ndarray, label: int) -> None:
    for k in range(len(codes)):
        seen[label, k, np.unique(codes[k])] += 1


def odds_of(seen: np.ndarray, n: np.ndarray) -> np.ndarray:
    rate = (seen + 0.5) / (n[:, None, None] + 1)
    odds = np.log(rate[1] / (1 - rate[1])) - np.log(rate[0] / (1 - rate[0]))
    # Rare buckets say little: shrink by how often they were seen at all.
    return odds * seen.sum(axis=0) / (seen.sum(axis=0) + 6)


def initial(odds: np.ndarray) -> Model:
    rng = np.random.default_rng(7)
    table = rng.normal(0, 0.01, (1 + len(PREFIXES), 1 << BITS, DIM)).astype(np.float32)
    table[:, :, 0] = odds / (1 + len(PREFIXES))
    model: Model = {"table": table}
    for width in NARROW:
        model[f"w{width}"] = rng.normal(0, 0.1, (width, DIM, FILTERS))
        model[f"w{width}"][:, 0] += 1 / width
    for width in WIDE:
        model[f"w{width}"] = rng.normal(0, 0.1, (1, DIM, FILTERS))
        model[f"w{width}"][:, 0] += 5
    model["dense"] = np.full(FILTERS * (len(NARROW) + len(WIDE)), 0.1)
    model["bias"] = np.array(-1.0)
    return model


def step(
    model: Model, past: Model, codes: np.ndarray, first: np.ndarray, label: np.ndarray,
    share: np.ndarray, rate: float, embed_rate: float,
) -> None:
    pooled, responses = forward(codes, first, model)
    err = share * (sigmoid(pooled @ model["dense"] + model["bias"]) - label)
    d_pooled = err[:, None] * model["dense"] * (pooled > 0)
    counts = np.diff(first)
    n = int(first[-1])
    grads: Model = {"dense": pooled.T @ err + 1e-4 * model["dense"], "bias": err.sum()}
    at_word, grad_word = [], []
    x = embed(codes, model["table"]).astype(np.float64) if n else np.zeros((0, DIM))
    rows = np.flatnonzero(counts)
    for k, (name, width) in enumerate([(f"w{v}", v) for v in NARROW + WIDE]):
        weight = model[name]
        grad = np.zeros_like(weight)
        for f in range(FILTERS):
            z = responses[name][:, f] if n else np.zeros(0)
            for r in rows:
                d = d_pooled[r, k * FILTERS + f]
                if d == 0:
                    continue
                a = int(first[r] + z[first[r] : first[r + 1]].argmax())
                b = min(a + width, int(first[r + 1]))
                if width in NARROW:
                    grad[: b - a, :, f] += d * x[a:b]
                    g = d * weight[: b - a, :, f]
                else:
                    grad[0, :, f] += d * x[a:b].sum(axis=0) / width
                    g = np.broadcast_to(d / width * weight[0, :, f], (b - a, DIM))
                at_word.append(np.arange(a, b))
                grad_word.append(g)
        grads[name] = grad
    for name, g in grads.items():
        past[name] = past.get(name, 0) + g**2
        model[name] = model[name] - rate * g / np.sqrt(past[name] + 1e-10)
    if at_word:
        at, g = np.concatenate(at_word), np.concatenate(grad_word)
        for k in range(len(codes)):
            bucket, where = np.unique(codes[k][at], return_inverse=True)
            total = np.stack([np.bincount(where, g[:, d], len(bucket)) for d in range(DIM)], axis=1)
            past["table"][k, bucket] += total**2
            model["table"][k, bucket] -= (embed_rate * total / np.sqrt(past["table"][k, bucket] + 1e-10)).astype(np.float32)


def read_text(text: bytes, table: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, int]:
    """The buckets of a text's words, and its language."""
    w = Words([text], blank=MARKS)
    return word_codes(w).astype(np.int32), int(languages(w, table)[0])


def untrained() -> Model:
    """Nothing to tell apart: score 0."""
    model = initial(np.zeros((1 + len(PREFIXES), 1 << BITS)))
    return model | {"dense": 0 * model["dense"], "slope": np.array(1.0), "by_language": np.full(len(LANGUAGES), -40.0)}


def trained(
    model: Model, codes: list[np.ndarray], label: np.ndarray, rates: np.ndarray, epochs: int = 4, batch: int = 32
) -> Model:
    """`model` after `epochs` passes over these texts; `rates`: share of each class among all texts."""
    past: Model = {"table": np.zeros(model["table"].shape)}
    rng = np.random.default_rng(11)
    balance = 0.5 / rates[label.astype(int)]
    for _ in range(epochs):
        order = rng.permutation(len(codes))
        for lo in range(0, len(order), batch):
            some = order[lo : lo + batch]
            first = np.concatenate(([0], np.cumsum([codes[i].shape[1] for i in some])))
            step(
                model, past, np.concatenate([codes[i] for i in some], axis=1), first, label[some],
                balance[some] / len(some), 0.05, 0.002,
            )
    return model


def calibrated(logit: np.ndarray, label: np.ndarray, weight: np.ndarray, language: np.ndarray) -> Model:
    """Slope, and intercept of every language with 40 texts or more of both classes."""
    slope, intercept = platt(logit, label, weight)
    by = np.full(len(LANGUAGES), intercept)
    for k in range(len(LANGUAGES)):
        some = language == k
        if weight[some].sum() >= 40 and len(set(label[some].tolist())) == 2:
            by[k] = best_intercept(slope * logit[some], label[some], weight[some], intercept)
    return {"slope": np.array(slope), "by_language": by}


def train(texts: list[bytes], label: np.ndarray, weight: np.ndarray, epochs: int = 4, batch: int = 32) -> Model:
    """One block on its own. Every fourth text is kept for calibration."""
    if len(set(label.tolist())) < 2:
        return untrained()
    table = language_table()
    codes, language = zip(*[read_text(t, table) for t in texts])
    held = np.arange(len(texts)) % 4 == 3
    own = [c for c, h in zip(codes, held) if not h]
    rates = np.array([(label[~held] == 0).mean(), (label[~held] == 1).mean()])
    model = trained(initial(log_odds(own, label[~held])), own, label[~held], rates, epochs, batch)
    logit = np.array([logits(c, np.array([0, c.shape[1]]), model)[0] for c in codes])
    return model | calibrated(logit[held], label[held], weight[held], np.array(language)[held])


def best_intercept(score: np.ndarray, label: np.ndarray, weight: np.ndarray, prior: float) -> float:
    """The intercept with the fewest weighted errors at 0.5; among equal ones that nearest `prior`."""
    at = np.argsort(score, kind="stable")
    order = score[at]
    cuts = np.concatenate(([prior], -(order[1:] + order[:-1]) / 2, [1 - order[0], -1 - order[-1]]))
    missed = np.concatenate(([0], np.cumsum(weight[at] * (label[at] == 1))))  # ones below a place
    alarms = np.concatenate(([0], np.cumsum(weight[at] * (label[at] != 1))))  # zeros below a place
    place = np.searchsorted(order, -cuts)
    errors = missed[place] + alarms[-1] - alarms[place]
    return float(min(zip(errors, np.abs(cuts - prior), cuts))[2])


def counted(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """In how many texts of each class a bucket occurs, and the number of texts of each class."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, n = np.zeros((2, 1 + len(PREFIXES), 1 << BITS), np.int64), np.zeros(2, np.int64)
        for batch in in_slices(batches):
            texts, label = columns(batch, "text", "label")
            for text, y in zip(texts_of(texts), label.to_pylist()):
                count_buckets(seen, word_codes(Words([text], blank=MARKS)), y)
                n[y] += 1
        if n.any():
            for slot, part in enumerate(seen.reshape(-1, CHUNK)):
                if part.any():
                    yield slot_batch([slot], [part])
            yield slot_batch([-1], [n])

    seen, n = np.zeros((2, 1 + len(PREFIXES), 1 << BITS), np.int64), np.zeros(2, np.int64)
    parts = seen.reshape(-1, CHUNK)
    found = to_python(rows).select("text", "label").mapInArrow(handing_back(run), SLOTS)
    for row in summed(found, len(parts)).toLocalIterator():
        (n if row["slot"] < 0 else parts[row["slot"]])[:] = np.frombuffer(row["numbers"], np.int64)
    return seen, n


def averaged(rows: DataFrame, odds: np.ndarray, rates: np.ndarray) -> Model:
    """Every block is trained from the same start, by one task. A row of the table becomes the start plus the
    mean change in the blocks that changed it, other parameters their mean over all blocks."""
    start = initial(odds)
    small = sorted(k for k in start if k != "table")
    shape = (-1, CHUNK, DIM + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = language_table()
        change = np.zeros((*start["table"].shape[:2], DIM + 1), np.int64)
        flat = np.zeros(1 + sum(start[k].size for k in small), np.int64)
        codes: list[np.ndarray] = []
        label: list[int] = []

        def learn() -> None:
            model = trained(initial(odds), codes, np.array(label, np.float64), rates)
            for k, at in enumerate(model["table"]):
                d = at.astype(np.float64) - start["table"][k]
                change[k, :, :DIM] += np.rint(d * UNIT).astype(np.int64)
                change[k, :, DIM] += d.any(axis=1)
            flat[:] += np.concatenate(([1], np.rint(np.concatenate([model[k].ravel() for k in small]) * UNIT))).astype(np.int64)
            codes.clear(), label.clear()

        block = None
        for batch in in_slices(batches):
            blocks, texts, y = columns(batch, "block", "text", "label")
            for b, text, one in zip(blocks.to_pylist(), texts_of(texts), y.to_pylist()):
                if codes and b != block:
                    learn()
                block = b
                codes.append(read_text(text, table)[0])
                label.append(one)
        if codes:
            learn()
        if flat[0]:
            for slot, part in enumerate(change.reshape(shape)):
                if part.any():
                    yield slot_batch([slot], [part])
            yield slot_batch([-1], [flat])

    blocks = rows.select("block").distinct().count()
    ordered = rows.select("block", "doc_id", "text", "label").repartition(blocks, "block").sortWithinPartitions("block", "doc_id")
    model, table = dict(start), start["table"].reshape(-1, CHUNK, DIM).copy()
    for row in summed(to_python(ordered).mapInArrow(handing_back(run), SLOTS), len(table)).toLocalIterator():
        numbers = np.frombuffer(row["numbers"], np.int64)
        if row["slot"] >= 0:
            part = numbers.reshape(shape[1:])
            table[row["slot"]] += (part[:, :DIM] / UNIT / np.maximum(part[:, DIM:], 1)).astype(np.float32)
            continue
        lo = 1
        for k in small:
            model[k] = (numbers[lo : lo + start[k].size] / UNIT / numbers[0]).reshape(start[k].shape)
            lo += start[k].size
    return model | {"table": table.reshape(start["table"].shape)}


def calibration(rows: DataFrame, model: Model) -> Model:
    """From the logits of all held texts, counted on a fixed grid per language and class."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = language_table()
        schema = pa.schema([("language", pa.int32()), ("label", pa.int32()), ("at", pa.int32())])
        for batch in in_slices(batches):
            texts, label = columns(batch, "text", "label")
            for lo, hi, part in over_texts(texts):
                w = Words(part, blank=MARKS)
                at = np.rint(np.clip(logits(word_codes(w), w.first, model), -40, 40) * GRID)
                yield record_batch(schema, languages(w, table), label.slice(lo, hi - lo), at.astype(np.int32))

    def last(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = pa.Table.from_batches(list(batches))
        language, label, at, n = (found[c].to_numpy() for c in ("language", "label", "at", "n"))
        made = calibrated(at / GRID, label.astype(float), n.astype(float), language)
        yield pa.RecordBatch.from_pydict({"numbers": pa.array([[float(made["slope"]), *made["by_language"]]], pa.list_(pa.float64()))})

    logit = to_python(rows).select("text", "label").mapInArrow(handing_back(run), "language int, label int, at int")
    cells = logit.groupBy("language", "label", "at").agg(F.count(F.lit(1)).alias("n"))
    # The cells of the grid are few however many texts there are.
    ordered = cells.repartition(1).sortWithinPartitions("language", "label", "at")
    done = ordered.mapInArrow(last, "numbers array<double>").collect()
    numbers = np.array(done[0]["numbers"] if done else [1.0] + [0.0] * len(LANGUAGES))
    return {"slope": np.array(numbers[0]), "by_language": numbers[1:]}


def toxicity_model(
    docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, learn_from: Column | None = None
) -> Model:
    """Learned from every labelled document, in blocks of twice `per_class` rows."""
    known = labels if learn_from is None else labels.where(learn_from)
    rows = labelled_blocks(docs, known, "toxic", 2 * per_class)
    own = rows.where(~F.col("held"))
    seen, n = counted(own)
    if not n.all():
        return untrained()
    model = averaged(own, odds_of(seen, n), n / n.sum())
    return model | calibration(rows.where(F.col("held")), model)


def scores(texts: list[bytes], model: Model, table: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    w = Words(texts, blank=MARKS)
    language = languages(w, table)
    return sigmoid(float(model["slope"]) * logits(word_codes(w), w.first, model) + model["by_language"][language]), language


def toxicity(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score, guessed_lang. The threshold of every language is at 0.5.

    Null and empty texts have a score as well (no word, language `other`). Repeated rows give
    repeated results; other columns are ignored. Without labels of both classes scores are 0. No shuffle.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = language_table()
        for batch in in_slices(batches):
            ids, texts = columns(batch, "doc_id", "text")
            schema = pa.schema([("doc_id", ids.type), ("score", pa.float64()), ("guessed_lang", pa.string())])
            for lo, hi, part in over_texts(texts):
                score, language = scores(part, model, table)
                yield record_batch(schema, ids.slice(lo, hi - lo), score, [LANGUAGES[k] for k in language])

    return to_python(docs).select("doc_id", "text").mapInArrow(handing_back(run), f"doc_id {kind}, score double, guessed_lang string")


def keep_clean(docs: DataFrame, model: Model, limit: float = 0.5) -> DataFrame:
    """The documents whose score is below `limit`; columns as they are."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = language_table()
        for batch in in_slices(batches):
            (texts,) = columns(batch, "text")
            ok = [scores(part, model, table)[0] < limit for _, _, part in over_texts(texts)]
            yield batch.filter(pa.array(np.concatenate(ok) if ok else [], pa.bool_()))

    return to_python(docs).mapInArrow(handing_back(run), docs.schema)

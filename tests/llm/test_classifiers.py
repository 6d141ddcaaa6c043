"""Held-out accuracy and odd rows of the trained classifiers."""

import random

import numpy as np
import pytest

from tallyfold.llm import passages, toxicity
from tallyfold.llm.labels import labelled_sample, platt, remainder, sigmoid


@pytest.fixture(scope="module")
def wide(spark, sf_dir):
    """Ten times the rows of the small tables, where they exist."""
    folder = sf_dir.replace("sf0.001", "sf0.01")
    return tuple(spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))


def auc(good, bad):
    a, b = np.array(good)[:, None], np.array(bad)[None]
    return float(np.mean((a > b) + 0.5 * (a == b)))


def test_word_order_decides():
    """Both classes have the same words; only a filter that was trained tells which of two comes first."""
    def texts(n, seed):
        r, out = random.Random(seed), []
        for i in range(n):
            words = r.choices([f"word{k}" for k in range(200)], k=r.randint(10, 40))
            at = r.randrange(len(words) + 1)
            words[at:at] = ["red", "stone"] if i % 2 else ["stone", "red"]
            out.append(" ".join(words).encode())
        return out, np.arange(n) % 2

    (own, label), (others, truth) = texts(1200, 1), texts(400, 2)

    def quality(epochs):
        model = toxicity.train(own, label, np.ones(len(own)), epochs=epochs)
        score, _ = toxicity.scores(others, model, toxicity.language_table())
        return np.mean((score >= 0.5) == (truth == 1)), auc(score[truth == 1], score[truth == 0])

    right, ranked = quality(4)
    assert right > 0.9 and ranked > 0.95
    start, unranked = quality(0)
    assert start < 0.6 and unranked < 0.6


def test_one_passage_decides():
    """Bad texts have one bad passage among many, and attention must find it."""
    def texts(n, seed):
        r, out, where = random.Random(seed), [], []
        for i in range(n):
            passages_ = [
                ["".join(r.choices("abcdefghijklmnop", k=r.randint(2, 9))) for _ in range(passages.PASSAGE)]
                for _ in range(r.randint(8, 30))
            ]
            bad = r.randrange(len(passages_))
            if i % 2 == 0:
                passages_[bad] = [w if r.random() < 0.5 else "$#%&" for w in passages_[bad]]
            out.append(" ".join(" ".join(p) for p in passages_).encode())
            where.append(bad)
        return out, np.arange(n) % 2, where

    own, label, _ = texts(300, 1)
    others, truth, where = texts(120, 2)
    model = passages.train(own, label, np.ones(len(own)))

    def right(m):
        return np.mean((passages.bag_logits(others, m) >= 0) == (truth == 1))

    assert right(model) > 0.95
    assert right(model | {"attention": 0 * model["attention"]}) < 0.7  # every passage alike
    x, first = passages.passage_features(others)
    a = passages.attend(np.clip((x - model["mean"]) / model["scale"], -8, 8), first, model)["a"]
    times = [a[first[i] + where[i]] * (first[i + 1] - first[i]) for i in range(len(others)) if truth[i] == 0]
    assert np.median(times) > 5  # of an equal share


def test_scores_are_those_of_a_plain_evaluation():
    """Both models, text by text and word by word."""
    r = random.Random(8)
    texts = [" ".join(r.choices(["the", "red", "Stone!", "a", "de", "é", "$#", "x"], k=k)).encode() for k in (0, 1, 2, 3, 40, 70, 150)]
    label = np.arange(len(texts)) % 2
    m = toxicity.train(texts * 9, np.tile(label, 9), np.ones(63), epochs=1)
    got, _ = toxicity.scores(texts, m, toxicity.language_table())
    for text, score in zip(texts, got):
        w = toxicity.Words([text], blank=toxicity.MARKS)
        x = toxicity.embed(toxicity.word_codes(w), m["table"]).astype(float)
        pooled = []
        for width in toxicity.NARROW:
            z = [sum(x[i + j] @ m[f"w{width}"][j] for j in range(width) if i + j < len(x)) for i in range(len(x))]
            pooled += list(np.maximum(np.max(z, axis=0), 0)) if len(x) else [0.0] * toxicity.FILTERS
        for width in toxicity.WIDE:
            z = [x[i : i + width].sum(axis=0) / width @ m[f"w{width}"][0] for i in range(len(x))]
            pooled += list(np.maximum(np.max(z, axis=0), 0)) if len(x) else [0.0] * toxicity.FILTERS
        language = toxicity.languages(w, toxicity.language_table())[0]
        logit = m["slope"] * (np.array(pooled) @ m["dense"] + m["bias"]) + m["by_language"][language]
        assert abs(score - sigmoid(np.array([logit]))[0]) < 1e-6
    q = passages.train(texts * 9, np.tile(label, 9), np.ones(63), steps=20)
    for text, logit in zip(texts, passages.bag_logits(texts, q)):
        x, _ = passages.passage_features([text])
        h = [np.tanh(np.clip((v - q["mean"]) / q["scale"], -8, 8) @ q["encode"] + q["encode_bias"]) for v in x]
        raw = [(np.tanh(v @ q["content"]) * sigmoid(v @ q["gate"])) @ q["attention"] for v in h]
        a = np.exp(np.array(raw) - max(raw))
        z = sum(share * v for share, v in zip(a / a.sum(), h))
        assert abs(logit - (z @ q["dense"] + q["bias"])) < 1e-9


@pytest.mark.parametrize("module, make, score, label, modulus, held, limit, least", [
    (passages, "quality_model", "quality", "quality", 4, 2, 0.7, 0.95),
    (toxicity, "toxicity_model", "toxicity", "toxic", 5, 0, 0.5, 0.9),
])
def test_held_out_accuracy(wide, module, make, score, label, modulus, held, limit, least):
    docs, labels = wide
    away = remainder("doc_id", modulus) == held
    model = getattr(module, make)(docs, labels, learn_from=~away)
    rows = getattr(module, score)(docs, model).join(labels.where(away), "doc_id").collect()
    right = np.mean([(r.score >= limit) == (r[label] == 1) for r in rows])
    assert len(rows) > 50 and right >= least
    # By class, as one of them holds nine rows in ten.
    good, bad = ([r.score for r in rows if r[label] == k] for k in (1, 0))
    assert auc(good, bad) >= 0.8
    assert np.mean([x >= limit for x in good]) >= 0.5 and np.mean([x < limit for x in bad]) >= 0.9
    assert all(0 <= r.score <= 1 for r in rows)


def test_odd_rows_and_no_labels(spark, wide, odd_docs, no_docs, no_labels):
    docs, labels = wide
    for module, make, score, empty in (
        (passages, "quality_model", "quality", 0.5), (toxicity, "toxicity_model", "toxicity", 0.0),
    ):
        model = getattr(module, make)(docs, labels, per_class=60)
        rows = getattr(module, score)(odd_docs, model).collect()
        assert len(rows) == odd_docs.count() and all(0 <= r.score <= 1 for r in rows)
        assert getattr(module, score)(no_docs, model).count() == 0
        none = getattr(module, make)(docs, no_labels)
        assert all(abs(r.score - empty) < 1e-9 for r in getattr(module, score)(odd_docs, none).collect())
    kept = toxicity.keep_clean(odd_docs, none)
    assert kept.columns == odd_docs.columns and kept.count() == odd_docs.count()
    assert toxicity.keep_clean(no_docs, none).count() == 0


def test_sample_is_bounded_and_clean(spark):
    docs = spark.createDataFrame([(i, f"t{i}") for i in range(50)] + [(3, "other")], "doc_id long, text string")
    rows = [(i, i % 2) for i in range(50)] + [(None, 1), (7, None), (8, 5), (3, 0)]
    labels = spark.createDataFrame(rows, "doc_id long, toxic int").selectExpr("*", "1 AS weight", "'x' AS text")
    sample = labelled_sample(docs, labels, "toxic", 10).collect()
    assert len(sample) == 20 and len({r.doc_id for r in sample}) == 20
    assert {r.weight for r in sample} == {2.5}
    assert all(r.label == r.doc_id % 2 for r in sample)
    again = labelled_sample(docs.repartition(7), labels.repartition(3), "toxic", 10).collect()
    assert sorted(sample) == sorted(again)


def test_gradients_of_the_attention_model():
    rng = np.random.default_rng(0)
    x, first = rng.normal(size=(9, passages.FEATURES)), np.array([0, 2, 3, 9])
    shape = {"encode": (passages.FEATURES, 4), "encode_bias": (4,), "content": (4, 3), "gate": (4, 3), "attention": (3,), "dense": (4,), "bias": ()}
    m = {k: rng.normal(0, 0.5, s) for k, s in shape.items()}
    label, share = np.array([1.0, 0, 1]), np.array([0.2, 0.5, 0.3])

    def loss(m):
        p = sigmoid(passages.attend(x, first, m)["logit"])
        return -(share * np.log(np.where(label == 1, p, 1 - p))).sum()

    grads = passages.gradients(x, first, m, label, share)
    for k, g in grads.items():
        d = rng.normal(size=shape[k])
        up, down = ({**m, k: m[k] + s * 1e-6 * d} for s in (1, -1))
        assert np.isclose((loss(up) - loss(down)) / 2e-6, (np.asarray(g) * d).sum(), atol=1e-6)


def test_calibration_restores_the_rate():
    rng = np.random.default_rng(1)
    z = rng.normal(size=4000)
    y = (rng.random(4000) < sigmoid(2 * z - 1)).astype(float)
    a, b = platt(z, y, np.ones(4000))
    assert abs(a - 2) < 0.3 and abs(b + 1) < 0.2


def test_languages_by_function_words():
    from tallyfold.llm.common import MARKS, Words

    texts = ["The cat is of the house", "le chat et les chiens dans une maison", "der Hund und die Katze", "el perro y los gatos", "zzz", ""]
    found = toxicity.languages(Words([t.encode() for t in texts], blank=MARKS), toxicity.language_table())
    assert [toxicity.LANGUAGES[k] for k in found] == ["en", "fr", "de", "es", "other", "other"]


def test_toxicity_learns_from_every_labelled_row(spark):
    """One text in a hundred has the only sign of its class, and each block sees few of them."""
    r = random.Random(5)
    rows = [(i, " ".join(r.choices([f"word{k}" for k in range(60)], k=12) + (["vile", "slur"] if i % 5 == 0 else []))) for i in range(1500)]
    rows = [(i, text + (" rareword" if i % 100 == 5 else "")) for i, text in rows]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i, _ in rows], "doc_id long, toxic int")
    blocks = toxicity.labelled_blocks(docs, labels, "toxic", 200)
    assert blocks.select("doc_id").distinct().count() == blocks.count() == 1500
    assert blocks.select("block").distinct().count() == 8
    seen, n = toxicity.counted(blocks.where("NOT held"))
    own = {x.doc_id for x in blocks.where("NOT held").collect()}
    assert n.tolist() == [sum(i % 5 != 0 for i in own), sum(i % 5 == 0 for i in own)] and n.sum() < 1200
    code = toxicity.word_codes(toxicity.Words([b"rareword"], blank=toxicity.MARKS))[0, 0]
    assert seen[1, 0, code] == sum(i % 100 == 5 for i in own)
    small = toxicity.toxicity_model(docs, labels, per_class=100)
    again = toxicity.toxicity_model(docs.repartition(5), labels.repartition(3), per_class=100)
    assert all(np.array_equal(small[k], again[k]) for k in small)
    score = {x.doc_id: x.score for x in toxicity.toxicity(docs, small).collect()}
    assert np.mean([(score[i] >= 0.5) == (i % 5 == 0) for i in score]) > 0.98

"""The stages one after the other against plain versions of their decisions."""

import corpus_pipeline
from tallyfold.llm import decontaminate, packing, secrets, toxicity

from .test_decontaminate import brute as found_items
from .test_overlap import brute as connected


def test_every_stage_takes_effect(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "ngram_jaccard_join", "decontamination", "secret_scan", "best_fit_packing"]
    steps = [docs]
    for name in list(stages)[:-1]:
        steps.append(corpus_pipeline.stored(stages[name](spark, steps[-1], sf_dir), name))
        assert steps[-1].columns == docs.columns and steps[-1].schema == docs.schema
    start, clean, single, fresh, last = ({r.doc_id: r.text for r in s.collect()} for s in steps)

    model = toxicity.toxicity_model(docs, labels)
    score = {r.doc_id: r.score for r in toxicity.toxicity(docs, model).collect()}
    assert set(clean) == {i for i in start if score[i] < 0.5}
    assert set(single) == {c for _, c in connected(clean.items(), 5, 80).values()}
    words = spark.createDataFrame(list(single.items()), "doc_id long, text string")
    split = lambda df, k: [(r[0], r[1]) for r in df.select(k, decontaminate.words_of(df.text)).collect()]
    items = split(spark.read.parquet(f"{sf_dir}/benchmark.parquet"), "item_id")
    bad = found_items([d for d in split(words, "doc_id") if len(d[1]) < 400], items, 7)
    assert not {d for d, _ in bad} & set(fresh) and len(fresh) > 0.8 * len(single)
    found = secrets.automaton()
    assert last == {i: secrets.redacted(t, found, "[SECRET]") for i, t in fresh.items()}
    assert not any(secrets.spans(t, found) for t in last.values())

    rows = corpus_pipeline.run(spark, sf_dir).collect()
    assert {r.doc_id for r in rows} == set(last)
    cut = {(r.doc_id, r.piece): r.ids_crc32 for r in packing.pieces(steps[-1]).collect()}
    assert {(r.doc_id, r.piece): r.ids_crc32 for r in rows} == cut


def test_odd_rows_pass_through(spark, odd_docs, no_docs, sf_dir):
    for start in (odd_docs, no_docs):
        docs = start
        for name, stage in corpus_pipeline.STAGES:
            docs = corpus_pipeline.stored(stage(spark, docs, sf_dir), name)
        assert (docs.count() == 0) == (start is no_docs)

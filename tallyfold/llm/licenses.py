"""License scan by diagonal voting.

All word k-grams of all texts are hashed; those whose hash some template has are kept with their
position and words, and Spark joins them to the template positions. Every pair votes for the diagonal
(position in the text minus position in the template). Phrases need every vote of one diagonal, which
is an occurrence of the phrase. For longer notices neighbouring diagonals are merged, so that words
inserted or left out do not break a span; all diagonals of a span lie close together, so it is hardly
longer than its template and its words come in the same order. A span counts if its votes, verified
word by word in the join, cover enough of the template.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyfold.llm.common import (
    MARKS, Words, columns, in_slices, inside, over_texts, record_batch, small, stored, to_python, window_hashes,
)

K = 3
MAX_SHIFT = 6  # words by which neighbouring diagonals may differ
MAX_DRIFT = 12  # words by which any two diagonals of a span may differ
MIN_COVERAGE = 0.6

# Phrases, and notices of public licenses as words.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
NOTICES = {
    "mit": "permission is hereby granted free of charge to any person obtaining a copy of this software "
    "and associated documentation files the software to deal in the software without restriction",
    "apache-2": "licensed under the apache license version 2 0 the license you may not use this file "
    "except in compliance with the license you may obtain a copy of the license at",
    "bsd": "redistribution and use in source and binary forms with or without modification are "
    "permitted provided that the following conditions are met",
    "gpl": "this program is free software you can redistribute it and or modify it under the terms of "
    "the gnu general public license as published by the free software foundation",
    "mpl-2": "this source code form is subject to the terms of the mozilla public license v 2 0 if a "
    "copy of the mpl was not distributed with this file you can obtain one at",
    "isc": "permission to use copy modify and or distribute this software for any purpose with or "
    "without fee is hereby granted provided that the above copyright notice",
}


def hashed(text: str) -> np.ndarray:
    return window_hashes(Words([text.encode()], blank=MARKS).hashes(), K).view(np.int64)


def template_rows(notices: Mapping[str, str] = NOTICES) -> list[tuple]:
    """(hash, words, template, label, exact, grams in the template, position)."""
    out = []
    for exact, texts in ((True, list(PHRASES.items())), (False, [(t.lower(), n) for n, t in notices.items()])):
        for text, label in texts:
            words, hashes = text.split(), hashed(text).tolist()
            name = text if exact else f"notice {label}"
            for i, h in enumerate(hashes):
                out.append((h, " ".join(words[i : i + K]), name, label, exact, len(hashes), i))
    return out


def gram_hits(docs: DataFrame, notices: Mapping[str, str] = NOTICES) -> DataFrame:
    """row, doc_id, n_words, hits: array of (pos, hash, words) of the k-grams that templates have."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    wanted = np.unique(np.array([r[0] for r in template_rows(notices)], np.int64)).view(np.uint64)
    low = np.zeros(1 << 16, bool)  # most hashes are ruled out by their last 16 bits
    low[(wanted & np.uint64(0xFFFF)).astype(np.int64)] = True
    hit_type = pa.list_(pa.struct([("pos", pa.int64()), ("hash", pa.int64()), ("words", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            rows, ids, texts = columns(batch, "row", "doc_id", "text")
            schema = pa.schema([("row", pa.int64()), ("doc_id", ids.type), ("n_words", pa.int64()), ("hits", hit_type)])
            for lo, hi, part in over_texts(texts):
                w = Words(part, blank=MARKS)
                h = window_hashes(w.hashes(), K)
                at = np.flatnonzero(low[(h & np.uint64(0xFFFF)).astype(np.int64)])
                at = at[np.isin(h[at], wanted) & inside(w.first, K, len(w.start))[at]]
                hits: list[list] = [[] for _ in part]
                for i in at.tolist():
                    words = " ".join(w.data[w.start[j] : w.end[j]].tobytes().decode() for j in range(i, i + K))
                    doc = int(w.doc[i])
                    hits[doc].append({"pos": i - int(w.first[doc]), "hash": int(h[i].view(np.int64)), "words": words})
                yield record_batch(schema, rows.slice(lo, hi - lo), ids.slice(lo, hi - lo), w.counts, hits)

    return to_python(docs).select(F.monotonically_increasing_id().alias("row"), "doc_id", "text").mapInArrow(
        run,
        f"row long, doc_id {kind}, n_words long, hits array<struct<pos: long, hash: long, words: string>>",
    )


def templates(spark: SparkSession, notices: Mapping[str, str] = NOTICES) -> DataFrame:
    return spark.createDataFrame(
        template_rows(notices),
        "hash long, words string, template string, label string, exact boolean, grams int, at int",
    )


def found_spans(hits: DataFrame, notices: Mapping[str, str] = NOTICES) -> DataFrame:
    """row, template, label, exact, start, coverage of every verified span."""
    votes = (
        hits.select("row", F.inline("hits"))
        .join(small(templates(hits.sparkSession, notices)), ["hash", "words"])
        .groupBy("row", "template", "label", "exact", "grams", (F.col("pos") - F.col("at")).alias("diagonal"))
        .agg(F.count("*").alias("votes"), F.min("pos").alias("start"), F.collect_set("at").alias("ats"))
    )
    phrases = votes.where(F.col("exact") & (F.col("votes") == F.col("grams")))
    near = Window.partitionBy("row", "template").orderBy("diagonal")
    far = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(near), F.lit(0)) > MAX_SHIFT
    span = Window.partitionBy("row", "template", "group").orderBy("diagonal").rangeBetween(0, MAX_DRIFT)
    chained = (
        votes.where(~F.col("exact"))
        .withColumn("far", far.cast("int"))
        .withColumn("group", F.sum("far").over(near))
        .withColumns({
            "votes": F.size(F.array_distinct(F.flatten(F.collect_list("ats").over(span)))),
            "start": F.min("start").over(span),
        })
    )
    # Of the spans that begin in one chain of diagonals, the one with most of the template, then the first.
    best = F.max(F.struct("votes", (-F.col("start")).alias("minus_start")))
    found = (
        chained.groupBy("row", "template", "label", "exact", "grams", "group").agg(best.alias("best"))
        .select("row", "template", "label", "exact", "grams", "best.votes", (-F.col("best.minus_start")).alias("start"))
        .where(F.col("votes") >= F.lit(MIN_COVERAGE) * F.col("grams"))
    )
    kept = ["row", "template", "label", "exact", "start", (F.col("votes") / F.col("grams")).alias("coverage")]
    return phrases.select(*kept).unionByName(found.select(*kept))


def scan(docs: DataFrame, notices: Mapping[str, str] = NOTICES) -> DataFrame:
    """One row per document: n_words, n_base, first_word, last_word, base_labels, labels, score.

    `notices` gives the text of each label beside the phrases, three words or more in ASCII letters,
    digits and spaces. score: the largest coverage of a span, 0 without one. Null and empty texts have no words.
    Repeated rows are scanned each; other columns are ignored.
    """
    hits = stored(gram_hits(docs, notices), "license-grams")
    spans = found_spans(hits.where(F.size("hits") > 0), notices)
    base = F.col("exact")
    names = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")
    by_row = spans.groupBy("row").agg(
        F.count_if(base).alias("n_base"),
        F.min(F.when(base, F.col("start"))).alias("first_word"),
        F.max(F.when(base, F.col("start"))).alias("last_word"),
        names(F.when(base, F.col("label"))).alias("base_labels"),
        names("label").alias("labels"),
        F.max("coverage").alias("score"),
    )
    return hits.select("row", "doc_id", "n_words").join(by_row, "row", "left").select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0)).alias("n_base"), "first_word", "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )

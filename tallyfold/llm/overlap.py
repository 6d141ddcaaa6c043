"""Joining documents by the Jaccard similarity of their word n-grams (T-occurrence search).

Two sets with similarity 0.85 share at least T = ceil(0.85 n) elements, n being the larger size. The
search for partners of a set counts how often other sets occur on the inverted lists of its elements
and keeps those that reach T. Long lists are what makes this costly, so lists are divided: with L
lists set aside, a partner must still occur T - L times on the others. The short lists are merged, and
only candidates found there are looked up, by binary search, in the long ones.

1. Equal sets are one class, represented by its smallest document id.
2. At first only the smallest hashes of a set are indexed: of n - T + l of them two partners share l at
   least (l: a thirtieth of the set, more for small sets). Elements that no other set has indexed have no list, and a set with fewer
   than the needed number of listed elements has no partner. Most of a corpus ends here.
3. The other sets are indexed in whole. A set with fewer than T listed elements has no partner.
4. The listed elements of a set are ordered by the length of their lists. The T - 1 longest are set
   aside; every partner is on one of the other lists, those of the keys.
5. Lists of keys with up to 40 sets are merged per set, and candidates are probed in the lists set
   aside. This begins with one candidate per set; candidates that are connected by then need none.
6. Lists of keys with more sets (large groups of near copies, passages that make up most of a text)
   are never multiplied out. Their sets are first compared with the smallest set of the list, which
   connects close copies. Only sets outside a group's largest component are then compared with the
   others, in blocks of 64 by 64 that emit nothing but links. No list is cut or dropped.

Documents are connected if a chain of links joins them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.llm.common import (
    Words, columns, in_slices, inside, mixed, over_texts, record_batch, small, stored, window_hashes, to_python,
)
from tallyfold.llm.graphs import components

SHORT = 40  # sets on a list that is merged
BLOCK = 64
SURE = 6  # shared indexed elements asked of sets of medium size
CHUNK = 4096  # elements per incidence matrix


@dataclass(frozen=True)
class Join:
    """n-gram width and similarity as a percentage."""

    width: int = 4
    percent: int = 85


def shingles(texts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-gram hashes of each text in ascending order, and where those of each text begin.
    A text with fewer words has its whole sequence as its only n-gram."""
    w = Words(texts)
    words = w.hashes()
    grams = window_hashes(words, width)
    ok = inside(w.first, width, len(words))
    doc, hashes = [w.doc[: len(grams)][ok]], [grams[ok]]
    for n in range(1, width):
        few = np.flatnonzero(w.counts == n)
        doc.append(few)
        hashes.append(window_hashes(words, n)[w.first[few]] if len(few) else np.zeros(0, np.uint64))
    doc, hashes = np.concatenate(doc), np.concatenate(hashes)
    order = np.lexsort((hashes, doc))
    doc, hashes = doc[order], hashes[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (hashes[1:] != hashes[:-1])
    return hashes[new], np.concatenate(([0], np.cumsum(np.bincount(doc[new], minlength=len(texts)))))


def least_overlap(n, percent: int):
    return (percent * n + 99) // 100


def listed(values: np.ndarray, first: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(values.view(np.int64), pa.int64()))


def shingle_sets(docs: DataFrame, join: Join, whole: bool) -> DataFrame:
    """doc_id, n, d1, d2 (128-bit digest of the set), hashes: all of them or those that are indexed."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            ids, texts = columns(batch, "doc_id", "text")
            schema = pa.schema([
                ("doc_id", ids.type), ("n", pa.int64()), ("d1", pa.int64()), ("d2", pa.int64()),
                ("hashes", pa.list_(pa.int64())),
            ])
            for lo, hi, part in over_texts(texts):
                h, first = shingles(part, join.width)
                n = np.diff(first)
                d1, d2 = digest(mixed(h + np.uint64(1)), first), digest(mixed(h ^ np.uint64(0xA5A5A5A5)), first)
                if not whole:
                    extra = np.maximum(n // 30, np.minimum(n // 4 + 1, SURE))
                    keep = np.where(n > 0, n - least_overlap(n, join.percent) + extra, 0)
                    h = h[np.arange(len(h)) - np.repeat(first[:-1], n) < np.repeat(keep, n)]
                    first = np.concatenate(([0], np.cumsum(np.minimum(keep, n))))
                yield record_batch(schema, ids.slice(lo, hi - lo), n, d1, d2, listed(h, first))

    return to_python(docs).select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n long, d1 long, d2 long, hashes array<long>"
    )


def digest(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of the values of each range modulo 2^64."""
    run = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)))
    return (run[first[1:]] - run[first[:-1]]).view(np.int64)


def needed(n: Column, join: Join) -> Column:
    """Indexed elements that a set shares with any partner: l of the smallest size a partner has."""
    m = least_shared(n, join)
    return F.greatest(F.floor(m / 30), F.least(F.floor(m / 4) + 1, F.lit(SURE)))


def least_shared(n: Column, join: Join) -> Column:
    """T: elements shared with any partner."""
    return F.floor((n * join.percent + 99) / 100)


def listed_postings(postings: DataFrame) -> DataFrame:
    """(token, rep, n) and df, the length of the list, for elements that two sets have at least."""
    # Counting `rep` keeps the columns, and so the plan below, as they are for the join: the exchange of
    # the classes then runs once for both.
    lengths = postings.groupBy("token").agg(F.count("rep").alias("df")).where("df > 1")
    return postings.join(lengths, "token")


def with_partners(postings: DataFrame, join: Join) -> DataFrame:
    """rep, n, lists (length of list, token; shortest first) of the sets with T listed elements."""
    return (
        listed_postings(postings)
        .groupBy("rep", "n")
        .agg(F.sort_array(F.collect_list(F.struct("df", "token"))).alias("lists"))
        .where(F.size("lists") >= least_shared(F.col("n"), join))
    )


def merged(short: DataFrame) -> DataFrame:
    """(token, rep) of short lists -> x, candidates (y, count) with y < x, by merging x's sorted lists."""
    lists = short.groupBy("token").agg(F.sort_array(F.collect_list("rep")).alias("members"))
    by_set = lists.select(F.explode("members").alias("x"), "members").groupBy("x").agg(
        F.collect_list("members").alias("lists")
    )
    found = pa.list_(pa.struct([("y", pa.int64()), ("count", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            xs, lists = columns(batch, "x", "lists")
            out = []
            for x, own in zip(xs.to_pylist(), lists):
                # A stable sort of sorted runs is their merge.
                y = np.sort(own.values.flatten().to_numpy(), kind="stable")
                y, n = np.unique(y[y < x], return_counts=True)
                out.append([{"y": a, "count": b} for a, b in zip(y.tolist(), n.tolist())])
            yield record_batch(pa.schema([("x", pa.int64()), ("candidates", found)]), xs, out)

    return by_set.mapInArrow(run, "x long, candidates array<struct<y: long, count: long>>")


def linked(pairs: DataFrame, sets: DataFrame, join: Join) -> DataFrame:
    """The pairs (a, b) that are similar enough; shared elements are counted by binary search. Elements
    that only one of the sets has on a list are in no other set, so lists suffice for an exact count."""
    def side(name: str) -> DataFrame:
        return sets.select(
            F.col("rep").alias(name), F.col("n").alias(f"n_{name}"), F.col("tokens").alias(f"tokens_{name}")
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            common = []
            n_a, n_b, ta, tb = columns(batch, "n_a", "n_b", "tokens_a", "tokens_b")
            for a, b in zip(ta, tb):
                a, b = a.values.to_numpy(), b.values.to_numpy()
                at = np.minimum(np.searchsorted(b, a), len(b) - 1)
                common.append(int((b[at] == a).sum()))
            ok = similar(np.array(common, np.int64), n_a.to_numpy(), n_b.to_numpy(), join)
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    sized = pairs.join(side("a"), "a").join(side("b"), "b").where(
        F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * join.percent
    )
    return sized.mapInArrow(run, "a long, b long")


def similar(common, n_a, n_b, join: Join):
    return 100 * common >= join.percent * (n_a + n_b - common)


def labelled(df: DataFrame, labels: DataFrame, *names: str) -> DataFrame:
    """Adds comp_<name>: the component of each named node, itself where it has no link."""
    for name in names:
        of = labels.select(F.col("node").alias(name), F.col("component").alias(f"comp_{name}"))
        df = df.join(of, name, "left").withColumn(f"comp_{name}", F.coalesce(f"comp_{name}", name))
    return df


def block_links(long: DataFrame, sets: DataFrame, labels: DataFrame, join: Join) -> DataFrame:
    """Links between sets of long lists that are not connected yet.

    Lists that have sets in common form a group. All but the group's largest component is compared
    with the whole group; a row holds two blocks of sets, and only links are emitted.
    """
    groups = components(long.select(F.col("rep").alias("a"), F.col("pivot").alias("b")))
    of = groups.select(F.col("node").alias("rep"), F.col("component").alias("group"))
    members = labelled(long.select("rep").distinct(), labels, "rep").join(of, "rep", "left")
    members = members.withColumn("group", F.coalesce("group", "rep"))
    parts = members.groupBy("group", "comp_rep").agg(F.count("*").alias("n"))
    about = parts.groupBy("group").agg(
        F.max_by("comp_rep", F.struct("n", "comp_rep")).alias("main"),
        F.sum("n").alias("size"), (F.sum("n") - F.max("n")).alias("outside"),
    ).where("outside > 0")
    held = members.join(about, "group").join(sets, "rep").select(
        "group", "main", "size", "outside",
        F.struct("rep", F.col("comp_rep").alias("comp"), "n", "tokens").alias("set"),
    )
    held = stored(held, "long-lists")

    def blocks(df: DataFrame, count: str, side: str) -> DataFrame:
        number = F.pmod(F.xxhash64("set.rep"), F.ceil(F.col(count) / BLOCK))
        return stored(
            df.groupBy("group", number.alias(side)).agg(F.collect_list("set").alias(f"{side}_sets")), side
        )

    outside = blocks(held.where(F.col("set.comp") != F.col("main")), "outside", "one")
    whole = blocks(held, "size", "two")
    rows = (
        outside.select("group", "one").join(whole.select("group", "two"), "group")
        .repartition("group", "one", "two")
        .join(outside, ["group", "one"]).join(whole, ["group", "two"])
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
        for batch in batches:
            for one, two in zip(*columns(batch, "one_sets", "two_sets")):
                yield record_batch(schema, *compared(one.values, two.values, join))

    return rows.select("one_sets", "two_sets").mapInArrow(run, "a long, b long").distinct()


def compared(one: pa.StructArray, two: pa.StructArray, join: Join) -> tuple[np.ndarray, np.ndarray]:
    """Links (larger id, smaller id) between sets of two blocks that are in different components."""
    def fields(block: pa.StructArray):
        rep, comp, n = (block.field(k).to_numpy() for k in ("rep", "comp", "n"))
        lists = block.field("tokens")
        size = lists.value_lengths().to_numpy().astype(np.int64)
        return rep, comp, n, size, lists.flatten().to_numpy(), np.repeat(np.arange(len(rep)), size)

    rep_a, comp_a, n_a, size_a, flat_a, row_a = fields(one)
    rep_b, comp_b, n_b, size_b, flat_b, row_b = fields(two)
    n_a, n_b = n_a[:, None], n_b[None, :]
    most = np.minimum(size_a[:, None], size_b[None, :])
    open_ = (comp_a[:, None] != comp_b[None, :]) & similar(most, n_a, n_b, join)
    none = np.zeros(0, np.int64)
    if not open_.any():
        return none, none
    shared = np.intersect1d(flat_a, flat_b)
    common = np.zeros(open_.shape, np.float32)
    at_a, at_b = np.searchsorted(shared, flat_a), np.searchsorted(shared, flat_b)
    for lo in range(0, len(shared), CHUNK):  # incidence matrices of some elements at a time
        x, y = (np.zeros((len(r), CHUNK), np.float32) for r in (rep_a, rep_b))
        for m, at, flat, row in ((x, at_a, flat_a, row_a), (y, at_b, flat_b, row_b)):
            ok = (at >= lo) & (at < min(lo + CHUNK, len(shared)))
            ok[ok] = shared[at[ok]] == flat[ok]
            m[row[ok], at[ok] - lo] = 1
        common += x @ y.T
    i, j = np.nonzero(open_ & similar(common.astype(np.int64), n_a, n_b, join))
    return np.maximum(rep_a[i], rep_b[j]), np.minimum(rep_a[i], rep_b[j])


def links_of(docs: DataFrame, sizes: DataFrame, join: Join) -> DataFrame:
    """node, component over the representatives of classes that are linked with another class.
    sizes: n, d1, d2, rep of every class."""
    # Hashed again rather than stored: the indexed elements are as large as a third of the texts.
    classes = shingle_sets(docs, join, whole=False).where("n > 0").groupBy("n", "d1", "d2").agg(
        F.min("doc_id").cast("long").alias("rep"), F.any_value("hashes").alias("hashes")
    )
    postings = classes.select("rep", F.explode("hashes").alias("token"))
    listed = listed_postings(postings).groupBy("rep").agg(F.count("*").alias("listed"))
    some = (
        listed.join(sizes.groupBy("rep").agg(F.min("n").alias("n")), "rep")
        .where(F.col("listed") >= needed(F.col("n"), join))
        .select(F.col("rep").alias("doc_id"))
    )
    texts = docs.select("doc_id", "text").join(small(stored(some, "some"), 2_000_000), "doc_id")
    full = shingle_sets(texts, join, whole=True).withColumnRenamed("doc_id", "rep")
    full = stored(full.select("rep", "n", "hashes").dropDuplicates(["rep", "n"]), "full-sets")
    once = stored(with_partners(full.select("rep", "n", F.explode("hashes").alias("token")), join), "sets-1")
    twice = with_partners(once.select("rep", "n", F.explode("lists.token").alias("token")), join)
    key_count = (F.size("lists") - least_shared(F.col("n"), join) + 1).cast("int")
    sets = stored(
        twice.select(
            "rep", "n", F.array_sort("lists.token").alias("tokens"),
            F.slice("lists.token", F.lit(1), key_count).alias("keys"),
        ),
        "sets-2",
    )
    keys = sets.select("rep", F.explode("keys").alias("token"))
    lengths = keys.groupBy("token").agg(F.count("*").alias("size"), F.min("rep").alias("pivot")).where("size > 1")
    lists = stored(keys.join(lengths, "token"), "lists")
    short, long = lists.where(F.col("size") <= SHORT), lists.where(F.col("size") > SHORT)
    candidates = stored(merged(short), "candidates")

    # One candidate per set from the short lists, and the smallest set of each long list.
    best = candidates.where(F.size("candidates") > 0).select(
        F.col("x").alias("a"),
        F.array_max(F.transform("candidates", lambda c: F.struct(c["count"], -c["y"]))).alias("best"),
    ).select("a", (-F.col("best.col2")).alias("b"))
    pivots = long.where(F.col("rep") != F.col("pivot")).select(F.col("rep").alias("a"), F.col("pivot").alias("b"))
    tried = stored(best.unionByName(pivots).distinct(), "tried")
    links = stored(linked(tried, sets, join), "links")
    labels = components(links)

    rest = candidates.select(F.col("x").alias("a"), F.explode("candidates.y").alias("b"))
    rest = labelled(rest, labels, "a", "b").where("comp_a <> comp_b").select("a", "b")
    found = linked(rest.join(tried, ["a", "b"], "left_anti"), sets, join)
    if not long.isEmpty():
        found = found.unionByName(block_links(long, sets, labels, join))
    found = stored(found, "more-links")
    if found.isEmpty():
        return labels
    return components(labels.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(found))


def linked_documents(docs: DataFrame, join: Join = Join()) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (smallest id it is connected with).

    Null and empty texts have no n-grams and no links. Rows that share a doc_id are one document with
    the links of all of them; repeated rows are returned each. A document without id has component
    null unless its set occurs under an id. Other columns are ignored.
    """
    ident = docs.schema["doc_id"].dataType
    indexed = stored(shingle_sets(docs, join, whole=False).drop("hashes"), "shingles")
    classes = indexed.where("n > 0").groupBy("n", "d1", "d2").agg(F.min("doc_id").cast("long").alias("rep"))
    labels = links_of(docs.where(F.col("doc_id").isNotNull()), classes.where(F.col("rep").isNotNull()), join)
    classes = labelled(classes, labels, "rep")
    return (
        indexed.join(classes, ["n", "d1", "d2"], "left")
        .select(
            "doc_id", F.col("n").alias("n_shingles"),
            F.coalesce("comp_rep", F.col("doc_id")).cast(ident).alias("component_id"),
        )
    )


def keep_one(docs: DataFrame, join: Join = Join()) -> DataFrame:
    """Of every group of connected documents the one with the smallest id; columns as they are.
    Documents without id stay."""
    dropped = linked_documents(docs, join).where(F.col("doc_id") != F.col("component_id"))
    dropped = stored(dropped.select("doc_id").distinct(), "near-copies")
    return docs.join(small(dropped, 2_000_000), "doc_id", "left_anti").select(docs.columns)


def oracle(join: Join = Join()) -> str:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    gram = " || ' ' || ".join(f"w[i + {k}]" for k in range(join.width))
    return rf"""
    WITH RECURSIVE words AS (
      SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), '[^\x20\x09-\x0D]+') AS w
      FROM documents
    ), grams AS (
      SELECT DISTINCT doc_id, {gram} AS g FROM (
        SELECT doc_id, w, unnest(range(1, len(w) - {join.width} + 2)) AS i FROM words WHERE len(w) >= {join.width})
      UNION ALL
      SELECT doc_id, array_to_string(w, ' ') AS g FROM words WHERE len(w) BETWEEN 1 AND {join.width - 1}
    ), sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
    links AS (
      SELECT a.doc_id AS a, b.doc_id AS b FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id
      JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
      GROUP BY 1, 2, x.n, y.n HAVING 100 * count(*) >= {join.percent} * (x.n + y.n - count(*))
    ), reached AS (
      SELECT doc_id AS a, doc_id AS c FROM documents UNION SELECT l.b, r.c FROM reached r JOIN links l ON l.a = r.a
    )
    SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, min(r.c) AS component_id
    FROM documents d JOIN reached r ON r.a = d.doc_id LEFT JOIN sizes s ON s.doc_id = d.doc_id GROUP BY d.doc_id, s.n
    """

"""Benchmark decontamination with spaced seeds, in DataFrame functions only.

A seed is the hash of six words at fixed places of a window; the places in between are ignored. Test
items and documents are hashed at every position, hashes are joined, and every hit names a diagonal
(position in the document minus position in the item). Along it, words are compared: an item is found
where 13 words in a row hold at least 11 equal ones. The two masks below have, between them, a window
free of any two substitutions in 13 words, so no such place is missed. Items of 7 to 12 words must
occur whole, and so must shorter ones, which are too short for the masks: there the seed is the hash of
the whole item, for each length that the test set has, and documents are hashed at that length as well.
A short item is found like any other but little evidence; removal leaves it out unless told otherwise.

Words are runs of ASCII letters, digits and characters beyond ASCII, in lower case.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.llm.common import let, small, stored

MASKS = ((0, 1, 2, 4, 5, 6), (0, 1, 2, 5, 8, 10))
WINDOW, MIN_EQUAL = 13, 11
SHORTEST = 7  # words of the shorter mask
BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), BETWEEN_WORDS), "")


def starts(words: Column, mask: tuple[int, ...]) -> Column:
    """How many windows of the mask fit."""
    return F.greatest(F.lit(0), F.size(words) - mask[-1])


def seeds_of(words: Column) -> Column:
    """Seed hashes of all masks, one mask's positions after the other's."""

    def of(hashes: Column, k: int, mask: tuple[int, ...]) -> Column:
        n = starts(hashes, mask)
        at = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
        return F.transform(at, lambda i: F.xxhash64(F.lit(k), *[F.get(hashes, i + o) for o in mask]))

    def both(hashes: Column) -> Column:
        return F.concat(*[of(hashes, k, m) for k, m in enumerate(MASKS)])

    return let(words, lambda w: let(F.transform(w, lambda x: F.xxhash64(x)), both))


def seeds(df: DataFrame, ident: str) -> DataFrame:
    """ident, seed, pos: one row per seed of a table with (ident, text)."""
    both = let(
        words_of(F.col("text")),
        lambda w: F.struct(F.size(w).alias("n"), seeds_of(w).alias("seeds")),
    )
    rows = df.select(ident, both.alias("s")).select(ident, F.col("s.n").alias("n"), F.posexplode("s.seeds"))
    first = F.greatest(F.lit(0), F.col("n") - MASKS[0][-1])
    pos = F.when(F.col("pos") < first, F.col("pos")).otherwise(F.col("pos") - first)
    return rows.select(ident, F.col("col").alias("seed"), pos.alias("pos"))


def key() -> Column:
    """The document id, null as the smallest integer. Rows that share an id are one document."""
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63)))


def short_hits(docs: DataFrame, items: DataFrame) -> DataFrame:
    """key, item_id, size, pos: where an item of fewer than SHORTEST words begins for the first time.

    `items` has item_id and item (words). A document is hashed once for each length that occurs. Hits
    are reduced to the first one map-side, so a common word costs a row per document and task.
    """
    lengths = sorted(r[0] for r in items.select(F.size("item")).distinct().collect())  # 6 at most
    whole = items.select(
        "item_id", F.size("item").alias("size"),
        F.xxhash64(F.array_join("item", " ")).alias("seed"),
    )

    def runs(words: Column, size: int) -> Column:
        n = F.size(words) - (size - 1)
        at = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
        return F.transform(at, lambda i: F.struct(
            F.lit(size).alias("size"), i.alias("pos"),
            F.xxhash64(F.array_join(F.slice(words, i + 1, size), " ")).alias("seed"),
        ))

    if not lengths:
        return whole.select(F.lit(0).cast("long").alias("key"), "item_id", "size", F.lit(0).alias("pos")).limit(0)
    places = let(words_of(F.col("text")), lambda w: F.concat(*[runs(w, n) for n in lengths]))
    rows = docs.select("key", F.inline(places))
    first = rows.join(small(stored(whole, "short-items")), ["size", "seed"]).groupBy("key", "item_id").agg(
        F.min("pos").alias("pos"), F.max("size").alias("size")
    )
    return first.select("key", "item_id", "size", "pos")


def best_window(words: Column, item: Column, shift: Column) -> Column:
    """struct(equal, start): most equal words of a window along the diagonal and where it begins in
    the document; null where no window fits."""
    size = F.least(F.lit(WINDOW), F.size(item))
    lo = F.greatest(F.lit(0), -shift)
    hi = F.least(F.size(item), F.size(words) - shift)

    def windows(same: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.size(same) - size),
            lambda j: F.struct(
                F.aggregate(F.slice(same, j + 1, size), F.lit(0), lambda a, x: a + x).alias("equal"),
                (-(j + lo + shift)).alias("minus_start"),
            ),
        )

    def along(i: Column) -> Column:
        return (F.get(words, i + shift) == F.get(item, i)).cast("int")

    best = let(F.transform(F.sequence(lo, hi - 1), along), lambda same: F.array_max(windows(same)))
    return F.when(hi - lo >= size, best)


def contaminated(docs: DataFrame, benchmark: DataFrame, shortest: int = 1) -> DataFrame:
    """doc_id, item_id, equal_words, window_words, start_word: for every item found in a document the
    window with the most equal words, the first one of equals.

    Items of fewer than `shortest` words are left out. Null or empty texts hold nothing, and nothing
    holds a null or empty item. A benchmark item without id is ignored; one repeated is reported once.
    Documents without id are one document. Other columns are ignored.
    """
    ident = docs.schema["doc_id"].dataType
    docs = docs.select(key().alias("key"), "text")
    items = benchmark.where(F.col("item_id").isNotNull()).select("item_id", "text").distinct()
    words = stored(
        items.select("item_id", words_of(F.col("text")).alias("item")).where(
            F.size("item") >= max(1, shortest)
        ),
        "items",
    )
    item_words = words.where(F.size("item") >= SHORTEST)
    wanted = stored(
        seeds(items, "item_id").select("item_id", "seed", F.col("pos").alias("item_pos")).distinct(), "seeds"
    )
    shift = (F.col("pos") - F.col("item_pos")).alias("shift")
    hits = seeds(docs, "key").join(small(wanted), "seed").select("key", "item_id", shift).distinct()
    hits = stored(hits, "seed-hits")
    found = docs.join(small(hits), "key").join(small(item_words), "item_id")
    best = let(words_of(F.col("text")), lambda w: best_window(w, F.col("item"), F.col("shift")))
    size = F.least(F.lit(WINDOW), F.size("item"))
    need = F.when(F.size("item") >= WINDOW, F.lit(MIN_EQUAL)).otherwise(F.size("item"))
    long = (
        found.select("key", "item_id", best.alias("best"), size.alias("size"), need.alias("need"))
        .where(F.col("best.equal") >= F.col("need"))
        .groupBy("key", "item_id")
        .agg(F.max("best").alias("best"), F.max("size").alias("size"))
        .select("key", "item_id", F.col("best.equal").alias("equal"), "size", (-F.col("best.minus_start")).alias("pos"))
    )
    if shortest < SHORTEST:
        short = short_hits(docs, words.where(F.size("item") < SHORTEST))
        long = long.unionByName(short.withColumn("equal", F.col("size")))
    return long.select(
        F.when(F.col("key") != -(2**63), F.col("key")).cast(ident).alias("doc_id"),
        "item_id",
        F.col("equal").cast("long").alias("equal_words"),
        F.col("size").cast("long").alias("window_words"),
        F.col("pos").cast("long").alias("start_word"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, shortest: int = SHORTEST) -> DataFrame:
    """The documents in which no item of `shortest` words or more is found; columns as they are.

    Null and empty texts stay, repeated rows are judged alike; documents without id are one document and
    stay or go together.
    """
    name = "key"
    while name in docs.columns:
        name += "_"
    bad = contaminated(docs, benchmark, shortest).select(key().alias(name)).distinct()
    return docs.withColumn(name, key()).join(small(stored(bad, "contaminated")), name, "left_anti").select(docs.columns)


def oracle() -> str:
    """The definition as SQL: candidates share six words of a mask, windows are counted along the diagonal."""
    def shared(k: int) -> str:
        mask = MASKS[k]
        key = " || ' ' || ".join(f"words[i + {o}]" for o in mask)
        return f"""
          SELECT d.id AS doc_id, t.id AS item_id, d.i - t.i AS shift
          FROM (SELECT id, i, {key} AS s FROM (SELECT id, words, unnest(range(1, len(words) - {mask[-1]} + 1)) AS i FROM dw)) d
          JOIN (SELECT id, i, {key} AS s FROM (SELECT id, words, unnest(range(1, len(words) - {mask[-1]} + 1)) AS i FROM iw)) t
          USING (s)"""

    pattern = BETWEEN_WORDS
    words = "list_filter(regexp_split_to_array(lower(coalesce(text, '')), '{}'), lambda x: x <> '')".format(pattern)
    union = reduce(lambda a, b: f"{a} UNION {b}", [shared(k) for k in range(len(MASKS))])
    return f"""
    WITH dw AS (SELECT doc_id AS id, {words} AS words FROM documents),
    iw AS (SELECT item_id AS id, {words} AS words FROM benchmark),
    hits AS ({union}),
    along AS (
      SELECT h.doc_id, h.item_id, h.shift, iw.words AS item, dw.words AS doc, least({WINDOW}, len(iw.words)) AS size,
        greatest(1, 1 - h.shift) AS lo, least(len(iw.words), len(dw.words) - h.shift) AS hi
      FROM hits h JOIN dw ON dw.id = h.doc_id JOIN iw ON iw.id = h.item_id
    ),
    windows AS (
      SELECT doc_id, item_id, shift, item, doc, size, unnest(range(lo, hi - size + 2)) AS j FROM along WHERE hi - lo + 1 >= size
    ),
    counted AS (
      SELECT doc_id, item_id, size, j + shift - 1 AS start_word,
        len(list_filter(range(j, j + size), lambda i: item[i] = doc[i + shift])) AS equal_words, len(item) AS n
      FROM windows
    ),
    ranked AS (
      SELECT *, row_number() OVER (PARTITION BY doc_id, item_id ORDER BY equal_words DESC, start_word) AS k
      FROM counted WHERE equal_words >= CASE WHEN n >= {WINDOW} THEN {MIN_EQUAL} ELSE n END
    )
    SELECT doc_id, item_id, equal_words::BIGINT AS equal_words, size::BIGINT AS window_words, start_word::BIGINT AS start_word
    FROM ranked WHERE k = 1
    UNION ALL
    SELECT d.id, i.id, len(i.words), len(i.words), min(d.p - 1)
    FROM (SELECT id, words, unnest(range(1, len(words) + 1)) AS p FROM dw) d
    JOIN (SELECT * FROM iw WHERE len(words) BETWEEN 1 AND {SHORTEST - 1}) i ON d.words[d.p] = i.words[1]
    WHERE d.words[d.p:d.p + len(i.words) - 1] = i.words
    GROUP BY d.id, i.id, i.words
    """

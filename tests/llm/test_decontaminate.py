import itertools
import random

from tallyfold.llm import decontaminate


def test_masks_survive_any_two_substitutions():
    for changed in itertools.combinations(range(decontaminate.WINDOW), 2):
        assert any(
            not set(changed) & {start + o for o in mask}
            for mask in decontaminate.MASKS
            for start in range(decontaminate.WINDOW - mask[-1])
        )


def brute(docs, items, shortest=1):
    """(doc_id, item_id) of every item with enough equal words in a window of some diagonal."""
    out = set()
    for d, text in docs:
        words = set(text)
        for i, item in items:
            size = min(decontaminate.WINDOW, len(item))
            need = decontaminate.MIN_EQUAL if len(item) >= decontaminate.WINDOW else len(item)
            if len(item) < shortest or sum(w in words for w in item) < need:
                continue
            for shift in range(-len(item), len(text)):
                same = [0 <= k + shift < len(text) and item[k] == text[k + shift] for k in range(len(item))]
                ok = [0 <= k + shift < len(text) for k in range(len(item))]
                if any(all(ok[k : k + size]) and sum(same[k : k + size]) >= need for k in range(len(item) - size + 1)):
                    out.add((d, i))
    return out


def test_found_are_exactly_the_close_windows(spark):
    rng = random.Random(4)
    word = lambda: f"w{rng.randrange(60)}"
    items = [(i, [word() for _ in range(rng.choice((1, 2, 5, 6, 7, 9, 13, 20)))]) for i in range(20)]
    docs = []
    for d in range(150):
        part = list(rng.choice(items)[1])
        for _ in range(rng.randrange(5)):
            part[rng.randrange(len(part))] = word()
        cut = rng.randrange(4)
        docs.append((d, [*(word() for _ in range(rng.randrange(15))), *part[cut:], *(word() for _ in range(rng.randrange(15)))]))
    df = spark.createDataFrame([(d, ". ".join(t).upper()) for d, t in docs], "doc_id long, text string")
    bench = spark.createDataFrame([(i, ", ".join(t)) for i, t in items], "item_id long, text string")
    found = decontaminate.contaminated(df, bench)
    assert {(r.doc_id, r.item_id) for r in found.collect()} == brute(docs, items)
    clean = decontaminate.drop_contaminated(df, bench)
    assert {r.doc_id for r in clean.collect()} == {d for d, _ in docs} - {d for d, _ in brute(docs, items, 7)}
    strict = decontaminate.drop_contaminated(df, bench, 2)
    assert {r.doc_id for r in strict.collect()} == {d for d, _ in docs} - {d for d, _ in brute(docs, items, 2)}


def test_short_items_are_found_whole_and_first(spark):
    docs = spark.createDataFrame([
        (1, "They ask: what is the capital of France? The capital."), (2, "the the capital"), (3, "of capital the"), (4, None),
    ], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "What is the capital of France"), (2, "the capital"), (3, "THE"), (4, "?!")], "item_id long, text string")
    got = {(r.doc_id, r.item_id, r.equal_words, r.window_words, r.start_word) for r in decontaminate.contaminated(docs, bench).collect()}
    assert got == {(1, 1, 6, 6, 2), (1, 2, 2, 2, 4), (1, 3, 1, 1, 4), (2, 2, 2, 2, 1), (2, 3, 1, 1, 0), (3, 3, 1, 1, 2)}
    assert decontaminate.drop_contaminated(docs, bench).count() == 4
    plan = decontaminate.contaminated(docs, bench)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "NestedLoop" not in plan


def test_sql_of_short_items(spark, tmp_path, sf_dir):
    """The given items have 15 words and more; here are short ones against the same SQL."""
    from tests.compare import compare, connect

    texts = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts.write.parquet(str(tmp_path / "documents.parquet"))
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").selectExpr("item_id", "array_join(slice(split(text, ' '), 1, 1 + CAST(item_id % 7 AS INT)), ' ') AS text")
    items.coalesce(1).write.parquet(str(tmp_path / "benchmark.parquet"))
    con = connect(sf_dir)
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM read_parquet('{tmp_path}/{name}.parquet/*.parquet')")
    query = lambda s, d: decontaminate.contaminated(*(s.read.parquet(f"{d}/{t}.parquet") for t in ("documents", "benchmark")))
    assert compare(spark, con, query, decontaminate.oracle(), str(tmp_path)) == []


def test_main_path_is_native(spark, sf_dir):
    docs, bench = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    plan = decontaminate.contaminated(docs, bench)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_odd_rows(spark, odd_docs, no_docs):
    bench = spark.createDataFrame(
        [(1, None), (2, ""), (3, "a row without any id at all"), (3, "a row without any id at all"), (None, "same words in both of these texts")],
        "item_id long, text string",
    ).selectExpr("*", "1 AS seed", "2 AS pos")
    found = decontaminate.contaminated(odd_docs, bench).collect()
    assert [(r.doc_id, r.item_id, r.equal_words) for r in found] == [(None, 3, 7)]  # null and empty items: nowhere
    clean = decontaminate.drop_contaminated(odd_docs, bench)
    assert clean.columns == odd_docs.columns and clean.count() == odd_docs.count() - 2
    assert decontaminate.contaminated(no_docs, bench).count() == 0
    assert decontaminate.contaminated(odd_docs, bench.limit(0)).count() == 0

import pytest

LONG = " ".join(f"word{i % 977}x{i}" for i in range(60_000))
CLASHES = ("row", "key", "key_", "label", "weight", "n", "length", "bucket", "rank", "score", "hashes", "words", "comp_rep")


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Null and empty texts and ids, one very long text, ties, repeated rows, columns named like the
    operators' own."""
    rows = [
        (1, None), (2, ""), (3, " \t\n "), (4, LONG), (5, "one"), (6, "same words in both of these texts"),
        (7, "same words in both of these texts"), (7, "same words in both of these texts"),
        (None, "a row without any id at all"), (None, None), (8, "é中 x\x1cy \U0001f600"),
    ]
    df = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows],
                               "doc_id long, text string, lang string, source string, n_chars long")
    for name in CLASHES:
        df = df.selectExpr("*", f"'{name}' AS `{name}`")
    return df


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)


@pytest.fixture(scope="session")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")

from datetime import datetime, timedelta

from tallyfold.operators.pages import listings_from_pages
from tallyfold.schemas import LISTING_SNAPSHOTS
from tallyfold.sources.bucketed import BucketedTable
from tallyfold.streaming import ingest as st

SCHEMA = "k int, v string, at timestamp_ntz"
T0 = datetime(2026, 5, 1)


def put(spark, folder, *rows):
    spark.createDataFrame(list(rows), SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def schema_of(spark):
    return spark.createDataFrame([], SCHEMA).schema


def run(spark, tmp_path):
    stream = st.stream_files(spark, str(tmp_path / "in"), schema_of(spark), files_per_batch=1)
    st.ingest_stream(stream, str(tmp_path / "out"), str(tmp_path / "cp"), ["k"], ["at", "v"], buckets=3).awaitTermination()
    df = st.read_current(spark, str(tmp_path / "out"))
    return sorted((r["k"], r["v"]) for r in df.collect())


def test_ingest_resumes_and_later_batches_win(spark, tmp_path):
    put(spark, str(tmp_path / "in"), (1, "a", T0), (1, "b", T0 + timedelta(1)), (2, "c", T0))
    assert run(spark, tmp_path) == [(1, "b"), (2, "c")]
    put(spark, str(tmp_path / "in"), (2, "d", T0), (3, "e", T0))
    assert run(spark, tmp_path) == [(1, "b"), (2, "d"), (3, "e")]
    assert run(spark, tmp_path) == [(1, "b"), (2, "d"), (3, "e")]


def test_replayed_batch_leaves_the_table_unchanged(spark, tmp_path):
    batch = spark.createDataFrame([(1, "a", T0), (1, "z", T0), (2, "b", T0)], SCHEMA)
    target = str(tmp_path / "t")
    for _ in range(2):
        st.write_batch(batch, 0, target, ["k"], ["at", "v"])
    assert BucketedTable(spark, target).version == 2
    assert {r["v"] for r in st.read_current(spark, target).collect()} == {"z", "b"}


def test_a_new_checkpoint_starts_over(spark, tmp_path):
    """Its batches are numbered from 0 again, and are no replays."""
    put(spark, str(tmp_path / "in"), (1, "a", T0))
    assert run(spark, tmp_path) == [(1, "a")]
    put(spark, str(tmp_path / "in"), (1, "b", T0 + timedelta(1)), (4, "d", T0))
    stream = st.stream_files(spark, str(tmp_path / "in"), schema_of(spark))
    st.ingest_stream(stream, str(tmp_path / "out"), str(tmp_path / "cp2"), ["k"], ["at"]).awaitTermination()
    assert sorted(r["v"] for r in st.read_current(spark, str(tmp_path / "out")).collect()) == ["b", "d"]


def test_compact_keeps_the_current_rows(spark, tmp_path):
    target = str(tmp_path / "t")
    for i in range(3):
        st.write_batch(spark.createDataFrame([(1, f"v{i}", T0), (i + 5, "x", T0)], SCHEMA), i, target, ["k"], ["at"], 2)
    before = sorted(tuple(r) for r in st.read_current(spark, target).collect())
    st.compact(spark, target, keep=1)
    assert len(BucketedTable(spark, target).runs) == 2
    assert sorted(tuple(r) for r in st.read_current(spark, target).collect()) == before


def test_stream_dedupe_across_batches(spark, tmp_path):
    folder = str(tmp_path / "in")
    put(spark, folder, (1, "a", T0), (1, "a2", T0), (2, "b", T0))
    put(spark, folder, (1, "late", T0 + timedelta(minutes=5)), (3, "c", T0))
    stream = st.stream_files(spark, folder, schema_of(spark), files_per_batch=1)
    first = st.stream_dedupe(stream, ["k"], "at", "1 hour")
    (first.select("k").writeStream.format("parquet").option("path", str(tmp_path / "o"))
     .option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination())
    assert sorted(r["k"] for r in spark.read.parquet(str(tmp_path / "o")).collect()) == [1, 2, 3]


def test_pages_arrive_as_listings(spark, tmp_path):
    """Stored result pages in, current listings out; a page fetched again replaces its cards."""
    schema = ("run_id string, query_id string, page int, html string, scraped_at timestamp_ntz, "
              "raw_snapshot_path string")
    card = '<div class="base-search-card job-search-card"><a href="/jobs/view/{}">x</a><h3>{}</h3></div>'

    def arrive(html, at):
        rows = [("r", "q", 1, html, at, None)]
        spark.createDataFrame(rows, schema).write.mode("append").parquet(str(tmp_path / "in"))
        stream = st.stream_files(spark, str(tmp_path / "in"), spark.createDataFrame([], schema).schema)
        st.ingest_stream(stream, str(tmp_path / "out"), str(tmp_path / "cp"), ["snapshot_id"],
                         ["scraped_at"], listings_from_pages, 2).awaitTermination()
        df = st.read_current(spark, str(tmp_path / "out"))
        assert set(df.columns) == set(LISTING_SNAPSHOTS.fieldNames())
        return sorted((r["snapshot_id"], r["title"]) for r in df.collect())

    assert arrive(card.format(7, "Cook"), T0) == [("q:1:1:7", "Cook")]
    again = card.format(7, "Chef") + card.format(8, "Nurse")
    assert arrive(again, T0 + timedelta(1)) == [("q:1:1:7", "Chef"), ("q:1:2:8", "Nurse")]


def test_first_sight_never_forgets(spark, tmp_path):
    target, keys = str(tmp_path / "seen"), ["k"]
    batches = [
        [(1, "a", T0), (1, "b", T0 + timedelta(1)), (None, "n", T0)],
        [(1, "late", T0 + timedelta(400)), (2, "c", T0), (None, "m", T0)],
    ]
    for number in (0, 1, 1, 0):  # replays included
        st.write_batch(spark.createDataFrame(batches[number], SCHEMA), number, target, keys, ["at", "v"], 2, True)
    got = st.read_current(spark, target).collect()
    assert sorted((r["k"] or 0, r["v"]) for r in got) == [(0, "n"), (1, "a"), (2, "c")]


def test_a_late_earlier_row_replaces_the_first_sight(spark, tmp_path):
    folder, target = str(tmp_path / "in"), str(tmp_path / "out")
    day = lambda n: T0 + timedelta(n)

    def arrive(*rows):
        put(spark, folder, *rows)
        stream = st.stream_files(spark, folder, schema_of(spark))
        st.first_seen_table(
            stream, target, str(tmp_path / "cp"), ["k"], "at", "v", "10 days", "20 days", 2
        ).awaitTermination()
        return sorted((r["k"], r["v"]) for r in st.read_current(spark, target).collect())

    assert arrive((1, "b", day(5)), (1, "c", day(6)), (2, "x", day(5))) == [(1, "b"), (2, "x")]
    assert arrive((1, "a", day(1)), (2, "y", day(9)), (2, "w", day(5))) == [(1, "a"), (2, "w")]
    # The watermark passes the states, which are dropped; rows behind it are too late to count.
    assert arrive((3, "z", day(60))) == [(1, "a"), (2, "w"), (3, "z")]
    assert arrive((1, "0", day(0)), (4, "q", day(61))) == [(1, "a"), (2, "w"), (3, "z"), (4, "q")]
    assert arrive((2, "new", day(62))) == [(1, "a"), (2, "new"), (3, "z"), (4, "q")]

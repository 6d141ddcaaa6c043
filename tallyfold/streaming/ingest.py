"""Incremental arrival of observations.

The target is a stored table in buckets by key (`BucketedTable`): a micro-batch adds files to the buckets it
hits, runs of similar size are merged, and readers see the newest row per key of one published version.
A replayed batch is known by its number and changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tallyfold.sources.bucketed import BUCKETS, BucketedTable


def stream_files(
    spark: SparkSession, folder: str, schema: T.StructType, glob: str = "*.parquet",
    files_per_batch: int | None = None,
) -> DataFrame:
    """File source; new files below `folder` become new rows."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def write_batch(
    batch: DataFrame, batch_id: int, target: str, keys: Sequence[str], order: Sequence[str],
    buckets: int = BUCKETS, absent_only: bool = False, source: str = "",
) -> None:
    """Put one batch into the table at `target`, made by the first batch.

    Of several rows of a key, that with the highest `order` counts, nulls last; with `absent_only`, that
    with the lowest, and only if no earlier batch had the key.
    """
    spark = batch.sparkSession
    table = BucketedTable.open(spark, target, batch.schema, keys, buckets=buckets)
    direction = F.asc_nulls_last if absent_only else F.desc_nulls_last
    table.upsert(batch, [direction(c) for c in order], batch_id, source, absent_only)


def _started(
    rows: DataFrame, target: str, checkpoint: str, keys: Sequence[str], order: Sequence[str],
    buckets: int, absent_only: bool,
) -> StreamingQuery:
    spark = rows.sparkSession
    BucketedTable.open(spark, target, rows.schema, keys, buckets=buckets)

    def sink(batch: DataFrame, batch_id: int) -> None:
        # The id of the query lives in its checkpoint: batches of a new one are numbered anew.
        query = spark.sparkContext.getLocalProperty("sql.streaming.queryId") or ""
        write_batch(batch, batch_id, target, keys, order, buckets, absent_only, query)

    return (
        rows.writeStream.foreachBatch(sink)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def ingest_stream(
    stream: DataFrame,
    target: str,
    checkpoint: str,
    keys: Sequence[str],
    order: Sequence[str],
    transform: Callable[[DataFrame], DataFrame] | None = None,
    buckets: int = BUCKETS,
) -> StreamingQuery:
    """Start taking in everything available; the checkpoint is what makes it resumable."""
    rows = stream if transform is None else transform(stream)
    return _started(rows, target, checkpoint, keys, order, buckets, False)


def first_sight(
    stream: DataFrame, target: str, checkpoint: str, keys: Sequence[str], order: Sequence[str],
    buckets: int = BUCKETS,
) -> StreamingQuery:
    """First row of every key over all time: a batch is held against the buckets it hits, so nothing is
    forgotten and no state is held. `stream_dedupe` is the form with bounded memory."""
    return _started(stream, target, checkpoint, keys, order, buckets, True)


def read_current(spark: SparkSession, target: str) -> DataFrame:
    """Newest row per key over all batches: the later batch wins."""
    return BucketedTable(spark, target).current()


def compact(spark: SparkSession, target: str, keep: int = 2) -> None:
    """One run per bucket; files that only versions before the newest `keep` name are deleted."""
    table = BucketedTable(spark, target)
    table.compact()
    table.sweep(keep)


def stream_dedupe(
    stream: DataFrame, keys: Sequence[str], event_time: str, delay: str
) -> DataFrame:
    """First sight of each key within the watermark, which also bounds the state.

    Watermarks need an instant, so a zone-less event time is read in the session zone.
    """
    timed = stream.withColumn(event_time, F.col(event_time).cast("timestamp"))
    return timed.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(keys))


def first_seen(
    stream: DataFrame, keys: Sequence[str], event_time: str, tie: str, delay: str, keep: str
) -> DataFrame:
    """The earliest row of each key so far, again whenever a late row turns out to be earlier.

    State is one (time, tie) pair per key, forgotten `keep` after the key's last row has passed the
    watermark, which trails by `delay`; a key that comes back after that is new. Written in update mode, a row
    replaces the one emitted before: `first_seen_table` does so. Rows without a time are left out.
    """
    schema = stream.schema
    names, pair = schema.fieldNames(), [event_time, tie]
    instants = [f.name for f in schema if f.dataType in (T.TimestampType(), T.TimestampNTZType())]
    lasting = pd.Timedelta(keep)
    # Watermarks and state need instants, so zone-less times are read in the session zone.
    timed = stream.where(F.col(event_time).isNotNull()).withColumns({
        c: F.col(c).cast("timestamp") for c in instants
    }).withWatermark(event_time, delay)
    out = T.StructType([timed.schema[c] for c in names])
    kept = T.StructType([out[c] for c in pair])

    def earliest(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        best, last = None, None
        for frame in frames:
            if len(frame):
                first = frame.sort_values(pair).iloc[:1]
                if best is None or tuple(first[pair].iloc[0]) < tuple(best[pair].iloc[0]):
                    best = first
                top = frame[event_time].max()
                last = top if last is None or top > last else last
        if best is None:
            return
        until = int((last + lasting).timestamp() * 1000)
        found = tuple(best[pair].iloc[0])
        if not state.exists or found < tuple(state.get):
            state.update(found)
            yield best[names]
        state.setTimeoutTimestamp(max(until, state.getCurrentWatermarkMs() + 1))

    return timed.groupBy(*keys).applyInPandasWithState(
        earliest, out, kept, "update", GroupStateTimeout.EventTimeTimeout
    )


def first_seen_table(
    stream: DataFrame, target: str, checkpoint: str, keys: Sequence[str], event_time: str, tie: str,
    delay: str, keep: str, buckets: int = BUCKETS,
) -> StreamingQuery:
    """Keeps the table at `target` at the earliest row of each key, corrections included."""
    rows = first_seen(stream, keys, event_time, tie, delay, keep)
    spark = rows.sparkSession
    BucketedTable.open(spark, target, rows.schema, keys, buckets=buckets)

    def sink(batch: DataFrame, batch_id: int) -> None:
        query = spark.sparkContext.getLocalProperty("sql.streaming.queryId") or ""
        table = BucketedTable(spark, target)
        table.upsert(batch, [F.asc(event_time), F.asc(tie)], batch_id, query)

    return (
        rows.writeStream.outputMode("update").foreachBatch(sink)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )

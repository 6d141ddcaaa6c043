"""Canonical jobs kept up to date batch by batch.

The tables of all runs are stored in buckets by job. A batch of new listings, detail rows or searches touches
some jobs: those it names, and those that a changed search had found. Only their stored facts are read, through a
semi join on the touched keys in the buckets they fall into; best row, labels and discovery paths are
computed anew for them, and replace their rows in the stored result. All other rows stay where they are.

The work of a batch follows the jobs it touches, not the history. A replayed batch changes nothing, also if the
first attempt died half-way: each table knows which batches it has.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyfold.operators.canonical import JOB, canonical_jobs
from tallyfold.plans.market import classify_best
from tallyfold.schemas import JOB_DETAILS, LISTING_SNAPSHOTS, SEARCH_QUERIES
from tallyfold.sources.bucketed import BUCKETS, BucketedTable
from tallyfold.sources.versions import Versions

# What the canonical row takes from a search; a change of anything else touches no job.
USED = ("city_name", "city_key", "keyword", "experience_key", "target_weight")


class JobStore:
    """Listings, details, searches and canonical jobs below one folder."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS):
        self.spark, self.root, self.buckets = spark, root.rstrip("/"), buckets
        self.listings = self._table("listing_snapshots", LISTING_SNAPSHOTS, [*JOB, "snapshot_id"], JOB)
        self.details = self._table("job_details", JOB_DETAILS, JOB)
        self.searches = self._table("search_queries", SEARCH_QUERIES, ["query_id"])
        self.jobs = self._table("canonical_jobs", None, JOB)

    def _table(
        self, name: str, schema: T.StructType | None, keys: list[str], by: list[str] | None = None
    ) -> BucketedTable:
        """The table as stored, or a new one; no schema stands for that of the canonical rows."""
        path = f"{self.root}/{name}"
        if Versions(self.spark, path).numbers():
            return BucketedTable(self.spark, path)
        if schema is None:
            none = [self.spark.createDataFrame([], s) for s in (LISTING_SNAPSHOTS, JOB_DETAILS, SEARCH_QUERIES)]
            schema = self._recomputed(*none).schema
        return BucketedTable.create(self.spark, path, schema, keys, by or keys, self.buckets)

    @staticmethod
    def _recomputed(listings: DataFrame, details: DataFrame, searches: DataFrame) -> DataFrame:
        """Canonical rows of the given facts, labels included."""
        tables = {"listing_snapshots": listings, "job_details": details, "search_queries": searches}
        return canonical_jobs({**tables, "classified_best": classify_best(tables)})

    def touched(self, batch: Mapping[str, DataFrame]) -> DataFrame:
        """Keys of the jobs that a batch may change: those of its listings and details, and those found by
        searches whose used attributes it changes."""
        keys = self.spark.createDataFrame([], T.StructType([LISTING_SNAPSHOTS[c] for c in JOB]))
        for name in ("listing_snapshots", "job_details"):
            if name in batch:
                keys = keys.unionByName(batch[name].select(*JOB))
        if "search_queries" in batch:
            before = self.searches.current().select("query_id", *USED).withColumn("_known", F.lit(True))
            old = before.select(*[F.col(c).alias(f"_{c}") for c in before.columns if c != "_known"], "_known")
            rows = batch["search_queries"].join(old, F.col("query_id") == F.col("_query_id"), "left")
            same = F.col("_known").isNotNull()
            for c in USED:
                same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
            changed = rows.where(~same).select("query_id")
            found = self.listings.current().select(*JOB, "query_id").join(changed, "query_id", "left_semi")
            keys = keys.unionByName(found.select(*JOB))
        return keys.distinct()

    def facts(self, touched: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
        """Listings and details of the touched jobs, and all searches."""
        return self.listings.lookup(touched), self.details.lookup(touched), self.searches.current()

    def apply(self, batch: Mapping[str, DataFrame], batch_id: int) -> int:
        """Take in a batch (any of listing_snapshots, job_details, search_queries); returns the number of
        jobs computed anew, 0 for a replay of a finished batch.

        Rows of a known key replace the stored ones. Tables of the batch may have further columns.
        """
        if self.jobs.seen(batch_id):
            return 0
        # Before the searches of the batch hide what they change; an attempt that died keeps its keys.
        held = self._held(batch_id) or self._hold(self.touched(batch), batch_id)
        for name, table in (
            ("listing_snapshots", self.listings), ("job_details", self.details), ("search_queries", self.searches),
        ):
            if name in batch:
                table.upsert(batch[name], batch_id=batch_id)
        new = self._recomputed(*self.facts(held))
        self.jobs.upsert(new, batch_id=batch_id)
        return held.count()

    def _held(self, batch_id: int) -> DataFrame | None:
        """Keys written by an attempt at this batch that got that far."""
        if "_SUCCESS" not in Versions(self.spark, self.root).listed(f"touched/batch={batch_id}"):
            return None
        schema = T.StructType([LISTING_SNAPSHOTS[c] for c in JOB])
        return self.spark.read.schema(schema).parquet(f"{self.root}/touched/batch={batch_id}")

    def _hold(self, keys: DataFrame, batch_id: int) -> DataFrame:
        keys.write.mode("overwrite").parquet(f"{self.root}/touched/batch={batch_id}")
        return self._held(batch_id)

    def sweep(self, keep: int = 2) -> None:
        """Fold each table into one run per bucket and delete what only older versions name."""
        for table in (self.listings, self.details, self.searches, self.jobs):
            table.compact()
            table.sweep(keep)

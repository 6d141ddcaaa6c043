"""A stored table with upserts by key.

Rows are dealt to a fixed number of buckets by a hash of (a part of) their key. An upsert adds one sorted
run of files to each bucket it hits and touches no other; of a key, the row with the highest sequence number
counts. Runs of a bucket that have grown to similar size are merged (size-tiered compaction): each row is
rewritten as often as there are tiers, the logarithm of a bucket's size, and a bucket never has more
than a few runs per tier. A manifest names the runs that count; readers see one version of it whole.
Batches that carry a number are applied once, so a replay changes nothing.

A bucket is what one task writes and merges, so the number of buckets is chosen for the size the table
will have. The driver sees one line per bucket and run, never rows.
"""

from __future__ import annotations

import json
import math
import uuid
from collections import defaultdict
from collections.abc import Iterable, Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyfold.session import stored
from tallyfold.sources.versions import Versions

BUCKETS = 64
ROWS = 200_000  # of a bucket, where the number of buckets follows that of rows
# So many runs of one tier are merged; tiers differ by this factor in rows.
FAN = 4
SEQ = "_seq"
BUCKET = "_bucket"


def buckets_for(rows: int, least: int = 1) -> int:
    """So many buckets that the task which writes one gets about `ROWS` rows, however many there are."""
    return max(least, -(-rows // ROWS))


@dataclass(frozen=True)
class Run:
    """One bucket's part of one write."""

    bucket: int
    folder: str
    rows: int

    @property
    def tier(self) -> int:
        return int(math.log(max(self.rows, 1), FAN))

    @property
    def path(self) -> str:
        return f"{self.folder}/bucket={self.bucket}"


def merged(runs: Iterable[Run], fan: int = FAN) -> list[list[Run]]:
    """Groups of runs of one bucket and tier that are due for a merge."""
    tiers: dict[tuple[int, int], list[Run]] = defaultdict(list)
    for run in runs:
        tiers[run.bucket, run.tier].append(run)
    return [group for group in tiers.values() if len(group) >= fan]


class BucketedTable:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.versions = Versions(spark, self.root)
        self.version, content = self.versions.current()
        if not content:
            raise FileNotFoundError(f"no table at {root}")
        self._load(content)

    def _load(self, content: dict) -> None:
        self.keys, self.by, self.buckets = content["keys"], content["by"], content["buckets"]
        self.schema = T.StructType.fromJson(json.loads(content["schema"]))
        self.runs = [Run(**r) for r in content["runs"]]
        self.applied: dict[str, int] = content["applied"]

    @classmethod
    def create(
        cls, spark: SparkSession, root: str, schema: T.StructType, keys: Sequence[str],
        by: Sequence[str] = (), buckets: int = BUCKETS,
    ) -> BucketedTable:
        """An empty table. `by` names the key columns that decide a row's bucket, all of them at first."""
        Versions(spark, root).publish(0, {
            "keys": list(keys), "by": list(by or keys), "buckets": buckets, "schema": schema.json(),
            "runs": [], "applied": {},
        })
        return cls(spark, root)

    @classmethod
    def open(cls, spark: SparkSession, root: str, schema: T.StructType, keys: Sequence[str], **more) -> BucketedTable:
        """The table at `root`, created if there is none."""
        if Versions(spark, root).numbers():
            return cls(spark, root)
        return cls.create(spark, root, schema, keys, **more)

    # --- Reading ---

    def bucket_of(self) -> Column:
        return F.pmod(F.xxhash64(*self.by), F.lit(self.buckets)).cast("int")

    def _read(self, runs: Sequence[Run]) -> DataFrame:
        fields = [*self.schema.fields, T.StructField(SEQ, T.LongType())]
        reader = self.spark.read.schema(T.StructType(fields))
        if not runs:
            return self.spark.createDataFrame([], T.StructType(fields))
        return reader.parquet(*[f"{self.root}/{run.path}" for run in runs])

    def _newest(self, runs: Sequence[Run], only: DataFrame | None = None) -> DataFrame:
        """Newest row per key of these runs. Buckets with one run have one row per key as they are."""
        per_bucket: dict[int, int] = defaultdict(int)
        for run in runs:
            per_bucket[run.bucket] += 1
        single = [r for r in runs if per_bucket[r.bucket] == 1]
        several = [r for r in runs if per_bucket[r.bucket] > 1]
        parts = []
        if single or not several:
            parts.append(self._matching(self._read(single), only))
        if several:
            newest = Window.partitionBy(*self.keys).orderBy(F.desc(SEQ))
            rows = self._matching(self._read(several), only).withColumn("_rn", F.row_number().over(newest))
            parts.append(rows.where("_rn = 1").drop("_rn"))
        return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])

    @staticmethod
    def _matching(rows: DataFrame, only: DataFrame | None) -> DataFrame:
        if only is None:
            return rows
        named = only.select(*[F.col(c).alias(f"_k_{c}") for c in only.columns])
        return rows.join(named, [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in only.columns], "left_semi")

    def current(self) -> DataFrame:
        """All rows, one per key, of the version at hand."""
        return self._newest(self.runs).drop(SEQ)

    def lookup(self, keys: DataFrame) -> DataFrame:
        """Current rows that match `keys`, which has the columns `by` (and others of the key). Only buckets
        that `keys` hits are read, and their rows only through a semi join."""
        hit = self._hit(keys)
        return self._newest([r for r in self.runs if r.bucket in hit], keys).drop(SEQ)

    def _hit(self, rows: DataFrame) -> set[int]:
        return {r[0] for r in rows.select(self.bucket_of()).distinct().collect()}  # `buckets` at most

    # --- Writing ---

    def _write(self, rows: DataFrame) -> list[Run]:
        """Rows with SEQ as runs below a new folder, one task and one file per bucket."""
        folder = f"data/{uuid.uuid4().hex}"
        (
            rows.withColumn("bucket", F.col(BUCKET)).drop(BUCKET)
            .write.partitionBy("bucket").parquet(f"{self.root}/{folder}")
        )
        if not any(name.startswith("bucket=") for name in self.versions.listed(folder)):
            return []
        found = self.spark.read.schema("bucket int").parquet(f"{self.root}/{folder}")
        counts = found.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).collect()
        return [Run(r["bucket"], folder, r["n"]) for r in counts]

    def _in_buckets(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn(BUCKET, self.bucket_of()).repartition(self.buckets, BUCKET)

    def _publish(self, runs: list[Run], applied: dict[str, int]) -> None:
        content = {
            "keys": self.keys, "by": self.by, "buckets": self.buckets, "schema": self.schema.json(),
            "runs": [asdict(r) for r in runs], "applied": applied,
        }
        self.version = self.versions.publish(self.version, content)
        self.runs, self.applied = runs, applied

    def seen(self, batch_id: int | None, source: str = "") -> bool:
        return batch_id is not None and self.applied.get(source, -1) >= batch_id

    def upsert(
        self, batch: DataFrame, order: Sequence[Column] = (), batch_id: int | None = None,
        source: str = "", absent_only: bool = False,
    ) -> bool:
        """Put the batch's rows in place of those with the same key; False if it was applied before.

        Of several rows of one key, the first by `order` counts, then one chosen by a hash of the whole
        row. Null keys are keys like others. With `absent_only`, keys that the table has stay as they
        are. Numbered batches of one `source` come in order, and each is applied once.
        """
        if self.seen(batch_id, source):
            return False
        columns = self.schema.fieldNames()
        plain = [f.name for f in self.schema if "map" not in f.dataType.simpleString()]
        ranked = Window.partitionBy(BUCKET, *self.keys).orderBy(*order, F.xxhash64(*plain))
        # One exchange: the rows of a key are in the bucket's task already.
        rows = self._in_buckets(batch.select(*columns)).withColumn("_rn", F.row_number().over(ranked))
        fresh = rows.where("_rn = 1").drop("_rn")
        if absent_only:
            fresh = stored(fresh, "fresh")
            known = self.lookup(fresh.select(*self.keys)).select(
                *[F.col(k).alias(f"_k_{k}") for k in self.keys]
            )
            same = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in self.keys]
            fresh = fresh.join(known, same, "left_anti").repartition(self.buckets, BUCKET)
        new = self._write(fresh.withColumn(SEQ, F.lit(self.version + 1).cast("bigint")))
        applied = {**self.applied, source: batch_id} if batch_id is not None else self.applied
        self._publish([*self.runs, *new], applied)
        while groups := merged(self.runs):
            self._merge(groups)
        return True

    def _merge(self, groups: list[list[Run]]) -> None:
        """Replace each group of runs by one."""
        gone = {r for group in groups for r in group}
        newest = Window.partitionBy(BUCKET, *self.keys).orderBy(F.desc(SEQ))
        rows = self._in_buckets(self._read(sorted(gone, key=lambda r: r.path)))
        kept = rows.withColumn("_rn", F.row_number().over(newest)).where("_rn = 1").drop("_rn")
        self._publish([*(r for r in self.runs if r not in gone), *self._write(kept)], self.applied)

    def compact(self) -> None:
        """One run per bucket."""
        per_bucket: dict[int, list[Run]] = defaultdict(list)
        for run in self.runs:
            per_bucket[run.bucket].append(run)
        groups = [runs for runs in per_bucket.values() if len(runs) > 1]
        if groups:
            self._merge(groups)

    def sweep(self, keep: int = 2) -> int:
        """Delete manifests but the newest `keep`, and files that none of those names; returns how many
        folders went. Readers of older versions must be done, and no write be under way."""
        named = {Run(**r).path for content in self.versions.forget(keep) for r in content["runs"]}
        gone = 0
        for folder in self.versions.listed("data"):
            parts = [p for p in self.versions.listed(f"data/{folder}") if p.startswith("bucket=")]
            dead = [p for p in parts if f"data/{folder}/{p}" not in named]
            for p in [""] if len(dead) == len(parts) else dead:
                self.versions.delete(f"data/{folder}/{p}".rstrip("/"))
            gone += len(dead)
        return gone

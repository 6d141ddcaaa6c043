"""An export that appears at once.

All nine tables are written to new folders first; a manifest then names the folder of every run of every
table. Readers resolve one version and see its tables together, whatever a writer is doing or where one has
died. An export of one run replaces that run in the next version and leaves the others' files alone.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyfold.operators.canonical import canonical_jobs
from tallyfold.schemas import SHARED_TABLES, TABLES
from tallyfold.sources.versions import Versions

RUN = "_run"
ALL = ""  # stands for the run of a shared table
Folders = dict[str, str]  # run -> folder


def _read(spark: SparkSession, root: str, schema: T.StructType, folders: Folders) -> DataFrame:
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{root}/{folder}" for folder in sorted(folders.values())])


def _write(versions: Versions, df: DataFrame, name: str, shared: bool) -> Folders:
    """The folder of each run of the table, rows of a run in files of balanced size."""
    folder = f"data/{uuid.uuid4().hex}/{name}"
    path = f"{versions.root}/{folder}"
    if shared:
        df.write.parquet(path)
        return {ALL: folder}
    df.withColumn(RUN, F.col("run_id")).hint("rebalance", RUN).write.partitionBy(RUN).parquet(path)
    parts = [p for p in versions.listed(folder) if p.startswith(f"{RUN}=")]
    return {unquote(p.removeprefix(f"{RUN}=")): f"{folder}/{p}" for p in parts}


def publish(tables: Mapping[str, DataFrame], root: str, run_id: str | None = None) -> int:
    """Export the pipeline tables and the canonical jobs made from them; returns the version.

    With `run_id`, the run takes the place of its earlier export, also where a table has no row of it any
    more; the shared dimensions go whole. Without it, everything is replaced. If anything fails, or another
    writer was faster, readers keep what they have.
    """
    spark = next(iter(tables.values())).sparkSession
    versions = Versions(spark, root)
    number, before = versions.current()
    after: dict[str, Folders] = {}
    schemas: dict[str, str] = {}

    def keep(name: str, written: Folders) -> None:
        old = before.get("tables", {}).get(name, {}) if run_id is not None and name not in SHARED_TABLES else {}
        after[name] = {run: f for run, f in old.items() if run != run_id} | written

    own = {}
    for name, schema in TABLES.items():
        df = tables[name].select(*schema.fieldNames())
        if run_id is not None and name not in SHARED_TABLES:
            df = df.where(F.col("run_id") == run_id)
        written = _write(versions, df, name, name in SHARED_TABLES)
        own[name] = _read(spark, versions.root, schema, written)
        schemas[name] = schema.json()
        keep(name, written)
    jobs = canonical_jobs(own)
    schemas["canonical_jobs"] = T.StructType([T.StructField(f.name, f.dataType) for f in jobs.schema]).json()
    keep("canonical_jobs", _write(versions, jobs, "canonical_jobs", False))
    return versions.publish(number, {"tables": after, "schemas": schemas})


def read_published(spark: SparkSession, root: str, version: int | None = None) -> dict[str, DataFrame]:
    """All tables of the newest version, or of one that has not been swept yet."""
    versions = Versions(spark, root)
    content = versions.current()[1] if version is None else versions.read(version)
    if not content:
        raise FileNotFoundError(f"nothing is published at {root}")
    return {
        name: _read(spark, versions.root, T.StructType.fromJson(json.loads(content["schemas"][name])), folders)
        for name, folders in content["tables"].items()
    }


def sweep(spark: SparkSession, root: str, keep: int = 2) -> int:
    """Delete versions but the newest `keep`, and folders that none of those names: earlier exports and
    what failed writers left. Returns how many folders went. No write may be under way."""
    versions = Versions(spark, root)
    named = {f for content in versions.forget(keep) for folders in content["tables"].values() for f in folders.values()}
    gone = 0
    for folder in versions.listed("data"):
        used = {f for f in named if f.startswith(f"data/{folder}/")}
        if not used:
            versions.delete(f"data/{folder}")
            gone += 1
            continue
        for name in versions.listed(f"data/{folder}"):
            for part in versions.listed(f"data/{folder}/{name}"):
                path = f"data/{folder}/{name}/{part}"
                if part.startswith(f"{RUN}=") and path not in used:
                    versions.delete(path)
                    gone += 1
    return gone

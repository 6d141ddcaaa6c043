"""Set-based table maintenance: every operator gives the table after the change."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyfold.functions.text import clean_text, norm_text
from tallyfold.operators.dedupe import first_per_key


def upsert_by_key(
    current: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    version: str | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Last write wins per key; `current` holds one row per key.

    `version` orders several incoming rows of one key (incoming beats current regardless).
    `keep` names columns that an update must not touch; a new row takes its own value. Columns
    that the batch does not have keep their values as well.
    """
    order = [F.desc("_batch")]
    if version:
        order.append(F.col(version).desc_nulls_last())
    payload = [c for c in incoming.columns if c not in keys]
    # Whole-row hash as last resort, so replays of one batch always pick the same row.
    hashable = [
        f.name for f in incoming.schema
        if f.name in payload and not isinstance(f.dataType, T.MapType)
    ]
    if hashable:
        order.append(F.xxhash64(*hashable).asc())
    fresh = first_per_key(incoming.withColumn("_batch", F.lit(1)), keys, order).drop("_batch")
    if not keep and set(current.columns) <= set(incoming.columns):
        # Whatever the batch names is replaced whole: the stored rows are only filtered.
        named = fresh.select(*[F.col(k).alias(f"_k_{k}") for k in keys])
        same = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]
        return current.join(named, same, "left_anti").unionByName(fresh, allowMissingColumns=True)
    new = fresh.withColumn("_hit", F.lit(True))
    for k in keys:
        new = new.withColumnRenamed(k, f"_k_{k}")
    for c in payload:
        new = new.withColumnRenamed(c, f"_n_{c}")
    on = [current[k].eqNullSafe(new[f"_k_{k}"]) for k in keys]
    old = current.withColumn("_old", F.lit(True))
    joined = old.join(new, on, "full_outer")
    out = [F.coalesce(F.col(k), F.col(f"_k_{k}")).alias(k) for k in keys]
    for c in [c for c in current.columns if c not in keys]:
        if c not in payload:
            out.append(F.col(c))
        elif c in keep:
            out.append(F.when(F.col("_old"), F.col(c)).otherwise(F.col(f"_n_{c}")).alias(c))
        else:
            out.append(F.when(F.col("_hit"), F.col(f"_n_{c}")).otherwise(F.col(c)).alias(c))
    return joined.select(*out)


def insert_if_absent(
    dim: DataFrame, incoming: DataFrame, value: str, seen_at: str, key: str = "key"
) -> DataFrame:
    """Dimension after adding unknown values; the earliest spelling of a key is kept, undated ones
    last.

    Rows are reduced to one per spelling by a plain minimum, which hashes; only the spellings are cleaned
    and compared as a whole, which sorts."""
    spellings = incoming.where(F.col(value).isNotNull()).groupBy(F.col(value).alias("_spelling")).agg(
        F.min(seen_at).alias("_at")
    )
    named = spellings.where(clean_text("_spelling") != "")
    first = named.groupBy(norm_text("_spelling").alias(key)).agg(
        F.min(F.struct(
            F.col("_at").isNull().alias("undated"), F.col("_at").alias("at"),
            F.trim("_spelling").alias("name"),
        )).alias("f")
    )
    found = first.select(
        key, F.col("f.name").alias("canonical_name"), F.col("f.at").alias("first_seen_at")
    )
    return dim.unionByName(found.join(dim.select(key), key, "left_anti"))


def update_status(frame: DataFrame, updates: DataFrame, key: str = "query_id") -> DataFrame:
    """Frame after status updates: counts only if given, the error text always."""
    u = updates.select(
        F.col(key).alias("_key"), F.col("status").alias("_status"),
        F.col("result_count").alias("_count"), F.col("pages_collected").alias("_pages"),
        F.col("last_error").alias("_error"),
    )
    joined = frame.join(u, frame[key] == u["_key"], "left")
    hit = F.col("_key").isNotNull()
    new = {
        "status": F.when(hit, F.col("_status")).otherwise(F.col("status")),
        "result_count": F.coalesce("_count", "result_count"),
        "pages_collected": F.coalesce("_pages", "pages_collected"),
        "last_error": F.when(hit, F.col("_error")).otherwise(F.col("last_error")),
    }
    return joined.select(*[new[c].alias(c) if c in new else F.col(c) for c in frame.columns])


def run_guard(runs: DataFrame, incoming: DataFrame, enforce: bool = True) -> DataFrame:
    """State of the requested runs: new ones start, known ones resume.

    A known run with another config hash fails the job when the row is written; with
    `enforce=False` it is reported as `conflict` instead. A run that starts or resumes is not over:
    its `ended_at`, if it has one, goes.
    """
    known = runs.select("run_id", F.col("config_hash").alias("known_hash"))
    joined = incoming.join(known, "run_id", "left")
    conflict = F.col("known_hash") != F.col("config_hash")
    if enforce:
        verdict = F.raise_error(
            F.concat(F.lit("run already exists with a different config hash: "), F.col("run_id"))
        ).cast("string")
    else:
        verdict = F.lit("conflict")
    action = (
        F.when(F.col("known_hash").isNull(), F.lit("new"))
        .when(conflict, verdict)
        .otherwise(F.lit("resumed"))
    )
    out = joined.withColumn("action", action).withColumn(
        "status", F.when(F.col("action") != "conflict", F.lit("running"))
    ).drop("known_hash")
    if "ended_at" not in out.columns:
        return out
    kept = F.when(F.col("action") == "conflict", F.col("ended_at"))
    return out.withColumn("ended_at", kept)


def resume_runs(runs: DataFrame, started: DataFrame) -> DataFrame:
    """The run table after `run_guard` let runs start: known ones run again and have no end, new ones
    come in, and those in conflict stay as they are."""
    fine = started.where(F.col("action") != "conflict")
    known = fine.where(F.col("action") == "resumed").select(F.col("run_id").alias("_run"))
    again = F.col("_run").isNotNull()
    kept = runs.join(known, F.col("run_id") == F.col("_run"), "left").withColumns({
        "status": F.when(again, F.lit("running")).otherwise(F.col("status")),
        "ended_at": F.when(~again, F.col("ended_at")),
    }).select(runs.columns)
    new = fine.where(F.col("action") == "new")
    return kept.unionByName(new.select(*[c for c in runs.columns if c in new.columns]), allowMissingColumns=True)


def finish_runs(runs: DataFrame, finished: DataFrame) -> DataFrame:
    """The run table after runs ended: `finished` has run_id, status and ended_at. Only a running run can
    end; what ended before keeps its end."""
    ended = finished.select(
        F.col("run_id").alias("_run"), F.col("status").alias("_status"), F.col("ended_at").alias("_ended")
    )
    over = F.col("_run").isNotNull() & (F.col("status") == "running")
    return runs.join(ended, F.col("run_id") == F.col("_run"), "left").withColumns({
        "ended_at": F.when(over, F.col("_ended")).otherwise(F.col("ended_at")),
        "status": F.when(over, F.coalesce("_status", F.lit("complete"))).otherwise(F.col("status")),
    }).select(runs.columns)

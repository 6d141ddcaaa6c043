"""Writers. Run tables are partitioned by run_id and overwritten run by run."""

from __future__ import annotations

import itertools
import os
import re
from collections.abc import Iterator, Mapping, Sequence

from pyspark import TaskContext
from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F

from tallyfold.operators.canonical import canonical_jobs
from tallyfold.schemas import SHARED_TABLES, TABLES
from tallyfold.session import stored
from tallyfold.sources.readers import CSV_TIMESTAMP, read_table

PLAIN_VALUE = re.compile(r"[\w.\-]+")
FILE_TASKS = 4  # tasks per core where every row makes a file
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"  # as Spark names a null


def replace_partition(
    df: DataFrame, path: str, partition: str = "run_id", values: Sequence[str] = ()
) -> None:
    """Replace the partitions present in `df`; all others stay as they are.

    Values named in `values` are replaced even if `df` has no row for them, which empties
    them: a run whose check found nothing must lose the issues of an earlier check.

    Rows of one partition value go to few tasks of balanced size, so that the number of files
    follows the data and not tasks times values.
    """
    for value in values:
        if not PLAIN_VALUE.fullmatch(value):
            raise ValueError(f"partition value {value!r} would need escaping")
    if values:
        # Evaluated once, also where `df` reads the folder that is about to change.
        df = stored(df, "partitions")
    (
        df.hint("rebalance", partition)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition)
        .parquet(path)
    )
    if values:
        # At most one row per named value comes back.
        found = df.where(F.col(partition).isin(*values)).select(partition).distinct().collect()
        nothing = df.sparkSession.createDataFrame([], df.drop(partition).schema)
        for value in set(values) - {row[0] for row in found}:
            nothing.write.mode("overwrite").parquet(f"{path}/{partition}={value}")


def export_run(
    tables: Mapping[str, DataFrame], root: str, run_id: str | None = None
) -> list[str]:
    """Write the pipeline tables and the canonical jobs; returns the nine folders.

    With `run_id`, tables are cut to that run and its earlier export is replaced as a whole,
    also where a table has no row any more; the shared dimensions go whole. Without it, everything is
    replaced. `root` must not be where `tables` are read from. The canonical jobs are made from the
    exported folders.
    """
    def replaced(df: DataFrame, path: str) -> None:
        if run_id is not None:
            replace_partition(df.where(F.col("run_id") == run_id), path, values=[run_id])
            return
        (
            df.hint("rebalance", "run_id").write.mode("overwrite")
            .option("partitionOverwriteMode", "static").partitionBy("run_id").parquet(path)
        )

    paths, written = [], {}
    for name, schema in TABLES.items():
        df, path = tables[name].select(*schema.fieldNames()), f"{root}/{name}"
        if name in SHARED_TABLES:
            df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)
        else:
            replaced(df, path)
        written[name] = read_table(
            df.sparkSession, path, schema, None if name in SHARED_TABLES else run_id
        )
        paths.append(path)
    path = f"{root}/canonical_jobs"
    replaced(canonical_jobs(written), path)
    return [*paths, path]


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header line per file; quotes inside values are doubled."""
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("timestampNTZFormat", CSV_TIMESTAMP)
        .csv(path)
    )


def write_page_files(df: DataFrame, path: str, key: str, text: str) -> None:
    """One file per value of `key`, named key=value, in a new folder that all machines see; a text ends with
    a line feed, and the texts of rows that share a key follow each other.

    A file costs the same however short it is, so every core writes some. Hadoop's local file system starts
    several processes per file to set its rights; folders of that kind get plain files from the tasks.
    """
    spark = df.sparkSession
    tasks = FILE_TASKS * spark.sparkContext.defaultParallelism
    rows = df.select(key, F.col(text).alias("value")).repartition(tasks, key)
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if system.getScheme() != "file":
        rows.write.partitionBy(key).option("mapreduce.fileoutputcommitter.algorithm.version", 2).text(path)
        return
    root = system.makeQualified(folder).toUri().getPath()
    os.makedirs(root)

    def write(part: Iterator[Row]) -> None:
        context = TaskContext.get()
        own = f"{root}/{context.partitionId():05}"
        for value, same in itertools.groupby(part, lambda row: row[0]):
            os.makedirs(own, exist_ok=True)
            name = f"{own}/{key}={NO_VALUE if value is None else value}.txt"
            # Renamed when whole, so that a second attempt at the task never shows half a file.
            with open(half := f"{own}/_{context.taskAttemptId()}", "wb") as out:
                for row in same:
                    out.write((row[1] or "").encode() + b"\n")
            os.replace(half, name)

    rows.sortWithinPartitions(key).foreachPartition(write)


def write_summary(df: DataFrame, path: str) -> None:
    """One-row summary as JSON."""
    df.write.mode("overwrite").json(path)


def number_issues(issues: DataFrame, order: str) -> DataFrame:
    """issue_id = run:ordinal:code, numbered within the run by `order`."""
    rn = F.row_number().over(Window.partitionBy("run_id").orderBy(order, "code"))
    return issues.withColumn(
        "issue_id", F.format_string("%s:%04d:%s", F.col("run_id"), rn, F.col("code"))
    )

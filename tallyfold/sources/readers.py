"""Readers with explicit schemas."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyfold.schemas import CSV_JOBS, CSV_LABELS, SHARED_TABLES, TABLES

# Microseconds are kept; Spark's own default writes milliseconds.
CSV_TIMESTAMP = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def read_table(
    spark: SparkSession, path: str, schema: T.StructType, run_id: str | None = None
) -> DataFrame:
    """Parquet table; a run filter on a table partitioned by run_id prunes directories."""
    df = spark.read.schema(schema).parquet(path)
    return df if run_id is None else df.where(F.col("run_id") == run_id)


def read_tables(
    spark: SparkSession, root: str, run_id: str | None = None
) -> Mapping[str, DataFrame]:
    """All pipeline tables below `root`, one folder each."""
    return {
        name: read_table(
            spark, f"{root}/{name}", schema, None if name in SHARED_TABLES else run_id
        )
        for name, schema in TABLES.items()
    }


def read_snapshots(spark: SparkSession, glob: str) -> DataFrame:
    """Stored pages: one row per file with its path, text and hash. Files below a folder that is named are
    found by Spark's tasks; a glob over many folders is resolved by the driver alone."""
    raw = spark.read.option("recursiveFileLookup", True).text(glob, wholetext=True)
    return raw.select(
        F.col("_metadata.file_path").alias("path"),
        F.col("value").alias("html"),
        F.sha2("value", 256).alias("content_sha256"),
    )


def snapshot_name(kind: str, ident, content_sha256):
    """File name of a stored page: <kind>/<id>_<first 12 hash digits>.html."""
    return F.concat(
        F.lit(f"{kind}/"), ident.cast("string"), F.lit("_"), F.substring(content_sha256, 1, 12),
        F.lit(".html"),
    )


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType | str, multi_line: bool = False
) -> DataFrame:
    """CSV with a header; quoted values may hold commas and doubled quotes.

    An empty value is NULL, whether quoted or not: CSV cannot tell the two apart.

    Files are read in splits. Line breaks inside values need `multi_line`, which makes each file
    one split.
    """
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multi_line)
        .option("timestampNTZFormat", CSV_TIMESTAMP)
        .csv(path)
    )


def read_csv_jobs(
    spark: SparkSession, path: str, schema: T.StructType = CSV_JOBS, multi_line: bool = False
) -> DataFrame:
    return read_csv(spark, path, schema, multi_line)


def read_labels(
    spark: SparkSession, path: str, schema: T.StructType = CSV_LABELS, multi_line: bool = False
) -> DataFrame:
    return read_csv(spark, path, schema, multi_line)

"""Stratified sampling frame, quotas and seeded samples."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyfold.functions.identity import PAGE_SIZE, SEARCH_BASE, hash32, search_url, stable_id
from tallyfold.functions.text import col
from tallyfold.operators.selection import lowest

_CITY = "struct<key:string,name:string,weight:double,locations:array<string>>"
_FAMILY = "struct<key:string,name:string,keywords:array<string>>"
_LEVEL = "struct<key:string,param:string,weight:double>"
CONFIG_SCHEMA = (
    "run_id string, name string, time_window_days int, max_pages int,"
    f" cities array<{_CITY}>, families array<{_FAMILY}>, levels array<{_LEVEL}>"
)
# Bounds of a valid configuration.
WEIGHT_TOLERANCE = 0.01
WINDOW_DAYS = (1, 30)
MAX_PAGES = (1, 40)
# Fixed value: one search is expected to yield this many usable rows.
ROWS_PER_SEARCH = 20
HASH_BITS = 32


def config_rows(spark: SparkSession, configs: Mapping[str, Mapping[str, Any]]) -> DataFrame:
    """Configuration documents, one row per run; dimension lists stay nested."""
    rows = [
        (
            run_id, c.get("name", run_id), int(c.get("time_window_days", 7)),
            int(c.get("max_pages", 3)),
            [(x["key"], x["name"], float(x["weight"]), list(x["locations"])) for x in c["cities"]],
            [(x["key"], x["name"], list(x["keywords"])) for x in c["families"]],
            [(x["key"], x["param"], float(x["weight"])) for x in c["levels"]],
        )
        for run_id, c in configs.items()
    ]
    return spark.createDataFrame(rows, CONFIG_SCHEMA)


def _weight_sum(array: str) -> Column:
    return F.aggregate(F.col(array), F.lit(0.0), lambda acc, x: acc + x["weight"])


def config_problems(configs: DataFrame) -> DataFrame:
    """Violated configuration rules, one row each; none for a valid configuration."""
    def off(array: str) -> Column:
        return F.abs(_weight_sum(array) - 1.0) > WEIGHT_TOLERANCE

    checks = {
        "city weights must sum to 1": off("cities"),
        "level weights must sum to 1": off("levels"),
        "city weights must be positive": F.exists("cities", lambda c: c["weight"] <= 0),
        "level weights must be positive": F.exists("levels", lambda c: c["weight"] <= 0),
        "time_window_days out of range": ~F.col("time_window_days").between(*WINDOW_DAYS),
        "max_pages out of range": ~F.col("max_pages").between(*MAX_PAGES),
        "a city needs a location": F.exists("cities", lambda c: F.size(c["locations"]) == 0),
        "a family needs a keyword": F.exists("families", lambda c: F.size(c["keywords"]) == 0),
    }
    found = F.array_compact(F.array(*[F.when(cond, F.lit(text)) for text, cond in checks.items()]))
    return configs.select("run_id", F.explode(found).alias("problem"))


def search_frame(configs: DataFrame, base: str = SEARCH_BASE) -> DataFrame:
    """One row per city location, keyword and level of each run.

    The grid unfolds from the nested configuration row by `explode`, without any join;
    the weights of one run's frame sum to 1.
    """
    cities = configs.select(
        "run_id", "time_window_days", "families", "levels", F.explode("cities").alias("c")
    )
    places = cities.select("*", F.explode("c.locations").alias("location"))
    families = places.select("*", F.explode("families").alias("f"))
    keywords = families.select("*", F.explode("f.keywords").alias("keyword"))
    grid = keywords.select("*", F.explode("levels").alias("l"))
    weight = (
        F.col("c.weight") * F.col("l.weight") * (F.lit(1.0) / F.size("families"))
        / (F.size("c.locations") * F.size("f.keywords"))
    )
    query_id = stable_id("run_id", "c.key", "location", "f.key", "keyword", "l.key")
    return grid.select(
        query_id.alias("query_id"), "run_id",
        F.col("c.key").alias("city_key"), F.col("c.name").alias("city_name"),
        "location", "keyword",
        F.col("f.key").alias("role_family_key"), F.col("l.key").alias("experience_key"),
        F.col("l.param").alias("experience_param"), "time_window_days",
        weight.alias("target_weight"),
        search_url("keyword", "location", "time_window_days", "l.param", base=base).alias("url"),
        F.lit("pending").alias("status"),
        F.lit(None).cast("int").alias("result_count"),
        F.lit(0).alias("pages_collected"),
        F.lit(None).cast("string").alias("last_error"),
    )


def page_plan(frame: DataFrame, max_pages: int, base: str = SEARCH_BASE) -> DataFrame:
    """Every page to fetch with its address; the first page carries no offset."""
    pages = frame.select("*", F.explode(F.sequence(F.lit(1), F.lit(max_pages))).alias("page"))
    start = (F.col("page") - 1) * PAGE_SIZE
    url = search_url(
        "keyword", "location", "time_window_days", "experience_param", start, base
    )
    return pages.select("query_id", "page", start.alias("start"), url.alias("page_url"))


def page_loop_stop(pages: DataFrame, found: str = "n") -> DataFrame:
    """Pages up to and including each query's first empty one, summed per query."""
    empty_at = pages.groupBy("query_id").agg(
        F.min(F.when(F.col(found) == 0, F.col("page"))).alias("stop")
    )
    kept = pages.join(empty_at, "query_id").where(
        F.col("stop").isNull() | (F.col("page") <= F.col("stop"))
    )
    return kept.groupBy("query_id").agg(
        F.sum(found).alias("result_count"), F.max("page").alias("pages_collected")
    )


def quota_gap(df: DataFrame, stratum: str, weights: Mapping[str, float], total: int) -> DataFrame:
    """Rows still wanted per stratum: floor(total x weight) less the rows at hand."""
    have = df.groupBy(stratum).agg(F.count(F.lit(1)).alias("have"))
    spark = df.sparkSession
    wanted = spark.createDataFrame(list(weights.items()), f"{stratum} string, weight double")
    joined = wanted.join(have, stratum, "left").withColumn("have", F.coalesce("have", F.lit(0)))
    target = F.floor(F.lit(total) * F.col("weight"))
    return joined.select(
        stratum, target.alias("target"), F.col("have").cast("bigint").alias("have"),
        F.greatest(target - F.col("have"), F.lit(0)).alias("gap"),
    )


def capped_sample(
    df: DataFrame, stratum: str, quotas: DataFrame, key: str, seed: int = 42
) -> DataFrame:
    """Seeded sample of at most `quota` rows per stratum, exactly the lowest hashes.

    Ranking a whole stratum would put a third of the table into one sort. Radix selection finds
    the narrow hash range in which the quota is reached: lower ranges are taken as they are, and only
    the few rows of that range are ranked. Strata without a quota row are left out.
    """
    limits = quotas.select(stratum, F.col("quota").alias("room"))
    return lowest(df, stratum, hash32(F.lit(seed), key), HASH_BITS, limits, key)


def shuffled_frame(frame: DataFrame, key: str, target: int, seed: int = 42) -> DataFrame:
    """Frame in seeded random order, repeated if it is too small for the target."""
    size = frame.agg(F.count(F.lit(1))).scalar()
    copies = F.when(
        size < target // ROWS_PER_SEARCH, F.floor(F.try_divide(F.lit(target), size * ROWS_PER_SEARCH)) + 1
    ).otherwise(F.lit(1))
    repeated = frame.select(
        "*", F.explode(F.sequence(F.lit(1), copies.cast("int"))).alias("copy")
    )
    drawn = repeated.withColumn("draw", hash32(F.lit(seed), key, "copy"))
    return drawn.orderBy("draw", key, "copy")


def sampling_weight(weight: str | Column) -> Column:
    """1 / stratum weight; NULL for a weight of 0."""
    return F.try_divide(F.lit(1.0), col(weight))


def frame_weight_sums(frame: DataFrame) -> DataFrame:
    return frame.groupBy("run_id").agg(F.sum("target_weight").alias("weight_sum"))


def strata_quotas(spark: SparkSession, stratum: str, quotas: Sequence[tuple[str, int]]):
    schema = T.StructType(
        [T.StructField(stratum, T.StringType()), T.StructField("quota", T.LongType())]
    )
    return spark.createDataFrame(list(quotas), schema)

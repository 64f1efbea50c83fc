"""Tables, reports and their writers."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_table(spark: SparkSession, path: str, equal: dict[str, Any] | None = None, among: dict[str, list] | None = None, least: dict[str, Any] | None = None, like: dict[str, str] | None = None, due: tuple[str, Any] | None = None, order: list[Any] | None = None, limit: int | None = None) -> DataFrame:
    """A filtered Parquet scan; all filters but ``like`` reach the scan. ``due``: a column that is null or at most a value."""
    df = spark.read.parquet(path)
    for c, v in (equal or {}).items():
        df = df.where(F.col(c) == v)
    for c, vs in (among or {}).items():
        df = df.where(F.col(c).isin(*vs))
    for c, v in (least or {}).items():
        df = df.where(F.col(c) >= v)
    for c, v in (like or {}).items():
        df = df.where(F.col(c).ilike(v))
    if due:
        df = df.where(F.col(due[0]).isNull() | (F.col(due[0]) <= F.lit(due[1])))
    df = df.orderBy(*order) if order else df
    return df if limit is None else df.limit(limit)


def stage_rows(new: DataFrame, target: DataFrame, key: str = "dedupe_key") -> DataFrame:
    """Rows to append: one for each key that the target does not have."""
    return new.dropDuplicates([key]).join(target.select(key), key, "left_anti").select(*new.columns)


def upsert_last(old: DataFrame, new: DataFrame, keys: list[str], order: Column) -> DataFrame:
    """Old and new rows by key, the new ones before the old and the greatest ``order`` before the rest."""
    both = old.withColumn("_n", F.lit(0)).unionByName(new.withColumn("_n", F.lit(1)))
    w = Window.partitionBy(*keys).orderBy(F.desc("_n"), order.desc_nulls_last())
    return both.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_n", "_r")


def append(df: DataFrame, path: str) -> None:
    """Append to a log of checks, comparisons or spends."""
    df.write.mode("append").parquet(path)


def write_reports(df: DataFrame, path: str, by: tuple[str, ...] = ("run_id", "shard")) -> None:
    """Reports as JSON lines in a folder for each run and shard."""
    df.write.mode("overwrite").partitionBy(*by).json(path)


def combine_reports(spark: SparkSession, path: str, schema: StructType | str) -> tuple[DataFrame, DataFrame]:
    """All shards' reports: rows in report order, and counts by status."""
    rows = spark.read.schema(schema).option("recursiveFileLookup", "false").json(path)
    tier = F.when(F.col("priority").isNull() | (F.col("priority") == 0), 9).otherwise(F.col("priority"))
    return rows.orderBy(F.col("verdict") != "OK", tier, "source"), rows.groupBy("verdict").count()


def csv_rows(df: DataFrame, columns: list[str]) -> DataFrame:
    """Chosen columns as text for CSV: arrays joined by a comma, missing columns empty."""
    have = dict(df.dtypes)
    one = lambda c: F.lit("") if c not in have else F.array_join(c, ", ") if have[c].startswith("array") else F.coalesce(F.col(c).cast("string"), F.lit(""))
    return df.select(*[one(c).alias(c) for c in columns])


def write_csv(df: DataFrame, path: str, columns: list[str]) -> None:
    csv_rows(df, columns).write.mode("overwrite").option("header", True).csv(path)

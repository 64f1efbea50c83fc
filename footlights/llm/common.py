"""Helpers shared by the corpus operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.graph import cluster, cut_lineage, gone_at_end, own_path

__all__ = ["ASCII_SPACE", "bounded_or_shuffled", "cluster", "own_path", "schema_with", "slices", "stash", "stash_bucketed", "table", "text_or_empty"]

#: Write a frame as a table in the shared folder and read it again.
stash = cut_lineage

#: White space of the word rule: space and \t \n \v \f \r. ``bytes.split()`` splits on exactly these.
ASCII_SPACE = b" \t\n\x0b\x0c\r"


def stash_bucketed(df: DataFrame, name: str, key: str) -> DataFrame:
    """Like ``stash``, bucketed by ``key`` into as many buckets as there are shuffle partitions: joins on it do not move ``df``.

    Bucketing needs a table name; it is dropped at once, the files stay.
    """
    spark = df.sparkSession
    path, table_name = own_path(spark, name), f"footlights_{name}_{uuid.uuid4().hex}"
    df.write.format("parquet").bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), key).option("path", path).saveAsTable(table_name)
    gone_at_end(spark, path)
    found = spark.table(table_name)
    found.schema  # resolved before the name goes
    spark.sql(f"drop table {table_name}")
    return found


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_or_shuffled(df: DataFrame, rows: int, limit: int) -> DataFrame:
    """Mark ``df`` for broadcast if its counted ``rows`` are within ``limit``; else leave it to a shuffle join."""
    return F.broadcast(df) if rows <= limit else df


def schema_with(df: DataFrame, **fields: str) -> StructType:
    """The schema of ``df`` and further fields, by name and type."""
    out = StructType(list(df.schema.fields))
    for name, kind in fields.items():
        out.add(name, kind)
    return out


def slices(batches: Iterator[pa.RecordBatch], most: int = 1000) -> Iterator[pa.RecordBatch]:
    """A worker's batches in parts of at most ``most`` rows, whatever the session's batch size: it bounds what is unpacked at once."""
    for batch in batches:
        for at in range(0, batch.num_rows, most):
            yield batch.slice(at, most)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))

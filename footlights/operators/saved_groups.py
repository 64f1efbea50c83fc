"""Evening groups as a kept table: a batch of changes makes anew only the evenings it names.

The table is partitioned by a hash of the evening's key, ``slot``. A batch reads the partitions of its keys (others are
pruned by their folder), makes the named evenings anew from the rows that are now theirs, and overwrites those partitions
only. Spark writes new content beside the partitions and puts it in their place when all of it is there, so nothing is read
from a partition while it is overwritten, and a batch that is run again gives the same table.

Rows are dealt by ``ek`` once, to a multiple of the slots: a slot is what a shuffle's own hash leaves by the number of slots,
so that a task has groups of one slot, and groups are not moved again to be written. A caller whose rows repeat few facts in
many columns may ``deal`` them before they are repeated, and say so.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .graph import cut_lineage
from .groups import group_evenings, header_flags, refresh_groups


def slot_of(ek: Column | str, buckets: int) -> Column:
    return F.pmod(F.hash(ek), F.lit(buckets)).cast("int")


def deal(rows: DataFrame, buckets: int = 64) -> DataFrame:
    """Rows dealt by ``ek``, to a multiple of ``buckets`` of at least the session's number of shuffle partitions."""
    least = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(buckets * -(-least // buckets), "ek")


def save_groups(rows: DataFrame, path: str, buckets: int = 64, dealt: bool = False) -> None:
    """Write the groups of all evenings. rows: those of ``header_flags`` and ``group_evenings`` before flags are set.

    ``dealt``: the rows come from ``deal``, with the same ``ek``."""
    groups = group_evenings(header_flags(rows if dealt else deal(rows, buckets))).withColumn("slot", slot_of("ek", buckets))
    groups.write.mode("overwrite").partitionBy("slot").parquet(path)


def saved_groups(spark: SparkSession, path: str) -> DataFrame:
    """The kept groups; an evening that was a group and is none any more has ``n_rows`` 1."""
    return spark.read.parquet(path).drop("slot")


def refresh_saved(path: str, rows: DataFrame, keys: DataFrame, buckets: int = 64, dealt: bool = False) -> int:
    """Bring the evenings ``keys(ek)`` up to date from the current ``rows``; gives the number of partitions written.

    Null keys are ignored. ``buckets`` and ``dealt`` are those of ``save_groups``; the driver sees the touched partitions' numbers only.
    """
    spark = rows.sparkSession
    named = cut_lineage(keys.select("ek").where("ek is not null").distinct().withColumn("slot", slot_of("ek", buckets)), "evenings")
    touched = sorted(r.slot for r in named.select("slot").distinct().collect())
    if not touched:
        return 0
    kept = spark.read.parquet(path).where(F.col("slot").isin(touched)).drop("slot")
    now = header_flags((rows if dealt else deal(rows, buckets)).join(named.select("ek"), "ek", "left_semi"))
    fresh = refresh_groups(deal(kept, buckets), now, named).withColumn("slot", slot_of("ek", buckets))
    fresh.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("slot").parquet(path)
    return len(touched)

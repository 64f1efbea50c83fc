"""Corpus pipeline: quality, near duplicates, benchmark decontamination, personal data, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage before kept. All but the last return the
columns of ``documents``; each is written as Parquet in the shared folder and read again for the next.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footlights.llm.common import stash, table
from footlights.llm.decontaminate import contamination
from footlights.llm.jaccard import one_of_each_class
from footlights.llm.packing import pack, token_pieces
from footlights.llm.pii import find_pii, fit_booster, propose, redact
from footlights.llm.quality import RESULTS, fit_line_model, labelled_documents, quality


def _keeping_columns(docs: DataFrame, names: tuple[str, ...], work: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``work(docs)`` with the columns of ``docs``: those that bear a name that the work uses itself are set aside."""
    own = {c: f"_own_{c}" for c in docs.columns if c in names}
    done = work(docs.withColumnsRenamed(own))
    return done.select(*[F.col(own.get(c, c)).alias(c) for c in docs.columns])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality operator keeps."""
    model = fit_line_model(labelled_documents(docs, table(spark, sf_dir, "labels")))
    return _keeping_columns(docs, RESULTS, lambda rows: quality(rows, model).where("kept"))


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates: the one with the least id, then text digest."""
    return one_of_each_class(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item; rows are judged by their texts, whatever ids they share or lack."""
    found = contamination(docs, table(spark, sf_dir, "benchmark")).select(F.col("doc_id").alias("_id"), F.col("version").alias("_of")).distinct()
    same = docs["doc_id"].eqNullSafe(found["_id"]) & (F.md5(F.coalesce(docs["text"], F.lit(""))) == found["_of"])
    return docs.join(found, same, "left_anti").select(*docs.columns)


def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with personal data replaced in their texts; ``n_chars`` follows the new text."""

    def safe(rows: DataFrame) -> DataFrame:
        proposed = stash(propose(rows), "candidates")
        out = redact(find_pii(proposed, fit_booster(proposed)))
        if "n_chars" not in rows.columns:
            return out
        return out.withColumn("n_chars", F.when(F.size("pii") > 0, F.length("text")).otherwise(F.col("n_chars")).cast(rows.schema["n_chars"].dataType))

    return _keeping_columns(docs, ("pii", "_base", "_candidates"), safe)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 4096 tokens."""
    import public_tokenizers

    return pack(token_pieces(docs, public_tokenizers.path("word_bpe_49k.json")))


STAGES = [
    ("quality_rules", quality_rules),
    ("ngram_jaccard_join", jaccard_join),
    ("benchmark_decontamination", decontaminate),
    ("pii", redact_pii),
    ("best_fit_packing", best_fit_packing),
]

#: The learned line model, the boosted trees and the tokenizer have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage but the last is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stash(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

"""Operator 1: language identification by compression against one zstandard raw-content dictionary per language."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import regex
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import schema_with, stash

#: A fitted model: language -> raw dictionary content. Bounded by ``docs_per_language`` and ``dictionary_bytes``.
Dictionaries = dict[str, bytes]

#: A letter, in the fit and in the verdict.
_LETTER = r"\p{L}"


def fit_dictionaries(
    train: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    docs_per_language: int = 96,
    dictionary_bytes: int = 96 * 1024,
    most_languages: int = 200,
) -> Dictionaries:
    """Raw dictionary content per language from a bounded sample of labelled rows.

    The sample is one row for each (language, hash bucket), ``docs_per_language`` buckets, the row with the least hash;
    it is chosen by an aggregate over ids only, and just the texts of the chosen rows reach the driver
    (``docs_per_language`` texts for each of at most ``most_languages`` languages, those with the most documents). Each gives its letters-bearing text, shortest texts last, until
    ``dictionary_bytes`` are full: zstandard finds what lies at the end most cheaply.

    Rows with a null text, null language or no letter teach nothing. No usable row: an empty model.
    """
    usable = train.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull() & F.col(text_col).rlike(_LETTER))
    rows = usable.select(F.col(lang_col).alias("l"), F.col(text_col).alias("t"), F.xxhash64(F.col(id_col).cast("string"), F.lit("dict")).alias("h"))
    chosen = rows.groupBy("l", F.pmod("h", F.lit(docs_per_language)).alias("bucket")).agg(F.min("h").alias("h"), F.count("*").alias("n"))
    chosen = stash(chosen, "sample")  # languages x docs_per_language short rows
    known = chosen.groupBy("l").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "l").limit(most_languages).select("l")
    chosen = chosen.join(F.broadcast(known), "l").select("l", "h")
    # at most most_languages x docs_per_language rows
    texts = rows.join(F.broadcast(chosen), ["l", "h"]).dropDuplicates(["l", "h"]).select("l", F.substring("t", 1, dictionary_bytes).alias("t"), "h").collect()
    model: Dictionaries = {}
    for lang in sorted({r.l for r in texts}):
        share, content = dictionary_bytes, []
        for r in sorted((r for r in texts if r.l == lang), key=lambda r: (len(r.t), r.h, r.t)):
            if share <= 0:
                break
            content.append(part := r.t.lower().encode()[:share])
            share -= len(part) + 1
        model[lang] = b"\n".join(reversed(content))
    return model


def predict_language(
    docs: DataFrame,
    model: Dictionaries,
    text_col: str = "text",
    block_bytes: int = 1024,
    level: int = 6,
    min_margin: float = 0.01,
) -> DataFrame:
    """Add ``lang_pred``, ``score`` and ``rejected`` to every row of ``docs``.

    The whole text, in lower case, is cut into blocks of ``block_bytes``, every block is compressed once with each language's
    dictionary, and the language with the least sum of bytes wins. ``score`` is the margin: 1 - least / second least,
    from 0 to 1. ``rejected`` is true where the margin is below ``min_margin``: the caller may treat those as unknown.

    Null texts, texts without a letter and an empty model give ``und`` with score 0, rejected. Equal sizes: the
    language first in name order, score 0, rejected. A model with one language gives score 1. Other columns are kept;
    input columns that bear a result's name are replaced.
    """
    langs = sorted(model)
    kept = [c for c in docs.columns if c not in ("lang_pred", "score", "rejected")]
    schema = schema_with(docs.select(*kept), lang_pred="string", score="double", rejected="boolean")

    def coders() -> list[zstandard.ZstdCompressor]:
        out = []
        for lang in langs:
            content = zstandard.ZstdCompressionDict(model[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            content.precompute_compress(level=level)
            out.append(zstandard.ZstdCompressor(dict_data=content, level=level, write_checksum=False, write_content_size=False, write_dict_id=False))
        return out

    def verdict(text: str | None, compressors: list[zstandard.ZstdCompressor], letter: regex.Pattern) -> tuple[str, float, bool]:
        if text is None or not compressors or not letter.search(text):
            return "und", 0.0, True
        raw = text.lower().encode()
        blocks = [raw[i : i + block_bytes] for i in range(0, len(raw), block_bytes)]
        sizes = sorted((sum(len(c.compress(b)) for b in blocks), lang) for c, lang in zip(compressors, langs, strict=True))
        score = 1.0 if len(sizes) == 1 else 1.0 - sizes[0][0] / sizes[1][0]
        return sizes[0][1], score, score < min_margin

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        compressors, letter = coders(), regex.compile(_LETTER)
        for pdf in batches:
            found = [verdict(t, compressors, letter) for t in pdf[text_col]]
            pdf = pdf.assign(lang_pred=[x[0] for x in found], score=[x[1] for x in found], rejected=[x[2] for x in found])
            yield pdf

    return docs.select(*kept).mapInPandas(run, schema)


def held_out(id_col: str = "doc_id") -> Column:
    """Whether a document is held out of learning: crc32 of its id as text is divisible by 5 (null id: false)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(False))

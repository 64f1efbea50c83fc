"""The predicted language against sums of compressed blocks, language by language."""

import zstandard
from pyspark.sql import functions as F

from footlights.llm import language


def test_least_sum_of_blocks(spark):
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    model = language.fit_dictionaries(documents.where(~language.held_out() & F.col("lang").isNotNull()))
    rows = documents.where(F.col("text").isNotNull() & (F.col("doc_id") % 12 == 0)).select("doc_id", "text")
    got = {r.doc_id: r for r in language.predict_language(rows, model).collect()}
    assert len(model) > 2 and len(got) > 50
    for r in rows.collect():
        raw, sizes = r.text.lower().encode(), {}
        for lang, content in model.items():
            held = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            held.precompute_compress(level=6)
            coder = zstandard.ZstdCompressor(dict_data=held, level=6, write_checksum=False, write_content_size=False, write_dict_id=False)
            sizes[lang] = sum(len(coder.compress(raw[k : k + 1024])) for k in range(0, len(raw), 1024))
        first, second = sorted((n, lang) for lang, n in sizes.items())[:2]
        mine = got[r.doc_id]
        if mine.lang_pred == "und":
            assert not any(c.isalpha() for c in r.text)
            continue
        assert mine.lang_pred == first[1] and mine.score == 1 - first[0] / second[0] and mine.rejected == (mine.score < 0.01)

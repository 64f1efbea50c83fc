"""The rule ensemble: statistics by hand, compiled rules against arrays, held-out accuracy and odd inputs."""

import random
import re
from math import log2

import numpy as np
import pytest
from pyspark.sql import functions as F

from footlights.llm import language, rules

WORDS = "the of and stage dance evening city venue player light shadow river stone cloud amber violet copper".split()


def prose(seed, n):
    rnd = random.Random(seed)
    return " ".join(rnd.choice(WORDS).capitalize() + str(rnd.randrange(500)) * (rnd.random() < 0.3) for _ in range(n)) + "."


TEXTS = [None, "", " \n\t ", "one", "A b\n\nA b\n \nÜnï c1!? #x", "word " * 3000, prose(1, 50_000), "\x1c x\x0by\n", "a" * 5000]


def by_hand(text):
    text = text or ""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    lines = [x for x in text.split("\n") if x.strip(" \t\x0b\x0c\r")]
    n = {k: len(re.findall(f"[{c}]", text)) for k, c in {"capitals": "A-Z", "small": "a-z", "digits": "0-9", "symbols": "#*$%&|<>", "marks": "!?", "ends": ".,;:"}.items()}
    size = sum(map(len, words))
    share = lambda a, b: a / b if b else 0.0
    return {
        "words": len(words), "mean_word": share(size, len(words)), "symbols": share(n["symbols"], size), "marks": share(n["marks"], len(words)), "ends": share(n["ends"], len(words)),
        "capitals": share(n["capitals"], n["capitals"] + n["small"]), "digits": share(n["digits"], size), "other_letters": share(size - sum(n.values()), size),
        "distinct_words": share(len(set(words)), len(words)), "word_again": share(log2(len(set(words)) + 1), log2(len(words) + 1)),
        "words_a_line": share(len(words), len(lines)), "repeated_lines": share(len(lines) - len(set(lines)), len(lines)),
    }


def test_statistics(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    for r in rules.statistics(df).collect():
        want = by_hand(TEXTS[r.doc_id])
        assert tuple(want) == rules.STATISTICS
        assert [r["_s_" + s] for s in rules.STATISTICS] == pytest.approx(list(want.values())), r.doc_id


@pytest.fixture(scope="module")
def model(spark):
    bad = ["### | %%% | $$$ sale! " * (20 + i % 9) for i in range(60)] + ["again " * (50 + i) for i in range(60)]
    rows = [(i, prose(i, 40 + i % 90)) for i in range(200)] + [(1000 + i, t) for i, t in enumerate(bad)]
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 1000)) for i, _ in rows] + [(None, 1), (3, None), (10**6, 0)], "doc_id long, quality int")
    sample, counts = rules.labelled_statistics(documents, labels)
    assert sample.count() == sum(1 for i, _ in rows if not _crc(i)) and sum(counts.values()) == sum(1 for i in [*(i for i, _ in rows), 10**6] if not _crc(i))
    return rules.fit_rules(sample, counts)


def _crc(i):
    import zlib

    return zlib.crc32(str(i).encode()) % 5 == 0


def test_compiled_rules_equal_arrays(spark, model):
    df = spark.createDataFrame([(i, t) for i, t in enumerate([*TEXTS, prose(7, 60), "### | " * 50])], "doc_id long, text string")
    rows = rules.quality_scores(df, model).orderBy("doc_id").collect()
    stats = np.array([list(r[1:]) for r in rules.statistics(df).drop("text").orderBy("doc_id").collect()], float)
    odds = model.base + sum(r.weight * r.holds(stats) for r in model.rules)
    assert 0 < len(model.rules) < 40
    assert [r.score for r in rows] == pytest.approx(list(1 / (1 + np.exp(-odds))))
    assert [r.predicted for r in rows] == [int(r.score >= 0.3) for r in rows]
    assert rows[-2].predicted == 1 and rows[-1].predicted == 0 and rows[5].predicted == 0


def test_conjunctions_are_learned_and_compiled(spark):
    """Good where long words or many digits occur, not both and not neither: no single statistic tells."""
    rnd = np.random.default_rng(3)
    values = rnd.random((800, len(rules.STATISTICS)))
    a, b = rules.STATISTICS.index("mean_word"), rules.STATISTICS.index("digits")
    good = (values[:, a] > 0.5) != (values[:, b] > 0.4)
    sample = spark.createDataFrame([(int(y), *map(float, v)) for y, v in zip(good, values, strict=True)], "_label int, " + ", ".join(f"{s} double" for s in rules.STATISTICS))
    model = rules.fit_rules(sample, {0: int((~good).sum()), 1: int(good.sum())})
    assert any(len(r.bounds) > 1 for r in model.rules)
    odds = model.base + sum(r.weight * r.holds(values) for r in model.rules)
    assert ((odds > 0) == good).mean() > 0.93
    compiled = np.array([r[0] for r in sample.select(model.score()).collect()])
    assert compiled == pytest.approx(1 / (1 + np.exp(-odds)))


def test_odd_inputs(spark, model):
    clash = spark.createDataFrame([(1, "x", "score of old", "p"), (1, "x", "y", "p"), (None, None, None, None)], "doc_id long, text string, score string, predicted string")
    got = rules.quality_scores(clash, model).collect()
    assert len(got) == 3 and all(0 <= r.score <= 1 for r in got) and got[0].score == got[1].score
    assert rules.quality_scores(clash.limit(0), model).count() == 0
    none = spark.createDataFrame([], "doc_id long, quality int")
    documents = spark.createDataFrame([(1, "text"), (2, "other")], "doc_id long, text string")
    assert rules.fit_rules(*rules.labelled_statistics(documents, none)).score is not None
    assert rules.quality_scores(documents, rules.fit_rules(*rules.labelled_statistics(documents, none))).select("score").distinct().collect()[0][0] == pytest.approx(0.5)
    one = spark.createDataFrame([(1, 1), (2, 1)], "doc_id long, quality int")
    assert rules.quality_scores(documents, rules.fit_rules(*rules.labelled_statistics(documents, one))).first().predicted == 1


def test_held_out_accuracy(spark):
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    model = rules.fit_rules(*rules.labelled_statistics(documents, labels))
    again = rules.fit_rules(*rules.labelled_statistics(documents.repartition(5), labels.repartition(3)))
    assert model == again
    judged = rules.quality_scores(documents, model).join(labels.where(language.held_out() & F.col("quality").isNotNull()), "doc_id")
    assert judged.select(F.avg((F.col("predicted") == F.col("quality")).cast("int"))).first()[0] >= 0.98

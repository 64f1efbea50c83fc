"""The Merkle manifest against a plain tree over all rows, at several sizes of a part."""

import random
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from footlights.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, leaf string, part long, key string"


def digest(text):
    return sha256(text.encode()).hexdigest()


def leaf(row):
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row[:5]))


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([digest("".join(out[-1][k : k + 16])) for k in range(0, len(out[-1]), 16)])
    return out


def plain(rows, change):
    """``(doc_id, source, position, leaf, subroot, root, proof digest, folded root)`` by the book."""
    by = {}
    for r in rows:
        by.setdefault(r[1], []).append((r[0] is not None, r[0] or 0, leaf(r), leaf(change(r))))
    groups = sorted(by, key=lambda g: (g is not None, (g or "").encode()))
    trees = [levels([x[2] for x in sorted(by[g])]) for g in groups]
    top = levels([t[-1][0] for t in trees])
    out = []
    for place, (g, tree) in enumerate(zip(groups, trees, strict=True)):
        for k, (known, doc_id, own, claimed) in enumerate(sorted(by[g])):
            proof, node = "", claimed
            for way, at in ((tree, k), (top, place)):
                for nodes in way[:-1]:
                    first = at - at % 16
                    before, after = "".join(nodes[first:at]), "".join(nodes[at + 1 : first + 16])
                    proof, node, at = proof + before + after, digest(before + node + after), at // 16
            out.append((doc_id if known else None, g, k, own, tree[-1][0], top[-1][0], digest(proof), node))
    return out


def got(spark, rows, local):
    df = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA).repartition(3)
    found = merkle.merkle_manifest(df, claimed={"text": F.translate("text", "AB", "ab")}, local=local)
    before, after = F.col("before"), F.col("after")
    return found.select("doc_id", "source", "position", "leaf", "subroot", "root", merkle.proof_digest(before, after), merkle.fold(F.col("claimed_leaf"), before, after))


def lowered(r):
    return (*r[:4], r[4].replace("A", "a").replace("B", "b") if r[4] else r[4])


@pytest.mark.parametrize("local", [1, merkle.LOCAL])
def test_against_a_plain_tree(spark, local):
    """Parts of 16 rows need three rounds inside the large group and two over the groups; null and equal ids, nulls in every column."""
    rnd = random.Random(local)
    rows = []
    for g in [None, "", "é", "a", *(f"s{i}" for i in range(17))]:
        for k in range({"a": 1100, "é": 257, "s1": 1, "s2": 16, "s3": 17}.get(g, rnd.randrange(1, 30))):
            rows.append((rnd.choice([None, k, k + 1]) if g == "é" else k, g, rnd.choice(["en", None]), rnd.choice([1, None]), rnd.choice(["Ab", None, "", "ü B"])))
    rows += rows[:60] + [(5, "long", "en", 1, "AB " * 300_000)]
    assert sorted(map(str, map(tuple, got(spark, rows, local).collect()))) == sorted(map(str, plain(rows, lowered)))


def test_one_row_and_none(spark):
    one = got(spark, [(7, None, None, None, "AB")], 3).collect()
    assert [tuple(r) for r in one] == plain([(7, None, None, None, "AB")], lowered)
    assert one[0][6] == digest("")
    assert got(spark, [(7, None, None, None, "AB")], 3).limit(0).count() == 0
    empty = spark.createDataFrame([], SCHEMA)
    assert merkle.merkle_manifest(empty).count() == 0


def test_large_ids_keep_their_value(spark):
    rows = [(2**62 + 1, "a", None, None, None), (None, "a", None, None, None)]
    assert {r.doc_id for r in got(spark, rows, 3).collect()} == {2**62 + 1, None}

"""Hard negatives against whole-number arithmetic in plain Python."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from footlights.llm import negatives

SCHEMA = "vec_id long, embedding array<float>, label int, row long, v string, id string, anchor string"


def plain(rows, every, positives=5, keep=3):
    used = [(i, [math.floor(256 * float(np.float32(x))) for x in v], y) for i, v, y in rows if i is not None and y is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, (i, v, y) in enumerate(used):
        if i % every:
            continue
        scored = sorted((-sum(p * q for p, q in zip(v, w, strict=False)), j, z == y) for b, (j, w, z) in enumerate(used) if b != a)
        for score, j, _ in [s for s in scored if s[2]][:positives]:
            low = [s for s in scored if not s[2] and -50 * score <= -100 * s[0] <= -95 * score][:keep]
            out += [(i, j, k, s[1], -score, -s[0]) for k, s in enumerate(low, 1)]
    return sorted(out)


def got(spark, rows, every, **more):
    df = spark.createDataFrame([(*r, 1, "v", "i", "a") for r in rows], SCHEMA).repartition(5)
    return sorted(map(tuple, negatives.hard_negatives(df, F.col("vec_id") % every == 0, **more).collect()))


def vectors(seed, n, dims, labels, spread=0.6):
    rnd = np.random.default_rng(seed)
    centre = rnd.normal(size=dims) * 1.5 + rnd.normal(size=(labels, dims))
    out = []
    for i in range(n):
        v = centre[i % labels] * 0.5 + rnd.normal(size=dims) * spread
        out.append((i, (v / np.linalg.norm(v)).astype(np.float32).tolist(), i % labels))
    return out


@pytest.mark.parametrize(("dims", "labels"), [(16, 4), (300, 3)])
def test_against_plain_arithmetic(spark, dims, labels):
    rows = vectors(dims, 400, dims, labels)
    want = plain(rows, 20)
    assert want and got(spark, rows, 20) == want
    # anchors in many chunks
    assert got(spark, rows, 20, chunk_bytes=8 * dims * 7) == want


def test_odd_rows(spark):
    rnd = random.Random(5)
    rows = vectors(1, 150, 8, 3) + [(10, [0.5] * 8, 1)] * 40 + [(11, [0.5] * 8, 2)] * 30 + [(20, [0.25] * 4, 1), (21, [0.5, 0.5], 2), (40, [], 0)]
    rows += [(None, [0.5] * 8, 1), (30, None, 1), (50, [0.5] * 8, None), (60, [0.5, None] * 4, 1), (70, [float("nan")] * 8, 1), (80, [float("inf")] + [0.0] * 7, 1), (90, [-0.5] * 8, 1), (100, [0.0] * 8, 2)]
    rnd.shuffle(rows)
    # ids 10 and 20 occur again: each row is an anchor of its own
    assert got(spark, rows, 10) == plain(rows, 10)
    assert got(spark, [], 10) == [] and got(spark, [(1, [1.0], 1)], 10) == [] and got(spark, [(10, [1.0], 1)], 10) == []
    assert got(spark, [(10, [1.0], 1), (11, [1.0], 1)], 10) == []


def test_large_components(spark):
    rows = [(i, [random.Random(i * 9 + k).uniform(-9e3, 9e3) for k in range(8)], i % 2) for i in range(60)]
    assert got(spark, rows, 5) == plain(rows, 5)
    with pytest.raises(ValueError, match="cannot be told"):
        got(spark, [(0, [1e30], 1)], 5)


@pytest.mark.parametrize(("dims", "most"), [(1, 2**20), (64, 2**11), (700, 2**19), (5, 2**23)])
def test_residues_give_exact_products(dims, most):
    rnd = np.random.default_rng(dims)
    a, b = rnd.integers(-most, most + 1, (40, dims)), rnd.integers(-most, most + 1, (50, dims))
    a[0], b[0], a[1] = most, most, -most
    system = negatives.Residues.of(dims, dims * most**2)
    want = np.array(a.astype(object) @ b.astype(object).T)
    assert (system.scores(system.split(a), system.split(b)) == want).all()

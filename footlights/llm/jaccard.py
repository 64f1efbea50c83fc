"""Operator 9: Jaccard join on word shingles with Bayesian pruning of candidate pairs."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from math import exp, lgamma, log

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from .common import bounded_or_shuffled, cluster, slices, stash, text_or_empty

#: 28 bands of 4 values: a pair at a similarity of 0.8 is missed with probability (1 - 0.8**4)**28 = 4e-7.
BANDS, ROWS = 28, 4
HASHES = BANDS * ROWS
#: Pairs are compared by so many values at a time.
STEP = 16
_KEPT_WORDS = 300_000
#: Digests of up to so many candidate texts (16 bytes each) are broadcast to pick them; more are joined by a shuffle.
BROADCAST_TEXTS = 300_000


@lru_cache(maxsize=1)
def _permutations() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240101)
    return rng.integers(1, 1 << 63, HASHES, np.uint64) | np.uint64(1), rng.integers(0, 1 << 63, HASHES, np.uint64)


def shingles(text: str, size: int, known: dict[bytes, int]) -> np.ndarray:
    """Sorted distinct 64-bit fingerprints of the text's windows of ``size`` words.

    A text of fewer words has one shingle of all its words; a text without a word has none.
    """
    import xxhash

    words = text.encode().split()
    if not words:
        return np.zeros(0, np.uint64)
    if len(known) > _KEPT_WORDS:
        known.clear()
    for w in set(words).difference(known):
        known[w] = xxhash.xxh3_64_intdigest(w)
    ids = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    n = max(1, len(ids) - size + 1)
    out = np.zeros(n, np.uint64)
    for k in range(min(size, len(ids))):
        out = (out ^ (out >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + ids[k : k + n]
    out ^= out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    return np.unique(out ^ (out >> np.uint64(32)))


def minhashes(prints: np.ndarray) -> np.ndarray:
    """``HASHES`` MinHash values (32 bits) of a set of fingerprints."""
    mul, add = _permutations()
    least = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(prints), 512):  # small blocks stay in the cache
        part = prints[at : at + 512, None] * mul
        part += add
        np.minimum(least, part.min(axis=0), out=least)
    return (least >> np.uint64(32)).astype(np.uint32)


@lru_cache(maxsize=64)
def least_agreements(threshold: float, tolerance: float) -> tuple[int, ...]:
    """For each multiple of ``STEP`` values compared: the least number of agreements with which a pair lives on.

    With a uniform prior the similarity's posterior after m agreements of n is Beta(m + 1, n - m + 1); a pair is dropped
    when its probability of reaching ``threshold`` is below ``tolerance``. For whole numbers that probability is a
    binomial sum: P(Beta(m + 1, n - m + 1) >= t) = P(Binomial(n + 1, t) <= m).
    """
    out = []
    for n in range(STEP, HASHES + 1, STEP):
        total = 0.0
        for m in range(n + 2):
            total += exp(lgamma(n + 2) - lgamma(m + 1) - lgamma(n + 2 - m) + m * log(threshold) + (n + 1 - m) * log(1 - threshold))
            if total >= tolerance:
                break
        out.append(m)
    return tuple(out)


def _prepared(text: str, size: int, known: dict[bytes, int]) -> tuple[bytes, np.ndarray]:
    """A digest of the text's shingle set, equal for copies, and the set."""
    from hashlib import blake2b

    prints = shingles(text, size, known)
    return blake2b(prints.tobytes(), digest_size=16).digest(), prints


def signatures(docs: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """``(doc_id, version, fingerprint, n_shingles, signature)`` for every row; no signature for texts without a word.

    ``version`` is an MD5 digest of the text, ``fingerprint`` a digest of its shingle set.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"), _version(text_col).alias("version"))
    schema = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, version string, fingerprint binary, n_shingles int, signature binary"

    shape = to_arrow_schema(rows.select("doc_id", "version").schema)
    shape = shape.append(pa.field("fingerprint", pa.binary())).append(pa.field("n_shingles", pa.int32())).append(pa.field("signature", pa.binary()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = {}
        for part in slices(batches):
            signed = []
            for text in part["text"].to_pylist():  # a set is dropped as soon as it is signed
                fingerprint, prints = _prepared(text, size, known)
                signed.append((fingerprint, len(prints), minhashes(prints).tobytes() if len(prints) else None))
            yield pa.RecordBatch.from_arrays([part["doc_id"], part["version"], *(pa.array(x, f.type) for x, f in zip(zip(*signed, strict=True), list(shape)[2:], strict=True))], schema=shape)

    return rows.mapInArrow(run, schema)


def _version(text_col: str) -> Column:
    return F.md5(text_or_empty(text_col))


def _matching_pairs(sigs: np.ndarray, rows: np.ndarray, cols: np.ndarray, needed: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (row < col) of two index ranges that survive the incremental comparison."""
    keep_i, keep_j = [], []
    for i in rows:
        js = cols[cols > i] if len(cols) and cols[0] <= i else cols
        agree = np.zeros(len(js), np.int32)
        for step, least in enumerate(needed):
            part = slice(step * STEP, (step + 1) * STEP)
            agree += (sigs[js, part] == sigs[i, part]).sum(axis=1, dtype=np.int32)
            alive = agree >= least
            if not alive.all():
                js, agree = js[alive], agree[alive]
            if not len(js):
                break
        keep_i.append(np.full(len(js), i))
        keep_j.append(js)
    return np.concatenate(keep_i or [np.zeros(0, int)]), np.concatenate(keep_j or [np.zeros(0, int)])


def _classes(
    docs: DataFrame, id_col: str, text_col: str, size: int, threshold: float, tolerance: float, block: int
) -> tuple[DataFrame, DataFrame]:
    """Rows ``(doc_id, version, fingerprint, n_shingles)``, and ``(fingerprint, class, links, copies, doc_id)`` of the nodes."""
    rows = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"), _version(text_col).alias("version"))
    sigs = stash(signatures(rows, "doc_id", "text", size), "signatures")
    with_words = sigs.where("n_shingles > 0")
    nodes = stash(with_words.groupBy("fingerprint").agg(F.min("doc_id").alias("doc_id"), F.min("version").alias("version"), F.count("*").alias("copies"), F.first("signature").alias("signature")), "nodes")
    key = lambda b: F.xxhash64(F.lit(b), F.substring("signature", b * 4 * ROWS + 1, 4 * ROWS))
    # a short name of a node: two nodes with one name would only be compared more often
    bands = nodes.select(F.xxhash64("fingerprint").alias("node"), F.explode(F.array(*[key(b) for b in range(BANDS)])).alias("band"))
    buckets = bands.groupBy("band").agg(F.min("node").alias("least"), F.max("node").alias("most")).where("least <> most").select("band", "least")
    ties = stash(bands.join(buckets, "band"), "ties")
    # a node's home is the least of its buckets' least nodes; a home with many nodes has several blocks
    homes = ties.groupBy("node").agg(F.min("least").alias("home"))
    sizes = homes.groupBy("home").agg(F.ceil(F.count("*") / block).cast("int").alias("k"))
    placed = stash(homes.join(sizes, "home").select("node", F.xxhash64("home", F.pmod(F.xxhash64("node"), F.col("k"))).alias("block")), "placed")
    # two blocks are compared if they share a bucket
    shared = stash(ties.join(placed, "node").select("band", "block").distinct(), "shared")
    other = shared.select("band", F.col("block").alias("col"))
    cells = stash(shared.select("band", F.col("block").alias("row")).join(other, "band").where("row <= col").select("row", "col").distinct(), "cells")
    parts = cells.select(F.col("row").alias("block"), "row", "col").unionByName(cells.where("row <> col").select(F.col("col").alias("block"), "row", "col"))
    wanted = stash(nodes.select("fingerprint", "version", "copies", F.xxhash64("fingerprint").alias("node")).join(placed, "node").drop("node"), "wanted")
    n_wanted = wanted.count()
    texts = rows.join(bounded_or_shuffled(wanted.select("version"), n_wanted, BROADCAST_TEXTS), "version", "left_semi").dropDuplicates(["version"])
    payload = stash(signatures_with_sets(texts, size), "sets").join(wanted.select("fingerprint", "copies", "block"), "fingerprint")
    dealt = payload.join(parts, "block")
    needed = least_agreements(threshold, tolerance)

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("fingerprint", kind="stable")
        sig = np.stack([np.frombuffer(s, np.uint32) for s in pdf["signature"]])
        sets = [np.frombuffer(p, np.uint64) for p in pdf["prints"]]
        node, copies, b = pdf["fingerprint"].to_numpy(), pdf["copies"].to_numpy(), pdf["block"].to_numpy()
        row, col = pdf["row"].iloc[0], pdf["col"].iloc[0]
        every = np.arange(len(pdf))
        if row == col:
            i, j = _matching_pairs(sig, every, every, needed)
        else:
            order = np.argsort(b != row, kind="stable")  # the first block before the second
            sig, sets, node, copies = sig[order], [sets[x] for x in order], node[order], copies[order]
            first = int((b == row).sum())
            i, j = _matching_pairs(sig, every[:first], every[first:], needed)
        links, edge = np.zeros(len(node), np.int64), np.arange(len(node))
        for x, y in zip(i.tolist(), j.tolist(), strict=True):
            small, large = (sets[x], sets[y]) if len(sets[x]) <= len(sets[y]) else (sets[y], sets[x])
            if len(small) < threshold * len(large):
                continue
            at = np.searchsorted(large, small)
            both = int((large[np.minimum(at, len(large) - 1)] == small).sum())
            if both >= threshold * (len(small) + len(large) - both):
                links[x] += copies[y]
                links[y] += copies[x]
                while edge[x] != x:
                    x = edge[x]
                while edge[y] != y:
                    y = edge[y]
                edge[max(x, y)] = min(x, y)
        return pd.DataFrame({"fingerprint": node, "links": links, "edge": node[edge]})

    found = stash(dealt.groupBy("row", "col").applyInPandas(compare, "fingerprint binary, links long, edge binary"), "links")
    text_of = lambda c: F.hex(c)
    classes = cluster(found.where("fingerprint <> edge").select(text_of("fingerprint").alias("a_id"), text_of("edge").alias("b_id")))
    linked = found.groupBy("fingerprint").agg(F.sum("links").alias("links"))
    named = nodes.select("fingerprint", "doc_id", "copies", text_of("fingerprint").alias("id")).join(linked, "fingerprint", "left").join(classes, "id", "left")
    told = named.select("fingerprint", F.coalesce("cluster_id", "id").alias("class"), F.coalesce("links", F.lit(0)).cast("long").alias("links"), "copies", "doc_id")
    return sigs.drop("signature"), stash(told, "classes")


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = 5,
    threshold: float = 0.8,
    tolerance: float = 1e-6,
    block: int = 512,
) -> DataFrame:
    """Classes of near duplicates: ``(doc_id, class_id, n_links)``, one row for every row of ``docs``.

    Two documents are linked if the Jaccard similarity of their sets of ``size``-word shingles is at least
    ``threshold``; ``class_id`` is the least id among all that are linked directly or through others, and ``n_links``
    the number of documents linked to this one, copies included.

    1. Documents with equal shingle sets form one node, kept once, with a count.
    2. Nodes that share a band of MinHash values share a bucket. A node is filed in a block of at most about ``block``
       nodes under the least node of its buckets, and two blocks are compared if some bucket has nodes of both: texts
       that are only tied through a chain of others are not.
    3. Blocks are compared in cells: MinHash values in steps, a pair being dropped when the posterior probability of
       reaching ``threshold`` falls below ``tolerance``; the rest is verified on the whole shingle sets. A cell returns
       a count of links and one edge for each node, never the pairs.
    4. Counts are summed over cells, edges give the classes.

    Null and empty texts and texts without words have no shingle: a class of their own each, no link. Every row is a
    document: rows that share an id are compared by their texts, rows with equal texts are links of each other. Null ids
    are compared too; ``class_id`` is null only if no document of the class has an id. Extra columns are ignored.
    """
    rows, nodes = _classes(docs, id_col, text_col, size, threshold, tolerance, block)
    least = nodes.groupBy("class").agg(F.min("doc_id").alias("class_id"))
    told = stash(nodes.join(least, "class").select("fingerprint", "class_id", (F.col("links") + F.col("copies") - 1).alias("n_links")), "told")
    with_words = rows.where("n_shingles > 0").join(told, "fingerprint").select("doc_id", "class_id", "n_links")
    return with_words.unionByName(rows.where("n_shingles = 0").select("doc_id", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links")))


def one_of_each_class(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, threshold: float = 0.8, tolerance: float = 1e-6, block: int = 512) -> DataFrame:
    """The rows of ``docs`` without near duplicates: of each class one row, that with the least id, then text digest.

    Rows are told apart by id and text, so different texts that share an id or have none are judged by their texts. A
    null id comes last. Rows that agree in id and text are one (any of them, whatever their other columns). Texts without
    a word have no duplicates: all their rows stay.
    """
    rows, nodes = _classes(docs, id_col, text_col, size, threshold, tolerance, block)
    chosen = (
        rows.where("n_shingles > 0").join(nodes.select("fingerprint", "class"), "fingerprint")
        .groupBy("class").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "version")).alias("first"))
    )
    keys = stash(chosen.select(F.col("first.doc_id").alias("_id"), F.col("first.version").alias("_key")), "chosen")
    keyed = docs.withColumn("_version", _version(text_col))
    wordless = ~text_or_empty(text_col).rlike(r"[^\x20\x09-\x0D]")
    kept = keyed.where(~wordless).join(keys, keyed[id_col].eqNullSafe(keys["_id"]) & (keyed["_version"] == keys["_key"]), "left_semi").dropDuplicates([id_col, "_version"])
    return kept.unionByName(keyed.where(wordless)).select(*docs.columns)


def signatures_with_sets(rows: DataFrame, size: int) -> DataFrame:
    """``(fingerprint, signature, prints)`` of candidate rows; ``prints`` is the sorted shingle set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = {}
        for part in slices(batches, 500):  # sets are larger than texts
            found = [_prepared(t, size, known) for t in part["text"].to_pylist()]
            columns = [f for f, _ in found], [minhashes(p).tobytes() for _, p in found], [p.tobytes() for _, p in found]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in columns], ["fingerprint", "signature", "prints"])

    return rows.select("text").mapInArrow(run, "fingerprint binary, signature binary, prints binary")

"""Operator 13: hard negatives by exact integer scores, multiplied modulo small primes in single precision.

Components become integers; a score is an integer inner product. Each matrix of integers is split into its residues modulo
a few small primes (a residue number system). Residues are so small that their float32 products add up exactly, so every
residue of a score comes out of one plain matrix product; the signed score follows by Chinese remaindering.

The stated queries (anchors) are taken in chunks of a counted size that are broadcast; all rows are scanned against a
chunk, each task keeps the best few per anchor, and windows select among the tasks' rows. No pair is shuffled but these.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import own_path, stash
from ..operators.graph import gone_at_end

#: Sums of float32 products of residues stay below this, so that they and their neighbours are exact.
_EXACT = 2**23
#: Components of a matrix product at once; longer vectors are added up slab by slab.
_SLAB = 256
#: Bytes of anchors (as 8-byte components) that are broadcast at once.
CHUNK_BYTES = 2**25
#: Anchors and rows of one product of matrices.
_ANCHORS, _ROWS = 256, 8192
#: Scores beyond this cannot be told apart from their places in one 64-bit number (with _ROWS places).
MOST = 2**49
_NEVER = np.iinfo(np.int64).min


@dataclass(frozen=True)
class Residues:
    """A residue number system for inner products of ``dims`` components whose values are within ``bound``."""

    dims: int
    primes: tuple[int, ...]

    @staticmethod
    def of(dims: int, bound: int) -> Residues:
        """The largest primes whose products stay exact, as many as tell all scores within ``bound`` apart."""
        top, primes, product = 2 * isqrt(_EXACT // max(1, min(dims, _SLAB))) + 1, [], 1
        while product <= 4 * bound + 4:
            top -= 1
            if all(top % k for k in range(2, isqrt(top) + 1)):
                primes.append(top)
                product *= top
        return Residues(dims, tuple(primes))

    def split(self, values: np.ndarray) -> list[np.ndarray]:
        """Residues of an integer matrix, nearest to zero, one float32 matrix a prime."""
        out = []
        for p in self.primes:
            r = values % p
            out.append(np.where(r > p // 2, r - p, r).astype(np.float32))
        return out

    def scores(self, left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
        """Exact inner products of all rows of two matrices that were split."""
        digits, total, scale = [], 0, 1
        for k, p in enumerate(self.primes):
            digit = np.float32(0)
            for at in range(0, max(1, self.dims), _SLAB):
                digit = _near(digit + left[k][:, at : at + _SLAB] @ right[k][:, at : at + _SLAB].T, p)
            # mixed radix: the digit of this prime is what the ones before leave, divided by their product
            for q, before in zip(self.primes, digits, strict=False):
                digit = _near((digit - before) * np.float32(_balanced(pow(q, -1, p), p)), p)
            digits.append(digit)
            total = total + digit.astype(np.int64) * scale
            scale *= p
        return total


def _balanced(r: int, p: int) -> int:
    return r - p if r > p // 2 else r


def _near(x: np.ndarray, p: int) -> np.ndarray:
    """``x`` less a multiple of ``p``, at most about half of ``p`` in size."""
    return x - np.float32(p) * np.rint(x * np.float32(1 / p))


def hard_negatives(
    vectors: DataFrame, anchors: Column, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding", positives: int = 5, negatives: int = 3,
    low: int = 50, high: int = 95, scale: int = 256, chunk_bytes: int = CHUNK_BYTES,
) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)`` for the rows where ``anchors`` holds.

    Components become ``floor(scale * x)``; a score is the integer inner product. An anchor's positives are its
    ``positives`` best other rows of its label; for each, the ``negatives`` best rows of another label with ``low`` to
    ``high`` percent of the positive's score are returned, ranked from 1. Higher scores come first, ties by smaller id.
    Fewer rows are found where there are no more; a pair without one gives no row.

    Rows with a null id, label or vector or a null or non-finite component take no part. Shorter vectors end in zeros.
    Rows that share an id are rows of their own: each is an anchor, a positive or a negative. An empty table gives no
    row. Other columns are not read. Scores must stay below 2**49 in size (the square of the longest scaled vector is
    checked), else the operator refuses.
    """
    finite = F.forall(F.col(vector_col), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    used = vectors.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & F.col(vector_col).isNotNull() & F.coalesce(finite, F.lit(False)))
    vector = F.transform(F.col(vector_col), lambda x: x.cast("double") * scale)
    rows = used.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).alias("label"), F.coalesce(anchors, F.lit(False)).alias("anchor"), vector.alias("v"))
    # rounding down moves a component by less than one
    norm = F.aggregate("v", F.lit(0.0), lambda s, x: s + (F.abs(x) + 1) * (F.abs(x) + 1))
    bound, dims = rows.agg(F.coalesce(F.max(norm), F.lit(0.0)), F.coalesce(F.max(F.size("v")), F.lit(0))).first()
    if bound >= MOST:
        raise ValueError(f"scores of up to {bound:.3g} cannot be told exactly; scale components by less than {scale}")
    kind = "short" if bound < 2**28 else "int" if bound < 2**60 else "long"
    whole = F.transform("v", lambda x: F.floor(x).cast(kind))
    rows = stash(rows.select(F.monotonically_increasing_id().alias("row"), "id", "label", "anchor", whole.alias("v")), "vectors")
    system = Residues.of(dims, int(bound) + 1)
    found = [own_path(vectors.sparkSession, name) for name in ("positives", "negatives")]
    for part in _chunks(rows.where("anchor").drop("anchor"), max(1, chunk_bytes // (8 * max(1, dims)))):
        _mine(rows, part, system, positives, negatives, low, high, found)
    return _read(vectors.sparkSession, found[1], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")


def _read(spark, path: str, schema: str) -> DataFrame:
    fs = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not fs.getFileSystem(spark._jsc.hadoopConfiguration()).exists(fs):
        return spark.createDataFrame([], schema)
    gone_at_end(spark, path)
    return spark.read.schema(schema).parquet(path)


def _chunks(anchors: DataFrame, most: int) -> Iterator[DataFrame]:
    """The anchors in hashed parts, each counted to have at most ``most`` rows."""
    n = -(-anchors.count() // most)
    while n:
        part = F.pmod(F.xxhash64("row"), F.lit(n))
        if anchors.groupBy(part.alias("part")).count().agg(F.max("count")).first()[0] <= most:
            break
        n += 1
    for k in range(n):
        yield anchors.where(part == k)


def _matrix(table: pa.Table | pa.RecordBatch, dims: int) -> np.ndarray:
    """The vectors as an integer matrix, shorter ones with zeros at their end."""
    column = table["v"].combine_chunks() if isinstance(table["v"], pa.ChunkedArray) else table["v"]
    sizes, values = np.diff(column.offsets.to_numpy()), column.flatten().to_numpy(zero_copy_only=False)
    if len(sizes) and (sizes == dims).all():
        return values.reshape(-1, dims).astype(np.int64)
    out = np.zeros((len(sizes), dims), np.int64)
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = values
    return out


def _numpy(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    return column.to_numpy() if isinstance(column, pa.ChunkedArray) else column.to_numpy(zero_copy_only=False)


class _Best:
    """The best ``keep`` of all candidates seen, per place: scores and ids."""

    def __init__(self, places: int, keep: int) -> None:
        self.keep, self.scores, self.ids = keep, np.full((places, keep), _NEVER), np.full((places, keep), _NEVER)

    def add(self, places: slice, scores: np.ndarray, allowed: np.ndarray, ids: np.ndarray) -> None:
        """Candidates of ``places``: a column an id, ascending; at most ``_ROWS`` columns, scores within ``MOST``."""
        n = len(ids)
        # a score and its place in one number: the larger is the better, none are equal
        keys = np.where(allowed, scores * n + np.arange(n - 1, -1, -1), _NEVER)
        top = np.partition(keys, n - self.keep, axis=1)[:, n - self.keep :] if n > self.keep else keys
        fits = top != _NEVER
        score = np.where(fits, top // n, _NEVER)
        who = np.where(fits, ids[n - 1 - top % n], _NEVER)
        both, all_ids = np.hstack([self.scores[places], score]), np.hstack([self.ids[places], who])
        order = np.lexsort((all_ids, -np.maximum(both, _NEVER + 1)), axis=1)[:, : self.keep]
        self.scores[places], self.ids[places] = np.take_along_axis(both, order, 1), np.take_along_axis(all_ids, order, 1)

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        place, k = np.nonzero(self.scores != _NEVER)
        return place, self.scores[place, k], self.ids[place, k]


def _slabs(batches: Iterator[pa.RecordBatch], system: Residues, known: dict) -> Iterator[tuple]:
    """Rows of at most ``_ROWS``, by ascending id: row numbers, ids, labels and residues."""
    for batch in batches:
        for at in range(0, batch.num_rows, _ROWS):
            part = batch.slice(at, _ROWS)
            ids = _numpy(part["id"])
            order = np.argsort(ids, kind="stable")
            # labels that no anchor has are all alike: -1
            labels = np.array([known.get(x, -1) for x in part["label"].to_pylist()], np.int64)
            yield _numpy(part["row"])[order], ids[order], labels[order], _matrix(part, system.dims)[order]


def _mine(rows: DataFrame, part: DataFrame, system: Residues, positives: int, negatives: int, low: int, high: int, paths: list[str]) -> None:
    """Positives, then negatives of one chunk of anchors, appended to ``paths``."""
    spark = rows.sparkSession
    # a chunk of a counted size; sorted so that a block of anchors has few labels
    held = part.orderBy("label", "id", "row").toArrow()
    known = {x: k for k, x in enumerate(dict.fromkeys(held["label"].to_pylist()))}
    labels = np.array([known[x] for x in held["label"].to_pylist()], np.int64)
    ids, numbers = _numpy(held["id"]), _numpy(held["row"])
    sent = spark.sparkContext.broadcast((known, labels, ids, numbers, _matrix(held, system.dims)))
    blocks = [slice(at, at + _ANCHORS) for at in range(0, len(ids), _ANCHORS)]

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, labels, ids, numbers, matrix = sent.value
        best, left = _Best(len(ids), positives), [system.split(matrix[b]) for b in blocks]
        for row, row_ids, row_labels, values in _slabs(batches, system, known):
            right = system.split(values)
            for b, block in zip(blocks, left, strict=True):
                some = np.flatnonzero(np.isin(row_labels, labels[b]))
                if len(some):
                    allowed = (labels[b, None] == row_labels[some]) & (numbers[b, None] != row[some])
                    best.add(b, system.scores(block, [m[some] for m in right]), allowed, row_ids[some])
        place, score, who = best.rows()
        yield pa.RecordBatch.from_pydict({"place": pa.array(place, pa.int64()), "score": pa.array(score, pa.int64()), "id": pa.array(who, pa.int64())})

    found = rows.select("row", "id", "label", "v").mapInArrow(near, "place long, score long, id long")
    first = Window.partitionBy("place").orderBy(F.desc("score"), "id")
    chosen = stash(found.withColumn("slot", F.row_number().over(first) - 1).where(F.col("slot") < positives), paths[0].rpartition("/")[2])
    kept = chosen.toArrow()  # at most ``positives`` rows an anchor of the chunk
    scores, with_ids = np.full((len(ids), positives), _NEVER), np.zeros((len(ids), positives), np.int64)
    at = _numpy(kept["place"]), _numpy(kept["slot"])
    scores[at], with_ids[at] = _numpy(kept["score"]), _numpy(kept["id"])
    pairs = spark.sparkContext.broadcast((scores, with_ids))

    def far(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, labels, ids, numbers, matrix = sent.value
        scores, with_ids = pairs.value
        best, left = [_Best(len(ids), negatives) for _ in range(positives)], [system.split(matrix[b]) for b in blocks]
        for _, row_ids, row_labels, values in _slabs(batches, system, known):
            right = system.split(values)
            for b, block in zip(blocks, left, strict=True):
                percent = 100 * system.scores(block, right)
                other = labels[b, None] != row_labels
                for slot in range(positives):
                    target = np.maximum(scores[b, slot, None], -1)  # a score below zero has no negative
                    allowed = other & (percent >= low * target) & (percent <= high * target)
                    if allowed.any():
                        best[slot].add(b, percent // 100, allowed, row_ids)
        for slot in range(positives):
            place, score, who = best[slot].rows()
            same = {"place": place, "slot": np.full(len(place), slot), "anchor_id": ids[place], "positive_id": with_ids[place, slot], "positive_score": scores[place, slot]}
            yield pa.RecordBatch.from_pydict({k: pa.array(v, pa.int64()) for k, v in (same | {"negative_id": who, "negative_score": score}).items()})

    found = rows.select("row", "id", "label", "v").mapInArrow(far, "place long, slot long, anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long")
    first = Window.partitionBy("place", "slot").orderBy(F.desc("negative_score"), "negative_id")
    ranked = found.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= negatives)
    ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").write.mode("append").parquet(paths[1])
    sent.unpersist()
    pairs.unpersist()

"""Operator 4: benchmark decontamination by greedy string tiling."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from .common import slices, stash, text_or_empty

_NOT_WORD = re.compile(r"[^\w]+|_+")
#: Base of the running hash (an odd 64-bit number), and the least and most address bits of the bitmap that goes to all
#: tasks (1 to 16 MB): sixteen places for each window of the benchmark, as far as that goes.
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MAP_BITS = (23, 27)
#: Words kept by a worker before its table starts anew.
_KEPT_WORDS = 300_000


def normal_word(chunk: bytes) -> str:
    """A white-space separated chunk in lower case without punctuation; may be empty."""
    return _NOT_WORD.sub("", chunk.decode().lower())


def word_hash(word: str) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(word)


def running_hashes(words: np.ndarray, length: int) -> np.ndarray:
    """Karp-Rabin hashes of all windows of ``length`` word hashes, modulo 2**64."""
    n = len(words) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for k in range(length):  # Horner; a window is short
        out = out * _BASE + words[k : k + n]
    return out ^ (out >> np.uint64(29))


def windows(rows: DataFrame, length: int, bitmap: Broadcast | None = None, bits: int = 0) -> DataFrame:
    """``(id, version, at, seed, words)``: places of word windows of ``rows(id, version, text)``, by running hash and by their words.

    ``bitmap`` marks the wanted hashes by their highest ``bits`` bits: other windows never become rows.
    """
    shape = to_arrow_schema(rows.select("id", "version").schema)
    for name, kind in (("at", pa.int32()), ("seed", pa.int64()), ("words", pa.string())):
        shape = shape.append(pa.field(name, kind))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = None if bitmap is None else np.frombuffer(bitmap.value, np.uint8)
        known: dict[bytes, int] = {}
        for part in slices(batches):
            out: list[tuple] = []
            for key, version, text in zip(*(part[c].to_pylist() for c in ("id", "version", "text")), strict=True):
                chunks = text.encode().split()
                if len(known) > _KEPT_WORDS:
                    known.clear()
                for c in set(chunks).difference(known):
                    known[c] = word_hash(w) if (w := normal_word(c)) else 0
                hashes = np.fromiter(map(known.__getitem__, chunks), np.uint64, len(chunks))
                real = np.flatnonzero(hashes)
                seeds = running_hashes(hashes[real], length)
                places = np.arange(len(seeds))
                if wanted is not None:
                    spots = (seeds >> np.uint64(64 - bits)).astype(np.int64)
                    places = np.flatnonzero(wanted[spots >> 3] >> (spots & 7).astype(np.uint8) & 1)
                out += [(key, version, int(p), int(seeds[p].view(np.int64)), " ".join(normal_word(chunks[i]) for i in real[p : p + length])) for p in places]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), shape, strict=True)], schema=shape)

    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, version string, at int, seed long, words string")


def greedy_tiles(runs: Iterable[tuple[int, int, int]], length: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling of two token strings from their maximal matches ``(i, j, n)`` of ``n`` >= ``length`` tokens.

    The longest match of unmarked tokens is marked first, then the next, until none of at least ``length`` tokens is
    left; equal lengths go by place in the second, then the first string. Tiles ``(i, j, n)`` overlap in neither string.
    """
    waiting = [(-n, j, i) for i, j, n in runs]
    heapify(waiting)
    marked_i: set[int] = set()
    marked_j: set[int] = set()
    tiles = []
    while waiting:
        n, j, i = heappop(waiting)
        free = [k for k in range(-n) if i + k not in marked_i and j + k not in marked_j]
        if len(free) == -n:
            tiles.append((i, j, -n))
            marked_i.update(range(i, i - n))
            marked_j.update(range(j, j - n))
            continue
        # what is left of it waits its turn
        first = 0
        for k in range(1, len(free) + 1):
            if k == len(free) or free[k] != free[k - 1] + 1:
                if k - first >= length:
                    heappush(waiting, (first - k, j + free[first], i + free[first]))
                first = k
    return tiles


def _bitmap(seeds: DataFrame, bits: int) -> bytes:
    """A bit for each value of the highest ``bits`` bits of the seeds, made on the executors; 2**bits / 8 bytes reach the driver."""
    place = F.shiftrightunsigned("seed", 64 - bits) + 1  # buckets of bits are numbered from 1
    parts = seeds.groupBy(F.bitmap_bucket_number(place).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("part"))
    out = bytearray(1 << (bits - 3))
    for r in parts.toLocalIterator():
        out[(r["bucket"] - 1) * len(r["part"]) : r["bucket"] * len(r["part"])] = r["part"]
    return bytes(out)


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    item_col: str = "item_id",
    text_col: str = "text",
    min_match: int = 5,
    threshold: float = 0.8,
) -> DataFrame:
    """Pairs of documents and benchmark items of which the document holds at least ``threshold`` of the words.

    Returns ``(doc_id, version, item_id, n_tiles, n_words, coverage)``; ``version`` is the MD5 digest of the document's
    text. Words are white-space separated, in lower case, without punctuation. Windows of ``min_match`` words of all whole
    documents are looked up among those of the items by running hash (a join; the words are compared too), windows that
    follow each other in both texts are joined to maximal matches, and each pair that has one is tiled greedily:
    ``coverage`` is the share of the item's words under tiles, in whatever order the document has them.

    Documents are told apart by id and text: rows that share an id or have none are judged by their texts, rows that
    agree in both are one. The bitmap that thins out document windows before the join grows with the benchmark up to
    2**27 places (16 MB); the join alone decides. Items of fewer than ``min_match`` words have no window and are never
    found, nor are items without an id; items that share an id count as one. Null and empty texts hold nothing. Extra
    columns are ignored, whatever their names.
    """
    read = lambda df, key: df.select(F.col(key).alias("id"), F.md5(text_or_empty(text_col)).alias("version"), text_or_empty(text_col).alias("text"))
    items = read(benchmark.where(F.col(item_col).isNotNull()), item_col)
    item_windows = stash(windows(items, min_match).select("id", "at", "seed", "words"), "item-windows")
    bits = min(_MAP_BITS[1], max(_MAP_BITS[0], (16 * item_windows.count()).bit_length()))
    shared = docs.sparkSession.sparkContext.broadcast(_bitmap(item_windows, bits))
    doc_windows = windows(read(docs, id_col), min_match, shared, bits)
    pair = ["doc_id", "version", "item_id"]
    hits = doc_windows.withColumnsRenamed({"id": "doc_id", "at": "i"}).join(item_windows.withColumnsRenamed({"id": "item_id", "at": "j"}), ["seed", "words"])
    # all of a pair's hits meet once; what follows keeps them there
    hits = hits.select(*pair, "i", "j").repartition(*pair).distinct()
    nth = F.row_number().over(Window.partitionBy(*pair, F.col("i") - F.col("j")).orderBy("i"))
    runs = hits.withColumn("run", F.col("i") - nth).groupBy(*pair, (F.col("i") - F.col("j")).alias("shift"), "run").agg(F.min("i").alias("i"), F.min("j").alias("j"), (F.count("*") + min_match - 1).cast("int").alias("n"))
    words = items.groupBy(F.col("id").alias("item_id")).agg(F.max(_n_words("text")).alias("n_words"))
    pairs = runs.groupBy(*pair).agg(F.collect_list(F.struct("i", "j", "n")).alias("runs")).join(words, "item_id")
    shape = to_arrow_schema(pairs.select(*pair, "n_words").schema).append(pa.field("n_tiles", pa.int32())).append(pa.field("coverage", pa.float64()))

    def tile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            tiles = [greedy_tiles(((r["i"], r["j"], r["n"]) for r in runs), min_match) for runs in part["runs"].to_pylist()]
            coverage = [sum(t[2] for t in found) / n for found, n in zip(tiles, part["n_words"].to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*(part[c] for c in (*pair, "n_words")), pa.array([len(t) for t in tiles], pa.int32()), pa.array(coverage, pa.float64())], schema=shape)

    types = {f.name: f.dataType.simpleString() for f in pairs.schema.fields}
    schema = ", ".join(f"{c} {types[c]}" for c in (*pair, "n_words")) + ", n_tiles int, coverage double"
    return pairs.mapInArrow(tile, schema).where(F.col("coverage") >= threshold).select(*pair, "n_tiles", "n_words", "coverage")


def _n_words(text_col: str):
    """Words of a text after normalising; small tables only use it."""

    @F.pandas_udf("int")
    def count(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: sum(1 for c in t.encode().split() if normal_word(c))).astype("int32")

    return count(text_col)

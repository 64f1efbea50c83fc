"""Operator 3: packing of tokenised documents into sequences by best-two-fit."""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from .common import schema_with, slices, stash, text_or_empty
from .tokens import chunk_table


def token_pieces(
    docs: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = 4096,
    end_id: int = 1,
) -> DataFrame:
    """Tokenise every whole text, append ``end_id`` and cut what is longer than ``capacity``.

    Returns ``(doc_id, piece, start, length, ids_crc32)``; only documents longer than ``capacity`` have several pieces.
    Null and empty texts are one piece that holds ``end_id``. Rows that share an id are separate documents.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
    schema = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, piece int, start long, length long, ids_crc32 long"
    end = np.array([end_id], "<u4").tobytes()

    id_type = to_arrow_schema(rows.schema).field("doc_id").type

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = chunk_table(tokenizer_path)
        for part in slices(batches, 500):
            out: list[tuple] = []
            texts = [t.split() for t in part["text"].cast(pa.binary()).to_pylist()]
            known.learn(set().union(*texts))
            for doc, chunks in zip(part["doc_id"].to_pylist(), texts, strict=True):
                ids = b"".join(map(known.chunks.__getitem__, chunks)) + end
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    cut = ids[at : at + 4 * capacity]
                    out.append((doc, k, at // 4, len(cut) // 4, zlib.crc32(cut)))
            doc, *numbers = zip(*out, strict=True)
            types = (pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(doc, id_type), *(pa.array(x, t) for x, t in zip(numbers, types, strict=True))], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return rows.mapInArrow(run, schema)


def best_two_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bins and offsets of items: fill a bin with the largest that fit, then try to exchange its smallest item for two.

    The exchange takes the two unpacked items that fill the gap left by the smallest item most tightly, and only if
    they fill it better than the smallest did. Equal lengths are taken in order of position.
    """
    order = np.argsort(lengths, kind="stable")
    sizes, first, counts = np.unique(lengths[order], return_index=True, return_counts=True)
    waiting = {int(s): list(order[f : f + c][::-1]) for s, f, c in zip(sizes, first, counts, strict=True)}
    distinct = [int(s) for s in sizes]
    left = np.zeros(capacity + 1, np.int64)
    left[sizes] = counts

    def take(size: int) -> int:
        item = waiting[size].pop()
        left[size] -= 1
        if not waiting[size]:
            distinct.pop(bisect_right(distinct, size) - 1)
        return int(item)

    def give(size: int, item: int) -> None:
        if not waiting[size]:
            distinct.insert(bisect_right(distinct, size), size)
        waiting[size].append(item)
        left[size] += 1

    def pair(room: int, least: int) -> tuple[int, int] | None:
        have = np.array(distinct[: bisect_right(distinct, room - 1)])
        if not len(have):
            return None
        mate = np.searchsorted(have, np.minimum(room - have, have), "right") - 1
        # an equal mate needs a second item of that size
        mate = np.where((mate >= 0) & (have[mate] == have) & (left[have] < 2), mate - 1, mate)
        total = np.where(mate >= 0, have + have[np.maximum(mate, 0)], 0)
        at = int(np.argmax(total))
        return (int(have[at]), int(have[mate[at]])) if total[at] > least else None

    bins, offsets, number = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64), 0
    while distinct:
        held: list[tuple[int, int]] = []
        gap = capacity
        while gap and (k := bisect_right(distinct, gap)):
            size = distinct[k - 1]
            held.append((size, take(size)))
            gap -= size
        if gap and distinct and len(held) > 1:
            size, item = held[-1]
            if two := pair(gap + size, size):
                held.pop()
                give(size, item)
                held += [(s, take(s)) for s in two]
        at = 0
        for size, item in held:
            bins[item], offsets[item] = number, at
            at += size
        number += 1
    return bins, offsets


def pack(pieces: DataFrame, capacity: int = 4096, pieces_per_shard: int = 8192) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to rows that have a ``length`` of at most ``capacity``.

    Rows are dealt by a hash of their id into shards of about ``pieces_per_shard``; each shard is packed alone by
    ``best_two_fit``, so no task holds more than a shard and a shard wastes a part of one sequence at most.
    ``sequence_id`` is the shard's number times 2**32 plus the bin. Ties in length are broken by (doc_id, piece).
    An empty table gives an empty result; lengths of 0 take no room.
    """
    pieces = stash(pieces, "pieces")
    shards = max(1, -(-pieces.count() // pieces_per_shard))
    schema = schema_with(pieces, sequence_id="long", offset="long")

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["doc_id", "piece", "ids_crc32"], kind="stable").drop(columns="shard")
        bins, offsets = best_two_fit(pdf["length"].to_numpy(), capacity)
        return pdf.assign(sequence_id=bins + (int(key[0]) << 32), offset=offsets)

    # the crc spreads repeated rows too
    dealt = pieces.withColumn("shard", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(shards)))
    return dealt.groupBy("shard").applyInPandas(run, schema)

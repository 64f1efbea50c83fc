"""Operator 7: removal of repeated byte strings by sharded external induced sorting.

Every string of ``length`` bytes has an anchor: of its 64-byte grams, the first with the least hash. Equal strings have
equal anchors at equal places, so strings that share an anchor can be sorted apart from all others. Neighbouring
strings with one anchor form a piece. Pieces whose anchor occurs twice or more anywhere are candidates; equal ones are
collapsed to one with a count, and all candidates are dealt by anchor into shards, which are put in suffix order with
common prefixes by induced sorting. A string is repeated if its common prefix with a neighbour is ``length``.

The corpus is written once, as blocks of some megabytes of text with their pieces, in a table bucketed by block: texts
are never shuffled, only numbers of 8 bytes, candidate pieces and answers are.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stash, stash_bucketed, text_or_empty
from .suffixes import repeated_starts

#: Bytes of text in a block, and of texts whose grams are hashed together.
_BLOCK_BYTES, _BUFFER = 4 << 20, 1 << 18
#: A text longer than this is hashed in overlapping parts (places of grams have 24 bits).
_LONG = 8 << 20
#: Bytes of pieces in a shard, and of numbers that meet in one task.
SHARD_BYTES, MEET_BYTES = 8 << 20, 12 << 20
#: Distinct pieces with one anchor from which on they are not sorted in one shard but counted string by string.
HOT_PIECES = 50_000


def _gram(length: int) -> int:
    """Bytes of a gram: a power of two, at most 64 and half of ``length``."""
    return 1 << min(6, max(0, (length // 2).bit_length() - 1))


def _gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """64-bit hashes of all grams, by doubling; the last ``gram - 1`` places hold none."""
    base, h, k = 0x9E3779B97F4A7C15, data.astype(np.uint64) + np.uint64(1), 1
    while k < gram:
        h = h[:-k] * np.uint64(pow(base, k, 1 << 64)) + h[k:]
        k *= 2
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


def _window_least(keys: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each window of ``width`` keys: least of a block's end and the next block's beginning."""
    n = len(keys)
    blocks = -(-n // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = keys
    table = padded.reshape(blocks, width)
    heads = np.minimum.accumulate(table, axis=1).ravel()
    tails = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(tails[: n - width + 1], heads[width - 1 : n])


def anchored_pieces(data: np.ndarray, sizes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(text number, first start in the text, number of starts, anchor's hash)`` of the pieces of joined texts."""
    gram = _gram(length)
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none, none, none, none.view(np.uint64)
    hashes = _gram_hashes(data, gram)
    # the place in the lowest 24 bits decides between equal hashes
    keys = (hashes & ~np.uint64((1 << 24) - 1)) | np.arange(len(hashes), dtype=np.uint64)
    anchor = (_window_least(keys, length - gram + 1) & np.uint64((1 << 24) - 1)).astype(np.int64)
    begins = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(sizes)), sizes)[: len(anchor)]
    starts = np.flatnonzero(np.arange(len(anchor)) + length <= (begins + sizes)[owner])
    if not len(starts):
        return none, none, none, none.view(np.uint64)
    new = np.r_[True, (anchor[starts[1:]] != anchor[starts[:-1]]) | (owner[starts[1:]] != owner[starts[:-1]])]
    first = starts[new]
    count = np.diff(np.r_[np.flatnonzero(new), len(starts)])
    return owner[first], first - begins[owner[first]], count, hashes[anchor[first]]


def _bytes(values: np.ndarray, kind: str) -> bytes:
    return np.ascontiguousarray(values.astype(kind)).tobytes()


def _values(cell: pa.Scalar, kind: str) -> np.ndarray:
    return np.frombuffer(cell.as_buffer(), kind) if cell.is_valid else np.zeros(0, kind)


def _block(ids: list, texts: list[bytes], length: int) -> tuple:
    """A row of the block table: compressed texts, and of each piece its text, first start, starts, anchor and digest."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    joined = b"".join(texts)
    view, found = memoryview(joined), []
    bounds = np.cumsum(sizes)
    at = 0
    while at < len(texts):
        base = int(bounds[at] - sizes[at])
        if sizes[at] > _LONG:
            step = _LONG - length + 1
            for lo in range(0, int(sizes[at]) - length + 1, step):
                part = np.frombuffer(view[base + lo : base + min(lo + _LONG, int(sizes[at]))], np.uint8)
                _, start, count, key = anchored_pieces(part, np.array([len(part)]), length)
                found.append((np.full(len(start), at), start + lo, count, key))
            at += 1
            continue
        to = max(at + 1, int(np.searchsorted(bounds, base + _BUFFER, "right")))
        to = min([to, *(np.flatnonzero(sizes[at:to] > _LONG) + at).tolist()])
        owner, start, count, key = anchored_pieces(np.frombuffer(view[base : int(bounds[to - 1])], np.uint8), sizes[at:to], length)
        found.append((owner + at, start, count, key))
        at = to
    owner, start, count, key = (np.concatenate(c) for c in zip(*found, strict=True)) if found else [np.zeros(0, np.int64)] * 4
    lo = (bounds - sizes)[owner] + start if len(owner) else owner
    digest = np.fromiter((xxhash.xxh3_64_intdigest(view[a:b]) for a, b in zip(lo.tolist(), (lo + count + length - 1).tolist(), strict=True)), np.uint64, len(lo))
    packed = zstandard.ZstdCompressor(level=1).compress(joined)
    return uuid.uuid4().hex, ids, _bytes(sizes, "<u4"), packed, len(owner), _bytes(owner, "<u2"), _bytes(start, "<u4"), _bytes(count, "<u2"), key.tobytes(), digest.tobytes()


def _blocks(rows: DataFrame, length: int) -> DataFrame:
    """The block table of ``rows(doc_id, text)``."""
    id_type = rows.schema["doc_id"].dataType.simpleString()
    schema = f"block string, ids array<{id_type}>, sizes binary, data binary, n_pieces int, owner binary, start binary, count binary, key binary, digest binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list = []
        texts: list[bytes] = []
        held, id_kind = 0, None

        def row() -> pa.RecordBatch:
            values = _block(ids, texts, length)
            kinds = (pa.string(), pa.list_(id_kind), pa.binary(), pa.binary(), pa.int32(), *[pa.binary()] * 5)
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], [f.split(" ")[0] for f in schema.split(", ")])

        for batch in batches:
            id_kind = batch["doc_id"].type
            for key, text in zip(batch["doc_id"].to_pylist(), batch["text"], strict=True):
                raw = bytes(text.as_buffer())
                if ids and (held + len(raw) > _BLOCK_BYTES or len(ids) == 60_000):
                    yield row()
                    ids, texts, held = [], [], 0
                ids.append(key)
                texts.append(raw)
                held += len(raw)
        if ids:
            yield row()

    return rows.mapInArrow(run, schema)


class _Entries:
    """Numbers that a block sends to meet equal ones of other blocks, and the way back to its pieces.

    Kind 0: an anchor, with its distinct pieces. Kind 1: a distinct piece, with its copies. Kind 2: a string of a hot
    piece, with its copies. Each is sent once a block, so a frequent one is a few bytes a block.
    """

    def __init__(self, a: np.ndarray, b: np.ndarray, kind: int, weight: np.ndarray | None = None) -> None:
        self.kind = kind
        self.order = np.lexsort((b, a))
        a, b = a[self.order], b[self.order]
        self.new = np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])] if len(a) else np.zeros(0, bool)
        self.at = np.flatnonzero(self.new)
        self.a, self.b = a[self.at], b[self.at]
        self.copies = np.diff(np.r_[self.at, len(a)])
        self.weight = self.copies if weight is None else np.add.reduceat(weight[self.order], self.at) if len(a) else self.copies

    def buckets(self, n: int) -> np.ndarray:
        mixed = (self.a ^ (self.b * np.uint64(0xD6E8FEB86659FD93))) * np.uint64(0x9E3779B97F4A7C15)
        return ((mixed >> np.uint64(33)) % np.uint64(n)).astype(np.int64)

    def rows(self, block: str, n: int) -> Iterator[tuple]:
        bucket = self.buckets(n)
        order = np.argsort(bucket, kind="stable")
        cuts = np.searchsorted(bucket[order], np.arange(n + 1)).tolist()
        for number, (lo, hi) in enumerate(zip(cuts, cuts[1:])):
            if lo < hi:
                part = order[lo:hi]
                yield block, self.kind, number, self.a[part].tobytes(), self.b[part].tobytes() if self.kind else None, _bytes(np.minimum(self.weight[part], 65535), "<u2")

    def answers(self, told: list[dict], n: int) -> np.ndarray:
        """An answer for each entry from the answers of the buckets."""
        out = np.zeros(len(self.a), np.int64)
        bucket = self.buckets(n)
        order = np.argsort(bucket, kind="stable")
        cuts = np.searchsorted(bucket[order], np.arange(n + 1))
        for row in told:
            if row["kind"] == self.kind:
                out[order[cuts[row["bucket"]] : cuts[row["bucket"] + 1]]] = np.frombuffer(row["answer"], "<u2")
        return out

    def spread(self, values: np.ndarray) -> np.ndarray:
        """A value of each entry for each of the numbers that the entries were made of."""
        out = np.empty(len(self.order), values.dtype)
        out[self.order] = np.repeat(values, self.copies)
        return out

    def firsts(self) -> np.ndarray:
        """Whether a number is the first of its entry."""
        out = np.zeros(len(self.order), bool)
        out[self.order[self.at]] = True
        return out


_ENTRY = "block string, kind int, bucket int, a binary, b binary, weight binary"


def _piece_entries(row: dict) -> tuple[_Entries, _Entries]:
    key, digest = np.frombuffer(row["key"], np.uint64), np.frombuffer(row["digest"], np.uint64)
    pieces = _Entries(key, digest, 1)
    return _Entries(pieces.a, np.zeros(len(pieces.a), np.uint64), 0), pieces


def _meet(entries: DataFrame) -> DataFrame:
    """Answers ``(block, kind, bucket, answer)``: for each number twice the blocks' weights (up to 32,767), and 1 for the first.

    All numbers of a bucket meet in one task; a bucket has about ``MEET_BYTES``.
    """

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by("block")
        weight = np.concatenate([_values(c, "<u2") for c in table["weight"]]).astype(np.int64)
        a = np.concatenate([_values(c, np.uint64) for c in table["a"]])
        kind = table["kind"][0].as_py()
        b = np.concatenate([_values(c, np.uint64) for c in table["b"]]) if kind else np.zeros(len(a), np.uint64)
        order = np.lexsort((b, a)) if kind else np.argsort(a, kind="stable")
        sa, sb = a[order], b[order]
        at = np.flatnonzero(np.r_[True, (sa[1:] != sa[:-1]) | (sb[1:] != sb[:-1])])
        totals = np.add.reduceat(weight[order], at)
        answer = np.empty(len(a), np.int64)
        answer[order] = np.repeat(np.minimum(totals, 32767 if kind else 65535) << (1 if kind else 0), np.diff(np.r_[at, len(a)]))
        if kind:
            answer[order[at]] += 1
        ends = np.cumsum([len(c.as_buffer()) // 2 for c in table["weight"]])
        parts = np.split(answer, ends[:-1])
        return pa.table({"block": table["block"], "kind": table["kind"], "bucket": table["bucket"], "answer": pa.array([_bytes(p, "<u2") for p in parts], pa.binary())})

    answers = entries.groupBy("kind", "bucket").applyInArrow(run, "block string, kind int, bucket int, answer binary")
    return answers.groupBy("block").agg(F.collect_list(F.struct("kind", "bucket", "answer")).alias("told"))


def _rows_of(run_row, schema: pa.Schema):
    """A function over batches that gives the rows that ``run_row`` makes of each input row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                rows = list(run_row(batch.slice(k, 1).to_pylist()[0]))
                for lo in range(0, len(rows), 20_000):
                    columns = zip(*rows[lo : lo + 20_000], strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return run


def _shape(**kinds: pa.DataType) -> pa.Schema:
    return pa.schema(list(kinds.items()))


_ENTRY_SHAPE = _shape(block=pa.string(), kind=pa.int32(), bucket=pa.int32(), a=pa.binary(), b=pa.binary(), weight=pa.binary())


def _with(blocks: DataFrame, small: DataFrame, *columns: str) -> DataFrame:
    """Join block rows with rows of the same block; the blocks stay where they are."""
    return blocks.select("block", *columns).join(small.hint("shuffle_hash"), "block")


def _texts(row: dict) -> tuple[bytes, np.ndarray, np.ndarray]:
    """Joined texts of a block, and sizes and begins of the texts."""
    sizes = np.frombuffer(row["sizes"], "<u4").astype(np.int64)
    return zstandard.ZstdDecompressor().decompress(row["data"], max_output_size=max(1, int(sizes.sum()))), sizes, np.cumsum(sizes) - sizes


def _places(row: dict, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First starts of the pieces within the joined texts, and their numbers of starts."""
    start, owner = np.frombuffer(row["start"], "<u4").astype(np.int64), np.frombuffer(row["owner"], "<u2")
    return begins[owner] + start, np.frombuffer(row["count"], "<u2").astype(np.int64)


def _verdicts(blocks: DataFrame, length: int, buckets: int, hot: int) -> DataFrame:
    """For each block, which pieces are to be sorted (with copies: 1 or 2), which are repeated as a whole, and which are hot.

    Of equal pieces the first is sorted, or hot, and stands for all of them.
    """
    entries = blocks.select("block", "key", "digest").mapInArrow(
        _rows_of(lambda row: (x for kind in _piece_entries(row) for x in kind.rows(row["block"], buckets)), _ENTRY_SHAPE), _ENTRY
    )
    answers = stash(_meet(entries), "answers")

    def judge(row: dict) -> Iterator[tuple]:
        anchors, pieces = _piece_entries(row)
        crowd = anchors.spread(anchors.answers(row["told"], buckets))  # distinct pieces of all blocks, for each piece of this one
        told = pieces.answers(row["told"], buckets)
        copies, mine = told >> 1, (told & 1) == 1
        wanted = (crowd > 1) | (copies > 1)
        sort = wanted & mine & (crowd <= hot)
        count = np.frombuffer(row["count"], "<u2").astype(np.int64)
        first = pieces.firsts()
        chosen = np.flatnonzero(pieces.spread(sort) & first)
        whole = np.flatnonzero(pieces.spread(wanted & (copies > 1)) & ~(pieces.spread(mine & (crowd <= hot)) & first))
        crowded = np.flatnonzero(pieces.spread(wanted & mine & (crowd > hot)) & first)
        yield row["block"], _bytes(chosen, "<u4"), _bytes(np.minimum(pieces.spread(copies)[chosen], 2), "u1"), _bytes(whole, "<u4"), _bytes(crowded, "<u4"), int((count[chosen] + length - 1).sum()), len(crowded)

    shape = _shape(block=pa.string(), chosen=pa.binary(), copies=pa.binary(), whole=pa.binary(), hot=pa.binary(), n_bytes=pa.int64(), n_hot=pa.int64())
    return _with(blocks, answers, "key", "digest", "count").mapInArrow(_rows_of(judge, shape), "block string, chosen binary, copies binary, whole binary, hot binary, n_bytes long, n_hot long")


_MARK = "block string, piece binary, first binary, last binary"


def _sorted_marks(blocks: DataFrame, verdicts: DataFrame, n_bytes: int, length: int) -> DataFrame:
    """Repeated ranges within pieces, ``_MARK`` packed by block and shard: the pieces to be sorted go to shards by anchor."""

    def cut(row: dict) -> Iterator[tuple]:
        data, _, begins = _texts(row)
        place, count = _places(row, begins)
        key = np.frombuffer(row["key"], np.int64)
        chosen, copies = np.frombuffer(row["chosen"], "<u4"), np.frombuffer(row["copies"], "u1").tolist()
        for k, anchor, n, lo, hi in zip(chosen.tolist(), key[chosen].tolist(), copies, place[chosen].tolist(), (place + count + length - 1)[chosen].tolist(), strict=True):
            yield anchor, row["block"], k, n, data[lo:hi]

    def mark(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["anchor", "block", "piece"], kind="stable")
        held: dict[str, list] = {}
        for block, piece, hits in zip(pdf["block"], pdf["piece"], repeated_starts(list(pdf["bytes"]), pdf["copies"].to_numpy(), length), strict=True):
            edges = np.flatnonzero(np.diff(np.concatenate([[False], hits, [False]]).astype(np.int8))).tolist()
            held.setdefault(block, []).extend((piece, a, b - 1 + length) for a, b in zip(edges[::2], edges[1::2], strict=True))
        out = [(block, *(_bytes(np.array(c), "<u4") for c in zip(*marks, strict=True))) for block, marks in held.items() if marks]
        return pd.DataFrame(out, columns=["block", "piece", "first", "last"])

    shape = _shape(anchor=pa.int64(), block=pa.string(), piece=pa.int32(), copies=pa.int32(), bytes=pa.binary())
    wanted = verdicts.where(F.octet_length("chosen") > 0).select("block", "chosen", "copies")
    pieces = _with(blocks, wanted, "data", "sizes", "owner", "start", "count", "key").mapInArrow(_rows_of(cut, shape), "anchor long, block string, piece int, copies int, bytes binary")
    shards = max(1, -(-n_bytes // SHARD_BYTES))
    return pieces.withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(shards))).groupBy("shard").applyInPandas(mark, _MARK)


def _hot_marks(blocks: DataFrame, verdicts: DataFrame, buckets: int, length: int) -> DataFrame:
    """The same for pieces of hot anchors, whose strings are counted by their 128-bit digests, once a block and string."""
    wanted = verdicts.where("n_hot > 0").select("block", "hot")
    columns = ("data", "sizes", "owner", "start", "count")

    def strings(row: dict) -> tuple[_Entries, np.ndarray, np.ndarray]:
        data, _, begins = _texts(row)
        place, count = _places(row, begins)
        hot = np.frombuffer(row["hot"], "<u4")
        piece = np.repeat(hot, count[hot])
        first = np.concatenate([np.arange(n) for n in count[hot].tolist()] or [np.zeros(0, np.int64)])
        view = memoryview(data)
        digests = b"".join(xxhash.xxh3_128_digest(view[a : a + length]) for a in (place[piece] + first).tolist())
        a, b = np.frombuffer(digests, np.uint64).reshape(-1, 2).T
        return _Entries(a, b, 2), piece, first

    entries = _with(blocks, wanted, *columns).mapInArrow(_rows_of(lambda row: strings(row)[0].rows(row["block"], buckets), _ENTRY_SHAPE), _ENTRY)
    answers = stash(_meet(entries), "hot-answers")

    def mark(row: dict) -> Iterator[tuple]:
        found, piece, first = strings(row)
        hit = found.spread(found.answers(row["told"], buckets) >> 1) > 1
        if hit.any():
            yield row["block"], _bytes(piece[hit], "<u4"), _bytes(first[hit], "<u4"), _bytes(first[hit] + length, "<u4")

    shape = _shape(block=pa.string(), piece=pa.binary(), first=pa.binary(), last=pa.binary())
    return _with(blocks, wanted.join(answers, "block"), *columns).mapInArrow(_rows_of(mark, shape), _MARK)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 200) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept)``: each text without the bytes of repeated strings.

    A byte goes if a string of ``length`` (at most 254) bytes over it also starts anywhere else, in the same document
    included; texts are judged as they came. ``kept`` is binary: cuts may fall inside a character. Null and empty texts
    have no bytes. Every row of ``docs`` gives a row; ids are not looked at, so they may be null or repeat. Extra columns
    are ignored. An empty table gives an empty result.

    1. Texts are written in blocks with their pieces (``_blocks``).
    2. Anchors and digests of pieces, once a block each, meet by value. Answers go back to the blocks: a piece is alone,
       the first of its copies, a copy (repeated as a whole), or its anchor is hot (``_verdicts``).
    3. Pieces that share an anchor with another go to shards and are sorted (``_sorted_marks``). Anchors with more than
       ``HOT_PIECES`` distinct pieces are not given to one task: their strings are counted one by one (``_hot_marks``).
    4. Marks go back to the blocks, which give the rows.
    """
    if not 1 <= length <= 254:
        raise ValueError("length must be from 1 to 254")
    rows = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
    blocks = stash_bucketed(_blocks(rows, length), "blocks", "block")
    n_pieces = blocks.agg(F.sum(F.col("n_pieces").cast("long"))).first()[0] or 0
    buckets = max(1, -(-25 * n_pieces // (2 * MEET_BYTES)))
    verdicts = stash(_verdicts(blocks, length, buckets, HOT_PIECES), "verdicts")
    n_bytes, n_hot = verdicts.agg(F.sum("n_bytes"), F.sum("n_hot")).first()
    marks = _sorted_marks(blocks, verdicts, n_bytes or 0, length)
    if n_hot:
        marks = marks.unionByName(_hot_marks(blocks, verdicts, buckets, length))
    listed = stash(marks, "marks").groupBy("block").agg(F.collect_list(F.struct("piece", "first", "last")).alias("marks"))
    told = verdicts.select("block", "whole").join(listed, "block", "left")
    id_type = rows.schema["doc_id"].dataType.simpleString()
    joined = _with(blocks, told, "ids", "sizes", "data", "owner", "start", "count")

    def cleaned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                part = batch.slice(k, 1)
                row = part.drop_columns(["ids"]).to_pylist()[0]
                columns = _cleaned(row, length)
                yield pa.RecordBatch.from_arrays([part["ids"].flatten(), *columns], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    return joined.mapInArrow(cleaned, f"doc_id {id_type}, n_bytes long, n_removed long, n_spans long, kept binary")


def _cleaned(row: dict, length: int) -> tuple[pa.Array, pa.Array, pa.Array, pa.Array]:
    """Bytes, removed bytes, removed runs and kept bytes of each text of a block."""
    data, sizes, begins = _texts(row)
    place, count = _places(row, begins)
    owner = np.frombuffer(row["owner"], "<u2").astype(np.int64)
    whole = np.frombuffer(row["whole"], "<u4").astype(np.int64)
    told = row["marks"] or []
    piece, first, last = (np.concatenate([np.frombuffer(m[c], "<u4").astype(np.int64) for m in told] or [np.zeros(0, np.int64)]) for c in ("piece", "first", "last"))
    lo, hi, text = np.r_[place[whole], place[piece] + first], np.r_[place[whole] + count[whole] + length - 1, place[piece] + last], np.r_[owner[whole], owner[piece]]
    order = np.argsort(lo, kind="stable")
    lo, text = lo[order], text[order]
    reach = np.maximum.accumulate(hi[order]) if len(lo) else lo
    # runs that touch are one, but not over the end of a text
    new = np.r_[True, (lo[1:] > reach[:-1]) | (text[1:] != text[:-1])] if len(lo) else np.zeros(0, bool)
    starts, ends, text = lo[new], reach[np.r_[np.flatnonzero(new)[1:] - 1, len(lo) - 1]] if len(lo) else lo, text[new]
    removed = np.bincount(text, ends - starts, len(sizes)).astype(np.int64)
    kept, cuts = [], np.searchsorted(text, np.arange(len(sizes) + 1)).tolist()
    run_starts, run_ends = starts.tolist(), ends.tolist()
    for k, (at, size) in enumerate(zip(begins.tolist(), sizes.tolist(), strict=True)):
        if cuts[k] == cuts[k + 1]:
            kept.append(data[at : at + size])
            continue
        out, end = [], at + size
        for r in range(cuts[k], cuts[k + 1]):
            out.append(data[at : run_starts[r]])
            at = run_ends[r]
        kept.append(b"".join([*out, data[at:end]]))
    return pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(np.diff(cuts), pa.int64()), pa.array(kept, pa.binary())

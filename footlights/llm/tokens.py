"""Operator 10 and the tokenising part of operator 3.

The tokenizer drops white space and never joins across it, so a text's ids are the ids of its white-space separated
chunks in order. A chunk is therefore a valid pre-token: the library is asked once for each distinct chunk, and its own
normalisation, contraction rules and special strings apply inside the chunk as they would inside the text.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from .common import text_or_empty


@lru_cache(maxsize=2)
def load_tokenizer(path: str):
    """The tokenizer of a ``tokenizers`` file; one a process."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark has a task on every core already
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(path)
    found.no_truncation()
    found.no_padding()
    return found


def encode_chunks(path: str, chunks: list[bytes]) -> list[list[int]]:
    """Ids of each chunk, without added special tokens. Chunks are pieces of valid UTF-8 between ASCII white space."""
    return [e.ids for e in load_tokenizer(path).encode_batch_fast([c.decode() for c in chunks], add_special_tokens=False)]


@lru_cache(maxsize=2)
def _ends_word(path: str) -> np.ndarray:
    """For each id whether it ends a pre-token (this kind of vocabulary marks word ends)."""
    vocabulary = load_tokenizer(path).get_vocab()
    out = np.zeros(max(vocabulary.values()) + 1, bool)
    for token, number in vocabulary.items():
        out[number] = token.endswith("</w>")
    return out


def encode_words(path: str, words: list[bytes], together: int = 1000) -> list[bytes]:
    """Ids (little-endian, 32 bits) of words that are one pre-token each: many in one call, cut at the marked word ends."""
    out: list[bytes] = []
    ends = _ends_word(path)
    for at in range(0, len(words), together):
        part = words[at : at + together]
        ids = np.array(load_tokenizer(path).encode(b" ".join(part).decode(), add_special_tokens=False).ids, "<u4")
        cuts = (4 * (np.flatnonzero(ends[ids]) + 1)).tolist()
        if len(cuts) != len(part):  # a vocabulary without such marks
            out += [array("I", x).tobytes() for x in encode_chunks(path, part)]
            continue
        raw = ids.tobytes()
        out += [raw[a:b] for a, b in zip([0, *cuts], cuts)]
    return out


#: Chunks of Latin letters and closing points or commas: the tokenizer splits exactly there, whatever the case.
_PLAIN = "([A-Za-zÀ-ÖØ-öø-įĲ-ɏ]+)([.,]*)"
_PLAIN_CHUNK = re.compile(_PLAIN)
#: The same for many chunks, a line each; other lines give empty groups.
_PLAIN_LINES = re.compile(f"^(?:{_PLAIN}|.*)$", re.M)


class ChunkTable:
    """Ids of chunks as little-endian unsigned 32-bit numbers, for one worker process.

    Letter words are looked up in lower case and without closing punctuation, so that the library sees each word once
    and not each spelling of a chunk. Both tables are cut beyond their bound, which limits a worker's memory: chunks to
    those that are wanted at the time, words to none.
    """

    def __init__(self, path: str, most_chunks: int = 300_000, most_words: int = 400_000) -> None:
        self.path, self.most_chunks, self.most_words = path, most_chunks, most_words
        self.chunks: dict[bytes, bytes] = {}
        self.words: dict[bytes, bytes] = {}

    def learn(self, wanted: set[bytes]) -> None:
        """Make sure that all ``wanted`` chunks are in ``chunks``."""
        if len(self.chunks) > self.most_chunks:
            self.chunks = {c: self.chunks[c] for c in wanted.intersection(self.chunks)}
        if len(self.words) > self.most_words:
            self.words.clear()
        missing = list(wanted.difference(self.chunks))
        if not missing:
            return
        # one pass over all of them: no chunk holds a line's end
        parts = _PLAIN_LINES.findall(b"\n".join(missing).decode())
        lower = "\n".join([word for word, _ in parts]).lower().encode().split(b"\n")
        ends = {end: end.encode() for end in {end for _, end in parts}}
        new = list({*lower, *ends.values()}.difference(self.words, [b""]))
        words, chunks = self.words, self.chunks
        words.update(zip(new, encode_words(self.path, new), strict=True))
        words[b""] = b""
        odd = [chunk for chunk, word in zip(missing, lower, strict=True) if not word]
        chunks.update((chunk, array("I", ids).tobytes()) for chunk, ids in zip(odd, encode_chunks(self.path, odd), strict=True))
        chunks.update((chunk, words[word] + words[ends[end]] if end else words[word]) for chunk, word, (_, end) in zip(missing, lower, parts, strict=True) if word)


@lru_cache(maxsize=2)
def chunk_table(path: str) -> ChunkTable:
    """The process' table; Python workers are used for many tasks."""
    return ChunkTable(path)


def pre_tokens(chunk: str) -> tuple[str, ...]:
    """A chunk as the pieces that are counted: a plain word in lower case and its points, or the chunk itself."""
    plain = _PLAIN_CHUNK.fullmatch(chunk)
    if not plain:
        return (chunk,)
    return (plain[1].lower(), plain[2]) if plain[2] else (plain[1].lower(),)


#: A block ends with so many documents (places have 16 bits) or pairs of word and document.
_BLOCK_DOCS, _BLOCK_PAIRS = 32_000, 5_000_000
#: Pre-tokens whose number of pieces a worker keeps before it starts anew.
_KEPT_COUNTS = 1_500_000


def _text_groups(batches: Iterator[pa.RecordBatch], most_bytes: int = 8 << 20) -> Iterator[tuple[pa.Array, pa.Array, np.ndarray]]:
    """Documents in groups of about ``most_bytes``: ids, texts, bytes of each text."""
    for batch in batches:
        size = pc.binary_length(batch["text"]).to_numpy(zero_copy_only=False).astype(np.int64)
        ends, at = np.cumsum(size), 0
        while at < batch.num_rows:
            n = min(10_000, max(1, int(np.searchsorted(ends[at:], (ends[at - 1] if at else 0) + most_bytes, "right"))))
            part = batch.slice(at, n)
            yield part["doc_id"], part["text"], size[at : at + n]
            at += n


def _numbers(value: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(value, kind)


class _Block:
    """Frequencies of the pre-tokens of some documents."""

    def __init__(self) -> None:
        self.chunks: dict[str, int] = {}
        self.words: dict[str, int] = {}
        #: for each chunk the number of its word and that of its points, if any
        self.first, self.second = array("q"), array("q")
        self.pairs: list[np.ndarray] = []
        self.times: list[np.ndarray] = []
        self.ids: list = []
        self.sizes: list[int] = []
        self.digest = xxhash.xxh3_64()

    def add(self, ids: pa.Array, texts: pa.Array, sizes: np.ndarray) -> None:
        parts = pc.ascii_split_whitespace(texts)
        owner = np.repeat(np.arange(len(self.ids), len(self.ids) + len(texts)), np.diff(parts.offsets.to_numpy()))
        coded = parts.flatten().dictionary_encode()
        known = self.chunks
        code = np.zeros(len(coded.dictionary), np.int64)
        for k, chunk in enumerate(coded.dictionary.to_pylist()):
            at = known.get(chunk)
            if at is None:
                at = known[chunk] = len(known)
                tokens = pre_tokens(chunk) if chunk else ()
                self.first.append(self.words.setdefault(tokens[0], len(self.words)) if tokens else -1)
                self.second.append(self.words.setdefault(tokens[1], len(self.words)) if len(tokens) > 1 else -1)
            code[k] = at
        used = code[coded.indices.to_numpy()]
        keys = []
        for numbers in (self.first, self.second):
            own = np.frombuffer(numbers, np.int64)[used] if len(used) else np.zeros(0, np.int64)
            keys.append(((own << 16) + owner)[own >= 0])
            del own  # the array cannot grow while a view of it lives
        found, n = np.unique(np.concatenate(keys), return_counts=True)
        self.pairs.append(found)
        self.times.append(n)
        self.ids += ids.to_pylist()
        self.sizes += sizes.tolist()
        for buffer in texts.buffers()[1:]:
            if buffer is not None:
                self.digest.update(buffer)

    def full(self) -> bool:
        return len(self.ids) > _BLOCK_DOCS or sum(map(len, self.pairs)) > _BLOCK_PAIRS

    def rows(self, schema: pa.Schema, buckets: int, number: int) -> pa.RecordBatch:
        """One row for each bucket of pre-tokens, and one with the documents.

        A row of a bucket has its pre-tokens (line by line), how many documents each is in, their places (16 bits), and
        how often they have it: a bit tells whether all of a pre-token's counts are 1, else they are listed.
        """
        name = xxhash.xxh3_64_intdigest(f"{TaskContext.get().partitionId()} {number} {self.digest.hexdigest()}") >> 1
        key, n = np.concatenate(self.pairs), np.concatenate(self.times)
        tokens = [w.encode() for w in self.words]
        bucket = np.fromiter((zlib.crc32(t) % buckets for t in tokens), np.int64, len(tokens))
        order = np.argsort(bucket, kind="stable")
        rank = np.empty(len(tokens), np.int64)
        rank[order] = np.arange(len(tokens))
        key = (rank[key >> 16] << 16) + (key & 0xFFFF)
        by = np.argsort(key, kind="stable")
        key, n = key[by], n[by]
        ends = np.searchsorted(key >> 16, np.arange(len(tokens) + 1))
        many = np.add.reduceat(np.r_[n > 1, False], ends[:-1]) > 0 if len(tokens) else np.zeros(0, bool)
        shown = np.repeat(many, np.diff(ends))
        cuts = np.searchsorted(bucket[order], np.arange(buckets + 1)).tolist()
        out: list[tuple] = []
        for b, (lo, hi) in enumerate(zip(cuts, cuts[1:])):
            if lo < hi:
                part = slice(ends[lo], ends[hi])
                out.append((name, b, b"\n".join([tokens[k] for k in order[lo:hi]]), np.diff(ends[lo : hi + 1]).astype("<u2").tobytes(), np.packbits(many[lo:hi]).tobytes(), (key[part] & 0xFFFF).astype("<u2").tobytes(), n[part][shown[part]].astype("<u4").tobytes(), None, None))
        out.append((name, name % buckets, None, None, None, None, None, [{"id": i, "size": s} for i, s in zip(self.ids, self.sizes, strict=True)], len(out)))
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema, strict=True)], schema=schema)


def _frequencies(batches: Iterator[pa.RecordBatch], buckets: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Blocks of documents as packed rows."""
    block, number = _Block(), 0
    for ids, texts, sizes in _text_groups(batches):
        block.add(ids, texts, sizes)
        if block.full():
            yield block.rows(schema, buckets, number)
            block, number = _Block(), number + 1
    if block.ids:
        yield block.rows(schema, buckets, number)


def _partial_sums(batches: Iterator[pa.RecordBatch], path: str, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Count the pieces of each pre-token that comes, once, and add them up by block and place.

    Rows with documents pass through. Sums of a block are held until many blocks are; ``n_rows`` tells how many rows
    they stand for.
    """
    pieces: dict[bytes, int] = {}
    held: dict[int, tuple[np.ndarray, int]] = {}

    def flushed() -> pa.RecordBatch:
        rows = [(block, sums.astype("<u8").tobytes(), None, n) for block, (sums, n) in held.items()]
        held.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema, strict=True)], schema=schema)

    for batch in batches:
        with_docs = batch.filter(batch["docs"].is_valid())
        if with_docs.num_rows:
            yield pa.RecordBatch.from_arrays([with_docs["block"], pa.nulls(with_docs.num_rows, pa.binary()), with_docs["docs"], with_docs["n_rows"]], schema=schema)
        for row in batch.filter(batch["docs"].is_null()).drop_columns(["docs"]).to_pylist():
            tokens = row["tokens"].split(b"\n")
            if len(pieces) > _KEPT_COUNTS:
                pieces.clear()
            new = [t for t in tokens if t not in pieces]
            pieces.update(zip(new, count_pieces(path, new), strict=True))
            docs_of = _numbers(row["n_docs"], "<u2").astype(np.int64)
            places = _numbers(row["places"], "<u2").astype(np.int64)
            times = np.ones(len(places), np.int64)
            times[np.repeat(np.unpackbits(_numbers(row["many"], np.uint8), count=len(tokens)).astype(bool), docs_of)] = _numbers(row["times"], "<u4")
            each = np.fromiter(map(pieces.__getitem__, tokens), np.int64, len(tokens))
            sums = np.bincount(places, times * np.repeat(each, docs_of)).astype(np.int64)  # exact below 2**53
            old, n = held.get(row["block"], (np.zeros(0, np.int64), 0))
            long, short = sorted((old, sums), key=len, reverse=True)
            long[: len(short)] += short
            held[row["block"]] = long, n + 1
            if len(held) > 128:
                yield flushed()
    if held:
        yield flushed()


def count_pieces(path: str, tokens: list[bytes]) -> list[int]:
    """The library's number of pieces of each pre-token: plain words many in one call, others one by one."""
    plain = [bool(_PLAIN_CHUNK.fullmatch(t.decode())) and t[-1:] not in b".," for t in tokens]
    words = iter(encode_words(path, [t for t, p in zip(tokens, plain, strict=True) if p]))
    others = iter(encode_chunks(path, [t for t, p in zip(tokens, plain, strict=True) if not p]))
    return [len(next(words)) // 4 if p else len(next(others)) for p in plain]


def count_tokens(
    docs: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    limit: int = 2048,
) -> DataFrame:
    """Tokens of every text: ``(doc_id, n_bytes, n_tokens, over_limit)``.

    1. One scan gives the frequencies: for each block of documents (about one an input split) a packed row for each
       bucket of pre-tokens, with the places of the documents that have them and how often.
    2. Rows are brought together by bucket, so all frequencies of a pre-token meet; the library is asked once for the
       pieces of each distinct pre-token there, and pieces are joined to its frequencies and summed by block and place.
    3. Sums are added up by block and joined to the block's documents. Ids are never kept.

    There are as many buckets as shuffle partitions. A frequent pre-token adds two bytes for each document that has it
    to its bucket; adaptive execution splits a bucket that has grown large (its pre-tokens are then counted once a split).
    A block's name is a digest of its texts, and sums are only accepted if they stand for all rows of the block: a
    recomputed block of other rows fails loudly instead of giving wrong counts.
    Null and empty texts: 0 tokens. Every row gives a row, ids may repeat or be null. Extra columns are ignored.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
    id_type = rows.schema["doc_id"].dataType
    buckets = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    listed = f"array<struct<id:{id_type.simpleString()},size:bigint>>"
    packed = "block long, bucket int, tokens binary, n_docs binary, many binary, places binary, times binary"
    arrow = to_arrow_schema(rows.select("doc_id").schema).field(0).type
    docs_type = pa.list_(pa.struct([("id", arrow), ("size", pa.int64())]))
    kinds = (pa.int64(), pa.int32(), *[pa.binary()] * 5, docs_type, pa.int32())
    shape = pa.schema(list(zip(("block", "bucket", "tokens", "n_docs", "many", "places", "times", "docs", "n_rows"), kinds)))
    sums_shape = pa.schema([("block", pa.int64()), ("sums", pa.binary()), ("docs", docs_type), ("n_rows", pa.int32())])
    blocks = rows.mapInArrow(lambda batches: _frequencies(batches, buckets, shape), f"{packed}, docs {listed}, n_rows int")
    met = blocks.hint("rebalance", F.col("bucket"))
    added = met.mapInArrow(lambda batches: _partial_sums(batches, tokenizer_path, sums_shape), f"block long, sums binary, docs {listed}, n_rows int")

    def total(table: pa.Table) -> pa.Table:
        has = table["docs"].is_valid()
        told = table.filter(has)
        docs = told["docs"].combine_chunks().flatten()
        n, rows = np.zeros(len(docs), np.int64), 0
        for sums, k in zip(table["sums"], table["n_rows"], strict=True):
            if sums.is_valid:
                own = np.frombuffer(sums.as_py(), "<u8").astype(np.int64)
                n[: len(own)] += own
                rows += k.as_py()
        if told.num_rows != 1 or rows != told["n_rows"][0].as_py():
            raise RuntimeError("the rows of a block do not belong together: the input gave other rows when read again")
        return pa.table({"doc_id": docs.field("id"), "n_bytes": docs.field("size"), "n_tokens": n, "over_limit": n > limit})

    return added.groupBy("block").applyInArrow(total, f"doc_id {id_type.simpleString()}, n_bytes long, n_tokens long, over_limit boolean")

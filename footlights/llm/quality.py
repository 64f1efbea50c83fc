"""Operator 2: quality rules and line labelling by a linear-chain conditional random field."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from .common import ASCII_SPACE, schema_with, slices, text_or_empty

_SYMBOLS = b"#*$%&|<>"
_CAPITALS, _SMALL = bytes(range(65, 91)), bytes(range(97, 123))
#: Long documents are cut into chains of so many lines for the fit (not for decoding).
_CHAIN = 60
_PLAIN_END = (b".", b"!", b"?", b":", b'"', b")")
_NOTICE = re.compile(rb"rights reserved|copyright|licen[sc]ed? under|cookie|javascript|click here|terms of (use|service)", re.I)

#: Columns that the operator adds.
RESULTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "content_share", "kept")

FEATURES = (
    "bias", "symbols over 2 %", "symbols over 8 %", "more capitals than small letters", "exclamation words over 30 %",
    "words repeated over 50 %", "word repeats its neighbour over 30 %", "seen above", "notice", "up to 4 words",
    "5 to 12 words", "over 12 words", "sentence end", "digits over 20 %", "mean word over 14 or under 2 bytes",
)


@dataclass(frozen=True)
class LineModel:
    """A two-label chain: ``weights[label, feature]`` and ``moves[from, to]``; label 1 is content.

    ``held_out``: shares of lines and documents outside the fit that it labels as they are, if it was fitted.
    """

    weights: np.ndarray
    moves: np.ndarray
    held_out: tuple[float, float] | None = None


def _plain_model() -> LineModel:
    """Used where no labelled document exists: a line is content unless its features speak against it."""
    against = np.array([-1.0, 1, 2, 1, 2, 2, 2, 1, 2, 0, 0, -0.5, -0.5, 1, 1])
    return LineModel(np.stack([against, np.zeros(len(FEATURES))]), np.array([[0.5, 0.0], [0.0, 0.5]]))


def line_features(lines: list[bytes], words: list[list[bytes]]) -> np.ndarray:
    """A row of 0/1 features for each line; ``words`` are the lines' words."""
    out, seen = np.zeros((len(lines), len(FEATURES)), np.float32), set()
    for row, line, own in zip(out, lines, words, strict=True):
        n, size = len(own), sum(map(len, own))
        symbols = len(line) - len(line.translate(None, _SYMBOLS))
        small = len(line) - len(line.translate(None, _SMALL))
        capitals = len(line) - len(line.translate(None, _CAPITALS))
        repeats = n - len(set(own))
        neighbours = sum(map(bytes.__eq__, own, own[1:]))
        row[:] = (
            1, symbols > 0.02 * size, symbols > 0.08 * size, capitals > small, line.count(b"!") > 0.3 * n,
            n > 4 and repeats > 0.5 * n, n > 2 and neighbours > 0.3 * n, line in seen, _NOTICE.search(line) is not None, n <= 4,
            4 < n <= 12, n > 12, line.rstrip().endswith(_PLAIN_END), len(line.translate(None, b"0123456789")) < len(line) - 0.2 * size, not 2 * n <= size <= 14 * n,
        )
        seen.add(line)
    return out


def _split(text: str) -> tuple[list[bytes], list[list[bytes]]]:
    """Lines that have a word, and their words."""
    lines = [(line, words) for line in text.encode().split(b"\n") if (words := line.split())]
    return [x[0] for x in lines], [x[1] for x in lines]


def fit_line_model(labelled: DataFrame, text_col: str = "text", label_col: str = "good", max_rows: int = 1600, rounds: int = 2) -> LineModel:
    """Fit the chain by maximum likelihood on at most ``max_rows`` labelled documents, with line labels of its own.

    ``labelled`` has a text and a boolean label. The sample takes the least hashes of the text and is all that reaches the
    driver; a quarter of it is held out of the fit and gives ``LineModel.held_out``.

    Lines have no labels, so they are hidden: at first a line is content in a good document and boilerplate in a bad one
    or if three documents or more of the sample have it. A chain is fitted, lines of which it is sure get the label that
    it gives them, whatever their document, and it is fitted again (``rounds`` times). Chains are the documents, and good
    documents into which lines of a bad one are spliced: so moves between content and boilerplate are learned where they
    happen, inside a document. Without both labels the plain model is returned.
    """
    rows = labelled.where(F.col(text_col).isNotNull() & F.col(label_col).isNotNull()).select(F.col(text_col).alias("t"), F.col(label_col).alias("y"))
    picked = rows.orderBy(F.xxhash64("t"), "y").limit(max_rows).collect()
    found = [(parts, int(r.y)) for r in picked if (parts := _split(r.t))[0]]
    in_documents = Counter(line for (lines, _), _ in found for line in set(lines))
    documents = [(lines, words, np.array([int(y and in_documents[line] < 3) for line in lines])) for (lines, words), y in found]
    told = [y for _, y in found]
    fit, test = [[d for k, d in enumerate(documents) if (k % 4 == 3) == held] for held in (False, True)]
    fit_told, test_told = [[y for k, y in enumerate(told) if (k % 4 == 3) == held] for held in (False, True)]
    if len(set(fit_told)) < 2:
        return _plain_model()
    for _ in range(rounds):
        chains = _chains(fit, fit_told)
        model = LineModel(*_likeliest([(line_features(lines, words), y) for lines, words, y in chains]))
        for lines, words, y in fit:
            margin = line_features(lines, words) @ (model.weights[1] - model.weights[0])
            y[np.abs(margin) > _SURE] = (margin > 0)[np.abs(margin) > _SURE]
    model = LineModel(*_likeliest([(line_features(lines, words), y) for lines, words, y in _chains(fit, fit_told)]))
    return replace(model, held_out=_agreement(model, _chains(test, test_told), test, test_told))


#: Log odds from which on a fitted chain is sure of a line by itself.
_SURE = 3.0
Lines = tuple[list[bytes], list[list[bytes]], np.ndarray]


def _chains(documents: list[Lines], told: list[int]) -> list[Lines]:
    """All documents, and each good one with lines of a bad one in its middle."""
    good, bad = ([d for d, y in zip(documents, told, strict=True) if y == label] for label in (1, 0))
    out = [*good, *bad]
    for k, (lines, words, y) in enumerate(good if bad else []):
        more = bad[k % len(bad)]
        at, n = (k * 7919) % (len(lines) + 1), 1 + k % 12
        out.append((lines[:at] + more[0][:n] + lines[at:], words[:at] + more[1][:n] + words[at:], np.concatenate([y[:at], more[2][:n], y[at:]])))
    return out


def _agreement(model: LineModel, chains: list[Lines], documents: list[Lines], told: list[int]) -> tuple[float, float]:
    """Shares of held-out lines that are labelled as where they come from, and of documents that are judged as told."""
    hits = [np.mean(np.array(viterbi(line_features(lines, words), model)) == y) for lines, words, y in chains]
    shares = [np.average(viterbi(line_features(lines, words), model), weights=[len(w) for w in words]) for lines, words, _ in documents]
    return float(np.mean(hits)) if hits else 1.0, float(np.mean([(s >= 0.5) == bool(y) for s, y in zip(shares, told, strict=True)])) if told else 1.0


def _likeliest(labelled: list[tuple[np.ndarray, np.ndarray]], steps: int = 100, rate: float = 0.15) -> tuple[np.ndarray, np.ndarray]:
    """Weights and moves of the likeliest chain, by adaptive gradient steps; both labels weigh the same."""
    # equal chains are one chain with a count
    groups: Counter[tuple[bytes, bytes]] = Counter()
    for x, y in labelled:
        for at in range(0, len(x), _CHAIN):
            groups[x[at : at + _CHAIN].tobytes(), y[at : at + _CHAIN].astype(np.int8).tobytes()] += 1
    size, d = max(len(y) for _, y in groups), len(FEATURES)
    x, mask, own, count = np.zeros((len(groups), size, d)), np.zeros((len(groups), size)), np.zeros((len(groups), size), int), np.zeros(len(groups))
    for i, ((raw, y), times) in enumerate(groups.items()):
        x[i, : len(y)], mask[i, : len(y)], own[i, : len(y)], count[i] = np.frombuffer(raw, np.float32).reshape(-1, d), 1, np.frombuffer(y, np.int8), times
    truth = np.eye(2)[own] * mask[..., None]
    share = np.maximum(1.0, np.einsum("n,ntl->l", count, truth))
    # a chain weighs as its lines do on average
    count = count * (truth @ (1 / share)).sum(1) / mask.sum(1) * 0.5
    w, m, gw, gm = np.zeros((2, d)), np.zeros((2, 2)), np.zeros((2, d)), np.zeros((2, 2))
    for _ in range(steps):
        unary = np.einsum("ntd,ld->ntl", x, w)
        alpha, beta = np.zeros_like(unary), np.zeros_like(unary)
        alpha[:, 0] = unary[:, 0]
        for t in range(1, size):
            step = np.logaddexp(alpha[:, t - 1, :1] + m[0], alpha[:, t - 1, 1:] + m[1]) + unary[:, t]
            alpha[:, t] = np.where(mask[:, t, None] > 0, step, alpha[:, t - 1])
        for t in range(size - 2, -1, -1):
            ahead = unary[:, t + 1] + beta[:, t + 1]
            step = np.logaddexp(ahead[:, :1] + m[:, 0], ahead[:, 1:] + m[:, 1])
            beta[:, t] = np.where(mask[:, t + 1, None] > 0, step, 0)
        total = np.logaddexp(alpha[:, -1, 0], alpha[:, -1, 1])
        p = np.exp(alpha + beta - total[:, None, None]) * mask[..., None]
        new_w = np.einsum("n,ntl,ntd->ld", count, truth - p, x) - 1e-4 * w
        pair = np.exp(alpha[:, :-1, :, None] + m + (unary + beta)[:, 1:, None, :] - total[:, None, None, None]) * mask[:, 1:, None, None]
        new_m = np.einsum("n,ntab->ab", count, truth[:, :-1, :, None] * truth[:, 1:, None, :] - pair) - 1e-4 * m
        gw, gm = gw + new_w**2, gm + new_m**2
        w, m = w + rate * new_w / np.sqrt(gw + 1e-12), m + rate * new_m / np.sqrt(gm + 1e-12)
    return w, m


def viterbi(features: np.ndarray, model: LineModel) -> list[int]:
    """The likeliest labels of a chain of lines; ties go to content."""
    (a0, a1), ((m00, m01), (m10, m11)) = (features @ model.weights.T).T.tolist(), model.moves.tolist()
    s0, s1, back = a0[0], a1[0], []
    for u0, u1 in zip(a0[1:], a1[1:], strict=True):
        from0, from1 = s1 + m10 >= s0 + m00, s1 + m11 >= s0 + m01
        s0, s1 = (s1 + m10 if from0 else s0 + m00) + u0, (s1 + m11 if from1 else s0 + m01) + u1
        back.append((from0, from1))
    label = int(s1 >= s0)
    labels = [label]
    for step in reversed(back):
        labels.append(label := int(step[label]))
    return labels[::-1]


def repeated_words(words: list[bytes]) -> int:
    """Words in 3-word windows that occur twice or more in the text, the first ones included."""
    if len(words) < 4:
        return 0
    index: dict[bytes, int] = {}
    ids = np.fromiter((index.setdefault(w, len(index)) for w in words), np.int64, len(words))
    pairs = ids[:-1] * len(index) + ids[1:]
    pairs = np.unique(pairs, return_inverse=True)[1] if len(index) > 1_000_000 else pairs
    windows = pairs[:-1] * len(index) + ids[2:]
    _, at, n = np.unique(windows, return_inverse=True, return_counts=True)
    hit = n[at] > 1
    covered = np.zeros(len(words), bool)
    for k in range(3):
        covered[k : k + len(hit)] |= hit
    return int(covered.sum())


def quality(docs: DataFrame, model: LineModel, text_col: str = "text", min_words: int = 50, max_repeated: float = 0.5, min_content: float = 0.5) -> DataFrame:
    """Add the base counts, ``content_share`` and ``kept`` to every row of ``docs``.

    Words are runs without ASCII white space. ``base_failed``: fewer than ``min_words`` words, or more than
    ``max_repeated`` of the words in repeated 3-word windows. Else Viterbi decoding marks each line as content or
    boilerplate; ``content_share`` is the content lines' share of all words and ``kept`` is true from ``min_content``
    on. Null and empty texts have no words, fail and are not kept, with a share of 0. Other columns stay; input
    columns that bear a result's name are replaced.
    """
    names = RESULTS
    types = ("long",) * 5 + ("boolean", "double", "boolean")
    kept = docs.select(*[c for c in docs.columns if c not in names])
    schema = schema_with(kept, **dict(zip(names, types, strict=True)))

    def judge(text: str | None) -> tuple:
        raw = (text or "").encode()
        lines, by_line = _split(text or "")
        words = [w for own in by_line for w in own]
        chars = len(text or "") - (len(raw) - len(raw.translate(None, ASCII_SPACE)))
        repeated = repeated_words(words)
        failed = len(words) < min_words or repeated > max_repeated * len(words)
        labels = viterbi(line_features(lines, by_line), model) if lines else []
        content = sum(len(own) for own, label in zip(by_line, labels, strict=True) if label)
        share = content / len(words) if words else 0.0
        return len(words), chars, len(raw) - len(raw.translate(None, _SYMBOLS)), len(lines) - len(set(lines)), repeated, failed, share, not failed and share >= min_content

    shape = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            found = zip(*map(judge, part[text_col].to_pylist()), strict=True)
            yield pa.RecordBatch.from_arrays([*part.columns, *(pa.array(x, shape.field(n).type) for n, x in zip(names, found, strict=True))], schema=shape)

    return kept.mapInArrow(run, schema)


def labelled_documents(docs: DataFrame, labels: DataFrame, max_rows: int = 800) -> DataFrame:
    """``(text, good)`` of at most ``2 * max_rows`` labelled documents: the least hashes of each quality label.

    The sample is chosen among the labels, so only its rows are fetched from ``docs``. Null ids and labels are passed
    over; an id that has several labels counts for each.
    """
    picked = [
        labels.where((F.col("quality") == q) & F.col("doc_id").isNotNull()).select("doc_id", F.lit(bool(q)).alias("good")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
        for q in (0, 1)
    ]
    # at most 2 x max_rows rows
    return docs.select("doc_id", text_or_empty().alias("text")).join(F.broadcast(picked[0].unionByName(picked[1])), "doc_id").select("text", "good")

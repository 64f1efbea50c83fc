"""Operator 12: a sparse ensemble of rules over text statistics, scored by Spark columns.

Small boosted trees propose conjunctive rules: every path from the root to a node is one. A logistic regression with an L1
penalty weighs them and drops most. What is left is compiled into column expressions, so scoring is a projection.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import log

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_or_empty
from .language import held_out

_SPACE = r"[\x20\x09-\x0D]+"
#: Classes of characters that are counted; runs of all others are removed at once.
_CLASSES = {"capitals": "A-Z", "digits": "0-9", "symbols": "#*$%&|<>", "marks": "!?", "ends": ".,;:"}
#: Statistics of a text, in the order in which models number them.
STATISTICS = (
    "words", "mean_word", "symbols", "marks", "ends", "capitals", "digits", "other_letters", "distinct_words", "word_again", "words_a_line", "repeated_lines",
)
RESULTS = ("score", "predicted")


@dataclass(frozen=True)
class Rule:
    """Holds where every named statistic is above ``low`` and not above ``high`` (None: no such bound)."""

    bounds: tuple[tuple[str, float | None, float | None], ...]
    weight: float = 0.0

    def column(self, prefix: str = "") -> Column:
        parts = [F.col(prefix + s) > low for s, low, _ in self.bounds if low is not None] + [F.col(prefix + s) <= high for s, _, high in self.bounds if high is not None]
        out = parts[0]
        for p in parts[1:]:
            out = out & p
        return out

    def holds(self, values: np.ndarray) -> np.ndarray:
        out = np.ones(len(values), bool)
        for s, low, high in self.bounds:
            x = values[:, STATISTICS.index(s)]
            out &= (x > (-np.inf if low is None else low)) & (x <= (np.inf if high is None else high))
        return out

    def __str__(self) -> str:
        return " and ".join(f"{'' if low is None else f'{low:.4g} < '}{s}{'' if high is None else f' <= {high:.4g}'}" for s, low, high in self.bounds) + f": {self.weight:+.2f}"


@dataclass(frozen=True)
class RuleModel:
    """Log odds ``base`` and the weighted rules that were kept."""

    base: float
    rules: tuple[Rule, ...] = ()

    def score(self, prefix: str = "") -> Column:
        odds = F.lit(self.base)
        for r in self.rules:
            odds = odds + F.when(r.column(prefix), r.weight).otherwise(0.0)
        return 1 / (1 + F.exp(-odds))


def statistics(docs: DataFrame, text_col: str = "text", prefix: str = "_s_") -> DataFrame:
    """Add the statistics of every whole text as double columns ``prefix`` + name; shares of nothing are 0.

    Words are runs without ASCII white space, lines those that have a word. The texts are read by built-in functions only:
    words and lines in one projection, what is counted from them in the next.
    """
    text, t = F.col(text_col), prefix
    left = lambda pattern: F.coalesce(F.length(F.regexp_replace(F.col(t + "rest"), pattern, "")), F.lit(0)).cast("double")
    # small letters are most of a text: everything else is counted in what is left without them
    some = docs.withColumn(t + "rest", F.regexp_replace(text, "[a-z]+", "")).withColumns(
        {
            t + "w": F.array_remove(F.split(F.coalesce(text, F.lit("")), _SPACE), ""),
            t + "l": F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: F.length(F.btrim(x, F.lit(" \t\x0b\x0c\r"))) > 0),
            **{t + "n_" + name: left(f"[^{chars}]+") for name, chars in _CLASSES.items()},
            t + "n_small": F.coalesce(F.length(text) - F.length(t + "rest"), F.lit(0)).cast("double"),
            t + "big": left(_SPACE),
        }
    )
    words, lines = F.col(t + "w"), F.col(t + "l")
    counted = some.withColumns(
        {
            t + "words": F.size(words).cast("double"),
            t + "kinds": F.size(F.array_distinct(words)).cast("double"),
            t + "lines": F.size(lines).cast("double"),
            t + "line_kinds": F.size(F.array_distinct(lines)).cast("double"),
        }
    )
    share = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    c = {n: F.col(t + n) for n in ("words", "big", "kinds", "lines", "line_kinds", "n_small", *(f"n_{k}" for k in _CLASSES))}
    small, size = c["n_small"], c["n_small"] + c["big"]
    done = counted.withColumns(
        {
            t + "mean_word": share(size, c["words"]),
            t + "symbols": share(c["n_symbols"], size),
            t + "marks": share(c["n_marks"], c["words"]),
            t + "ends": share(c["n_ends"], c["words"]),
            t + "capitals": share(c["n_capitals"], c["n_capitals"] + small),
            t + "digits": share(c["n_digits"], size),
            t + "other_letters": share(size - small - sum((c[f"n_{k}"] for k in _CLASSES), F.lit(0.0)), size),
            t + "distinct_words": share(c["kinds"], c["words"]),
            # unlike the share of distinct words this does not fall with the length of ordinary prose
            t + "word_again": share(F.log2(c["kinds"] + 1), F.log2(c["words"] + 1)),
            t + "words_a_line": share(c["words"], c["lines"]),
            t + "repeated_lines": share(c["lines"] - c["line_kinds"], c["lines"]),
        }
    )
    return done.select(*docs.columns, *[t + s for s in STATISTICS])


def labelled_statistics(docs: DataFrame, labels: DataFrame, max_rows: int = 2000, id_col: str = "doc_id", label_col: str = "quality") -> tuple[DataFrame, dict[int, int]]:
    """``(label, statistics)`` of at most ``max_rows`` labelled documents of each label, and how many there are of each.

    Held-out ids never teach. The sample takes the least hashes of the ids; null ids and labels are passed over, and an id
    with several labels counts for each.
    """
    told = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(id_col)).select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_label"))
    counts = {r["_label"]: r["n"] for r in told.groupBy("_label").agg(F.count("*").alias("n")).collect()}
    picked = [told.where(F.col("_label") == y).orderBy(F.xxhash64("_id"), "_id").limit(max_rows) for y in (0, 1)]
    # at most 2 x max_rows ids
    rows = docs.select(F.col(id_col).alias("_id"), text_or_empty().alias("text")).join(F.broadcast(picked[0].unionByName(picked[1])), "_id")
    return statistics(rows, prefix="").select("_label", *STATISTICS), counts


def fit_rules(sample: DataFrame, counts: dict[int, int], trees: int = 40, depth: int = 3, seed: int = 1, threshold: float = 0.3) -> RuleModel:
    """Fit the ensemble on a sample that the driver can hold (statistics only); both labels weigh as often as they occur.

    Equal rows count together and rows are sorted, so the same sample gives the same model. A quarter of the sample chooses
    the penalty: the strongest one that errs there no more often than the best one and loses at most one standard error
    (or 0.005) more. Without both labels the score is the label's
    share, or 0.5 where no label is known.
    """
    got = sample.toPandas()
    rows = got.sort_values(list(got.columns)).to_numpy(float)
    y, x = rows[:, 0], rows[:, 1:]
    if len(np.unique(y)) < 2:
        share = (sum(counts[k] * k for k in counts) + 1) / (sum(counts.values()) + 2)
        return RuleModel(log(share / (1 - share)))
    weight = np.where(y == 1, counts[1] / (y == 1).sum(), counts[0] / (y == 0).sum())
    weight *= len(y) / weight.sum()
    rules = _proposed(x, y, weight, trees, depth, np.random.default_rng(seed))
    active = np.stack([r.holds(x) for r in rules], 1).astype(float)
    test = np.arange(len(y)) % 4 == 3
    path = _lasso_path(active[~test], y[~test], weight[~test])
    judged = [_judged(active[test], y[test], weight[test], base, w, threshold) for _, base, w in path]
    loss, spread, errors = min(judged)
    chosen = next(penalty for (penalty, _, _), (mine, _, wrong) in zip(path, judged, strict=True) if mine <= loss + max(spread, 0.005) and wrong <= errors)
    base, w = next((b, w) for penalty, b, w in _lasso_path(active, y, weight) if penalty <= chosen)
    return RuleModel(float(base), tuple(Rule(r.bounds, float(v)) for r, v in zip(rules, w, strict=True) if v))


def _proposed(x: np.ndarray, y: np.ndarray, weight: np.ndarray, trees: int, depth: int, rnd: np.random.Generator) -> list[Rule]:
    """Rules of boosted trees: each tree fits the slope of the logistic loss on half of the rows."""
    edges = [np.unique(np.quantile(column, np.linspace(0, 1, 33)[1:-1])) for column in x.T]
    odds = np.full(len(y), log(max(1e-9, np.average(y, weights=weight)) / max(1e-9, 1 - np.average(y, weights=weight))))
    found: dict[bytes, Rule] = {}
    for _ in range(trees):
        p = 1 / (1 + np.exp(-odds))
        slope, curve = weight * (y - p), weight * p * (1 - p) + 1e-9
        half = rnd.random(len(y)) < 0.5
        leaves = [(np.ones(len(y), bool), ())]
        for _ in range(depth):
            grown = []
            for inside, bounds in leaves:
                split = _split(x, edges, slope, curve, inside & half)
                if split is None:
                    grown.append((inside, bounds))
                    continue
                f, cut = split
                for low, high in ((None, cut), (cut, None)):
                    narrowed = _narrowed(bounds, STATISTICS[f], low, high)
                    mine = inside & (x[:, f] <= cut if low is None else x[:, f] > cut)
                    # rules that hold for the same rows are one: the shorter that was found first
                    if mine.any() and not mine.all():
                        found.setdefault(np.packbits(mine).tobytes(), Rule(narrowed))
                    grown.append((mine, narrowed))
            leaves = grown
        for inside, _ in leaves:
            odds[inside] += 0.3 * np.clip(slope[inside & half].sum() / (curve[inside & half].sum() + 1), -4, 4)
    return list(found.values())


def _narrowed(bounds: tuple, name: str, low: float | None, high: float | None) -> tuple:
    known = {s: (a, b) for s, a, b in bounds}
    a, b = known.get(name, (None, None))
    known[name] = (a if low is None else float(low), b if high is None else float(high))
    return tuple((s, *known[s]) for s in sorted(known))


def _split(x: np.ndarray, edges: list[np.ndarray], slope: np.ndarray, curve: np.ndarray, inside: np.ndarray) -> tuple[int, float] | None:
    """The statistic and the cut that lower the loss most, with at least 10 rows on either side."""
    best, out = 1e-6, None
    g, h, n = slope[inside], curve[inside], inside.sum()
    if n < 20:
        return None
    whole = g.sum() ** 2 / (h.sum() + 1)
    for f, cuts in enumerate(edges):
        place = np.searchsorted(cuts, x[inside, f], side="left")
        g_left, h_left, n_left = (np.cumsum(np.bincount(place, v, len(cuts) + 1))[:-1] for v in (g, h, np.ones(n)))
        gain = g_left**2 / (h_left + 1) + (g.sum() - g_left) ** 2 / (h.sum() - h_left + 1) - whole
        gain[(n_left < 10) | (n - n_left < 10)] = -1
        if len(gain) and gain.max() > best:
            best, out = gain.max(), (f, cuts[gain.argmax()])
    return out


def _lasso_path(active: np.ndarray, y: np.ndarray, weight: np.ndarray, steps: int = 14, rounds: int = 150) -> list[tuple[float, float, np.ndarray]]:
    """``(penalty, base, weights)`` from the strongest penalty on, by accelerated proximal steps from one to the next."""
    # equal rows are one row with a weight
    both, at = np.unique(np.column_stack([active, y]), axis=0, return_inverse=True)
    a, t, m = both[:, :-1], both[:, -1], np.bincount(at.ravel(), weight) / weight.sum()
    base = log((m @ t) / (1 - m @ t))
    penalty = np.abs(a.T @ (m * (t - m @ t))).max() * 0.7
    # the slope changes at most by a quarter of the largest eigenvalue
    one = np.column_stack([a, np.ones(len(a))])
    rate = 4 / np.linalg.eigvalsh(one.T @ (one * m[:, None]))[-1]
    w, out = np.append(np.zeros(a.shape[1]), base), []
    for _ in range(steps):
        ahead, momentum = w, 1.0
        for _ in range(rounds):
            slope = one.T @ (m * (1 / (1 + np.exp(-(one @ ahead))) - t))
            new = ahead - rate * slope
            new[:-1] = np.sign(new[:-1]) * np.maximum(np.abs(new[:-1]) - rate * penalty, 0)
            following = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
            ahead, w, momentum = new + (momentum - 1) / following * (new - w), new, following
        out.append((penalty, w[-1], w[:-1].copy()))
        penalty *= 0.6
    return out


def _judged(active: np.ndarray, y: np.ndarray, weight: np.ndarray, base: float, w: np.ndarray, threshold: float) -> tuple[float, float, float]:
    """Mean loss, its standard error and the share on the wrong side of the threshold."""
    odds = base + active @ w
    losses = np.logaddexp(0, np.where(y == 1, -odds, odds))
    mean = np.average(losses, weights=weight)
    return float(mean), float(np.sqrt(np.average((losses - mean) ** 2, weights=weight) / len(y))), float(np.average((odds > log(threshold / (1 - threshold))) != (y == 1), weights=weight))


def quality_scores(docs: DataFrame, model: RuleModel, text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """Add ``score`` (0 to 1) and ``predicted`` (1 from ``threshold`` on, else 0) to every row of ``docs``.

    Only the text is read; null and empty texts have statistics of 0 and get a score as any other. Other columns stay,
    input columns that bear a result's name are replaced. Repeated rows get equal scores; an empty table gives none.
    """
    kept = [c for c in docs.columns if c not in RESULTS]
    scored = statistics(docs.select(*kept), text_col).withColumn("score", model.score("_s_"))
    return scored.select(*kept, "score", (F.col("score") >= threshold).cast("int").alias("predicted"))

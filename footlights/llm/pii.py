"""Operator 8: personal data by candidates, boosted trees and calibrated thresholds.

High-recall generators propose overlapping spans; a small gradient-boosted model over format and context features scores
them; thresholds calibrated on other documents than the trees were fitted on select what is redacted. All row work is
column expressions, linear in a text's matches; the driver only sees one count for each combination of feature values.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_or_empty

KINDS = ("email", "ip", "card", "phone")

#: Base patterns (fixed values), written so that long runs are scanned once: a match begins where its first run begins
#: or where the last match ended, and runs are possessive. Each finds what the plain pattern in the comment does, the
#: one for cards only those matches that have 13 to 19 digits.
BASE = {
    # [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    # [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # [0-9]([\x20-]?[0-9])+
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){12,18}+(?![\x20-]?[0-9])",
    # \+[0-9][\x20().0-9-]+[0-9]
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}

#: Generators of candidates, of high recall (fixed values): addresses in words or without a domain, dotted numbers, long
#: numbers with any dividers, groups of digits.
GENERATORS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+(?:\x20?[\[(]\x20?(?:at|AT)\x20?[\])]\x20?|@)[A-Za-z0-9-]{1,63}+(?:(?:\.|\x20?[\[(]\x20?(?:dot|DOT)\x20?[\])]\x20?)[A-Za-z0-9-]{1,63}+){0,8}+",
    "ip": r"(?<![0-9.])[0-9]{1,3}+(?:\.[0-9]{1,3}+){2,5}+(?![0-9])",
    "card": r"(?<![0-9])(?<![0-9][\x20.-])[0-9](?:[\x20.-]?[0-9]){11,19}+(?![\x20.-]?[0-9])",
    "phone": r"(?<![0-9+])(?<![0-9][\x20./-])\+?\(?[0-9]{2,5}\)?(?:[\x20./-]\(?[0-9]{2,7}\)?){1,5}+(?![0-9])",
}

#: Words before a span that speak for a kind (fixed values).
CUES = {
    "email": r"(?i)\b(?:e-?mail|mail|contact|write|address)\b",
    "ip": r"(?i)\b(?:ip|server|host|address|addr|node)\b",
    "card": r"(?i)\b(?:card|visa|mastercard|amex|credit|debit|payment)\b",
    "phone": r"(?i)\b(?:phone|tel|telephone|call|mobile|fax|cell)\b",
}

#: Features (0 or 1). None of them is part of what makes a base match: neither the Luhn check and the number of digits of
#: a card, nor the size and number of an address' parts, nor the plus and the digits of a phone number, nor the sign and
#: the domain of an e-mail.
FEATURES = ("cue", "free_before", "free_after", "line_start", "line_end", "near_another", "form_a", "form_b", "form_c")
_N_FEATURES = len(FEATURES)

_SPAN = "struct<kind:string,start:int,end:int>"
_CANDIDATE = "struct<kind:string,start:int,end:int,base:boolean,features:int>"
#: Elements that are appended to one array in a fold; longer lists are folded in parts of so many.
_PART = 128


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check; false for an empty one."""
    marks = F.filter(F.split(F.reverse(digits), ""), lambda d: d != "")
    double = lambda v: v - F.when(v > 9, 9).otherwise(0)
    weights = F.transform(marks, lambda d, i: F.when(i % 2 == 1, double(d.cast("int") * 2)).otherwise(d.cast("int")))
    return (F.length(digits) > 0) & (F.aggregate(weights, F.lit(0), lambda a, v: a + v) % 10 == 0)


def _octets(c: Column) -> Column:
    part = lambda p: (F.length(F.regexp_replace(p, "^0+", "")) <= 3) & (F.coalesce(F.substring(F.regexp_replace(p, "^0+", ""), 1, 3).try_cast("int"), F.lit(0)) <= 255)
    return F.forall(F.split(c, r"\."), part)


def _valid(kind: str, match: Column) -> Column:
    n = F.length(_digits(match))
    if kind == "card":
        return n.between(13, 19) & luhn(_digits(match))
    if kind == "phone":
        return n.between(9, 15)
    return _octets(match) if kind == "ip" else F.lit(True)


def _parts(items: Column) -> Column:
    """An array cut into arrays of ``_PART`` elements."""
    return F.when(
        F.size(items) > 0, F.transform(F.sequence(F.lit(0), F.floor((F.size(items) - 1) / _PART).cast("int")), lambda k: F.slice(items, k * _PART + 1, F.lit(_PART)))
    ).otherwise(F.array(F.slice(items, 1, 0)))


def _placed(found: Column, gaps: Column, keep: Callable[[Column], Column]) -> Column:
    """``array<struct<start, end, match, before, after, near>>`` of the matches that ``keep``, from matches and gaps.

    ``gaps`` are ``struct<n, tail, head>`` of the text between the matches. Places are sums of lengths: first over
    parts of the list, then within each part, so that no long array is copied for each match.
    """
    near = lambda i: ((i > 0) & (F.get(gaps, i)["n"] <= 2)) | ((i < F.size(found) - 1) & (F.get(gaps, i + 1)["n"] <= 2))
    items = F.transform(
        found,
        lambda m, i: F.struct(F.get(gaps, i)["n"].alias("gap"), F.length(m).alias("n"), m.alias("match"), F.get(gaps, i)["tail"].alias("before"), F.get(gaps, i + 1)["head"].alias("after"), near(i).alias("near")),
    )
    parts = _parts(items)
    sums = F.transform(parts, lambda p: F.aggregate(p, F.lit(0), lambda a, x: a + x["gap"] + x["n"]))
    begins = F.aggregate(sums, F.array(F.lit(0)).cast("array<int>"), lambda a, n: F.concat(a, F.array(F.element_at(a, -1) + n)).cast("array<int>"))
    kind = "array<struct<start:int,end:int,match:string,before:string,after:string,near:boolean>>"

    def within(part: Column, begin: Column) -> Column:
        place = lambda a, x: F.struct((a["at"] + x["gap"]).alias("start"), (a["at"] + x["gap"] + x["n"]).alias("end"), x["match"].alias("match"), x["before"].alias("before"), x["after"].alias("after"), x["near"].alias("near"))
        return F.aggregate(
            part,
            F.struct(begin.alias("at"), F.array().cast(kind).alias("out")),
            lambda a, x: F.struct((a["at"] + x["gap"] + x["n"]).alias("at"), F.when(keep(x["match"]), F.concat(a["out"], F.array(place(a, x)))).otherwise(a["out"]).cast(kind).alias("out")),
            lambda a: a["out"],
        )

    return F.flatten(F.transform(parts, lambda p, k: within(p, F.get(begins, k))))


def _forms(kind: str, match: Column) -> list[Column]:
    """Three features of a match's form."""
    digits = _digits(match)
    return {
        "email": [match.rlike(r"^[^@\[(]*[0-9]"), match.rlike(r"^[^@\[(]*[._-]"), match.rlike(r"(?i)(?:com|org|net|edu|info|[a-z]{2})$")],
        "ip": [match.rlike(r"(?:^|\.)0[0-9]"), match.rlike(r"^(?:[0-9]\.)+[0-9]$"), match.rlike(r"^(?:10|127|172|192)\.")],
        "card": [digits.rlike("^[3-6]"), match.rlike(r"^[0-9]{4}[\x20-][0-9]{4}[\x20-][0-9]{4}|^[0-9]{4}[\x20-][0-9]{6}[\x20-]"), F.size(F.array_distinct(F.split(digits, ""))) >= 5],
        "phone": [match.contains("("), match.rlike(r"[0-9]{4}-[01][0-9]-[0-3][0-9]|[0-9]{1,2}[./][0-9]{1,2}[./][0-9]{4}"), match.rlike(r"[0-9]{3,4}[\x20.-]?[0-9]{4}$")],
    }[kind]


def _described(kind: str) -> Callable[[Column], Column]:
    """A placed match as a candidate with its features."""

    def described(s: Column) -> Column:
        facts = [
            s["before"].rlike(CUES[kind]),
            ~s["before"].rlike(r"[A-Za-z0-9_=/.:#-]$"),
            ~s["after"].rlike(r"^(?:[A-Za-z0-9_=/:#-]|\.[0-9A-Za-z])"),
            s["before"].rlike(r"(?:^|\n)\s*$"),
            s["after"].rlike(r"^\s*(?:\n|$)"),
            s["near"],
            *_forms(kind, s["match"]),
        ]
        bits = reduce(lambda a, b: a + b, [F.when(f, 1 << k).otherwise(0) for k, f in enumerate(facts)])
        return F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), F.lit(False).alias("base"), bits.alias("features"))

    return described


_WANTED = {"email": r"@|[\[(] ?(?:at|AT) ?[\])]", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][0-9 .-]{10}", "phone": r"[0-9][0-9 ./()-]{5}"}
_NEEDS = {"email": "@", "phone": "+", "ip": ".", "card": ""}


def base_spans(docs: DataFrame, text: Column, out: str) -> DataFrame:
    """Add the base matches of all kinds that pass their kind's check, ``array<_SPAN>``; failing ones get no other try."""
    names = []
    for kind in KINDS:
        gaps = F.transform(F.split(text, BASE[kind], -1), lambda g: F.struct(F.length(g).alias("n"), F.lit("").alias("tail"), F.lit("").alias("head")))
        found, name = F.regexp_extract_all(text, F.lit(BASE[kind]), F.lit(0)), f"_b_{kind}"
        names.append(name)
        docs = docs.withColumn(name, F.when(text.contains(_NEEDS[kind]) & text.rlike("[0-9]" if kind != "email" else "@"), F.struct(found.alias("found"), gaps.alias("gaps"))))
    as_span = lambda kind: lambda s: F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"))
    for kind, name in zip(KINDS, names, strict=True):
        spans = F.transform(_placed(F.col(name)["found"], F.col(name)["gaps"], lambda m, k=kind: _valid(k, m)), as_span(kind))
        docs = docs.withColumn(name, F.when(F.size(F.col(name)["found"]) > 0, spans).otherwise(F.array()).cast(f"array<{_SPAN}>"))
    return docs.withColumn(out, F.concat(*names)).drop(*names)


def propose(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Add ``_base`` (base spans) and ``_candidates`` (proposed spans with their features as bits) to every row.

    A candidate is ``base`` if it overlaps a base match of its kind. Null texts count as empty. Columns that bear one of
    the two names are replaced. Made once and written, both the fit and the search use it.
    """
    docs = docs.drop("_base", "_candidates").withColumn("_text", text_or_empty(text_col))
    text = F.col("_text")
    docs = base_spans(docs, text, "_base")
    names = []
    for kind in KINDS:
        gaps = F.transform(F.split(text, GENERATORS[kind], -1), lambda g: F.struct(F.length(g).alias("n"), F.right(g, F.lit(24)).alias("tail"), F.left(g, F.lit(8)).alias("head")))
        found, name = F.regexp_extract_all(text, F.lit(GENERATORS[kind]), F.lit(0)), f"_g_{kind}"
        names.append(name)
        docs = docs.withColumn(name, F.when(text.rlike(_WANTED[kind]), F.struct(found.alias("found"), gaps.alias("gaps"))))
    n_digits = lambda m: F.length(_digits(m))
    keeps = {"email": lambda m: F.lit(True), "ip": lambda m: F.lit(True), "card": lambda m: F.lit(True), "phone": lambda m: n_digits(m).between(7, 15)}
    for kind, name in zip(KINDS, names, strict=True):
        placed = _placed(F.col(name)["found"], F.col(name)["gaps"], keeps[kind])
        docs = docs.withColumn(name, F.when(F.size(F.col(name)["found"]) > 0, placed))
        docs = docs.withColumn(name, F.coalesce(F.transform(name, _described(kind)), F.array()).cast(f"array<{_CANDIDATE}>"))
    return docs.withColumn("_candidates", _marked(F.concat(*names), F.col("_base"))).drop(*names, "_text")


def _marked(candidates: Column, base: Column) -> Column:
    """Candidates with ``base`` set where a base span of the kind overlaps: one sweep over both by kind and place.

    A candidate overlaps a base span if one begins within it, or one that began before reaches into it.
    """
    items = F.array_sort(
        F.concat(
            F.transform(candidates, lambda c: F.struct(c["kind"].alias("kind"), c["start"].alias("start"), F.lit(1).alias("what"), c["end"].alias("end"), c["features"].alias("features"))),
            F.transform(base, lambda b: F.struct(b["kind"].alias("kind"), b["start"].alias("start"), F.lit(0).alias("what"), b["end"].alias("end"), F.lit(0).alias("features"))),
        )
    )
    kind = f"struct<kind:string,reach:int,open:array<{_CANDIDATE}>,out:array<{_CANDIDATE}>>"
    state = lambda k, reach, held, out: F.struct(k.alias("kind"), reach.alias("reach"), held.alias("open"), out.alias("out")).cast(kind)
    none = F.array().cast(f"array<{_CANDIDATE}>")

    def step(a: Column, x: Column) -> Column:
        other = a["kind"] != x["kind"]
        reach = F.when(other, F.lit(-1)).otherwise(a["reach"])
        # a base span may begin within the candidate that is still open
        hit = ~other & (x["what"] == 0)
        closed = F.transform(a["open"], lambda c: F.struct(c["kind"].alias("kind"), c["start"].alias("start"), c["end"].alias("end"), (c["base"] | (hit & (x["start"] < c["end"]))).alias("base"), c["features"].alias("features")))
        fresh = F.array(F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end"), (x["start"] < reach).alias("base"), x["features"].alias("features")))
        return F.when(x["what"] == 0, state(x["kind"], F.greatest(reach, x["end"]), closed, a["out"])).otherwise(state(x["kind"], reach, fresh, F.concat(a["out"], a["open"])))

    def part(a: Column, p: Column) -> Column:
        return F.aggregate(p, state(a["kind"], a["reach"], a["open"], none), step)

    whole = f"struct<kind:string,reach:int,open:array<{_CANDIDATE}>,outs:array<array<{_CANDIDATE}>>>"
    swept = F.aggregate(
        _parts(items),
        F.struct(F.lit("").alias("kind"), F.lit(-1).alias("reach"), none.alias("open"), F.array().cast(f"array<array<{_CANDIDATE}>>").alias("outs")).cast(whole),
        lambda a, p: F.aggregate(F.array(part(a, p)), a, lambda b, r: F.struct(r["kind"].alias("kind"), r["reach"].alias("reach"), r["open"].alias("open"), F.concat(b["outs"], F.array(r["out"])).alias("outs")).cast(whole)),
        lambda a: F.concat(F.flatten(a["outs"]), a["open"]),
    )
    return F.when(F.size(candidates) > 0, swept).otherwise(none)


@dataclass(frozen=True)
class Booster:
    """Per kind that could be fitted: a start score, depth-two trees ``(feature, feature, four leaf values)``, a scale for
    calibration, the share of positives that are labelled, and a probability threshold."""

    start: dict[str, float]
    trees: dict[str, list[tuple[int, int, tuple[float, float, float, float]]]]
    scale: dict[str, tuple[float, float]]
    labelled: dict[str, float]
    threshold: dict[str, float]

    def probability(self, kind: str, features: Column) -> Column:
        """Calibrated probability that a candidate of one kind is personal data."""
        bit = lambda k: F.getbit(features, F.lit(k)) == 1
        leaf = lambda a, b, v: F.when(bit(a), F.when(bit(b), v[3]).otherwise(v[2])).otherwise(F.when(bit(b), v[1]).otherwise(v[0]))
        score = reduce(lambda x, t: x + leaf(*t), self.trees[kind], F.lit(self.start[kind]))
        a, b = self.scale[kind]
        return F.least(F.lit(1.0), 1 / (1 + F.exp(-(F.lit(a) * score + F.lit(b)))) / F.lit(self.labelled[kind]))


def _boost(x: np.ndarray, pos: np.ndarray, neg: np.ndarray, rounds: int, rate: float) -> tuple[float, list]:
    """Newton boosting of depth-two trees on weighted rows of 0/1 features."""
    n = pos + neg
    start = float(np.log((pos.sum() + 1) / (neg.sum() + 1)))
    score, trees = np.full(len(n), start), []
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-score))
        grad, hess = pos - n * p, n * p * (1 - p)
        best = None
        for a in range(x.shape[1]):
            for b in range(a + 1, x.shape[1]):
                cell = 2 * x[:, a] + x[:, b]
                g, h = np.bincount(cell, grad, 4), np.bincount(cell, hess, 4)
                gain = float((g * g / (h + 1)).sum())
                if best is None or gain > best[0] + 1e-9:
                    best = (gain, a, b, g / (h + 1), cell)
        if best is None or best[0] < 1e-3:
            break
        _, a, b, value, cell = best
        value = rate * np.clip(value, -4, 4)
        trees.append((a, b, tuple(float(v) for v in value)))
        score = score + value[cell]
    return start, trees


def fit_booster(proposed: DataFrame, id_col: str = "doc_id", rounds: int = 24, rate: float = 0.4, precision: float = 0.95) -> Booster:
    """Fit trees and thresholds on the candidates of all rows of ``propose``.

    Candidates at base matches are labelled positives; the others are unlabelled, since a number in another form, or with
    a mistyped digit, is personal data as well. The features say nothing of what makes a base match, so the trees learn
    in which form and surroundings base matches stand. Counts for each combination of kind, features, label and fold (at
    most 4 x 2**9 x 2 x 2) are summed by Spark over all documents, and only they reach the driver. Trees are fitted on
    one half of the documents. On the other half scores are calibrated (Platt); the mean of the calibrated scores of its
    labelled candidates estimates which share of the positives is labelled, and a candidate's probability is its score
    over that share. A kind's threshold is the least probability, 0.5 at least, from which on the mean of the other
    half's unlabelled candidates is ``precision``.

    A kind without labelled or without unlabelled candidates in both halves has no trees: nothing is added to its base.
    """
    found = proposed.select(F.pmod(F.xxhash64(F.col(id_col).cast("string")), F.lit(2)).alias("fold"), F.explode("_candidates").alias("c"))
    counts = found.groupBy("c.kind", "fold", F.col("c.base").cast("int").alias("label"), "c.features").count().collect()
    model = Booster({}, {}, {}, {}, {})
    for kind in KINDS:
        table: dict[int, np.ndarray] = {}
        for r in sorted(r for r in counts if r.kind == kind):
            table.setdefault(r.features, np.zeros((2, 2)))[r.fold, r.label] += r["count"]
        n = np.array(list(table.values()) or np.zeros((0, 2, 2)))
        if not len(n) or not n.sum(0).all():
            continue
        x = (np.array(list(table))[:, None] >> np.arange(_N_FEATURES)) & 1
        start, trees = _boost(x, n[:, 0, 1], n[:, 0, 0], rounds, rate)
        score = start + sum((np.array(v)[2 * x[:, a] + x[:, b]] for a, b, v in trees), np.zeros(len(x)))
        pos, neg = n[:, 1, 1], n[:, 1, 0]
        a, b = 1.0, 0.0
        for _ in range(50):  # Platt: Newton steps of a two-parameter logistic fit
            p = 1 / (1 + np.exp(-(a * score + b)))
            r, w = (pos + neg) * p - pos, (pos + neg) * p * (1 - p)
            g = np.array([(r * score).sum() + 1e-3 * (a - 1), r.sum() + 1e-3 * b])
            h = np.array([[(w * score * score).sum() + 1e-2, (w * score).sum()], [(w * score).sum(), w.sum() + 1e-2]])
            a, b = np.array([a, b]) - np.clip(np.linalg.solve(h, g), -1, 1)
        p = 1 / (1 + np.exp(-(a * score + b)))
        labelled = float((pos * p).sum() / pos.sum())
        p = np.minimum(1.0, p / labelled)
        order = np.argsort(-p, kind="stable")
        weight, sure = np.cumsum(neg[order]), np.cumsum((neg * p)[order])
        at = max((i for i in range(len(p)) if p[order[i]] >= 0.5 and sure[i] >= precision * weight[i]), default=-1)
        model.start[kind], model.trees[kind], model.scale[kind], model.labelled[kind] = start, trees, (float(a), float(b)), labelled
        model.threshold[kind] = float(p[order[at]]) - 1e-9 if at >= 0 else 2.0
    return model


def find_pii(proposed: DataFrame, model: Booster) -> DataFrame:
    """Replace the columns of ``propose`` by ``pii``: the spans ``array<struct<kind, start, end, base>>`` by kind and start.

    Base spans always stay. Of the other candidates those whose probability reaches their kind's threshold are added,
    from left to right: none that overlaps a base span of any kind, and of two that overlap the likelier one (ties: the
    one that begins first, then kind order). Places are code points, the end is exclusive. Null and empty texts have no
    spans; other columns stay.
    """
    rank = lambda c: reduce(lambda x, k: F.when(c == k[1], k[0]).otherwise(x), list(enumerate(KINDS)), F.lit(9))
    item = "struct<start:int,rank:int,p:double,end:int,kind:string,base:boolean>"
    chance = lambda c: reduce(lambda x, k: F.when(c["kind"] == k, model.probability(k, c["features"])).otherwise(x), list(model.trees), F.lit(0.0))
    least = lambda c: reduce(lambda x, k: F.when(c["kind"] == k, F.lit(model.threshold[k])).otherwise(x), list(model.trees), F.lit(2.0))
    as_item = lambda c, p, base: F.struct(c["start"].alias("start"), rank(c["kind"]).alias("rank"), p.alias("p"), c["end"].alias("end"), c["kind"].alias("kind"), F.lit(base).alias("base"))
    out = proposed.drop("pii").withColumn("_likely", F.transform(F.filter("_candidates", lambda c: ~c["base"] & (chance(c) >= least(c))), lambda c: as_item(c, chance(c), False)).cast(f"array<{item}>"))
    base = F.transform("_base", lambda b: as_item(b, F.lit(1.0), True)).cast(f"array<{item}>")
    spans = F.when(F.size("_likely") > 0, F.concat(base, _chosen(F.array_sort(F.concat(base, F.col("_likely"))), item))).otherwise(base)
    sorted_spans = F.array_sort(F.transform(spans, lambda s: F.struct(s["rank"].alias("rank"), s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"), s["base"].alias("base"))))
    return out.withColumn("pii", F.transform(sorted_spans, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["base"].alias("base")))).drop("_base", "_candidates", "_likely")


def _chosen(items: Column, item: str) -> Column:
    """Those of the items by place, no base spans, that overlap neither a base span nor a likelier one next to them."""
    none = F.array().cast(f"array<{item}>")
    kind = f"struct<reach:int,held:array<{item}>,out:array<{item}>>"

    def step(a: Column, x: Column) -> Column:
        held = a["held"]
        free = (F.size(held) > 0) & (F.get(held, F.lit(0))["end"] <= x["start"])
        blocked = x["start"] < a["reach"]
        mine = F.when(x["base"], none).when(blocked, held).when((F.size(held) == 0) | free | (x["p"] > F.get(held, F.lit(0))["p"]), F.array(x)).otherwise(held)
        kept = F.when(free & (x["base"] | ~blocked), F.concat(a["out"], held)).otherwise(a["out"])
        return F.struct(F.when(x["base"], F.greatest(a["reach"], x["end"])).otherwise(a["reach"]).alias("reach"), mine.alias("held"), kept.alias("out")).cast(kind)

    whole = f"struct<reach:int,held:array<{item}>,outs:array<array<{item}>>>"
    part = lambda a, p: F.aggregate(p, F.struct(a["reach"].alias("reach"), a["held"].alias("held"), none.alias("out")).cast(kind), step)
    return F.aggregate(
        _parts(items),
        F.struct(F.lit(-1).alias("reach"), none.alias("held"), F.array().cast(f"array<array<{item}>>").alias("outs")).cast(whole),
        lambda a, p: F.aggregate(F.array(part(a, p)), a, lambda b, r: F.struct(r["reach"].alias("reach"), r["held"].alias("held"), F.concat(b["outs"], F.array(r["out"])).alias("outs")).cast(whole)),
        lambda a: F.concat(F.flatten(a["outs"]), a["held"]),
    )


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Replace the spans in ``pii`` by ``<EMAIL>``, ``<IP>``, ``<CARD>`` or ``<PHONE>``; overlapping spans become one mark.

    Null texts stay null. The column ``pii`` stays. The text is cut before every ``_PART`` spans, and the parts are marked.
    """
    text = F.col(text_col)
    ordered = F.array_sort(F.transform("pii", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    # overlapping spans: the first one's mark, up to the last end
    joined = "array<struct<start:int,end:int,kind:string>>"
    merge = lambda a, s: F.when(
        (F.size(a) > 0) & (s["start"] < F.element_at(a, -1)["end"]),
        F.concat(F.slice(a, 1, F.size(a) - 1), F.array(F.struct(F.element_at(a, -1)["start"].alias("start"), F.greatest(F.element_at(a, -1)["end"], s["end"]).alias("end"), F.element_at(a, -1)["kind"].alias("kind")))),
    ).otherwise(F.concat(a, F.array(s)))
    outer = lambda a, p: F.concat(a, F.array(F.aggregate(p, F.slice(F.element_at(a, -1), -1, 1).cast(joined), lambda b, s: merge(b, s).cast(joined)))).cast(f"array<{joined}>")
    # each part begins with the last span of the part before, which may still grow: it is dropped there
    grown = F.aggregate(_parts(F.slice(ordered, 2, F.size(ordered))), F.array(F.slice(ordered, 1, 1)).cast(f"array<{joined}>"), outer)
    parts = F.transform(grown, lambda p, k: F.when(k < F.size(grown) - 1, F.slice(p, 1, F.size(p) - 1)).otherwise(p))
    docs = docs.withColumn("_parts", F.when(F.size("pii") > 0, F.filter(parts, lambda p: F.size(p) > 0)))
    begin = lambda k: F.when(k == 0, F.lit(0)).otherwise(F.element_at(F.get(F.col("_parts"), k - 1), -1)["end"])

    def marked(p: Column, k: Column) -> Column:
        own = F.substr(text, begin(k) + 1, F.element_at(p, -1)["end"] - begin(k))
        return F.aggregate(
            F.array(own),
            F.lit(""),
            lambda _, cut: F.array_join(
                F.transform(p, lambda s, i: F.concat(F.substr(cut, F.when(i == 0, F.lit(0)).otherwise(F.get(p, i - 1)["end"] - begin(k)) + 1, s["start"] - F.when(i == 0, begin(k)).otherwise(F.get(p, i - 1)["end"])), F.lit("<"), F.upper(s["kind"]), F.lit(">"))), ""
            ),
        )

    tail = F.substr(text, F.element_at(F.element_at(F.col("_parts"), -1), -1)["end"] + 1, F.length(text))
    safe = F.concat(F.array_join(F.transform("_parts", marked), ""), tail)
    return docs.withColumn(text_col, F.when(F.size("_parts") > 0, safe).otherwise(text)).drop("_parts")


def pii_digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts and digests of base spans and the list of all spans, as text."""
    base = F.filter("pii", lambda s: s["base"])
    number = lambda kind: F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    as_text = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    return found.select(
        id_col,
        *[number(k) for k in KINDS],
        F.sha2(as_text(base), 256).alias("base_sha256"),
        as_text("pii").alias("spans"),
    )

"""Operator 11: a Merkle manifest of a table, its proofs gathered by a butterfly exchange.

Leaves are hashed where the rows are scanned; only digests move. Each group's leaves are numbered in order and dealt in
parts of ``FAN ** LOCAL`` consecutive ones. A part hashes its own subtree. Then, round by round, parts that differ in one
base-``FAN`` digit of their number swap the roots they hold, and each of them hashes the parent: after the last round every
part holds the siblings of its whole way up, so nothing has to be sent down again. Rounds over the groups' roots follow in
the same way.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stash, stash_bucketed

#: Children of a node.
FAN = 16
#: Levels that a part hashes by itself: a part has at most FAN ** LOCAL leaves.
LOCAL = 3
#: Copies of a run of groups' message, so that the parts of one large group do not all meet one row.
_LANES = 64


def leaf_digest(fields: list[Column]) -> Column:
    """Lower-case hex SHA-256 of the fields in order: ``-`` if null, else the UTF-8 byte count, ``:`` and the value."""
    texts = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256)


def proof_digest(before: Column, after: Column) -> Column:
    """SHA-256 of all siblings of a proof, level by level and left to right."""
    return F.sha2(F.array_join(F.flatten(F.zip_with(before, after, lambda b, a: F.array(b, a))), ""), 256)


def fold(leaf: Column, before: Column, after: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(F.arrays_zip(before.alias("b"), after.alias("a")), leaf, lambda node, level: F.sha2(F.concat(level["b"], node, level["a"]), 256))


def merkle_manifest(
    rows: DataFrame, group: str = "source", order: str = "doc_id", fields: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"), claimed: dict[str, Column] | None = None, local: int = LOCAL
) -> DataFrame:
    """One row for each row of ``rows``: ``order`` and ``group`` as they are, and what proves the row.

    Adds ``position`` (in its group, from 0), ``leaf``, ``claimed_leaf`` (the digest with the columns of ``claimed`` in
    place of the row's own; ``leaf`` where it names none), ``subroot``, ``root``, and the proof ``before`` and ``after``:
    for each level the siblings to the left and to the right, as concatenated digests.

    In a group leaves ascend by ``order``, nulls first; equal ones by digest, so repeated rows give the same root in any
    order. While a group has several nodes, every 16 consecutive ones become the digest of their concatenation; the last
    run may have fewer, even one. Subroots in UTF-8 order of ``group``, the null group first, give the root likewise; one
    group's subroot is the root. A null in a hashed field counts as such. An empty table gives no row. Other columns of
    ``rows`` are neither read nor returned, so they can bear any name.
    """
    spark = rows.sparkSession
    own = leaf_digest([F.col(f) for f in fields])
    other = leaf_digest([claimed.get(f, F.col(f)) for f in fields]) if claimed else F.lit(None).cast("string")
    # a null group sorts first, and "=" before a name keeps the order of names
    key = F.when(F.col(group).isNull(), "").otherwise(F.concat(F.lit("="), F.col(group).cast("string")))
    leaves = stash(rows.select(F.col(order).alias("o"), F.col(group).alias("g"), key.alias("key"), own.alias("leaf"), other.alias("other"), F.monotonically_increasing_id().alias("tie")), "leaves")
    placed, groups = _placed(leaves, FAN**local)
    parts = stash_bucketed(placed.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "part"), "parts", "part")
    tops = _exchange(parts.groupBy("part").applyInArrow(lambda t: _root(t, local), "part long, n_leaves long, node string"), groups, FAN**local)
    digests = [F.col("leaf").alias(c) for c in ("leaf", "claimed_leaf", "subroot", "root")]
    schema = parts.select("o", "g", F.col("at").alias("position"), *digests, *[F.array("leaf").alias(c) for c in ("before", "after")]).schema
    proofs = parts.groupBy("part").cogroup(tops.groupBy("part")).applyInArrow(lambda t, top: _proofs(t, top, local), schema)
    return proofs.withColumnsRenamed({"o": order, "g": group})


def _placed(leaves: DataFrame, size: int) -> tuple[DataFrame, int]:
    """Leaves with the part they are in, their place in the group and its number of leaves; and the number of groups.

    Ranges of the total order are counted by group, and a leaf's place is its place in the range plus the counts of the
    ranges before: no group is sorted in one task. Per range and group there is one count, per range one row that all meet.
    """
    by = ["key", "o", "leaf", "tie"]
    ranges = stash(leaves.repartitionByRange(*by).withColumn("range", F.spark_partition_id()), "ranges")
    counts = stash(ranges.groupBy("range", "key").agg(F.count("*").alias("n")), "counts")
    earlier = Window.partitionBy("key").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumn("start", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    # groups are numbered in the same way: those that begin in a range, after all that begin before it
    groups = counts.groupBy("key").agg(F.min("range").alias("first"), F.sum("n").alias("n_leaves")).withColumn("nth", F.row_number().over(Window.partitionBy("first").orderBy("key")))
    begun = groups.groupBy("first").agg(F.count("*").alias("k"))
    begun = begun.withColumn("ahead", F.coalesce(F.sum("k").over(Window.orderBy("first").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    numbered = stash(groups.join(begun, "first").select("key", "n_leaves", (F.col("ahead") + F.col("nth") - 1).alias("group_no")), "groups")
    told = starts.join(numbered, "key").select("range", "key", "start", "n_leaves", "group_no")
    nth = F.row_number().over(Window.partitionBy("range", "key").orderBy(*by[1:]))
    at = F.col("start") + F.col("nth") - 1
    out = ranges.withColumn("nth", nth).join(told, ["range", "key"]).withColumn("at", at)
    part = F.shiftleft(F.col("group_no"), 32) + F.floor(F.col("at") / size)
    return out.select(part.alias("part"), "at", "n_leaves", "o", "g", "leaf", "other"), numbered.count()


def _exchange(roots: DataFrame, groups: int, size: int) -> DataFrame:
    """``(part, subroot, root, before, after)``: what every part holds after the rounds."""
    blocks = F.ceil(F.col("n_leaves") / size).cast("long")
    none = F.array().cast("array<string>")
    state = roots.select("part", F.shiftright("part", 32).alias("group_no"), F.col("part").bitwiseAND(2**32 - 1).alias("block"), blocks.alias("blocks"), "node", none.alias("before"), none.alias("after"))
    state = stash(state, "roots")
    widest = state.agg(F.max("blocks")).first()[0] or 0
    width = 1
    while width < widest:
        state = _swap_blocks(state, width)
        width *= FAN
    state = state.withColumn("subroot", F.col("node"))
    width = 1
    while width < groups:
        state = _swap_groups(stash(state, "round"), width)
        width *= FAN
    return state.select("part", "subroot", F.col("node").alias("root"), "before", "after")


def _joined(met: Column, keep: Column | None = None) -> Column:
    return F.array_join(F.transform(met if keep is None else F.filter(met, lambda m: keep(m)), lambda m: m["node"]), "")


def _climbed(state: DataFrame, met: Column, digit: Column, swaps: Column) -> DataFrame:
    """Where ``swaps``: add the siblings among the nodes ``met`` to the proof and become their parent."""
    state = state.withColumn("met", met).withColumn("digit", digit)
    left = _joined(F.col("met"), lambda m: m["digit"] < F.col("digit"))
    right = _joined(F.col("met"), lambda m: m["digit"] > F.col("digit"))
    return state.withColumns(
        {
            "before": F.when(swaps, F.concat("before", F.array(left))).otherwise(F.col("before")),
            "after": F.when(swaps, F.concat("after", F.array(right))).otherwise(F.col("after")),
            "node": F.when(swaps, F.sha2(_joined(F.col("met")), 256)).otherwise(F.col("node")),
        }
    ).drop("met", "digit")


def _swap_blocks(state: DataFrame, width: int) -> DataFrame:
    """A round inside the groups: parts that differ only in one digit of their number swap nodes of ``width`` parts each.

    A swap has at most 16 members. The last node of a group may have fewer parts than its siblings: each of its parts
    then stands in for further ones, evenly.
    """
    block, low = F.col("block"), F.col("block") % width
    digit = F.floor(block / width).cast("long") % FAN
    there = F.least(F.lit(width).cast("long"), F.col("blocks") - (block - low))
    lanes = F.when((digit > 0) & (there < width), F.sequence(low, F.lit(width - 1).cast("long"), there)).otherwise(F.array(low))
    sent = state.withColumn("lane", F.explode(lanes)).withColumn("run", F.floor(block / (width * FAN)))
    met = F.sort_array(F.collect_list(F.struct(digit.alias("digit"), "node")).over(Window.partitionBy("group_no", "run", "lane")))
    met_once = sent.withColumn("met_", met).where(F.col("lane") == low)
    return _climbed(met_once, F.col("met_"), digit, F.col("blocks") > width).select(*state.columns)


def _swap_groups(state: DataFrame, width: int) -> DataFrame:
    """A round over groups: the first group of each run of ``width`` groups tells the run's node to all parts of its 16 runs.

    It does so on 64 lanes and a part listens on one of them, so a large group's parts do not meet one row.
    """
    digit = F.floor(F.col("group_no") / width).cast("long") % FAN
    run = F.floor(F.col("group_no") / (width * FAN)).alias("run")
    tellers = state.where((F.col("group_no") % width == 0) & (F.col("block") < _LANES))
    lanes = F.sequence("block", F.lit(_LANES - 1).cast("long"), F.least("blocks", F.lit(_LANES).cast("long")))
    told = tellers.select(run, digit.alias("digit"), "node", F.explode(lanes).alias("lane"))
    told = told.groupBy("run", "lane").agg(F.sort_array(F.collect_list(F.struct("digit", "node"))).alias("met_"))
    heard = state.withColumn("run", run).withColumn("lane", F.col("block") % _LANES).join(told, ["run", "lane"])
    return _climbed(heard, F.col("met_"), digit, F.lit(True)).select(*state.columns)


def _levels(leaves: list[str], in_group: int, local: int) -> list[list[str]]:
    """The nodes of a part by level, from the leaves up: as long as the whole group has several nodes on a level."""
    levels = [leaves]
    while len(levels) <= local and in_group > 1:
        nodes = levels[-1]
        levels.append([sha256("".join(nodes[k : k + FAN]).encode()).hexdigest() for k in range(0, len(nodes), FAN)])
        in_group = -(-in_group // FAN)
    return levels


def _root(part: pa.Table, local: int) -> pa.Table:
    part = part.sort_by("at")
    n = part["n_leaves"][0].as_py()
    node = _levels(part["leaf"].to_pylist(), n, local)[-1][0]
    return pa.table({"part": part["part"][:1], "n_leaves": part["n_leaves"][:1], "node": pa.chunked_array([[node]], pa.string())})


def _siblings(levels: list[list[str]]) -> Iterator[tuple[list[str], list[str]]]:
    """For each leaf the siblings to the left and to the right on each level inside the part."""
    for k in range(len(levels[0])):
        before, after = [], []
        for nodes in levels[:-1]:
            first = k - k % FAN
            before.append("".join(nodes[first:k]))
            after.append("".join(nodes[k + 1 : first + FAN]))
            k //= FAN
        yield before, after


def _proofs(part: pa.Table, top: pa.Table, local: int) -> pa.Table:
    part = part.sort_by("at")
    levels = _levels(part["leaf"].to_pylist(), part["n_leaves"][0].as_py(), local)
    above_before, above_after = top["before"][0].as_py(), top["after"][0].as_py()
    before, after = zip(*((b + above_before, a + above_after) for b, a in _siblings(levels)), strict=True)
    same = [top[c][0].as_py() for c in ("subroot", "root")]
    strings = pa.list_(pa.string())
    return pa.table(
        {
            "o": part["o"], "g": part["g"], "position": part["at"], "leaf": part["leaf"],
            "claimed_leaf": pa.array([b or a for a, b in zip(part["leaf"].to_pylist(), part["other"].to_pylist(), strict=True)], pa.string()),
            "subroot": pa.array([same[0]] * len(part), pa.string()), "root": pa.array([same[1]] * len(part), pa.string()),
            "before": pa.array(before, strings), "after": pa.array(after, strings),
        }
    )

"""Connected components of pairs, for merges that must equal a sequence of single ones."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_own: dict[str, str] = {}
#: A label's root is given to so many groups of its nodes: the nodes of one component do not meet in one task.
_SALTS = 16
#: Pairs that a task holds before it thins them.
_HELD = 500_000


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share: ``spark.checkpoint.dir`` of the session.

    Where the session names none, a local master gets a fresh local folder, one per application; a cluster is refused,
    since its executors do not share local folders.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own:
        _own[app] = tempfile.mkdtemp(prefix="footlights-")
    return _own[app]


def own_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def gone_at_end(spark: SparkSession, path: str) -> None:
    """Have a written path deleted when the application ends."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(target)


def cut_lineage(df: DataFrame, name: str = "step") -> DataFrame:
    """Write a frame to the shared folder and read it again: a lost executor never recomputes what came before."""
    spark = df.sparkSession
    path = own_path(spark, name)
    df.write.parquet(path)
    gone_at_end(spark, path)
    return spark.read.schema(df.schema).parquet(path)


def thinner(most: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """What thins pairs ``(x, y)`` in a task; a closure, so that workers need not import this module."""

    def components(x: pd.Series, y: pd.Series) -> pd.DataFrame:
        """Each node that is not its component's root, with that root; a node alone with itself."""
        codes, names = pd.factorize(pd.concat([x, y], ignore_index=True))
        root = np.arange(len(names))
        a, b = codes[: len(x)], codes[len(x) :]
        while len(a):
            low, high = np.minimum(a, b), np.maximum(a, b)
            np.minimum.at(root, high, low)
            while (root[root] != root).any():
                root = root[root]
            a, b = root[a], root[b]
            open_ = a != b
            a, b = a[open_], b[open_]
        # a node that is only paired with itself stays so
        single = np.bincount(root, minlength=len(names)) == 1
        late = np.flatnonzero((root != np.arange(len(names))) | single)
        return pd.DataFrame({"x": names[late], "y": names[root[late]]})

    def forest(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Of a task's pairs as few as keep the same nodes together; a task holds at most some ``most`` pairs."""
        held, n = [], 0
        for frame in frames:
            held.append(frame)
            n += len(frame)
            if n >= most:
                all_ = pd.concat(held, ignore_index=True)
                few = components(all_["x"], all_["y"])
                if 2 * len(few) > most:  # nodes that do not shrink any more
                    yield few
                    few = few.iloc[:0]
                held, n = [few], len(few)
        if held:
            all_ = pd.concat(held, ignore_index=True)
            yield components(all_["x"], all_["y"])

    return forest


def cluster(pairs: DataFrame, a: str = "a_id", b: str = "b_id") -> DataFrame:
    """``(id, cluster_id)`` for every id in ``pairs``; ``cluster_id`` is the least id reached over pairs.

    Each round a node takes the least label among its neighbours and then that label's own label, so the rounds grow
    with the logarithm of the longest chain. Null ends are ignored. The driver sees one flag a round. Pairs within a group
    come out of a join together, so each task first leaves but a tree of them: rounds go over nodes rather than pairs.
    """
    x = pairs.select(F.col(a).alias("x"), F.col(b).alias("y")).where("x is not null and y is not null")
    few = x.mapInPandas(thinner(_HELD), x.schema)
    both = few.select(F.explode(F.array(F.struct("x", "y"), F.struct(F.col("y").alias("x"), F.col("x").alias("y")))).alias("e")).select("e.*")
    edges = cut_lineage(both.distinct(), "pairs")
    labels = cut_lineage(edges.groupBy(F.col("x").alias("id")).agg(F.min("y").alias("m")).select("id", F.least("id", "m").alias("label")), "labels")
    while True:
        seen = edges.join(labels.withColumnsRenamed({"id": "y"}), "y").groupBy(F.col("x").alias("id")).agg(F.min("label").alias("near"))
        step = labels.join(seen, "id").select("id", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        step = cut_lineage(step.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(_SALTS)).cast("int")), "steps")
        used = step.select(F.col("label").alias("id")).distinct()
        roots = step.select("id", F.col("label").alias("root")).join(used, "id").select(F.col("id").alias("label"), "root", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))).alias("salt"))
        step = step.join(roots, ["label", "salt"], "left").select("id", "old", F.least("label", F.coalesce("root", "label")).alias("label"))
        step = cut_lineage(step, "labels")
        labels = step.select("id", "label")
        if step.where("old <> label").isEmpty():
            return labels.select("id", F.col("label").alias("cluster_id"))

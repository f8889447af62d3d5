"""Scratch space, checkpoints and connected components shared by the operators of this subpackage."""

from __future__ import annotations

import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def scratch_root(spark: SparkSession) -> str:
    """The folder that driver and executors share, named by ``spark.checkpoint.dir``.

    Where the setting is absent and Spark runs in one process (tests), a temporary folder is used.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="scorelane-")
        spark.conf.set("spark.checkpoint.dir", root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """Materialise df in the shared folder and cut its lineage."""
    scratch_root(df.sparkSession)
    return df.checkpoint(eager=True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def drawn(of: Column, most: int, n: int) -> Column:
    """Whether a row is in the sample of about ``most`` of n rows that its 64-bit hash draws."""
    if n <= most:
        return F.lit(True)
    return of < F.lit(most * 2**64 // n - 2**63)


#: A key is hot if it holds more than one in HOT_SHARE rows, or than HOT_ROWS where that is less, but never one in less than
#: one in MOST_HOT: there are fewer hot keys than MOST_HOT, whatever the data.
HOT_SHARE, HOT_ROWS, MOST_HOT = 1_000, 1_000_000, 100_000


def hot_join(left: DataFrame, right: DataFrame, key: str, many: str = "many", how: str = "inner") -> DataFrame:
    """left joined (inner or left) with the row of right that has its key; hot keys do not meet in one task.

    ``right`` has one row a key, with the number of left's rows of that key in the column ``many``, which is left
    out of the result. Few keys can each hold more rows than the limit (see HOT_SHARE), so these are broadcast; the others
    are joined by shuffle. Both sides are read twice: pass tables or checkpoints.
    """
    total = right.agg(F.sum(many)).first()[0] or 0
    limit = min(total // HOT_SHARE, max(HOT_ROWS, total // MOST_HOT))
    hot = right.where(F.col(many) > limit).drop(many)
    rest = left.join(F.broadcast(hot.select(key)), key, "left_anti")
    return left.join(F.broadcast(hot), key).unionByName(rest.join(right.where(F.col(many) <= limit).drop(many), key, how))


def spanning_star(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node of its component) for the edges u-v, without the roots themselves."""
    nodes, flat = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = flat[: len(u)], flat[len(u) :]
    label = np.arange(len(nodes))
    while True:
        la, lb = label[a], label[b]
        if (la == lb).all():
            break
        low = np.minimum(la, lb)
        np.minimum.at(label, la, low)
        np.minimum.at(label, lb, low)
        while True:
            up = label[label]
            if (up == label).all():
                break
            label = up
    own = label != np.arange(len(nodes))
    return nodes[own], nodes[label[own]]


def whole_buckets(batches, limit: int, rows_at_once: int = 50_000):
    """(rows, large) from batches sorted by the column key: rows of whole buckets of up to ``limit`` rows, or, with large
    true, some rows of larger buckets. No more than about rows_at_once rows are held."""

    def parted(rows: pa.Table):
        key = rows.column("key").to_numpy()
        bounds = np.concatenate([[0], np.flatnonzero(np.diff(key)) + 1, [len(key)]])
        large = np.repeat(np.diff(bounds), np.diff(bounds)) > limit
        for kind in (False, True):
            part = rows.filter(pa.array(large == kind))
            if part.num_rows:
                yield part.combine_chunks(), kind

    held, many, passed = [], 0, None
    for batch in batches:
        if passed is not None:  # the rest of a bucket that was too large already
            same = int(np.searchsorted(batch.column("key").to_numpy(), passed, "right"))
            if same:
                yield pa.Table.from_batches([batch.slice(0, same)]), True
            batch = batch.slice(same)
            if not batch.num_rows:
                continue
            passed = None
        held.append(batch)
        many += batch.num_rows
        if many < rows_at_once:
            continue
        rows = pa.Table.from_batches(held).combine_chunks()
        key = rows.column("key").to_numpy()
        cut = int(np.searchsorted(key, key[-1], "left"))
        if len(key) - cut > limit:
            passed, cut = key[-1], len(key)
        if cut:
            yield from parted(rows.slice(0, cut))
        held = rows.slice(cut).to_batches()
        many = sum(b.num_rows for b in held)
    if held:
        yield from parted(pa.Table.from_batches(held).combine_chunks())


def block_pairs(rows: DataFrame, many: int) -> DataFrame:
    """rows (key, node, ...) of large buckets, once for each pair of blocks of about ``many`` rows, with bi, bj and side.

    Each block meets each other one and itself; ``side`` tells the two apart (0 for both where bi = bj).
    """
    sizes = checkpointed(rows.groupBy("key").agg(F.count("*").alias("many")).withColumn("blocks", F.ceil(F.col("many") / many)))
    wide = hot_join(rows, sizes, "key").withColumn("own", F.pmod(F.xxhash64("node"), "blocks"))
    wide = wide.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    side = F.when(F.col("own") <= F.col("other"), 0).otherwise(1)
    wide = wide.withColumns({"bi": F.least("own", "other"), "bj": F.greatest("own", "other"), "side": side})
    return wide.drop("blocks", "own", "other")


def _contract(batches):
    """Replace the edges of each partition, in portions, by a star per component: never more rows than it got."""
    u, v = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for batch in batches:
        u, v = np.concatenate([u, batch.column("u").to_numpy()]), np.concatenate([v, batch.column("v").to_numpy()])
        if len(u) > 2 * EDGES_A_TASK:
            u, v = spanning_star(u, v)
            if len(u) > EDGES_A_TASK:
                yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])
                u, v = u[:0], v[:0]
    u, v = spanning_star(u, v)
    yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])


#: Edges that a task of connected_components takes; fewer tasks than LEAST_TASKS are never used.
EDGES_A_TASK, LEAST_TASKS = 200_000, 16


def connected_components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """Rows (node, component): the smallest node reachable, for each node with an edge to another.

    ``edges`` has long columns u and v; direction, repeats, loops and nulls do not matter. Alternates
    large-star and small-star steps, and stars within each partition, on an edge table in the shared folder until it no
    longer changes, so neither edges nor labels ever meet in one place.
    """

    def tasks(rows: int) -> int:
        return max(LEAST_TASKS, -(-2 * rows // EDGES_A_TASK))

    def kept_small(df: DataFrame, rows: int) -> DataFrame:
        return checkpointed(df.coalesce(tasks(rows)))

    def kept(e: DataFrame):
        """The edges as stars within each partition, materialised, and what tells two sets of edges apart."""
        e = checkpointed(e.mapInArrow(_contract, "u long, v long"))
        return e, e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    e, seen = kept(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")))
    for _ in range(rounds):
        if not seen[0]:
            break
        # large star: what points at v points at the smallest neighbour of v; the root of a large star is a hot key
        low = e.groupBy(F.col("u").alias("v")).agg(F.min("v").alias("m"))
        ends = e.groupBy("v").agg(F.count("*").alias("many")).join(low, "v", "left").select("v", F.coalesce("m", "v").alias("m"), "many")
        large = hot_join(e, kept_small(ends, seen[0]), "v").select("u", F.col("m").alias("v"))
        # small star: so do all neighbours of u
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        step = large.join(low, "u")
        small = step.select("u", F.col("m").alias("v")).unionByName(step.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")))
        e, now = kept(small.coalesce(tasks(seen[0])))
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)

"""Embedding near-dedup by randomised-rotation binary codes.

Unit vectors are rotated at random. Stored once for each vector are the signs (the code), the code's inner product with
the rotated vector (the correction factor), and the rotated vector itself in sixteen levels, rounded by a fixed dither.
For a pair, <code, levels of the other> / factor estimates the cosine without bias, in counts of common bits; the factor
gives a confidence bound. Sign bits of further rotations are the keys of hash tables that bring pairs together; their
number is set so that a pair at the threshold meets in some table with probability RECALL. Tables hold codes alone: only
vectors of a pair whose upper bound reaches the threshold are fetched, and computed exactly, in double precision.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import block_pairs, checkpointed, connected_components, hot_join, spanning_star, whole_buckets

THRESHOLD = 0.95
RECALL = 0.995
#: Standard errors of the estimate within which a pair is computed exactly.
EPSILON = 4.0
#: Tables' buckets of more vectors than this are compared in pairs of blocks, each a task of its own.
BUCKET_LIMIT = 2_048
BLOCK = 1_024
#: Bits of each rotated component.
LEVEL_BITS = 4
SEED = 20_240_601


def rotation(dim: int, number: int, seed: int = SEED) -> np.ndarray:
    """A random orthogonal matrix, the same on every machine."""
    q, r = np.linalg.qr(np.random.default_rng([seed, dim, number]).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def tables_for(n: int, threshold: float = THRESHOLD, recall: float = RECALL) -> tuple[int, int]:
    """(bits, tables): keys long enough for some hundred unlike vectors a bucket, tables enough for the recall."""
    bits = min(40, max(8, math.ceil(math.log2(max(n, 2))) - 7))
    same = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, math.ceil(math.log(1 - recall) / math.log(1 - same))


def _unit(blobs: list[bytes]) -> np.ndarray:
    v = np.frombuffer(b"".join(blobs), "<f8").reshape(len(blobs), -1)
    with np.errstate(over="ignore"):
        v = v / np.abs(v).max(1, keepdims=True)  # no overflow or underflow in the squares
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def _words(bits: np.ndarray) -> np.ndarray:
    """Rows of bits as 64-bit words."""
    packed = np.packbits(bits, axis=1, bitorder="little")
    return np.pad(packed, ((0, 0), (0, -packed.shape[1] % 8))).view("<u8")


class Rotations:
    """Codes, factors, levels and keys for one dimension, by rotations made in each worker from the seed."""

    def __init__(self, dim: int, bits: int, tables: int):
        self.dim, self.bits, self.tables = dim, bits, tables
        need = bits * tables
        planes = np.concatenate([rotation(dim, 1 + k) for k in range(-(-need // dim))])[:need]
        rng = np.random.default_rng([SEED, dim, bits, tables])
        self.planes = planes[rng.permutation(need)]
        self.first, self.dither = rotation(dim, 0), rng.random(dim)

    def sketches(self, unit: np.ndarray) -> list[bytes]:
        """Code, levels by bits, then factor, lowest level and step as doubles."""
        turned = unit @ self.first.T
        low = turned.min(1)
        step = np.maximum(turned.max(1) - low, 1e-300) / (2**LEVEL_BITS - 1)
        levels = np.floor((turned - low[:, None]) / step[:, None] + self.dither).clip(0, 2**LEVEL_BITS - 1).astype(np.uint8)
        words = [_words(turned > 0), *(_words(levels >> j & 1) for j in range(LEVEL_BITS))]
        numbers = np.stack([np.abs(turned).sum(1) / math.sqrt(self.dim), low, step], axis=1)
        return [w.tobytes() + x.tobytes() for w, x in zip(np.concatenate(words, axis=1), numbers.astype("<f8"), strict=True)]

    def keys(self, unit: np.ndarray) -> list[bytes]:
        """The bits of all keys, packed."""
        return [row.tobytes() for row in np.packbits(unit @ self.planes.T > 0, axis=1)]


def _packed(batches):
    """(id, vec): components as little-endian doubles; null for what links with nothing."""
    for batch in batches:
        blobs = []
        for v in batch.column(1).to_pylist():
            if not v or any(x is None for x in v):
                blobs.append(None)
                continue
            a = np.asarray(v, "<f8") + 0.0  # -0.0 is 0.0
            blobs.append(a.tobytes() if np.isfinite(a).all() and a.any() else None)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(blobs, pa.binary())], names=["id", "vec"])


def _sketched(bits: int, tables: int):
    """(node, dim, sketch, keys) of rows (node, vec)."""

    def run(batches):
        made: dict[int, Rotations] = {}
        for batch in batches:
            nodes, blobs = batch.column(0).to_numpy(), batch.column(1).to_pylist()
            sizes = np.fromiter(map(len, blobs), np.int64, len(blobs)) // 8
            for dim in np.unique(sizes).tolist():
                turn = made.setdefault(dim, Rotations(dim, bits, tables))
                unit = _unit([blobs[k] for k in np.flatnonzero(sizes == dim)])
                arrays = [pa.array(nodes[sizes == dim]), pa.array([dim] * len(unit), pa.int32()), pa.array(turn.sketches(unit), pa.binary()), pa.array(turn.keys(unit), pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, names=["node", "dim", "sketch", "keys"])

    return run


def _key_bits(keys: list[bytes], bits: int, tables: int) -> np.ndarray:
    packed = np.frombuffer(b"".join(keys), np.uint8).reshape(len(keys), -1)
    return np.unpackbits(packed, axis=1)[:, : bits * tables].reshape(len(keys), tables, bits)


def _dealt(bits: int, tables: int):
    """One row a table for each vector: key, node, dim, sketch, keys."""
    weights = np.int64(1) << np.arange(bits, dtype=np.int64)

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            own = _key_bits(batch.column("keys").to_pylist(), bits, tables) @ weights
            head = batch.column("dim").to_numpy().astype(np.int64) % 4096 << np.int64(40)
            for t in range(tables):
                key = own[:, t] | head | np.int64(t) << np.int64(52)
                yield pa.RecordBatch.from_arrays([pa.array(key), *batch.columns], names=["key", *batch.schema.names])

    return run


class Sketches:
    """Sketches of one dimension, taken apart."""

    def __init__(self, blobs: list[bytes], dim: int):
        self.dim, words = dim, -(-dim // 64)
        raw = np.frombuffer(b"".join(blobs), np.uint8).reshape(len(blobs), -1)
        whole = np.ascontiguousarray(raw[:, : 8 * words * (1 + LEVEL_BITS)]).view("<u8")
        self.code, levels = whole[:, :words], whole[:, words:].reshape(len(raw), LEVEL_BITS, words)
        self.factor, self.low, self.step = np.ascontiguousarray(raw[:, -24:]).view("<f8").T
        self.levels, self.ones = levels, np.bitwise_count(self.code).sum(1, dtype=np.int64)
        weights = 1 << np.arange(LEVEL_BITS)
        self.sum = self.low * dim + self.step * (np.bitwise_count(levels).sum(2, dtype=np.int64) @ weights)
        self.error = np.sqrt(np.maximum(0, 1 - self.factor**2) / max(dim - 1, 1)) / self.factor

    def estimates(self, a: np.ndarray, other: Sketches, b: np.ndarray) -> np.ndarray:
        """Of the cosines of the vectors a with b of the other: half the bits of common levels, twice, less their sum."""
        common = np.zeros(len(a), np.int64)
        for j in range(LEVEL_BITS):
            common += np.bitwise_count(self.code[a] & other.levels[b, j]).sum(1, dtype=np.int64) << j
        inner = 2 * (other.low[b] * self.ones[a] + other.step[b] * common) - other.sum[b]
        return inner / math.sqrt(self.dim) / self.factor[a]

    def maybe(self, a: np.ndarray, other: Sketches, b: np.ndarray, threshold: float) -> np.ndarray:
        """Places of the pairs whose upper bound reaches the threshold; of few dimensions, all."""
        if self.dim < 16:
            return np.arange(len(a))
        # at the threshold the code's error applies to what is at right angles; rounding adds half a step at most
        error = np.hypot(self.error[a] * math.sqrt(1 - threshold * threshold), other.step[b] / 2 / self.factor[a])
        return np.flatnonzero(self.estimates(a, other, b) + EPSILON * error >= threshold)


def _first_table(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The first table in which pairs of vectors meet, by their key bits."""
    return (x == y).all(2).argmax(1)


def _pairs(key: np.ndarray, side: np.ndarray | None = None):
    """Places (a, b) of the pairs within each run of equal keys, in portions; with sides, pairs of one side are left out
    but for side -1."""
    active, d = np.arange(len(key)), 1
    while len(active := active[active + d < len(key)]) and len(active := active[key[active] == key[active + d]]):
        for lo in range(0, len(active), 50_000):
            a = active[lo : lo + 50_000]
            if side is not None:
                a = a[(side[a] < 0) | (side[a] != side[a + d])]
            if len(a):
                yield a, a + d
        d += 1


def _near(rows: pa.Table, pairs, bits: int, tables: int, threshold: float) -> np.ndarray:
    """Which rows are of a pair that meets here first and whose bound reaches the threshold."""
    key, dims = rows.column("key").to_numpy(), rows.column("dim").to_numpy()
    sketch, keys = rows.column("sketch").to_pylist(), rows.column("keys").to_pylist()
    marked = np.zeros(len(key), bool)
    for dim in np.unique(dims).tolist():
        at = np.flatnonzero(dims == dim)
        own, own_bits = Sketches([sketch[k] for k in at], dim), _key_bits([keys[k] for k in at], bits, tables)
        table = key[at] >> 52
        for a, b in pairs(at):
            near = own.maybe(a, own, b, threshold)
            near = near[_first_table(own_bits[a[near]], own_bits[b[near]]) == table[a[near]]]
            marked[at[a[near]]] = marked[at[b[near]]] = True
    return marked


_MET = "node long, part long, side int, key long"


def _met(node, part, side, key) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(node), part, pa.array(side, pa.int32()), pa.array(key)], names=["node", "part", "side", "key"])


def _near_runs(bits: int, tables: int, threshold: float, limit: int):
    """Of rows sorted by key, the vectors to be fetched for each bucket (part); part is null for rows of large buckets."""

    def run(batches):
        for rows, large in whole_buckets(batches, limit, 20_000):
            key, node = rows.column("key").to_numpy(), rows.column("node").to_numpy()
            if large:
                yield _met(node, pa.nulls(len(node), pa.int64()), np.zeros(len(node)), key)
                continue
            marked = _near(rows, lambda at, key=key: _pairs(key[at]), bits, tables, threshold)
            yield _met(node[marked], pa.array(key[marked]), np.full(marked.sum(), -1), key[marked])

    return run


def _near_blocks(bits: int, tables: int, threshold: float):
    """The vectors to be fetched for a pair of blocks of a large bucket; their part is named by the blocks, below zero."""

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks()
        key, node, side = (rows.column(c).to_numpy() for c in ("key", "node", "side"))
        within = rows.column("bi")[0].as_py() == rows.column("bj")[0].as_py()

        def pairs(at):
            x = np.arange(len(at)) if within else np.flatnonzero(side[at] == 0)
            y = x if within else np.flatnonzero(side[at] == 1)
            for lo in range(0, len(x), 64):
                i, j = (z.ravel() for z in np.meshgrid(x[lo : lo + 64], y, indexing="ij"))
                keep = i < j if within else slice(None)
                yield i[keep], j[keep]

        marked = _near(rows, pairs, bits, tables, threshold)
        name = np.int64(rows.column("part")[0].as_py())
        return pa.Table.from_batches([_met(node[marked], pa.array(np.full(marked.sum(), name)), np.full(marked.sum(), -1) if within else side[marked], key[marked])])

    return run


class _Found:
    """Links found in a batch: weights per node, and edges as stars."""

    def __init__(self):
        self.node, self.gain, self.u, self.v, self.exact = [], [], [], [], 0

    def add(self, node, weight, a, b):
        self.node += [node[a], node[b]]
        self.gain += [weight[b], weight[a]]
        self.u.append(node[a])
        self.v.append(node[b])
        if sum(map(len, self.u)) > 500_000:
            self._shrink()

    def _shrink(self):
        u, v = spanning_star(np.concatenate(self.u), np.concatenate(self.v))
        node, at = np.unique(np.concatenate(self.node), return_inverse=True)
        gain = np.zeros(len(node), np.int64)
        np.add.at(gain, at, np.concatenate(self.gain))
        self.node, self.gain, self.u, self.v = [node], [gain], [u], [v]

    def batch(self):
        """Rows (u, v, gain): edges with gain 0, gains with a null v, and the number of exact computations with a null u."""
        u = v = node = gain = np.zeros(0, np.int64)
        if self.node:
            self._shrink()
            u, v, node, gain = self.u[0], self.v[0], self.node[0], self.gain[0]
        no_u, no_v = np.zeros(len(u) + len(node) + 1, bool), np.ones(len(u) + len(node) + 1, bool)
        no_u[-1], no_v[: len(u)] = True, False
        arrays = [np.concatenate([u, node, [0]]), np.concatenate([v, node, [0]]), np.concatenate([u * 0, gain, [self.exact]])]
        columns = [pa.array(arrays[0], mask=no_u), pa.array(arrays[1], mask=no_v), pa.array(arrays[2])]
        return pa.RecordBatch.from_arrays(columns, names=["u", "v", "gain"])


def _linked(bits: int, tables: int, threshold: float):
    """Of rows sorted by part with vectors and sketches, the links."""

    def run(batches):
        renamed = (b.rename_columns(["table" if n == "key" else "key" if n == "part" else n for n in b.schema.names]) for b in batches)
        for rows, _ in whole_buckets(renamed, 1 << 62, 5_000):
            part, table, node, weight, dims, side = (rows.column(c).to_numpy() for c in ("key", "table", "node", "weight", "dim", "side"))
            vec, sketch, keys = (rows.column(c).to_pylist() for c in ("vec", "sketch", "keys"))
            found = _Found()
            for dim in np.unique(dims).tolist():
                at = np.flatnonzero(dims == dim)
                own, unit = Sketches([sketch[k] for k in at], dim), _unit([vec[k] for k in at])
                own_bits = _key_bits([keys[k] for k in at], bits, tables)
                for a, b in _pairs(part[at], side[at]):
                    near = own.maybe(a, own, b, threshold)
                    near = near[_first_table(own_bits[a[near]], own_bits[b[near]]) == table[at[a[near]]] >> 52]
                    a, b = a[near], b[near]
                    found.exact += len(a)
                    good = np.einsum("ij,ij->i", unit[a], unit[b]) >= threshold
                    if good.any():
                        found.add(node[at], weight[at], a[good], b[good])
            yield found.batch()

    return run


def links(nodes: DataFrame, threshold: float = THRESHOLD, limit: int = BUCKET_LIMIT) -> DataFrame:
    """Rows (u, v, gain) for rows (node, weight, vec) of distinct vectors: see ``_Found.batch``."""
    bits, tables = tables_for(nodes.count(), threshold)
    sketches = checkpointed(nodes.select("node", "vec").mapInArrow(_sketched(bits, tables), "node long, dim int, sketch binary, keys binary"))
    keyed = sketches.mapInArrow(_dealt(bits, tables), "key long, node long, dim int, sketch binary, keys binary")
    met = checkpointed(keyed.repartition("key").sortWithinPartitions("key").mapInArrow(_near_runs(bits, tables, threshold, limit), _MET))
    large = checkpointed(met.where("part is null").select("key", "node"))
    met = met.where("part is not null")
    if not large.isEmpty():
        wide = block_pairs(large, min(BLOCK, max(1, limit // 2))).withColumn("part", F.xxhash64("key", "bi", "bj").bitwiseOR(F.lit(-(2**63))))
        wide = wide.join(sketches, "node").select("key", "bi", "bj", "side", "part", "node", "dim", "sketch", "keys")
        met = met.unionByName(wide.groupBy("key", "bi", "bj").applyInArrow(_near_blocks(bits, tables, threshold), _MET))
    whole = nodes.select("node", "weight", "vec").join(sketches, "node")
    fetched = met.join(whole, "node").select("part", "key", "side", "node", "weight", "dim", "vec", "sketch", "keys")
    return checkpointed(fetched.repartition("part").sortWithinPartitions("part").mapInArrow(_linked(bits, tables, threshold), "u long, v long, gain long"))


def embedding_dedup(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", threshold: float = THRESHOLD, limit: int = BUCKET_LIMIT) -> DataFrame:
    """One row per row of vectors: id_col, n_links, component_id, kept.

    Vectors that are null, empty or zero, or hold null or non-finite components, link with nothing; vectors of
    unlike dimension do not link. Equal vectors are one node with a weight, so copies are never paired up one by
    one. Rows that repeat an id count as vectors of their own. A row with a null id links like others, and never
    names a component unless that has no other id. A pair links at a cosine of exactly ``threshold``, worked out in doubles
    from the vectors themselves. No labels or other columns are read, whatever their names. Very
    long vectors are taken whole. An empty table gives no rows.
    """
    kind = vectors.schema[id_col].dataType.simpleString()
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vec_col).cast("array<double>").alias("v"))
    rows = checkpointed(rows.mapInArrow(_packed, f"id {kind}, vec binary"))
    nodes = rows.where("vec is not null").groupBy("vec").agg(F.min("id").alias("low"), F.count("*").alias("weight"))
    nodes = checkpointed(nodes.withColumn("node", F.monotonically_increasing_id()))
    found = links(nodes, threshold, limit)
    comp = connected_components(found.where("v is not null").select("u", "v"))
    gains = found.where("u is not null and v is null").groupBy(F.col("u").alias("node")).agg(F.sum("gain").alias("gain"))
    placed = nodes.join(comp, "node", "left").join(gains, "node", "left")
    n_links = (F.coalesce("gain", F.lit(0)) + F.col("weight") - 1).alias("n_links")
    placed = checkpointed(placed.select("vec", "low", "weight", F.coalesce("component", "node").alias("component"), n_links))
    lowest = checkpointed(placed.groupBy("component").agg(F.min("low").alias("component_id"), F.count("*").alias("many")))
    named = checkpointed(hot_join(placed.drop("low"), lowest, "component").select("vec", "weight", "n_links", "component_id"))
    out = hot_join(rows.where("vec is not null"), named, "vec", "weight").drop("vec")
    none = rows.where("vec is null").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    out = out.unionByName(none)
    return out.select(F.col("id").alias(id_col), F.col("n_links").cast("long").alias("n_links"), "component_id", F.col("component_id").eqNullSafe(F.col("id")).alias("kept"))

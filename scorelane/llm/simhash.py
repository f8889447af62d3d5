"""SimHash near-dedup with pigeonring candidate filtering."""

from __future__ import annotations

import math
from itertools import pairwise

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import block_pairs, checkpointed, connected_components, hot_join, spanning_star, whole_buckets

#: The ring: 64 bits cut into five segments; a pair within 4 bits has a chain start whose l first segments
#: differ in at most floor(4 l / 5) bits, for every l.
RING = (13, 13, 13, 13, 12)
MAX_BITS = 4
BUDGETS = (0, 1, 2, 3, 4)
#: Buckets of more distinct fingerprints than this are linked by shared centres, without comparing pairs.
BUCKET_LIMIT = 4096
SEED = 42


def shingle_hashes(text: str | None, width: int, seed: int = SEED) -> np.ndarray:
    """XXH64 of each word shingle, repeats included; of the whole sequence where there are fewer words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII space only
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    k = min(width, len(words))
    digest, n = xxhash.xxh64_intdigest, len(words) - k + 1
    return np.fromiter((digest(joined[s:e], seed) for s, e in zip(starts[:n].tolist(), ends[k - 1 :].tolist(), strict=True)), np.uint64, n)


def fingerprint(text: str | None, width: int = 4, seed: int = SEED) -> int:
    """The 64-bit SimHash of all word shingles; 0 without words."""
    hashes = shingle_hashes(text, width, seed)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 100_000):
        part = hashes[at : at + 100_000].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4) -> DataFrame:
    """Rows (doc_id, fp long): one per row of docs."""

    def run(batches):
        for batch in batches:
            fps = np.array([fingerprint(t, width) for t in batch.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], names=["doc_id", "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), text_col).mapInArrow(run, f"doc_id {kind}, fp long")


def _segments(fps: np.ndarray) -> list[np.ndarray]:
    out, at = [], 0
    for bits in RING:
        out.append((fps >> np.uint64(at)) & np.uint64((1 << bits) - 1))
        at += bits
    return out


def _chains(batches):
    """Bucket keys of each fingerprint: per chain start, the first segment whole and the next with a bit masked.

    Two fingerprints share a key exactly if the chain's first segments are equal and the next differ in at most
    one bit: the budgets of lengths one and two.
    """
    for batch in batches:
        fps = batch.column(0).to_numpy().view(np.uint64)
        parts = _segments(fps)
        for i, bits in enumerate(RING):
            j = (i + 1) % len(RING)
            head = (np.uint64(i) << np.uint64(40)) | (parts[i] << np.uint64(17))
            for b in range(RING[j]):
                rest = parts[j] & ~np.uint64(1 << b)
                key = head | (rest << np.uint64(4)) | np.uint64(b)
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), batch.column(0)], names=["key", "fp"])
            del bits


def _chain_holds(x: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Whether the chains from ``start`` keep every budget, for the differing bits x of some pairs."""
    diffs = np.stack([np.bitwise_count(p) for p in _segments(x)], axis=1).astype(np.int64)
    order = (start[:, None] + np.arange(len(RING))) % len(RING)
    return (np.cumsum(np.take_along_axis(diffs, order, 1), axis=1) <= np.array(BUDGETS)).all(1)


def _link(keys: np.ndarray, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A spanning star of the linked pairs within each run of equal keys (keys are sorted)."""
    n = len(keys)
    if n < 2:
        return fps[:0].view(np.int64), fps[:0].view(np.int64)
    nodes, node = np.unique(fps, return_inverse=True)
    label = np.arange(len(nodes))
    start = (keys.view(np.uint64) >> np.uint64(40)).astype(np.int64)
    active, d = np.arange(n - 1), 1
    while True:
        active = active[active + d < n]
        active = active[keys[active] == keys[active + d]]
        if not len(active):
            break
        a, b = active, active + d
        apart = label[node[a]] != label[node[b]]
        a, b = a[apart], b[apart]
        if len(a):
            x = fps[a] ^ fps[b]
            near = _chain_holds(x, start[a])
            near[near] = np.bitwise_count(x[near]) <= MAX_BITS
            if near.any():
                child, root = spanning_star(
                    np.concatenate([label[node[a[near]]], np.arange(len(nodes))]),
                    np.concatenate([label[node[b[near]]], label]),
                )
                label = np.arange(len(nodes))
                label[child] = root
        d += 1
    own = label != np.arange(len(nodes))
    return nodes[own].view(np.int64), nodes[label[own]].view(np.int64)


def _linker(limit: int):
    """Streams rows sorted by key; gives edges, and (fp, null) for fingerprints of buckets beyond the limit."""

    def out(u, v, hot):
        nulls = np.concatenate([np.zeros(len(u), bool), np.ones(len(hot), bool)])
        second = pa.array(np.concatenate([v, np.zeros(len(hot), np.int64)]), mask=nulls)
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate([u, hot])), second], names=["u", "v"])

    def flush(keys, fps):
        edges = np.flatnonzero(np.diff(keys)) + 1
        bounds = np.concatenate([[0], edges, [len(keys)]])
        sizes = np.repeat(np.diff(bounds), np.diff(bounds))
        small = (sizes > 1) & (sizes <= limit)
        u, v = _link(keys[small], fps[small])
        return out(u, v, np.unique(fps[sizes > limit]).view(np.int64))

    def run(batches):
        keys, fps, hot_key = [], [], None
        for batch in batches:
            k, f = batch.column(0).to_numpy(), batch.column(1).to_numpy().view(np.uint64)
            if hot_key is not None:  # the rest of a bucket that was too large already
                same = int(np.searchsorted(k, hot_key, "right"))
                if same:
                    yield out(k[:0], k[:0], np.unique(f[:same]).view(np.int64))
                k, f = k[same:], f[same:]
                if not len(k):
                    continue
                hot_key = None
            keys.append(k)
            fps.append(f)
            if sum(map(len, keys)) < 100_000:
                continue
            k, f = np.concatenate(keys), np.concatenate(fps)
            cut = int(np.searchsorted(k, k[-1], "left"))
            if len(k) - cut > limit:
                hot_key, cut = k[-1], len(k)
            if cut:
                yield flush(k[:cut], f[:cut])
            keys, fps = [k[cut:]], [f[cut:]]
        if sum(map(len, keys)):
            yield flush(np.concatenate(keys), np.concatenate(fps))

    return run


def _centres(batches):
    """All values within two bits of each fingerprint. Two fingerprints within four bits share one of them, and
    any two that share one are within four bits."""
    one = np.uint64(1) << np.arange(64, dtype=np.uint64)
    i, j = np.triu_indices(64, 1)
    flips = np.concatenate([[np.uint64(0)], one, one[i] | one[j]])
    for batch in batches:
        fps = batch.column(0).to_numpy().view(np.uint64)
        for lo, hi in pairwise([*range(0, len(fps), 64), len(fps)]):
            part = fps[lo:hi]
            centre = (part[:, None] ^ flips[None, :]).ravel().view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(centre), pa.array(np.repeat(part, len(flips)).view(np.int64))], names=["centre", "fp"])


def links(distinct_fps: DataFrame, limit: int = BUCKET_LIMIT) -> DataFrame:
    """Edges (u, v) between distinct fingerprints that connect all pairs within MAX_BITS bits and no others."""
    keyed = distinct_fps.mapInArrow(_chains, "key long, fp long")
    found = checkpointed(keyed.repartition("key").sortWithinPartitions("key").mapInArrow(_linker(limit), "u long, v long").distinct())
    edges = found.where("v is not null")
    hot = found.where("v is null").select(F.col("u").alias("fp")).distinct()
    if hot.isEmpty():
        return edges
    spread = hot.mapInArrow(_centres, "centre long, fp long")
    low = spread.groupBy("centre").agg(F.min("fp").alias("v"), F.max("fp").alias("top")).where("v < top").select("centre", "v")
    return edges.unionByName(spread.join(low, "centre").select(F.col("fp").alias("u"), "v").where("u <> v").distinct())


def simhash_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4, limit: int = BUCKET_LIMIT
) -> DataFrame:
    """One row per row of docs: id_col, fingerprint (16 hex digits), component_id (smallest id reachable).

    Null and empty texts have fingerprint zero and are linked like others; texts of fewer words than ``width``
    are one shingle. Rows with a null id take part; they never name a component unless it has no other id.
    Repeated rows share a component. Only id_col and text_col are read. An empty table gives no rows.
    """
    prints = checkpointed(fingerprints(docs, id_col, text_col, width))
    groups = checkpointed(prints.groupBy("fp").agg(F.min("doc_id").alias("low"), F.count("*").alias("many")))
    comp = connected_components(links(groups.select("fp"), limit))
    placed = groups.join(comp, F.col("fp") == F.col("node"), "left").select("fp", "low", "many", F.coalesce("component", "fp").alias("component"))
    placed = checkpointed(placed)
    lowest = checkpointed(placed.groupBy("component").agg(F.min("low").alias("component_id"), F.count("*").alias("nodes")))
    named = checkpointed(hot_join(placed.drop("low"), lowest, "component", "nodes").select("fp", "component_id", "many"))
    hexed = F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint")
    return hot_join(prints, named, "fp").select(F.col("doc_id").alias(id_col), hexed, "component_id")


# Near copies by word shingles: 64 bits are too few for a similarity of 0.8, where a seventh of them differ. Longer
# fingerprints keep such pairs apart from others; samples of their bits bring pairs together, and the ring of
# segments prunes what meets by chance before the full Hamming check. That is a search for candidates only: every
# link is settled by the sets of shingles.

WIDE_BITS = 256
WIDE_RING = 16
SIMILARITY = 0.8
RECALL = 0.99
#: Standard deviations of the differing bits of a pair at the similarity: beyond them on the far side it is no candidate.
SLACK = 2.33
#: Texts, and shingles of them, in a block of a group whose pairs are all compared.
BLOCK_TEXTS, BLOCK_SHINGLES = 512, 1_000_000


def wide_fingerprint(hashes: np.ndarray) -> bytes:
    """The 256-bit SimHash of distinct shingles: each hash is stretched to four words; zeros without shingles."""
    ones = np.zeros(WIDE_BITS, np.int64)
    for at in range(0, len(hashes), 50_000):
        z = hashes[at : at + 50_000, None] + np.arange(1, WIDE_BITS // 64 + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        z ^= z >> np.uint64(31)
        ones += np.unpackbits(z.view(np.uint8).reshape(len(z), -1), axis=1).sum(0, dtype=np.int64)
    return np.packbits(2 * ones > len(hashes)).tobytes()


def wide_parameters(n: int, similarity: float = SIMILARITY, recall: float = RECALL) -> tuple[int, int, int]:
    """(most differing bits, bits a key, tables) for n fingerprints.

    The cosine of two sets of a Jaccard similarity is 2s/(1+s) at least; the share angle/pi of their bits differs.
    The tables give a pair at the similarity the recall.
    """
    share = math.acos(2 * similarity / (1 + similarity)) / math.pi
    mean, slack = WIDE_BITS * share, SLACK * math.sqrt(WIDE_BITS * share * (1 - share))
    bits = min(32, max(8, math.ceil(math.log2(max(n, 2))) - 6))  # some dozens of unlike texts a bucket
    return math.ceil(mean + slack), bits, math.ceil(math.log(1 - recall) / math.log(1 - (1 - share) ** bits))


def _sampled(bits: int, tables: int):
    """Rows (key, node, fp): each table's sample of the fingerprint's bits is a key."""
    rng = np.random.default_rng([SEED, bits, tables])
    chosen = np.stack([rng.permutation(WIDE_BITS)[:bits] for _ in range(tables)])
    weights = np.int64(1) << np.arange(bits, dtype=np.int64)

    def run(batches):
        for batch in batches:
            fps = batch.column(1).to_pylist()
            if not fps:
                continue
            on = np.unpackbits(np.frombuffer(b"".join(fps), np.uint8).reshape(len(fps), -1), axis=1)
            for t in range(tables):
                key = on[:, chosen[t]] @ weights | np.int64(t) << np.int64(bits)
                yield pa.RecordBatch.from_arrays([pa.array(key), batch.column(0), batch.column(1)], names=["key", "node", "fp"])

    return run


def _ring_holds(x: np.ndarray, most: int) -> np.ndarray:
    """Whether some chain around the ring keeps the budget l * most / segments for every length l."""
    diffs = np.bitwise_count(x.view("<u2")).astype(np.int32)
    m = diffs.shape[1]
    budget = (np.arange(1, m + 1) * most) // m
    total = np.cumsum(np.concatenate([diffs, diffs], axis=1), axis=1)
    total = np.concatenate([np.zeros((len(x), 1), np.int32), total], axis=1)
    held = np.zeros(len(x), bool)
    for start in range(m):
        rest = ~held
        if not rest.any():
            break
        held[rest] = (total[rest, start + 1 : start + m + 1] - total[rest, start : start + 1] <= budget).all(1)
    return held


class _Groups:
    """Groups of the rows of a batch that chains of candidate pairs connect, as stars: a row adds one edge at most,
    however large its bucket. No link is decided here."""

    def __init__(self, nodes: np.ndarray, fps: np.ndarray, most: int):
        self.nodes, self.at = np.unique(nodes, return_inverse=True)
        self.label = np.arange(len(self.nodes))
        self.fps, self.most = fps, most

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        """a and b: places of the rows; pairs within a group already are passed over."""
        for lo in range(0, len(a), 50_000):
            x, y = a[lo : lo + 50_000], b[lo : lo + 50_000]
            apart = self.label[self.at[x]] != self.label[self.at[y]]
            x, y = x[apart], y[apart]
            near = _candidates(self.fps[x] ^ self.fps[y], self.most)
            if not near.any():
                continue
            every = np.arange(len(self.nodes))
            ends = (np.concatenate([self.label[self.at[z[near]]], w]) for z, w in ((x, every), (y, self.label)))
            child, root = spanning_star(*ends)
            self.label = every
            self.label[child] = root

    def edges(self) -> tuple[np.ndarray, np.ndarray]:
        own = self.label != np.arange(len(self.nodes))
        return self.nodes[own], self.nodes[self.label[own]]


def _candidates(x: np.ndarray, most: int) -> np.ndarray:
    """Which differing bits x are of candidate pairs: the ring prunes before the full count."""
    near = _ring_holds(x, most)
    near[near] = np.bitwise_count(x[near]).sum(1, dtype=np.int64) <= most
    return near


def _words(fps) -> np.ndarray:
    return np.frombuffer(b"".join(fps.to_pylist()), "<u8").reshape(len(fps), WIDE_BITS // 64)


def _wide_runs(most: int, limit: int):
    """Groups the rows (key, node, fp) of a key, given sorted by key: edges (u, v) with a null key, and (node, null, key) for
    rows of buckets beyond the limit."""

    def run(batches):
        for rows, large in whole_buckets(batches, limit):
            key, node = rows.column("key").to_numpy(), rows.column("node").to_numpy()
            if large:
                yield pa.RecordBatch.from_arrays([pa.array(node), pa.nulls(len(node), pa.int64()), pa.array(key)], names=["u", "v", "key"])
                continue
            groups = _Groups(node, _words(rows.column("fp")), most)
            active, d = np.arange(len(key)), 1
            while len(active := active[active + d < len(key)]) and len(active := active[key[active] == key[active + d]]):
                groups.join(active, active + d)
                d += 1
            u, v = groups.edges()
            yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v), pa.nulls(len(u), pa.int64())], names=["u", "v", "key"])

    return run


def _wide_blocks(most: int):
    """Groups the rows of two blocks of one large bucket, or of one block (bi = bj), by the pairs between them."""

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks()
        side, groups = rows.column("side").to_numpy(), _Groups(rows.column("node").to_numpy(), _words(rows.column("fp")), most)
        x, y = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        within = rows.column("bi")[0].as_py() == rows.column("bj")[0].as_py()
        for i in x:
            other = x[x > i] if within else y
            groups.join(np.full(len(other), i), other)
        u, v = groups.edges()
        return pa.table({"u": u, "v": v})

    return run


def _shingled(docs: DataFrame, width: int, with_set: bool) -> DataFrame:
    """Rows (doc_id, mark, fp, n[, shingles]) of rows (doc_id, mark, text): the wide fingerprint, the number of distinct shingles and their hashes."""

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                sets = [np.unique(shingle_hashes(t, width)) for t in part.column(2).to_pylist()]
                sizes = np.array([len(x) for x in sets], np.int32)
                columns = [part.column(0), part.column(1), pa.array([wide_fingerprint(x) for x in sets], pa.binary()), pa.array(sizes)]
                if with_set:
                    offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
                    columns.append(pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(sets).view(np.int64))))
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "mark", "fp", "n", "shingles"][: len(columns)])

    kind = docs.schema["doc_id"].dataType.simpleString()
    sets = ", shingles array<bigint>" if with_set else ""
    return docs.select("doc_id", "mark", "text").mapInArrow(run, f"doc_id {kind}, mark long, fp binary, n int{sets}")


def _marked(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows (doc_id, mark, text): the mark tells rows of one id apart by their texts."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("mark"), text.alias("text"))


#: Rows (doc_id, mark) up to which a list of wanted texts is broadcast, some 20 MB; beyond it the texts are shuffled.
BROADCAST_ROWS = 500_000


def _sets(marked: DataFrame, grouped: DataFrame, width: int) -> DataFrame:
    """Rows (node, shingles) of ``grouped`` (node, low); only the texts of low are read again."""
    wanted = grouped.select(F.col("low.id").alias("__id"), F.col("low.mark").alias("__mark"), "node")
    wanted = F.broadcast(wanted) if grouped.count() <= BROADCAST_ROWS else wanted
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("mark") == F.col("__mark"))
    texts = marked.join(wanted, same).select(F.col("node").alias("doc_id"), "mark", "text")
    sets = _shingled(texts, width, True).select(F.col("doc_id").alias("node"), "shingles")
    return checkpointed(sets.dropDuplicates(["node"]))  # a row may be there twice


def _compared(rows: pa.Table, similarity: float, most: int) -> tuple[np.ndarray, list[int], list[int]]:
    """Of rows sorted by group: the components with those joined that a candidate pair of sets joins, and the joins (u, v).

    The pairs of a group within one block (bi = bj) are looked at, or those between two, by side.
    """
    group, side, parts = (rows.column(c).to_numpy() for c in ("group", "side", "component"))
    within = rows.column("bi")[0].as_py() == rows.column("bj")[0].as_py()
    components, label = np.unique(parts, return_inverse=True)
    sizes, fps = rows.column("n").to_numpy().astype(np.int64), _words(rows.column("fp"))
    at = np.concatenate([[0], np.cumsum(sizes)])
    lists = rows.column("shingles").combine_chunks()
    known, code = np.unique(lists.flatten().to_numpy(), return_inverse=True)
    mark, u, v = np.zeros(len(known), bool), [], []
    ends = np.searchsorted(group, group, "right")
    starts = np.arange(1, len(group) + 1) if within else np.searchsorted(group, group, "left")
    for x in np.flatnonzero(side == 0):
        lo, hi = starts[x], ends[x]
        ok = label[lo:hi] != label[x]
        if not within:
            ok &= side[lo:hi] == 1
        ok &= np.minimum(sizes[lo:hi], sizes[x]) / np.maximum(np.maximum(sizes[lo:hi], sizes[x]), 1) >= similarity
        y = lo + np.flatnonzero(ok)
        y = y[_candidates(fps[y] ^ fps[x], most)] if len(y) else y
        if not len(y):
            continue
        own = code[at[x] : at[x + 1]]
        mark[own] = True
        if len(y) * 4 < hi - lo:
            both = np.array([mark[code[at[k] : at[k + 1]]].sum() for k in y])
        else:
            hits = np.concatenate([[0], np.cumsum(mark[code[at[lo] : at[hi]]])])
            both = hits[at[y + 1] - at[lo]] - hits[at[y] - at[lo]]
        mark[own] = False
        reach = both / (sizes[x] + sizes[y] - both) >= similarity
        for other in np.unique(label[y[reach]]):
            low, high = sorted((label[x], other))
            u.append(components[high])
            v.append(components[low])
            label[label == high] = low
    return components[label], u, v


def _within_blocks(similarity: float, most: int):
    """The rows of a block without their sets, and with its components."""

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("group", "ascending"), ("node", "ascending")]).combine_chunks()
        component, _, _ = _compared(rows, similarity, most)
        rows = rows.set_column(rows.schema.get_field_index("component"), "component", pa.array(component))
        return rows.select(["group", "blocks", "block", "node", "component", "n", "fp"])

    return run


def _between_blocks(similarity: float, most: int):
    """Rows (u, v): components that the pairs between two blocks join, or those within one."""

    def run(rows: pa.Table) -> pa.Table:
        _, u, v = _compared(rows.sort_by([("group", "ascending"), ("node", "ascending")]).combine_chunks(), similarity, most)
        return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})

    return run


def _blocks(many, weight):
    return F.ceil(F.greatest(many / BLOCK_TEXTS, weight / BLOCK_SHINGLES, F.lit(1.0))).cast("long")


def _renamed(rows: DataFrame, edges: DataFrame) -> DataFrame:
    """rows with the components joined that the edges (u, v) between components join."""
    whole = connected_components(edges)
    sizes = rows.groupBy("component").agg(F.count("*").alias("nodes"))
    whole = whole.select(F.col("node").alias("component"), F.col("component").alias("whole")).join(sizes, "component")
    named = hot_join(rows, checkpointed(whole), "component", "nodes", how="left")
    return checkpointed(named.withColumn("component", F.coalesce("whole", "component")).drop("whole"))


def _settled(grouped: DataFrame, sets: DataFrame, most: int, similarity: float) -> DataFrame:
    """(node, component) for rows (node, group, fp, n): chains of candidate pairs whose sets reach the similarity.

    All candidate pairs of a group are compared: those within a block, which is all there is to a group of one; in a
    larger group those with a first block, so that what is common to most of it becomes one component; then, ordered by
    component, those of every two blocks but such of one component alone.
    """
    sizes = grouped.groupBy("group").agg(F.count("*").alias("many"), F.sum("n").alias("weight"))
    sizes = checkpointed(sizes.select("group", "many", _blocks(F.col("many"), F.col("weight")).alias("blocks"), "weight"))
    total = sizes.agg(F.sum("many"), F.sum("weight")).first()
    lots = _blocks(F.lit(total[0]), F.lit(total[1]))
    rows = hot_join(grouped.withColumn("component", F.col("node")), sizes.drop("weight"), "group")
    rows = rows.withColumn("block", F.pmod(F.xxhash64("node"), "blocks"))
    # groups of one block share tasks
    lot = F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("group"), lots)).otherwise(F.col("group") + lots)
    rows = rows.withColumns({"lot": lot, "bi": F.col("block"), "bj": F.col("block"), "side": F.lit(0)}).join(sets, "node")
    kept = "group long, blocks long, block long, node long, component long, n int, fp binary"
    rows = checkpointed(rows.groupBy("lot", "bi", "bj").applyInArrow(_within_blocks(similarity, most), kept))

    def unsettled(rows: DataFrame) -> DataFrame:
        """The rows of groups of several blocks that have several components."""
        parts = rows.where("blocks > 1").groupBy("group").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("many"))
        return checkpointed(hot_join(rows, checkpointed(parts.where("low < high").select("group", "many")), "group"))

    def between(rows: DataFrame, plan: DataFrame) -> DataFrame:
        """plan: rows group, bi, bj of two blocks, or of one twice."""
        sides = F.explode(F.when(F.col("bi") == F.col("bj"), F.array(F.struct(F.col("bi").alias("block"), F.lit(0).alias("side")))).otherwise(F.array(F.struct(F.col("bi").alias("block"), F.lit(0).alias("side")), F.struct(F.col("bj").alias("block"), F.lit(1).alias("side")))))
        plan = plan.select("group", "bi", "bj", sides.alias("of")).select("group", "bi", "bj", "of.block", "of.side")
        pairs = rows.join(plan, ["group", "block"]).join(sets, "node")
        return checkpointed(pairs.groupBy("group", "bi", "bj").applyInArrow(_between_blocks(similarity, most), "u long, v long"))

    rest = unsettled(rows)
    if rest.isEmpty():
        return rows
    met = rows.join(rest.select("node"), "node", "left_anti").select("node", "component")
    large = rest.select("group", "blocks").distinct()
    plan = large.select("group", F.lit(0).cast("long").alias("bi"), F.explode(F.sequence(F.lit(1).cast("long"), F.col("blocks") - 1)).alias("bj"))
    rest = _renamed(rest, between(rest, plan))
    again = unsettled(rest)
    if not again.isEmpty():
        met = met.unionByName(rest.join(again.select("node"), "node", "left_anti").select("node", "component"))
        # blocks anew: a large component has blocks of its own
        own = again.groupBy("group", "component").agg(F.count("*").alias("size"), F.sum("n").alias("load")).withColumn("parts", _blocks(F.col("size"), F.col("load")))
        own = checkpointed(own)
        small = own.where("parts = 1").groupBy("group").agg(F.sum("size").alias("s"), F.sum("load").alias("l")).select("group", _blocks(F.col("s"), F.col("l")).alias("lots"))
        own = checkpointed(own.join(small, "group", "left").select("component", "parts", F.coalesce("lots", F.lit(1)).alias("lots"), F.col("size").alias("many")))
        name = F.when(F.col("parts") == 1, F.xxhash64(F.lit(-1), F.pmod(F.xxhash64("component"), "lots"))).otherwise(F.xxhash64("component", F.pmod(F.xxhash64("node"), "parts")))
        rest = checkpointed(hot_join(again.drop("block"), own, "component").withColumn("block", name).drop("parts", "lots"))
        ends = checkpointed(rest.groupBy("group", "block").agg(F.min("component").alias("low"), F.max("component").alias("high")))
        other = ends.select("group", F.col("block").alias("bj"), F.col("low").alias("l"), F.col("high").alias("h"))
        plan = ends.join(other, "group").where("block <= bj and least(low, l) < greatest(high, h)")
        rest = _renamed(rest, between(rest, plan.select("group", F.col("block").alias("bi"), "bj")))
    return met.unionByName(rest.select("node", "component"))


def _named(docs: DataFrame, id_col: str, text_col: str, width: int, similarity: float, limit: int) -> DataFrame:
    """Rows (doc_id, mark, low): low is the struct (no id, id, mark) of the first row of the component."""
    marked = _marked(docs, id_col, text_col)
    prints = checkpointed(_shingled(marked, width, False))
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), "mark")
    nodes = prints.groupBy("fp", "n").agg(F.min(order).alias("low"), F.count("*").alias("many"))
    nodes = checkpointed(nodes.withColumn("node", F.monotonically_increasing_id()))
    most, bits, tables = wide_parameters(nodes.count(), similarity)
    keyed = nodes.select("node", "fp").mapInArrow(_sampled(bits, tables), "key long, node long, fp binary")
    found = checkpointed(keyed.repartition("key").sortWithinPartitions("key").mapInArrow(_wide_runs(most, limit), "u long, v long, key long").distinct())
    edges, large = found.where("key is null").select("u", "v"), checkpointed(found.where("key is not null").select("key", F.col("u").alias("node")))
    if not large.isEmpty():
        wide = block_pairs(checkpointed(large), limit // 2 or 1).join(nodes.select("node", "fp"), "node")
        edges = edges.unionByName(wide.select("key", "bi", "bj", "side", "node", "fp").groupBy("key", "bi", "bj").applyInArrow(_wide_blocks(most), "u long, v long"))
    groups = connected_components(edges).withColumnRenamed("component", "group")
    placed = nodes.withColumn("component", F.col("node"))
    if not groups.isEmpty():
        grouped = checkpointed(nodes.drop("many").join(groups, "node"))
        met = _settled(grouped.drop("low"), _sets(marked, grouped, width), most, similarity)
        placed = placed.drop("component").join(met.select("node", "component"), "node", "left").withColumn("component", F.coalesce("component", "node"))
    placed = checkpointed(placed)
    lowest = checkpointed(placed.groupBy("component").agg(F.min("low").alias("first"), F.count("*").alias("nodes")))
    print_ = F.struct("fp", "n").alias("print")
    named = checkpointed(hot_join(placed.drop("low"), lowest, "component", "nodes").select(print_, "first", "many"))
    return hot_join(prints.select("doc_id", "mark", print_), named, "print").select("doc_id", "mark", F.col("first").alias("low"))


def near_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, similarity: float = SIMILARITY, limit: int = BUCKET_LIMIT
) -> DataFrame:
    """One row per row of docs: id_col, component_id (the smallest id among near copies that chains of links reach).

    Texts are near copies if the Jaccard similarity of their sets of shingles is the given one or more. Candidates
    are pairs that differ in few of 256 sign bits, ring and all, and that some table or a chain of other candidates
    brings together; each of the two holds for a pair at the similarity with a probability of about RECALL. No two
    components are joined but by a pair whose sets reach the similarity, and of the candidates none is left untried.
    Cases (nulls, empty texts, very long texts, repeated rows, other columns, empty tables) as in ``simhash_dedup``.
    """
    return _named(docs, id_col, text_col, width, similarity, limit).select(F.col("doc_id").alias(id_col), F.col("low.id").alias("component_id"))


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of docs that stay: of each group of near copies the row with the smallest id, columns as they came.

    Null texts count as empty; texts without words are near copies of each other. A null id comes after all others.
    Of rows that share id, those with another text than the first go if they are near copies; rows that repeat both
    id and text stay or go together (``drop_exact_copies`` tells them apart). Very long texts count whole, columns
    may have any names, and an empty table gives no rows.
    """
    verdict = _named(docs, id_col, text_col, width, similarity, BUCKET_LIMIT)
    same = F.col("doc_id").eqNullSafe(F.col("low.id")) & (F.col("mark") == F.col("low.mark"))
    gone = checkpointed(verdict.where(~same).select("doc_id", "mark").distinct())
    gone = F.broadcast(gone) if gone.count() <= BROADCAST_ROWS else gone  # then no text is shuffled
    rows = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("sum"))
    return rows.join(gone, F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("sum") == F.col("mark")), "left_anti").select("row.*")

"""Sharding by balanced label propagation, in DataFrame operations alone.

Documents that share a hub are linked with each other; without given links, the hub of a document is its text, so that
copies go together. Links are never written as pairs: a round tallies each hub's documents by shard, joins the tallies
back, and every document asks for the shard where most of its neighbours are. How much of what asks may move is settled
by quotas: from the flows between shards (as many numbers as shards squared) follow the largest shares that keep every
shard within its capacity once what leaves has left. A share is taken by hash of hub and portion, so small hubs move
whole, and only hubs of much weight are cut. Documents without links are not placed before the end; they and what is
above quota then fill the shards along prefix sums of their weight, heavy ones first, so that the light ones even out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import checkpointed, hot_join

#: Rounds of propagation at most; they end sooner, once less than MOVED of the linked weight moves.
ROUNDS, MOVED = 24, 0.001
#: Shards may take so much more than their quota while labels move, and draw labels until they lack but so much; what is above
#: quota goes in the end.
SLACK = 0.05
#: A hub is cut into portions of at most this share of a shard's quota where it can't move whole.
PORTION = 1 / 16
#: Prefix sums go by buckets of about so many rows, and so many buckets at least.
BUCKET_ROWS, LEAST_BUCKETS = 50_000, 256
#: Weight classes of the fill, by multiples of the mean weight; the last takes the rest.
CLASSES = (8.0, 1.0, 1 / 8)


def quotas(total: int, shards: int) -> list[int]:
    """Whole-number quotas, at most one apart."""
    return [total // shards + (k < total % shards) for k in range(shards)]


def shares(loads: list[int], flows: dict[tuple[int, int], int], capacity: list[float]) -> list[float]:
    """For each shard the largest share of the weight asking to enter it that keeps all within capacity.

    From flows (from, to) of asked moves: all are let in at first, and shares fall until what enters a shard fits its room
    and what leaves it.
    """
    many = len(loads)
    asked = [sum(w for (_, b), w in flows.items() if b == k) for k in range(many)]
    let = [1.0] * many
    for _ in range(100):
        left = [sum(let[b] * w for (a, b), w in flows.items() if a == k) for k in range(many)]
        new = [min(let[k], max(0.0, (capacity[k] - loads[k] + left[k]) / asked[k])) if asked[k] else 1.0 for k in range(many)]
        if max(abs(a - b) for a, b in zip(new, let, strict=True)) < 1e-6:
            break
        let = new
    return let


def _chance(*of: Column) -> Column:
    """A number from 0 to 1 by hash."""
    return F.pmod(F.xxhash64(*of), F.lit(1 << 30)) / float(1 << 30)


def _by_shard(shard: Column, values: list) -> Column:
    """The value of each shard, as an expression."""
    found = F.when(shard == 0, F.lit(values[0]))
    for k, v in enumerate(values[1:], 1):
        found = found.when(shard == k, F.lit(v))
    return found


def _buckets(rows: int) -> int:
    return max(LEAST_BUCKETS, -(-rows // BUCKET_ROWS))


def _ahead(items: DataFrame, key: Column, order: list[str], value: Column, buckets: int, by: tuple[str, ...] = ()) -> DataFrame:
    """items with ``ahead``: the sum of ``value`` over all items before each, in the order of the bucket that ``key`` falls in.

    Rows meet by bucket only; the sums of buckets, few rows, are added up apart. ``by`` columns start anew.
    """
    rows = items.withColumn("bucket", F.pmod(key, F.lit(buckets)))
    sums = rows.groupBy(*by, "bucket").agg(F.sum(value).alias("total"))
    before = Window.partitionBy(*by).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("offset", F.coalesce(F.sum("total").over(before), F.lit(0))).drop("total")
    inner = Window.partitionBy(*by, "bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("ahead", F.coalesce(F.sum(value).over(inner), F.lit(0)))
    return rows.join(sums, [*by, "bucket"]).withColumn("ahead", F.col("ahead") + F.col("offset")).drop("bucket", "offset")


def _loads(rows: DataFrame, shards: int) -> list[int]:
    found = {r["shard"]: r["w"] for r in rows.groupBy("shard").agg(F.sum("weight").alias("w")).collect()}  # a row a shard
    return [found.get(k, 0) for k in range(shards)]


def _portion(quota: int) -> Column:
    """The portion of its hub that a row belongs to: hubs up to PORTION of a quota have one."""
    many = F.greatest(F.lit(1), F.ceil(F.col("many") * F.col("weight") / max(1.0, quota * PORTION)))
    return F.pmod(F.xxhash64("row", F.lit("portion")), many)


def propagate(members: DataFrame, total: int, shards: int, rounds: int = ROUNDS) -> DataFrame:
    """Rows (row, weight, hub, many, shard), one a linked document, after the propagation.

    ``members`` has rows (row, id, weight, hub), one for each document and hub; ``total`` is the weight of all documents, linked
    or not. A document of several hubs asks for the shard that most of all its neighbours are in, and counts by its
    smallest hub where portions are cut.
    """
    quota = quotas(total, shards)
    capacity = [q * (1 + SLACK) for q in quota]
    single = members.groupBy("row").agg(F.count("*").alias("n")).where("n > 1").isEmpty()
    state = members.withColumn("shard", F.pmod(F.xxhash64("id", F.lit("start")), F.lit(shards)).cast("int")).drop("id")
    room = [True] * shards
    counts = [f"c{k}" for k in range(shards)]
    for turn in range(rounds):
        tally = state.groupBy("hub").agg(F.count("*").alias("many"), *[F.count_if(F.col("shard") == k).alias(c) for k, c in enumerate(counts)])
        tally = checkpointed(tally.withColumn("size", F.col("many")))
        seen = hot_join(state.select("row", "weight", "hub", "shard"), tally, "hub").withColumnRenamed("size", "many")
        if not single:
            firsts = [F.first("weight").alias("weight"), F.first("shard").alias("shard"), F.min("hub").alias("hub"), F.max("many").alias("many")]
            seen = seen.groupBy("row").agg(*firsts, *[F.sum(c).alias(c) for c in counts])
        # the whole hub breaks ties alike, so two halves do not change places
        choices = [F.when((F.col("shard") == k) | F.lit(room[k]), F.struct(F.col(c).alias("n"), F.xxhash64("hub", F.lit(k)).alias("tie"), F.lit(k).alias("k"))) for k, c in enumerate(counts)]
        seen = seen.withColumn("wish", F.greatest(*choices)["k"] if shards > 1 else F.lit(0)).drop(*counts)
        seen = checkpointed(seen)
        asked = seen.groupBy("shard", "wish").agg(F.sum("weight").alias("w")).collect()  # at most shards squared
        loads = [sum(r["w"] for r in asked if r["shard"] == k) for k in range(shards)]
        flows = {(r["shard"], r["wish"]): r["w"] for r in asked if r["shard"] != r["wish"]}
        let = shares(loads, flows, capacity)
        moves = sum(let[b] * w for (_, b), w in flows.items())
        takes = (F.col("shard") != F.col("wish")) & (_chance(F.col("hub"), _portion(quota[0]), F.lit(turn)) < _by_shard(F.col("wish"), let))
        moved = seen.select("row", "weight", "hub", "many", F.when(takes, F.col("wish")).otherwise(F.col("shard")).alias("shard"))
        if single:
            state = moved
        else:
            moved = checkpointed(moved)
            state = state.drop("shard").join(moved.select("row", "shard"), "row")
        last = moved
        for (a, b), w in flows.items():  # what the shares let through on average; the next round counts anew
            loads[a] -= let[b] * w
            loads[b] += let[b] * w
        room = [load < q * (1 - SLACK) for load, q in zip(loads, quota, strict=True)]  # what is nearly full draws no more
        if moves <= MOVED * sum(loads):
            break
    return checkpointed(last)


def _within_quota(placed: DataFrame, quota: list[int], shards: int) -> tuple[DataFrame, DataFrame, list[int]]:
    """(rows that stay, rows taken out, loads): shards above quota give up portions of hubs until they are not.

    Hubs of much weight give first, as they are cut anyway; whole small hubs go where that is not enough.
    """
    large = F.col("many") * F.col("weight") > quota[0] / 8
    placed = placed.withColumn("out", F.lit(False))
    for turn in range(6):
        stays = placed.where("not out")
        loads = _loads(stays, shards)
        above = [max(0, w - q) for w, q in zip(loads, quota, strict=True)]
        if not any(above):
            break
        from_large = _loads(stays.where(large), shards)
        first = [1.1 * w < g for w, g in zip(above, from_large, strict=True)]
        base = [g if f else w for f, g, w in zip(first, from_large, loads, strict=True)]
        over = [min(1.0, (1.1 + turn) * w / g) if w else 0.0 for w, g in zip(above, base, strict=True)]
        if turn == 5:
            over, first = [float(w > 0) for w in above], [False] * shards
        goes = _chance(F.col("hub"), _portion(quota[0]), F.lit("out"), F.lit(turn)) < _by_shard(F.col("shard"), over)
        placed = checkpointed(placed.withColumn("out", F.col("out") | (goes & (large | ~_by_shard(F.col("shard"), first)))))
    else:
        loads = _loads(placed.where("not out"), shards)
    return placed.where("not out"), placed.where("out"), loads


def _filled(items: DataFrame, quota: list[int], loads: list[int], shards: int) -> DataFrame:
    """items (row, weight, key, out) with a shard: dealt along a line by weight, class by class, to the room that is left.

    What shards gave up (``out``) comes first and goes where most room is, so that it stays together.
    """
    counted = items.agg(F.count("*").alias("n"), F.sum("weight").alias("w")).first()
    mean = (counted["w"] or 0) / max(1, counted["n"])
    classes = F.lit(len(CLASSES))
    for k, times in reversed(list(enumerate(CLASSES))):
        classes = F.when(F.col("weight") > times * mean, k).otherwise(classes)
    items = items.withColumn("class", F.when(F.col("out"), -1).otherwise(classes))
    sums = {r["class"]: (r["n"], r["w"]) for r in items.groupBy("class").agg(F.count("*").alias("n"), F.sum("weight").alias("w")).collect()}
    room = [q - w for q, w in zip(quota, loads, strict=True)]
    done = None
    for k in sorted(sums):
        n, weight = sums[k]
        left = [max(0, r) for r in room]
        if k == max(sums):  # what is left must fit; earlier classes may have gone over by part of a document
            part = left
        elif k < 0:
            part, rest = [0] * shards, weight
            for s in sorted(range(shards), key=lambda s: -left[s]):
                part[s] = min(left[s], rest)
                rest -= part[s]
        else:
            part = [weight * r // max(1, sum(left)) for r in left]
        cuts, at = [], 0
        for p in part:
            at += p
            cuts.append(at)
        line = _ahead(items.where(F.col("class") == k), F.col("key"), ["key", "row"], F.col("weight"), _buckets(n))
        middle = 2 * F.col("ahead") + F.col("weight")
        shard = F.lit(shards - 1)
        for s in reversed(range(shards - 1)):
            shard = F.when(middle < 2 * cuts[s], s).otherwise(shard)
        dealt = checkpointed(line.withColumn("shard", shard).drop("ahead", "class", "out"))
        room = [r - w for r, w in zip(room, _loads(dealt, shards), strict=True)]
        done = dealt if done is None else done.unionByName(dealt)
    return done


def shard_documents(docs: DataFrame, links: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text", shards: int = 8, law: str = "bytes", rounds: int = ROUNDS) -> DataFrame:
    """One row per row of docs: id_col, size, text_crc32, law, shard, slot, grown_shard (null).

    ``law`` is ``bytes`` (sizes near equal) or ``rows`` (counts at most one apart). ``links`` (id_col, hub) links all documents of a
    hub; rows with nulls and repeats do not matter. Without it, equal texts are linked. Size is the text's bytes in UTF-8
    and one more; null text counts as empty. Rows that repeat an id, and null ids, are placed each. Ties go by hash.
    Very long texts count whole; a text larger than a quota makes its shard the largest. Other columns of docs
    are not read, whatever their names; an empty table gives no rows. ``shards`` is a small number: each is a column of a tally.
    """
    if law not in ("bytes", "rows"):
        raise ValueError("law is bytes or rows")
    text = F.coalesce(F.col(text_col), F.lit(""))
    own = F.unhex(F.sha2(text, 256)) if links is None else F.lit(None).cast("binary")
    nodes = docs.select(F.col(id_col).alias("id"), (F.octet_length(text).cast("long") + 1).alias("size"), F.crc32(text.cast("binary")).alias("crc"), own.alias("hub"))
    nodes = nodes.withColumns({"row": F.monotonically_increasing_id(), "weight": F.col("size") if law == "bytes" else F.lit(1).cast("long")})
    nodes = checkpointed(nodes)  # row numbers must not be drawn again
    counted = nodes.agg(F.count("*").alias("n"), F.sum("weight").alias("w")).first()
    total = counted["w"] or 0
    if links is None:
        hubs = checkpointed(nodes.groupBy("hub").agg(F.count("*").alias("many")).where("many > 1"))
        members = hot_join(nodes.select("row", "id", "weight", "hub"), hubs, "hub")
    else:
        given = links.select(F.col(id_col).alias("id"), links.columns[1 - links.columns.index(id_col)]).toDF("id", "hub").dropna().distinct()
        of = checkpointed(nodes.select("row", "weight", "id").join(given, "id"))
        hubs = checkpointed(of.groupBy("hub").agg(F.count("*").alias("many")).where("many > 1"))
        members = hot_join(of, hubs, "hub")
    members = checkpointed(members.select("row", "id", "weight", "hub"))
    quota, loads = quotas(total, shards), [0] * shards
    about = nodes.select("row", "id", "size", "crc")
    placed = None
    if members.isEmpty():
        items = nodes.select("row", "weight", F.xxhash64("row").alias("key"), F.lit(False).alias("out"))
    else:
        kept, out, loads = _within_quota(propagate(members, total, shards, rounds), quota, shards)
        placed = kept.select("row", "weight", "shard")
        alone = nodes.join(members.select("row").distinct(), "row", "left_anti").select("row", "weight", F.xxhash64("row").alias("key"), F.lit(False).alias("out"))
        items = checkpointed(alone.unionByName(out.select("row", "weight", F.xxhash64("hub", _portion(quota[0])).alias("key"), "out")))
    filled = _filled(items, quota, loads, shards)
    if filled is not None:
        filled = filled.select("row", "weight", "shard")
        placed = filled if placed is None else placed.unionByName(filled)
    if placed is None:
        placed = nodes.select("row", "weight", F.lit(0).alias("shard"))
    placed = checkpointed(about.join(placed, "row"))
    slots = _ahead(placed, F.xxhash64("row"), ["row"], F.lit(1).cast("long"), _buckets(counted["n"]), ("shard",))
    return slots.select(
        F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), F.lit(law).alias("law"), F.col("shard").cast("int").alias("shard"),
        F.col("ahead").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )

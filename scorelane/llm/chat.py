"""Chat formatting by quotation linking.

Messages are parsed into their own words and quoted passages by nesting level. Normalised passages are hashed
and joined to earlier messages of the conversation that hold them; the links give each message its parent, and
conversations come out in the order of replies, without the quotes.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import checkpointed, hot_join

_MARKS = re.compile(r"^(?:[ \t]*>)+[ \t]?")
#: Turns of a conversation are taken in blocks of so many, so that no task sorts a whole conversation or all replies to one message.
TURNS_A_BLOCK = 1_024


def parse(text: str | None) -> tuple[str, list[tuple[int, str]], list[str]]:
    """(own words, [(level, quoted passage)], own paragraphs and lines). A passage is a run of lines of one level."""
    own, passages, run, level = [], [], [], 0

    def close():
        if level and run:
            passages.append((level, "\n".join(run)))

    for line in re.split(r"\r\n|\r|\n", text or ""):
        mark = _MARKS.match(line)
        now = mark[0].count(">") if mark else 0
        if now != level:
            close()
            run, level = [], now
        if now:
            run.append(line[mark.end() :])
        else:
            own.append(line)
    close()
    body = "\n".join(own).strip("\n")
    units = {normal(body), *map(normal, re.split(r"\n\s*\n", body)), *map(normal, own)} - {""}
    return body, [(k, p) for k, p in passages if normal(p)], sorted(units)


def normal(passage: str) -> str:
    return " ".join(passage.lower().split())


def passage_hash(normalised: str) -> int:
    return int.from_bytes(hashlib.blake2b(normalised.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


_PARSED = "conv {}, turn long, role string, text string, n_quotes long, own array<long>, quoted array<struct<level:int,hash:long>>"


def _parsed(batches):
    """Rows as in _PARSED: own words, the hashes of their units, and those of the quoted passages and their lines."""
    pairs = pa.list_(pa.struct([("level", pa.int32()), ("hash", pa.int64())]))
    for batch in batches:
        bodies, many, own, quoted = [], [], [], []
        for text in batch.column(3).to_pylist():
            body, passages, units = parse(text)
            bodies.append(body)
            many.append(len(passages))
            own.append([passage_hash(u) for u in units])
            found = {(depth, unit) for depth, p in passages for unit in (normal(p), *map(normal, p.split("\n"))) if unit}
            quoted.append([{"level": depth, "hash": passage_hash(unit)} for depth, unit in sorted(found)])
        arrays = [*batch.columns[:3], pa.array(bodies, pa.string()), pa.array(many, pa.int64()), pa.array(own, pa.list_(pa.int64())), pa.array(quoted, pairs)]
        yield pa.RecordBatch.from_arrays(arrays, names=["conv", "turn", "role", "text", "n_quotes", "own", "quoted"])


def _block(turn: str = "turn"):
    return F.floor(F.col(turn) / TURNS_A_BLOCK)


def quotation_links(parsed: DataFrame) -> DataFrame:
    """Rows (conv, turn, level, source_turn): the latest earlier turn whose own words hold the quoted passage.

    An as-of step over the hashes that quotes and originals share: within each block of turns by one sorted pass, and
    from the latest of earlier blocks where there is none; never the pairs of a group.
    """
    placed = parsed.where("conv is not null and turn is not null")
    asked = placed.select("conv", "turn", F.inline("quoted"))
    held = placed.select("conv", "turn", F.lit(0).alias("level"), F.explode("own").alias("hash"))
    hashes = checkpointed(asked.unionByName(held).distinct().withColumn("block", _block()))
    keys = hashes.where("level > 0").select("conv", "hash").distinct()
    shared = checkpointed(hashes.join(keys, ["conv", "hash"], "left_semi"))
    source = F.when(F.col("level") == 0, F.col("turn"))
    earlier = Window.partitionBy("conv", "hash", "block").orderBy("turn").rangeBetween(Window.unboundedPreceding, -1)
    blocks = shared.groupBy("conv", "hash", "block").agg(F.max(source).alias("last"))
    before = Window.partitionBy("conv", "hash").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("older", F.max("last").over(before)).drop("last")
    found = shared.withColumn("near", F.max(source).over(earlier)).where("level > 0").join(blocks, ["conv", "hash", "block"])
    found = found.withColumn("source_turn", F.coalesce("near", "older"))
    return found.where("source_turn is not null").select("conv", "turn", "level", "source_turn")


def reply_trees(links: DataFrame, rounds: int = 64) -> DataFrame:
    """Rows (conv, turn, parent_turn, root_turn, depth): the parent is the latest source of the outermost linked quotes.

    Roots are found by pointer doubling, so the number of steps is the logarithm of the longest chain.
    """
    outer = links.groupBy("conv", "turn", "level").agg(F.max("source_turn").alias("source"))
    tree = outer.groupBy("conv", "turn").agg(F.min(F.struct("level", "source")).alias("first"))
    tree = tree.select("conv", "turn", F.col("first.source").alias("parent_turn"))
    tree = checkpointed(tree.select("*", F.col("parent_turn").alias("root_turn"), F.lit(1).cast("long").alias("depth")))
    for _ in range(rounds):
        above = tree.select("conv", F.col("turn").alias("root_turn"), F.col("root_turn").alias("up"), F.col("depth").alias("more"))
        # a root is no turn of the tree; those that point at one are done and need no join, however many they are
        inner = above.select("conv", "root_turn").join(tree.select("conv", "root_turn").distinct(), ["conv", "root_turn"], "left_semi")
        inner = checkpointed(inner)
        if inner.isEmpty():
            return tree
        sizes = tree.groupBy("conv", "root_turn").agg(F.count("*").alias("many")).join(above, ["conv", "root_turn"], "left")
        key = F.struct("conv", "root_turn").alias("key")
        named = checkpointed(sizes.select(key, "many", "up", "more"))
        joined = hot_join(tree.withColumn("key", key), named, "key")
        root, depth = F.coalesce("up", "root_turn"), F.col("depth") + F.coalesce("more", F.lit(0))
        tree = checkpointed(joined.select("conv", "turn", "parent_turn", root.alias("root_turn"), depth.alias("depth")))
    raise RuntimeError(f"reply chains did not end in {rounds} doublings")


def reading_order(turns: DataFrame, rounds: int = 64) -> DataFrame:
    """Rows (conv, root_turn, turn, place, total) for rows (conv, turn, weight, parent_turn, root_turn) of linked turns.

    ``place`` is the weight of what comes before a turn in its thread, in which each message is followed by its replies,
    theirs included, and those of one message come in the order of turns; ``total`` is the weight of the thread. The
    tour enters and leaves each turn; how much of it is left is found by pointer doubling.
    """
    replies = turns.where("parent_turn is not null").select("conv", "parent_turn", "turn", _block().alias("block"))
    near = Window.partitionBy("conv", "parent_turn", "block").orderBy("turn")
    far = Window.partitionBy("conv", "parent_turn").orderBy("block")
    firsts = replies.groupBy("conv", "parent_turn", "block").agg(F.min("turn").alias("first"))
    firsts = firsts.withColumn("later", F.lead("first").over(far))
    replies = replies.withColumn("next", F.lead("turn").over(near)).join(firsts, ["conv", "parent_turn", "block"])
    replies = checkpointed(replies.select("conv", "parent_turn", "turn", "first", F.coalesce("next", "later").alias("next")))
    child = replies.groupBy("conv", F.col("parent_turn").alias("turn")).agg(F.min("first").alias("child"))
    at = lambda turn, leaves: F.struct(F.col("conv"), F.col(turn).alias("turn"), F.lit(leaves).alias("leaves"))
    enter = turns.select("conv", "turn", "weight").join(child, ["conv", "turn"], "left")
    enter = enter.select(at("turn", False).alias("step"), F.when(F.col("child").isNull(), at("turn", True)).otherwise(at("child", False)).alias("to"), F.col("weight").alias("left"))
    onward = F.when(F.col("next").isNull(), at("parent_turn", True)).otherwise(at("next", False))
    leave = replies.select(at("turn", True).alias("step"), onward.alias("to"), F.lit(0).cast("long").alias("left"))
    ends = turns.where("parent_turn is null").select(at("turn", True).alias("step"), F.lit(0).cast("long").alias("left"))
    tour = checkpointed(enter.unionByName(leave).unionByName(ends.select("step", F.lit(None).cast(enter.schema["to"].dataType).alias("to"), "left")))
    for _ in range(rounds):
        on = tour.where("to is not null")
        if on.isEmpty():
            break
        above = tour.select(F.col("step").alias("to"), F.col("to").alias("on"), F.col("left").alias("more"))
        moved = on.join(above, "to").select("step", F.col("on").alias("to"), (F.col("left") + F.col("more")).alias("left"))
        tour = checkpointed(moved.unionByName(tour.where("to is null")))
    else:
        raise RuntimeError(f"reply chains did not end in {rounds} doublings")
    left = tour.where("not step.leaves").select(F.col("step.conv").alias("conv"), F.col("step.turn").alias("turn"), "left")
    placed = checkpointed(turns.join(left, ["conv", "turn"]).withColumn("key", F.struct("conv", "root_turn")))
    sizes = placed.groupBy("key").agg(F.count("*").alias("many"), F.max("left").alias("total"))
    placed = hot_join(placed, checkpointed(sizes), "key")
    return placed.select("conv", "root_turn", "turn", (F.col("total") - F.col("left")).alias("place"), "total")


def format_conversations(messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per message: conv_id, turn, position, role, parent_turn, root_turn, depth, n_quotes, text, formatted.

    A message without a linked quote starts a thread. Threads come in the order of their first turns; within one, each
    message is followed by its replies and theirs, replies to one message in the order of turns. ``position`` is the number
    of messages before it in the conversation; rows that repeat a turn share it, as they do parent and thread. ``text`` is
    without quotes. Null texts count as empty, a null role is ``unknown``. Messages with a null conversation or turn are
    never linked and have no position. Quotes of a message that only itself or later ones hold stay unlinked; of repeated
    quotes the latest source before the message counts. Very long texts are parsed whole. Other columns are not read;
    an empty table gives no rows.
    """
    kind = messages.schema[conv_col].dataType.simpleString()
    rows = messages.select(F.col(conv_col).alias("conv"), F.col(turn_col).cast("long").alias("turn"), F.coalesce(F.col(role_col).cast("string"), F.lit("unknown")).alias("role"), F.col(text_col).alias("text"))
    parsed = checkpointed(rows.mapInArrow(_parsed, _PARSED.format(kind)))
    tree = reply_trees(quotation_links(parsed))
    turns = parsed.where("conv is not null and turn is not null").groupBy("conv", "turn").agg(F.count("*").alias("weight"))
    turns = turns.join(tree, ["conv", "turn"], "left").withColumns({"root_turn": F.coalesce("root_turn", "turn"), "depth": F.coalesce("depth", F.lit(0)).cast("long")})
    parents = tree.select("conv", F.col("parent_turn").alias("turn")).distinct().withColumn("asked", F.lit(True))
    turns = checkpointed(turns.join(parents, ["conv", "turn"], "left"))
    linked = turns.where("asked or parent_turn is not null")
    alone = turns.where("asked is null and parent_turn is null").select("conv", "root_turn", "turn", F.lit(0).cast("long").alias("place"), F.col("weight").alias("total"))
    placed = alone if tree.isEmpty() else alone.unionByName(reading_order(linked.drop("asked", "depth")))
    placed = checkpointed(placed)
    # where each thread starts: within its block of turns, and after the blocks before
    threads = placed.where("turn = root_turn").select("conv", "root_turn", "total", _block("root_turn").alias("block"))
    before = lambda *by: Window.partitionBy("conv", *by[1:]).orderBy(by[0]).rowsBetween(Window.unboundedPreceding, -1)
    blocks = threads.groupBy("conv", "block").agg(F.sum("total").alias("sum"))
    blocks = blocks.select("conv", "block", F.coalesce(F.sum("sum").over(before("block")), F.lit(0)).alias("base"))
    threads = threads.withColumn("in", F.coalesce(F.sum("total").over(before("root_turn", "block")), F.lit(0)))
    threads = threads.join(blocks, ["conv", "block"]).select("conv", "root_turn", (F.col("base") + F.col("in")).alias("start"))
    sizes = placed.groupBy("conv", "root_turn").agg(F.count("*").alias("many")).join(threads, ["conv", "root_turn"])
    key = F.struct("conv", "root_turn").alias("key")
    starts = checkpointed(sizes.select(key, "many", "start"))
    placed = hot_join(placed.withColumn("key", key), starts, "key").select("conv", "turn", (F.col("start") + F.col("place")).alias("position"))
    turns = turns.select("conv", "turn", "parent_turn", "root_turn", "depth", F.col("weight").alias("many")).join(placed, ["conv", "turn"])
    turns = checkpointed(turns.select(F.struct("conv", "turn").alias("key"), "many", "parent_turn", "root_turn", "depth", "position"))
    whole = F.col("conv").isNotNull() & F.col("turn").isNotNull()
    columns = ["conv", "turn", "role", "text", "n_quotes"]
    done = hot_join(parsed.where(whole).select(F.struct("conv", "turn").alias("key"), *columns), turns, "key").drop("key")
    lost = parsed.where(~whole).select(*columns, F.lit(None).cast("long").alias("parent_turn"), F.col("turn").alias("root_turn"), F.lit(0).cast("long").alias("depth"), F.lit(None).cast("long").alias("position"))
    return done.unionByName(lost).select(
        F.col("conv").alias(conv_col),
        F.col("turn").alias(turn_col),
        "position",
        F.col("role").alias(role_col),
        "parent_turn",
        "root_turn",
        "depth",
        "n_quotes",
        F.col("text").alias(text_col),
        F.concat(F.lit("<|"), "role", F.lit("|>\n"), "text", F.lit("\n")).alias("formatted"),
    )

"""Keyed state on plain tables: merges, replace-sets, ledgers and locks as DataFrame operations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest(batch: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """One row per key: the last in order."""
    w = Window.partitionBy(*key).orderBy(*order)
    return batch.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


def merge(old: DataFrame, new: DataFrame, key: list[str], keep: tuple = (), fill: tuple = ()) -> DataFrame:
    """Upsert of a batch with one row per key. Columns take the new value; ``keep`` ones the old if there was a
    row; ``fill`` ones the new if it is not null, else the old."""
    o, n = old.alias("o"), new.alias("n")
    joined = o.join(n, [F.col(f"o.{k}") == F.col(f"n.{k}") for k in key], "full_outer")
    fresh = F.col(f"n.{key[0]}").isNotNull()

    def value(c: str) -> Column:
        a, b = F.col(f"o.{c}"), F.col(f"n.{c}") if c in new.columns else F.lit(None)
        if c in key or c in fill:
            return F.coalesce(b, a).alias(c)
        if c in keep:
            return F.when(F.col(f"o.{key[0]}").isNotNull(), a).otherwise(b).alias(c)
        return (F.when(fresh, b).otherwise(a) if c in new.columns else a).alias(c)

    return joined.select(*[value(c) for c in old.columns])


def replace_set(old: DataFrame, new: DataFrame, owner: list[str]) -> DataFrame:
    """Rows of the owners in the batch are replaced as a whole; others stay."""
    return old.join(new.select(*owner).distinct(), owner, "left_anti").unionByName(new)


def insert_ignore(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """Rows whose key is there already are ignored."""
    return old.unionByName(new.join(old.select(*key), key, "left_anti"))


def quarantine(rows: DataFrame, owner: list[str], bad: Column) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected): an owner with one bad row is rejected whole."""
    marked = rows.where(bad).select(*owner).distinct()
    return rows.join(marked, owner, "left_anti"), rows.join(marked, owner, "left_semi")


def roster_changes(rosters: DataFrame, team: str, order: str, roster: str) -> DataFrame:
    """Adds previous and changed: whether the roster differs from the team's one before."""
    previous = F.lag(roster).over(Window.partitionBy(team).orderBy(order))
    return rosters.withColumns({"previous": previous, "changed": previous.isNotNull() & (previous != F.col(roster))})


def roster_key(ids: Column) -> Column:
    """Ids in numeric order, joined by semicolons."""
    return F.array_join(F.transform(F.sort_array(ids), lambda x: x.cast("string")), ";")


def run_ledger(log: DataFrame, key: str, order: list[str], status: str, message: str) -> DataFrame:
    """The latest status and message of each run, and its first and last instants."""
    last = F.max_by(F.struct(status, message), F.struct(*order)).alias("l")
    return log.groupBy(key).agg(F.min(order[0]).alias("created_at"), F.max(order[0]).alias("finished_at"), last).select(key, "created_at", "finished_at", "l.*")


def _next_at(asks: DataFrame, marks: DataFrame, keys: list[str], block_ms: int) -> DataFrame:
    """asks (keys, at, tie, ...) with ``then``, the (at, tie) of the first mark after each, if any.

    Within blocks of time by one sorted pass, and from the first of later blocks where there is none: no task sorts all
    rows of a key.
    """
    place = F.struct("at", "tie")
    block = F.floor(F.col("at") / block_ms).alias("block")
    both = asks.select("*", block, F.lit(None).cast("struct<at:bigint,tie:bigint>").alias("mark"))
    both = both.unionByName(marks.select(*keys, "at", "tie", block, place.alias("mark")), allowMissingColumns=True)
    # from the last to the first: a frame that begins at the end only grows, one that ends there is added up anew for each row
    near = Window.partitionBy(*keys, "block").orderBy(F.desc("at"), F.desc("tie")).rowsBetween(Window.unboundedPreceding, -1)
    near = both.withColumn("near", F.min("mark").over(near)).where("mark is null").drop("mark")
    firsts = both.groupBy(*keys, "block").agg(F.min("mark").alias("first"))
    later = Window.partitionBy(*keys).orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    firsts = firsts.withColumn("later", F.min("first").over(later)).drop("first")
    return near.join(firsts, [*keys, "block"]).withColumn("then", F.coalesce("near", "later")).drop("near", "later", "block")


def lock_timeline(events: DataFrame, key: str, at_ms: str, action: str, token: str, ttl_ms: int, tie: str, block_ms: int = 86_400_000, rounds: int = 64) -> DataFrame:
    """Adds acquired (for acquire events) to acquire and release events of locks, each taken in order.

    A lock is taken if it is free or its time to live is over strictly before now, and released only by the token
    that holds it. ``tie`` (whole numbers, unique) orders events of one instant.

    Were an acquire to succeed, the next success would be the first acquire after its own token's next release or after its
    time is over, whatever came before. So every acquire points at one other, and those that the first acquire of a lock
    leads to succeed; they are found by pointer doubling, in as many joins as the logarithm of the successes of a lock.
    """
    from scorelane.sources.files import checkpointed

    rows = events.select(F.struct("*").alias("row"), F.col(key).alias("lock"), F.col(at_ms).cast("long").alias("at"), F.col(tie).cast("long").alias("tie"), F.col(action).alias("what"), F.col(token).alias("who"))
    rows = checkpointed(rows)
    acquires = rows.where("what = 'acquire'").select("lock", "at", "tie", "who")
    releases = rows.where("what <> 'acquire'").select("lock", "at", "tie", "who")
    freed = _next_at(acquires, releases, ["lock", "who"], block_ms).withColumnRenamed("then", "freed").drop("who")
    last = F.lit(2**63 - 1)
    marks = acquires.drop("who")
    after = lambda at, tie: freed.select("lock", at.alias("at"), tie.alias("tie"), F.struct("at", "tie").alias("own"))
    by_release = _next_at(after(F.col("freed.at"), F.col("freed.tie")).where("at is not null"), marks, ["lock"], block_ms).select("lock", "own", "then")
    by_time = _next_at(after(F.col("at") + ttl_ms, last), marks, ["lock"], block_ms).select("lock", "own", "then")
    to = by_release.unionByName(by_time).groupBy("lock", "own").agg(F.min("then").alias("to"))
    to = checkpointed(to)
    won = checkpointed(acquires.groupBy("lock").agg(F.min(F.struct("at", "tie")).alias("own")))
    jump = to.where("to is not null")
    for _ in range(rounds):
        ahead = won.join(jump, ["lock", "own"]).select("lock", F.col("to").alias("own"))
        fresh = checkpointed(ahead.join(won, ["lock", "own"], "left_anti"))
        if fresh.isEmpty():
            break
        won = checkpointed(won.unionByName(fresh))
        on = jump.select("lock", F.col("own").alias("to"), F.col("to").alias("on"))
        jump = checkpointed(jump.join(on, ["lock", "to"]).select("lock", "own", F.col("on").alias("to")))
    else:
        raise RuntimeError(f"the successes did not end in {rounds} doublings")
    won = won.select("lock", "own.at", "own.tie", F.lit(True).alias("won"))
    acquired = F.when(F.col("what") == "acquire", F.coalesce("won", F.lit(False)))
    return rows.join(won, ["lock", "at", "tie"], "left").withColumn("acquired", acquired).select("row.*", "acquired")


def record_demos(matches: DataFrame, artifacts: DataFrame, demos: DataFrame, key: str = "match_id") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(matches, artifacts, missing) after demos (match_id, demo_key, demo_url, byte_size) are recorded.

    A match that is there takes the key and URL, and an artifact of kind ``demo`` is written or written over; demos of a
    match that is not there are returned as missing and change nothing.
    """
    known = demos.join(matches.select(key), key, "left_semi")
    updated = merge(matches, known.select(key, "demo_key", "demo_url"), [key])
    made = known.select(key, F.lit("demo").alias("kind"), F.col("demo_key").alias("object_key"), "byte_size")
    return updated, merge(artifacts, made, [key, "kind"]), demos.join(matches.select(key), key, "left_anti")


def append_new(old: DataFrame, new: DataFrame, key: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows after a plain append, rows refused because their key is there already, or came first in the batch).

    Of a key's rows in the batch the smallest comes first; of equal ones, one is taken and the others are refused.
    """
    many = new.groupBy(*new.columns).agg(F.count("*").alias("copies"))  # aggregated before the shuffle, whatever a key holds
    row = F.struct(*new.columns)
    firsts = many.groupBy(*key).agg(F.min(row).alias("first"))
    known = old.select(*key).distinct().withColumn("known", F.lit(True))
    marked = many.join(firsts, key).join(known, key, "left").withColumn("taken", (row == F.col("first")) & F.col("known").isNull())
    refused = marked.withColumn("n", F.col("copies") - F.col("taken").cast("int")).where("n > 0").withColumn("again", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
    return old.unionByName(marked.where("taken").select(*old.columns)), refused.select(*new.columns)


def record_html(artifacts: DataFrame, new: DataFrame) -> DataFrame:
    """artifacts (kind, object_key, match_id, source_url, byte_size, checksum, status, created_at, updated_at) with stored pages.

    ``new`` has a row a key; a page stored again under its key is written over, but for the instant of creation.
    """
    rows = new.withColumns({"kind": F.lit("raw_html"), "status": F.lit("stored"), "created_at": F.col("updated_at")})
    return merge(artifacts, rows.select(*artifacts.columns), ["kind", "object_key"], keep=("created_at",))


def distinct_union(*tables: DataFrame) -> DataFrame:
    """The unlike rows of all tables."""
    rows = tables[0]
    for more in tables[1:]:
        rows = rows.unionByName(more)
    return rows.distinct()

"""Global orders without a global sort in one task: row numbers, prefix scans over groups, exact nearest ranks."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scorelane.sources.files import checkpointed

#: Rows of a range partition, about.
ROWS_A_PART = 1_000_000
#: Parts of an interval in each round of a selection.
HISTOGRAM = 4096
#: Groups up to which their bounds are broadcast, some 20 MB; more are joined by shuffle.
BROADCAST_GROUPS = 100_000


def range_parts(rows: DataFrame, order: list[Column], rows_a_part: int = ROWS_A_PART) -> DataFrame:
    """rows with ``part``, ascending along the order; rows of equal keys share a part, so end the order with a tie-break."""
    many = max(1, -(-rows.count() // rows_a_part))
    return checkpointed(rows.repartitionByRange(many, *order).withColumn("part", F.spark_partition_id()))


def prefix_scan(rows: DataFrame, order: list[Column], sums: dict[str, Column], group: list[str] | None = None, rows_a_part: int = ROWS_A_PART) -> DataFrame:
    """rows with the inclusive running sums of whole-number or other additive columns, in order within each group.

    A scan within range partitions of (group, order); a group may lie in any number of parts. Of a part only its first group may
    have begun before, so what is carried in is a row a part at most, which is broadcast: rows are shuffled once, as they
    came. Ties in order go as they fall: end the order with a unique column. Null keys come first, as Spark sorts them.
    """
    keys = [F.col(g) for g in group or []]
    names = list(sums)
    parts = range_parts(rows, [*keys, *order], rows_a_part).withColumns({f"{n}__in": v for n, v in sums.items()})
    cells = ["part", *(group or [])]
    inner = Window.partitionBy(*cells).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    scanned = parts.withColumns({n: F.sum(f"{n}__in").over(inner) for n in names}).drop(*[f"{n}__in" for n in names])
    totals = parts.groupBy(*cells).agg(*[F.sum(f"{n}__in").alias(n) for n in names])
    earlier = Window.partitionBy(*(group or [])).orderBy("part")
    before = earlier.rowsBetween(Window.unboundedPreceding, -1)
    carries = totals.select(*cells, F.row_number().over(earlier).alias("__nth"), *[F.sum(n).over(before).alias(f"{n}__before") for n in names]).where("__nth > 1")
    carries = carries.select(*[F.col(c).alias(f"{c}__of") for c in cells], *[f"{n}__before" for n in names])
    met = scanned.join(F.broadcast(carries), [F.col(c).eqNullSafe(F.col(f"{c}__of")) for c in cells], "left")
    return met.select(*rows.columns, *[(F.col(n) + F.coalesce(F.col(f"{n}__before"), F.lit(0))).alias(n) for n in names])


def numbered(rows: DataFrame, order: list[Column], name: str = "place", rows_a_part: int = ROWS_A_PART) -> DataFrame:
    """rows with their place from 1 in one global order."""
    return prefix_scan(rows, order, {name: F.lit(1).cast("long")}, rows_a_part=rows_a_part)


def nearest_ranks(rows: DataFrame, by: str, value: str, shares: dict[str, str], parts: int = HISTOGRAM) -> DataFrame:
    """Per group and share p (written as decimal text) the value of rank ceil(p * n), in columns named by ``shares``.

    Exact and without a group in one buffer: each round counts the values of an interval in ``parts`` equal parts and goes on
    with the part that holds the rank, from its least to its largest value, until these are equal. Nulls and NaN count as
    no value; a group without values is left out. A null group counts as one.
    """
    at = list(shares)
    rows = rows.select(F.col(by).alias("g"), F.col(value).alias("v")).where(F.col("v").isNotNull() & ~F.isnan(F.col("v").cast("double")))
    state = rows.groupBy("g").agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    least = lambda p: F.greatest(F.lit(1), F.ceil(F.lit(Decimal(p)) * F.col("n"))).cast("long")
    asked = F.array(*[F.struct(F.lit(k).alias("k"), least(p).alias("rank")) for k, p in enumerate(shares.values())])
    state = checkpointed(state.select("g", F.explode(asked).alias("a"), "lo", "hi").select("g", "a.k", "a.rank", "lo", "hi"))
    for _ in range(2200 // max(1, parts.bit_length() - 1) + 1):  # doubles span fewer than 2200 binary places
        open_ = state.where("lo < hi")
        if open_.isEmpty():
            break
        wanted = open_.groupBy(F.col("g").alias("of")).agg(F.collect_list(F.struct("k", "lo", "hi")).alias("asked"))  # as many as shares
        few = wanted.count() <= BROADCAST_GROUPS
        met = rows.join(F.broadcast(wanted) if few else wanted, F.col("g").eqNullSafe(F.col("of")))
        met = met.select("g", "v", F.explode("asked").alias("a")).where(F.col("v").between(F.col("a.lo"), F.col("a.hi")))
        half = lambda x: x.cast("double") / 2  # noqa: E731 (the width of an interval may be beyond a double)
        cell = F.floor((half(F.col("v")) - half(F.col("a.lo"))) / (half(F.col("a.hi")) - half(F.col("a.lo"))) * parts)
        counts = met.groupBy("g", F.col("a.k").alias("k"), cell.alias("cell")).agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
        upto = Window.partitionBy("g", "k").orderBy("cell").rowsBetween(Window.unboundedPreceding, 0)  # parts rows at most
        counts = counts.withColumn("upto", F.sum("n").over(upto)).withColumnsRenamed({"g": "g2", "k": "k2", "lo": "lo2", "hi": "hi2"})
        met = open_.join(counts, F.col("g").eqNullSafe(F.col("g2")) & (F.col("k") == F.col("k2")) & (F.col("upto") >= F.col("rank")) & (F.col("upto") - F.col("n") < F.col("rank")))
        narrowed = met.select("g", "k", (F.col("rank") - (F.col("upto") - F.col("n"))).alias("rank"), F.col("lo2").alias("lo"), F.col("hi2").alias("hi"))
        state = checkpointed(state.where("lo = hi").unionByName(narrowed))
    else:
        raise RuntimeError("a selection did not end")
    return state.groupBy(F.col("g").alias(by)).agg(*[F.max(F.when(F.col("k") == k, F.col("lo"))).alias(name) for k, name in enumerate(at)])


def as_of(left: DataFrame, right: DataFrame, key: str, left_at: str, right_at: str, columns: list[str], rows_a_part: int = ROWS_A_PART) -> DataFrame:
    """left with ``columns`` of the last row of right with its key that is strictly earlier; nulls where there is none.

    Both are scanned in one order: a row of left gets the number of right's rows before it, and an equi-join on key and
    number does the rest, so no key lies in one task. Of right's rows of one instant the greatest by columns counts. Rows
    of right without an instant count for none, rows of left without one get nulls; a null key is one key.
    """
    rows = right.where(F.col(right_at).isNotNull()).select(F.col(key).alias("k"), F.col(right_at).alias("at"), F.struct(*columns).alias("v"))
    both = left.select(F.struct("*").alias("l"), F.col(key).alias("k"), F.col(left_at).alias("at"), F.lit(0).alias("kind"))
    both = both.unionByName(rows.withColumn("kind", F.lit(1)), allowMissingColumns=True)
    both = prefix_scan(both, [F.col("at"), F.col("kind"), F.col("v")], {"upto": F.col("kind").cast("long")}, ["k"], rows_a_part)
    found = both.where("kind = 1").select(F.col("k").alias("k2"), F.col("upto").alias("n"), F.col("v").alias("found"))
    met = both.where("kind = 0").join(found, F.col("k").eqNullSafe(F.col("k2")) & (F.col("upto") == F.col("n")), "left")
    return met.select("l.*", *[F.col(f"found.{c}").alias(c) for c in columns])

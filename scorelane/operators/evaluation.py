"""Evaluation: nearest-rank summaries, accuracy, staleness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorelane.operators.ordering import ROWS_A_PART, nearest_ranks, prefix_scan

#: Games after which a run of accuracy ends.
STOP = 5001


def sample_summary(rows: DataFrame, by: str, value: str) -> DataFrame:
    """Count, total, mean, median, p95, least and most per group; percentiles are nearest ranks.

    Null values do not count; a group of nulls alone has n 0 and nulls.
    """
    sums = rows.groupBy(by).agg(F.count(value).alias("n"), F.round(F.sum(value), 4).alias("total"), F.round(F.avg(value), 4).alias("avg"), F.min(value).alias("least"), F.max(value).alias("most"))
    ranks = nearest_ranks(rows, by, value, {"median": "0.5", "p95": "0.95"}).withColumnRenamed(by, "of")
    return sums.join(ranks, F.col(by).eqNullSafe(F.col("of")), "left").select(by, "n", "total", "avg", "median", "p95", "least", "most")


def speed_up(rows: DataFrame, kind: str, value: str, cold: str, warm: str) -> DataFrame:
    total = lambda k: F.sum(F.when(F.col(kind) == k, F.col(value)))
    sums = rows.agg(total(cold).alias("cold"), total(warm).alias("warm"))
    return sums.select(F.round(F.col("cold") - F.col("warm"), 2).alias("delta"), F.round(F.col("cold") / F.nullif("warm", F.lit(0.0)), 2).alias("ratio"))


def running_accuracy(rows: DataFrame, group: str, order: str, p: Column, first_won: Column, rows_a_part: int = ROWS_A_PART) -> DataFrame:
    """Share of right predictions so far, by place in order within each group; ties and even predictions count as places only."""
    return prequential(rows, [F.col(order)], p, first_won, None, [group], rows_a_part).withColumn("accuracy", F.round("accuracy", 6))


def prequential(rows: DataFrame, order: list[Column], p: Column, first_won: Column, stop: int | None = STOP, group: list[str] | None = None, rows_a_part: int = ROWS_A_PART) -> DataFrame:
    """rows with place and accuracy, the share of right predictions up to each, in one order (or one for each group).

    A game without a winner (null) and a prediction of a half are places, but neither right nor reported, and the first
    place is not reported. Nothing counts after ``stop`` places. Scanned in range partitions, so no order lies in one task.
    """
    decided = first_won.isNotNull() & (p != 0.5)
    right = F.when(decided & ((p > 0.5) == first_won), 1).otherwise(0).cast("long")
    marked = prefix_scan(rows.withColumn("__decided", decided), order, {"place": F.lit(1).cast("long"), "__right": right}, group, rows_a_part)
    marked = marked.where("__decided and place > 1")
    if stop is not None:
        marked = marked.where(F.col("place") <= stop)
    return marked.withColumn("accuracy", F.col("__right") / F.col("place")).drop("__right", "__decided")


def stale(rows: DataFrame, by: str, ts: str, now: Column, hours: float) -> DataFrame:
    return rows.groupBy(by).agg(F.max(ts).alias("last_seen")).withColumn("stale", F.col("last_seen") < now - F.expr(f"INTERVAL '{int(hours * 3600)}' SECOND"))


def first_results(predictions: DataFrame, results: DataFrame, key: list[str], order: str, decisive: Column) -> DataFrame:
    """Each prediction with the first decisive result of its key, if any; ``decisive`` is over columns of results."""
    columns = [c for c in results.columns if c not in key]
    first = results.where(decisive).groupBy(*key).agg(F.min_by(F.struct(*columns), order).alias("r"))
    return predictions.join(first.select(*key, "r.*"), key, "left")


def overall_accuracy(rows: DataFrame, right: Column) -> DataFrame:
    """Right, wrong, and the percentage of right among both; rows where ``right`` is null count as neither."""
    counts = rows.agg(F.count_if(right).alias("good"), F.count_if(~right).alias("bad"))
    return counts.withColumn("percent", F.round(100.0 * F.col("good") / F.nullif(F.col("good") + F.col("bad"), F.lit(0)), 4))


def distinct_records(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Unlike records, as JSON text."""
    return rows.select(F.to_json(F.struct(*columns)).alias("record")).distinct()


def pick_sides(odds1: Column, odds2: Column) -> Column:
    """The side (0 or 1) of the larger odds, and that of the favourite; the first of equal ones."""
    return F.struct(F.when(odds1 >= odds2, 0).otherwise(1).alias("max_odds_side"), F.when(odds1 <= odds2, 0).otherwise(1).alias("favourite_side"))


def last_rows(rows: DataFrame, order: str, n: int) -> DataFrame:
    """The last n rows, latest first."""
    return rows.orderBy(F.col(order).desc()).limit(n)


def player_features(games: DataFrame, player: str, kind: str, value: str, ts: str, wanted: str, since: Column) -> DataFrame:
    """Per player: games of the wanted kind, value since an instant, and the number of kinds."""
    late = F.when(F.col(ts) >= since, F.col(value))
    return games.groupBy(player).agg(
        F.count_if(F.col(kind) == wanted).alias("clicks"), F.round(F.sum(late), 4).alias("late_value"), F.count_distinct(kind).alias("kinds")
    )


def latest_value(rows: DataFrame, by: list, value: str, order: list[str], name: str) -> DataFrame:
    """The value of the last row in order of each group."""
    return rows.groupBy(*by).agg(F.max_by(value, F.struct(*order)).alias(name))


def alerts(staleness: DataFrame, last: DataFrame, by: str, now: Column, hours: float, alerted: str = "alerted_at") -> DataFrame:
    """Stale groups whose last alert, if any, is longer ago than so many hours."""
    ago = now - F.expr(f"INTERVAL '{int(hours * 3600)}' SECOND")
    due = staleness.where("stale").join(last.select(by, alerted), by, "left")
    return due.where(F.col(alerted).isNull() | (F.col(alerted) < ago))

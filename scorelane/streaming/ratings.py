"""Ratings as a stream: games come in micro-batches, players' ratings and a high-water mark a league are kept between them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scorelane.operators.ordering import BROADCAST_GROUPS
from scorelane.operators.ratings import gaussian_replay

GAME = ("league", "game_id", "players1", "players2", "first_won")


def judged(games: DataFrame, marks: DataFrame | None, size: int = 5) -> DataFrame:
    """games with outcome: refused at or below the league's mark (league, mark) or if the id came before, rated with ``size`` a side, else skipped.

    Of rows that share league and id the first by a hash counts, so a batch that is run again gives the same.
    """
    again = Window.partitionBy("league", "game_id").orderBy(F.xxhash64(*GAME))
    rows = games.withColumn("turn", F.row_number().over(again))
    if marks is None:
        rows = rows.withColumn("mark", F.lit(None).cast("long"))
    else:
        rows = rows.join(F.broadcast(marks) if marks.count() <= BROADCAST_GROUPS else marks, "league", "left")
    whole = (F.size("players1") == size) & (F.size("players2") == size)
    outcome = F.when((F.col("turn") > 1) | F.coalesce(F.col("game_id") <= F.col("mark"), F.lit(False)), "refused").when(F.coalesce(whole, F.lit(False)), "rated").otherwise("skipped")
    return rows.select(*GAME, outcome.alias("outcome"))


def rate_stream(games: DataFrame, out: str, checkpoint: str, league: str = "league", size: int = 5, **sizes) -> None:
    """Rates what is there and ends; a later run with the same checkpoint goes on from the ratings and the marks.

    ``games`` is a stream of league, game_id long, players1, players2 and first_won; below ``out`` comes a row a game with p and
    outcome. Ids must rise from batch to batch within a league; within one they are put in order. Refused and skipped games
    change nothing but that a skipped one passes the mark. Games of a null id are left out. A batch is replayed as a table
    (see ``replay``, also for ``sizes``), so it may have any number of games. It reads what the batch before it left and
    writes beside it: one that is run again starts from the same ratings, and writes over its own rows.
    """

    def batch(df: DataFrame, number: int) -> None:
        spark = df.sparkSession
        left, makes = (f"{checkpoint}/ratings/{k % 2}" for k in (number - 1, number))
        known, marks = (spark.read.parquet(f"{left}/{x}") if number else None for x in ("players", "marks"))
        keyed = df.where("game_id is not null").select(F.coalesce(F.col(league).cast("string"), F.lit("")).alias("league"), *GAME[1:])
        rows = judged(keyed, marks, size)
        predicted, players = gaussian_replay(rows.where("outcome = 'rated'"), known=known, **sizes)
        predicted = predicted.select("league", "game_id", "p", "first_won", F.lit("rated").alias("outcome"))
        others = rows.where("outcome <> 'rated'").select("league", "game_id", F.lit(None).cast("double").alias("p"), "first_won", "outcome")
        predicted.unionByName(others).write.mode("overwrite").parquet(f"{out}/batch={number}")
        players.select("league", "player", "mu", "sigma").write.mode("overwrite").parquet(f"{makes}/players")
        passed = keyed.groupBy("league").agg(F.max("game_id").alias("mark"))
        passed = passed if marks is None else passed.unionByName(marks).groupBy("league").agg(F.max("mark").alias("mark"))
        passed.write.mode("overwrite").parquet(f"{makes}/marks")

    query = games.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()

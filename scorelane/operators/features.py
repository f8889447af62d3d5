"""Features of players that are known before each game: form of the last months, form on the map, rating, age of the roster."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scorelane.operators.ordering import BROADCAST_GROUPS, ROWS_A_PART, as_of, prefix_scan, range_parts
from scorelane.operators.state import roster_key
from scorelane.sources.files import checkpointed

SUMS = ("games", "wins", "kills", "headshots", "damage")


def recent_sums(rows: DataFrame, months: int, rows_a_part: int = ROWS_A_PART) -> DataFrame:
    """Per (game_id, player) the SUMS over the player's games of the last months, without those of the same instant.

    A window is the difference of two prefix sums: what lies before the game, less what lies before the window. Both are
    probes in one scan by player and instant, so a player's games may lie in any number of tasks.
    """
    # a probe has no sums of its own, and its place for them is one null
    no = F.lit(None).cast(f"struct<{', '.join(f'{c}: bigint' for c in SUMS)}>").alias("own")
    own = [F.lit(1).cast("long").alias("games"), F.col("won").cast("long").alias("wins"), *[F.coalesce(F.col(c).cast("long"), F.lit(0)).alias(c) for c in SUMS[2:]]]
    played = rows.select("player", "game_id", F.col("ts").alias("at"), F.lit(2).alias("kind"), F.struct(*own).alias("own"))
    until = rows.select("player", "game_id", F.col("ts").alias("at"), F.lit(1).alias("kind"), no)
    since = rows.select("player", "game_id", (F.col("ts") - F.expr(f"INTERVAL {months} MONTHS")).alias("at"), F.lit(0).alias("kind"), no)
    both = played.unionByName(until).unionByName(since)
    named = {f"{c}_upto": F.coalesce(F.col(f"own.{c}"), F.lit(0)) for c in SUMS}
    # what is played at an instant comes after all probes of that instant
    both = prefix_scan(both, [F.col("at"), F.col("kind"), F.col("game_id")], named, ["player"], rows_a_part).where("kind < 2")
    less = lambda c: F.sum(F.when(F.col("kind") == 1, F.col(c)).otherwise(-F.col(c)))
    return both.groupBy("game_id", "player").agg(*[less(f"{c}_upto").alias(c) for c in SUMS])


def map_form(rows: DataFrame, games: int, rows_a_part: int = ROWS_A_PART) -> DataFrame:
    """Per (game_id, player) the share won of the player's last ``games`` earlier games on the map; null without any."""
    seen = prefix_scan(rows.select("game_id", "player", "map", "ts", F.col("won").cast("long").alias("won")), [F.col("ts"), F.col("game_id")], {"place": F.lit(1).cast("long"), "wins": F.col("won")}, ["player", "map"], rows_a_part)
    back = seen.select(F.col("player").alias("p"), F.col("map").alias("m"), (F.col("place") + games + 1).alias("at"), F.col("wins").alias("before"))
    met = seen.join(back, (F.col("player") == F.col("p")) & (F.col("map") == F.col("m")) & (F.col("place") == F.col("at")), "left")
    wins, many = F.col("wins") - F.col("won") - F.coalesce("before", F.lit(0)), F.least(F.col("place") - 1, F.lit(games))
    return met.select("game_id", "player", (wins / F.nullif(many, F.lit(0))).alias("map_win_rate"))


def roster_age(rows: DataFrame, rows_a_part: int = ROWS_A_PART) -> DataFrame:
    """Per (game_id, team) the seconds since the team's roster last changed, 0 in the game that changes it; null before any change.

    One scan by team and instant: what a part needs of those before it, the team's last roster and change, is a row a part.
    """
    rosters = rows.groupBy("team", "game_id").agg(F.min("ts").alias("ts"), roster_key(F.collect_set("player")).alias("roster"))  # of one game
    placed = range_parts(rosters, [F.col("team"), F.col("ts"), F.col("game_id")], rows_a_part)
    inner, cells = Window.partitionBy("part", "team").orderBy("ts", "game_id"), Window.partitionBy("team").orderBy("part")
    here = (F.col("part") == F.col("p")) & F.col("team").eqNullSafe(F.col("t"))
    ends = placed.groupBy("part", "team").agg(F.max_by(F.struct("roster"), F.struct("ts", "game_id")).alias("end"))
    carried = ends.select(F.col("part").alias("p"), F.col("team").alias("t"), F.lag("end").over(cells).alias("carried")).where("carried is not null")
    previous = F.coalesce(F.lag(F.struct("roster")).over(inner), F.col("carried"))
    seen = placed.join(F.broadcast(carried), here, "left").withColumn("previous", previous)
    seen = seen.select("part", "team", "game_id", "ts", F.coalesce(F.col("previous.roster") != F.col("roster"), F.lit(False)).alias("changed"))
    at = F.max_by(F.when(F.col("changed"), F.struct("ts")), F.when(F.col("changed"), F.struct("ts", "game_id")))
    changes = seen.groupBy("part", "team").agg(at.alias("at"))
    earlier = changes.select(F.col("part").alias("p"), F.col("team").alias("t"), F.last("at", True).over(cells.rowsBetween(Window.unboundedPreceding, -1)).alias("earlier")).where("earlier is not null")
    own = F.last(F.when(F.col("changed"), F.struct("ts")), True).over(inner.rowsBetween(Window.unboundedPreceding, 0))
    met = seen.join(F.broadcast(earlier), here, "left").withColumn("since", F.coalesce(own, F.col("earlier"))["ts"])
    seconds = F.unix_micros(F.col("ts").cast("timestamp")) - F.unix_micros(F.col("since").cast("timestamp"))
    return met.select("game_id", "team", F.floor(seconds / 1_000_000).alias("roster_seconds"))


def of_players(rows: DataFrame, ratings: DataFrame, months: int, map_games: int, rows_a_part: int = ROWS_A_PART) -> DataFrame:
    """Per (game_id, player) the team, the rating mu, the SUMS of ``recent_sums`` and map_win_rate, for players whose games fit a task.

    Games and ratings are dealt by player, once; probes are made and met where they lie.
    """
    counts = [F.coalesce(F.col(c).cast("long"), F.lit(0)).alias(c) for c in SUMS[2:]]
    games = rows.select("player", F.col("ts").alias("at"), "game_id", "team", "map", F.lit(1).cast("long").alias("games"), F.col("won").cast("long").alias("wins"), *counts)
    told = ratings.where(F.col("at").isNotNull()).select("player", "at", F.struct(F.col("mu")).alias("told"))
    both = games.unionByName(told, allowMissingColumns=True).where("player is not null")
    many = max(rows.sparkSession.sparkContext.defaultParallelism, -(-rows.count() // rows_a_part))
    both = both.repartition(many, "player")
    played = F.col("games").isNotNull()
    form = Window.partitionBy("player", "map", "games").orderBy("at", "game_id").rowsBetween(-map_games, -1)
    both = both.withColumn("map_win_rate", F.when(played, F.sum("wins").over(form) / F.nullif(F.count("*").over(form), F.lit(0))))
    kinds = lambda *ks: F.array(*[F.struct(F.lit(k).alias("kind"), (F.col("at") - F.expr(f"INTERVAL {months} MONTHS") if k == 0 else F.col("at")).alias("at")) for k in ks])
    both = both.withColumn("k", F.explode(F.when(played, kinds(0, 1, 2)).otherwise(kinds(2)))).drop("at").select("*", "k.*").drop("k")
    # what is played or told at an instant comes after all probes of that instant
    upto = Window.partitionBy("player").orderBy("at", "kind", "told", "game_id").rowsBetween(Window.unboundedPreceding, 0)
    sums = {f"{c}_upto": F.coalesce(F.sum(F.when(F.col("kind") == 2, F.col(c))).over(upto), F.lit(0)) for c in SUMS}
    both = both.withColumns(sums | {"mu": F.last("told", True).over(upto)["mu"]}).where(played & (F.col("kind") < 2))
    less = lambda c: F.sum(F.when(F.col("kind") == 1, F.col(c)).otherwise(-F.col(c)))
    now = lambda c: F.max(F.when(F.col("kind") == 1, F.col(c))).alias(c)
    return both.groupBy("player", "game_id").agg(now("team"), now("mu"), *[less(f"{c}_upto").alias(c) for c in SUMS], now("map_win_rate"))


def game_features(rows: DataFrame, ratings: DataFrame, months: int = 3, map_games: int = 5, rows_a_part: int = ROWS_A_PART) -> DataFrame:
    """One row per (game_id, player): rating, win_rate, games, headshot_ratio, adr, map_win_rate and roster_seconds before the game.

    ``rows`` has a row per game and player: game_id, ts, player, team, map, won, kills, headshots, damage; ``ratings`` rows
    (player, at, mu) of which the last before the game counts. Nothing of the game itself or of its instant is used,
    but who plays. Rates without games are null. An empty table gives no rows.
    """
    rows = checkpointed(rows)
    # players of more games than a part has, or of as many ratings, are scanned over several tasks
    sizes = rows.select("player").unionAll(ratings.select("player")).groupBy("player").count()
    hot = checkpointed(sizes.where(F.col("count") > rows_a_part).select("player"))
    if many := hot.count():
        few = F.broadcast(hot) if many <= BROADCAST_GROUPS else hot
        of_hot, told = rows.join(few, "player", "left_semi"), ratings.join(few, "player", "left_semi")
        recent, form = recent_sums(of_hot, months, rows_a_part), map_form(of_hot, map_games, rows_a_part)
        rated = as_of(of_hot.select("game_id", "player", "team", "ts"), told, "player", "ts", "at", ["mu"], rows_a_part)
        scanned = rated.join(recent, ["game_id", "player"]).join(form, ["game_id", "player"])
        found = of_players(rows.join(few, "player", "left_anti"), ratings.join(few, "player", "left_anti"), months, map_games, rows_a_part)
        found = found.unionByName(scanned.select(*found.columns))
    else:
        found = of_players(rows, ratings, months, map_games, rows_a_part)
    out = found.join(roster_age(rows, rows_a_part), ["game_id", "team"])
    none = lambda c: F.nullif(F.col(c), F.lit(0))
    return out.select(
        "game_id", "player", F.col("mu").alias("rating"), (F.col("wins") / none("games")).alias("win_rate"), "games",
        (F.col("headshots") / none("kills")).alias("headshot_ratio"), (F.col("damage") / none("games")).alias("adr"), "map_win_rate", "roster_seconds",
    )

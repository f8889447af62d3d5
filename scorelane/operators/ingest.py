"""Ingest of parsed matches under constraints: a match is taken in whole or not at all, in order, and leaves an error if not."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scorelane.operators import store
from scorelane.operators.state import merge
from scorelane.sources.files import checkpointed

#: What a match fails by, in the order in which its statements would run.
ERRORS = (
    "FOREIGN KEY constraint failed: matches.winner_team_id",
    "UNIQUE constraint failed: maps.match_id, maps.map_name",
    "UNIQUE constraint failed: maps.map_id",
    "UNIQUE constraint failed: stats.match_id, stats.map_name, stats.player_id",
    "FOREIGN KEY constraint failed: stats.team_id",
)


def _before(flag: Column, by: str) -> Column:
    """Whether the flag holds for any row of ``by`` earlier in order."""
    w = Window.partitionBy(by).orderBy("seq").rangeBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.max(flag).over(w), F.lit(False))


def _tables(records: DataFrame, teams: DataFrame, maps: DataFrame, seq: str):
    side = lambda k: F.nullif(F.col(f"team{k}.team_id"), F.lit(0))
    own = F.array_compact(F.array(side(1), side(2)))
    names, ids = F.transform("maps", lambda m: m["map_name"]), F.array_compact(F.transform("maps", lambda m: m["map_id"]))
    keys = F.transform("player_stats", lambda s: F.struct(s["map_name"], s["player_id"]))
    twice = lambda xs: F.size(F.array_distinct(xs)) < F.size(xs)
    read = records.select(
        "match_id", F.col(seq).cast("long").alias("seq"), own.alias("own"), ids.alias("ids"),
        F.array(F.lit(False), twice(names), twice(ids), twice(keys), F.lit(False)).alias("local"),
        F.array_except(F.array_compact(F.array("winner_team_id")), own).alias("winner"),
        F.array_except(F.array_compact(F.transform("player_stats", lambda s: s["team_id"])), own).alias("others"),
    )
    read = checkpointed(read)
    held = maps.select(F.col("map_id"), F.col("match_id").alias("holder")).where("map_id is not null")
    claims = read.select("match_id", "seq", F.explode(F.array_distinct("ids")).alias("map_id")).join(held, "map_id", "left")
    places = read.select(F.col("match_id").alias("holder"), F.col("seq").alias("holder_seq"))
    claims = checkpointed(claims.join(places, "holder", "left"))
    asks = F.explode(F.array(F.struct(F.lit(0).alias("rank"), F.col("winner").alias("teams")), F.struct(F.lit(4).alias("rank"), F.col("others").alias("teams"))))
    needs = read.select("match_id", "seq", asks.alias("a")).select("match_id", "seq", "a.rank", F.explode("a.teams").alias("team"))
    needs = needs.join(teams.select(F.col("team_id").alias("team")), "team", "left_anti").withColumn("gives", F.lit(False))
    gives = read.select("match_id", "seq", F.lit(None).cast("int").alias("rank"), F.explode("own").alias("team"), F.lit(True).alias("gives"))
    gives = gives.join(needs.select("team").distinct(), "team", "left_semi")
    return read, claims, checkpointed(needs.unionByName(gives))


def admit(records: DataFrame, teams: DataFrame, maps: DataFrame, seq: str = "match_id") -> DataFrame:
    """Rows (match_id, error): null for records that are taken in, one after the other in the order of ``seq``.

    ``records`` has a row a match, ``teams`` and ``maps`` are what is stored. A record fails if its maps repeat a name or an id; if one
    of its map ids is another match's by then, which is one stored, unless that match was taken in before and gave it
    up, or one taken in before; if its statistics repeat a map and player; or if its winner or a player's team is not
    stored, its own, or of a record taken in before. Whether a record is taken in depends on earlier ones only, so rounds
    settle all whose earlier ones are settled, until none is left: as many rounds as the longest chain. No two records
    are paired: a map id or team is looked at in order. Null ids of maps and teams are not checked; team 0 is no team. Of
    several errors the first in ERRORS is told. An empty batch gives no rows.
    """
    read, claims, needs = _tables(records, teams, maps, seq)
    settled = read.select("match_id", F.when(F.exists("local", lambda x: x), False).alias("ok"))  # null: not settled

    def looked_at(settled: DataFrame) -> DataFrame:
        """Per match and rank: whether it fails, and whether that is open."""
        c = claims.join(settled, "match_id").join(settled.select(F.col("match_id").alias("holder"), F.col("ok").alias("holder_ok")), "holder", "left")
        other = F.col("holder").isNotNull() & (F.col("holder") != F.col("match_id"))
        later = F.col("holder_seq").isNull() | (F.col("holder_seq") > F.col("seq"))
        holds = other & (later | ~F.coalesce("holder_ok", F.lit(True)))
        open_ = other & ~later & F.col("holder_ok").isNull()
        taken = _before(F.coalesce("ok", F.lit(False)), "map_id") | holds
        c = c.select("match_id", F.lit(2).alias("rank"), taken.alias("fails"), (~taken & (_before(F.col("ok").isNull(), "map_id") | open_)).alias("open"))
        n = needs.join(settled, "match_id")
        given = _before(F.col("gives") & F.coalesce("ok", F.lit(False)), "team")
        may = _before(F.col("gives") & F.col("ok").isNull(), "team")
        n = n.withColumns({"fails": ~given & ~may, "open": ~given & may}).where("not gives")
        return c.unionByName(n.select(*c.columns))

    while not settled.where("ok is null").isEmpty():
        found = looked_at(settled).groupBy("match_id").agg(F.max("fails").alias("fails"), F.max("open").alias("open"))
        ok = F.when(F.col("ok").isNotNull(), F.col("ok")).when(F.coalesce("fails", F.lit(False)), False).when(~F.coalesce("open", F.lit(False)), True)
        settled = checkpointed(settled.join(found, "match_id", "left").select("match_id", ok.alias("ok")))
    local = read.select("match_id", F.posexplode("local").alias("rank", "fails")).where("fails")
    why = looked_at(settled).where("fails").select("match_id", "rank").unionByName(local.select("match_id", "rank"))
    why = why.groupBy("match_id").agg(F.min("rank").alias("rank"))
    told = F.when(~F.col("ok"), F.element_at(F.array(*map(F.lit, ERRORS)), F.col("rank") + 1))
    return settled.join(why, "match_id", "left").select("match_id", told.alias("error"))


def failed(matches: DataFrame, errors: DataFrame, now: Column, parser_version: str) -> DataFrame:
    """matches with the errors (match_id, source_url, error) of failed ingests: status, source and instant change, all else stays."""
    new = errors.select("match_id", "source_url", F.lit("error").alias("status"), F.col("error").alias("ingest_error"), now.alias("last_ingested_at"))
    there = new.join(matches.select("match_id"), "match_id", "left_semi")
    known = merge(matches.join(new.select("match_id"), "match_id", "left_semi").select(*matches.columns), there, ["match_id"])
    fresh = new.join(matches.select("match_id"), "match_id", "left_anti").withColumns({"parser_version": F.lit(parser_version), "first_seen_at": now})
    rest = matches.join(new.select("match_id"), "match_id", "left_anti").select(*matches.columns)
    return rest.unionByName(known).unionByName(fresh, allowMissingColumns=True).select(*matches.columns)


def constrained_ingest(tables: dict[str, DataFrame], records: DataFrame, html_keys: DataFrame, now: Column, seq: str = "match_id") -> tuple[dict[str, DataFrame], DataFrame]:
    """(all five tables after a batch, outcomes (match_id, error)): what is not admitted leaves only its error; see ``admit``."""
    outcomes = checkpointed(admit(records, tables["teams"], tables["maps"], seq))
    good = records.join(outcomes.where("error is null").select("match_id"), "match_id", "left_semi")
    after = store.ingested(tables, good, html_keys, now)
    bad = records.select("match_id", "source_url").join(outcomes.where("error is not null"), "match_id")
    version = records.agg(F.max("parser_version")).first()[0] or "1"
    after["matches"] = failed(after["matches"], bad, now, version)
    return after, outcomes

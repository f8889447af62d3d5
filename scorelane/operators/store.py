"""The tables of parsed matches: what one batch of records changes in teams, matches, maps, players and statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorelane.operators.state import merge, replace_set

#: A record's own columns in the table of matches; what else a stored match has is not touched by a batch.
PARSED = (
    "slug", "source_url", "event_name", "best_of", "scheduled_at", "winner_team_id", "team1_id", "team2_id", "team1_name", "team2_name", "team1_score", "team2_score", "status", "raw_demo_url", "parser_version",
)


def _settled(records: DataFrame, preserve_on_challenge: bool) -> DataFrame:
    return records.where("status <> 'challenge'") if preserve_on_challenge else records


def upsert_teams(teams: DataFrame, records: DataFrame, now: Column) -> DataFrame:
    """teams (team_id, name, created_at, updated_at) with both sides of the records; sides without an id, or with 0, are skipped.

    Of several names of a team in one batch that of the last match counts; the instant of creation stays.
    """
    sides = records.select("match_id", F.explode(F.array("team1", "team2")).alias("t")).where("t.team_id <> 0")
    named = sides.groupBy("t.team_id").agg(F.max_by("t.name", "match_id").alias("name"))
    return merge(teams, named.withColumns({"created_at": now, "updated_at": now}), ["team_id"], keep=("created_at",))


def upsert_matches(matches: DataFrame, records: DataFrame, html_keys: DataFrame, now: Column, preserve_on_challenge: bool = False) -> DataFrame:
    """matches (match_id, PARSED, html_key, demo_key, first_seen_at, last_ingested_at, ingest_error) after a batch.

    A stored page's key (match_id, html_key) is taken over if there is a new one, else kept; the key of a demo and the first
    instant stay; an error is cleared. With preserve_on_challenge, a challenge page changes nothing of a match that is there.
    """
    batch = records.withColumns({"team1_id": F.col("team1.team_id"), "team2_id": F.col("team2.team_id"), "team1_name": F.col("team1.name"), "team2_name": F.col("team2.name")})
    batch = batch.select("match_id", *PARSED).join(html_keys, "match_id", "left")
    if preserve_on_challenge:
        known = batch.where("status = 'challenge'").join(matches.select("match_id"), "match_id", "left_semi").select("match_id")
        batch = batch.join(known, "match_id", "left_anti")
    none = F.lit(None).cast("string")
    batch = batch.withColumns({"demo_key": none, "first_seen_at": now, "last_ingested_at": now, "ingest_error": none})
    return merge(matches, batch.select(*matches.columns), ["match_id"], keep=("demo_key", "first_seen_at"), fill=("html_key",))


def replace_maps(maps: DataFrame, records: DataFrame, preserve_on_challenge: bool = False) -> DataFrame:
    """maps with those of the records' matches replaced as a whole: a match without maps loses its own."""
    batch = _settled(records, preserve_on_challenge)
    fresh = batch.select("match_id", F.posexplode("maps").alias("pos", "m")).select("match_id", "pos", "m.*")
    return replace_set(maps.join(batch.select("match_id"), "match_id", "left_anti"), fresh.select(*maps.columns), ["match_id"])


def upsert_players(players: DataFrame, records: DataFrame, now: Column) -> DataFrame:
    """players (player_id, nickname, created_at, updated_at) with those of the records; the last match's nickname counts."""
    seen = records.select("match_id", F.explode("player_stats").alias("p"))
    named = seen.groupBy("p.player_id").agg(F.max_by("p.nickname", F.struct("match_id", "p.nickname")).alias("nickname"))
    return merge(players, named.withColumns({"created_at": now, "updated_at": now}), ["player_id"], keep=("created_at",))


def replace_stats(stats: DataFrame, records: DataFrame, preserve_on_challenge: bool = False) -> DataFrame:
    """Statistics with those of the records' matches replaced as a whole."""
    batch = _settled(records, preserve_on_challenge)
    fresh = batch.select("match_id", F.explode("player_stats").alias("p")).select("match_id", "p.*")
    return replace_set(stats.join(batch.select("match_id"), "match_id", "left_anti"), fresh.select(*stats.columns), ["match_id"])


def ingested(tables: dict[str, DataFrame], records: DataFrame, html_keys: DataFrame, now: Column, preserve_on_challenge: bool = False) -> dict[str, DataFrame]:
    """All five tables after a batch, to be published as one version."""
    return {
        "teams": upsert_teams(tables["teams"], records, now),
        "matches": upsert_matches(tables["matches"], records, html_keys, now, preserve_on_challenge),
        "maps": replace_maps(tables["maps"], records, preserve_on_challenge),
        "players": upsert_players(tables["players"], records, now),
        "stats": replace_stats(tables["stats"], records, preserve_on_challenge),
    }

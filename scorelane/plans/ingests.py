"""Registered queries of an ingest under constraints, over matches written from customers with planted violations."""

from __future__ import annotations

from pyspark.sql import functions as F

from scorelane.operators import ingest, store
from scorelane.plans.catalogue import _query, _read

_THEN, _NOW = "2024-01-01", "2024-02-02"


def _stamp(text):
    return F.lit(text).cast("timestamp_ntz")


def _batch(spark, sf_dir):
    """A record a customer: map ids that run into those of the one before, teams that others bring, repeats."""
    k = F.col("c_custkey")
    one, two = F.col("c_nationkey").cast("long"), 1000 + F.floor(k / 4) + k % 3
    team = lambda i: F.struct(i.alias("team_id"), F.concat(F.lit("T"), i.cast("string")).alias("name"))
    game = lambda i, n: F.struct(i.alias("map_id"), n.alias("map_name"))
    maps = F.array(game(k - (k % 5 == 0).cast("long"), F.lit("A")), game(1_000_000 + k - (k % 7 == 0).cast("long"), F.when(k % 17 == 0, "A").otherwise("B")))
    player = lambda i, t: F.struct(i.alias("player_id"), F.lit("A").alias("map_name"), F.lit("P").alias("nickname"), t.alias("team_id"))
    stats = F.array(player(k, F.when(k % 4 == 0, 1000 + F.floor(k / 4)).otherwise(two)), player(F.when(k % 23 == 0, k).otherwise(k + 1), F.lit(None).cast("long")))
    none = lambda t: F.lit(None).cast(t)
    return _read(spark, sf_dir, "customer").select(
        k.alias("match_id"), none("string").alias("slug"), F.concat(F.lit("/m/"), k.cast("string")).alias("source_url"), F.lit("new").alias("event_name"), none("int").alias("best_of"), none("timestamp_ntz").alias("scheduled_at"),
        F.when(k % 2 == 0, one).otherwise(two).alias("winner_team_id"), team(one).alias("team1"), team(two).alias("team2"), none("int").alias("team1_score"), none("int").alias("team2_score"), F.lit("parsed").alias("status"),
        none("string").alias("raw_demo_url"), F.lit("1").alias("parser_version"), maps.alias("maps"), stats.alias("player_stats"),
    )


def _stored(spark, sf_dir):
    """Matches of every third customer, with a map each: some of these ids are asked for by other matches of the batch."""
    c, k = _read(spark, sf_dir, "customer").where("c_custkey % 3 = 0"), F.col("c_custkey")
    old = {"first_seen_at": _stamp(_THEN), "last_ingested_at": _stamp(_THEN), "html_key": F.lit("h"), "demo_key": F.lit("d"), "ingest_error": F.lit(None).cast("string")}
    given = {"source_url": F.lit("/old"), "event_name": F.lit("old"), "status": F.lit("parsed"), "parser_version": F.lit("0")}
    types = {"best_of": "int", "scheduled_at": "timestamp_ntz", "winner_team_id": "long", "team1_id": "long", "team2_id": "long", "team1_score": "int", "team2_score": "int"}
    parsed = {n: given[n] if n in given else F.lit(None).cast(types.get(n, "string")) for n in store.PARSED}
    none = F.lit(None).cast("string")
    return {
        "teams": spark.range(1, 11).select(F.col("id").alias("team_id"), F.lit("old").alias("name"), _stamp(_THEN).alias("created_at"), _stamp(_THEN).alias("updated_at")),
        "matches": c.select(k.alias("match_id"), *[v.alias(n) for n, v in (parsed | old).items()]),
        "maps": c.select(k.alias("match_id"), F.lit(0).alias("pos"), (k + F.when(k % 2 == 0, 2).otherwise(-2)).alias("map_id"), F.lit("old").alias("map_name")),
        "players": c.limit(0).select(k.alias("player_id"), none.alias("nickname"), _stamp(_THEN).alias("created_at"), _stamp(_THEN).alias("updated_at")),
        "stats": c.limit(0).select(k.alias("match_id"), k.alias("player_id"), none.alias("map_name")),
    }


def _after(spark, sf_dir):
    keys = _read(spark, sf_dir, "customer").where("c_custkey % 4 = 0").select(F.col("c_custkey").alias("match_id"), F.lit("new").alias("html_key"))
    return ingest.constrained_ingest(_stored(spark, sf_dir), _batch(spark, sf_dir), keys, _stamp(_NOW))


#: The batch taken in one record after the other by recursion: who holds a map id by then, and which teams there are.
_ONE_BY_ONE = f"""WITH RECURSIVE b AS (SELECT c_custkey AS k, row_number() OVER (ORDER BY c_custkey) AS i, c_nationkey::BIGINT AS one, 1000 + c_custkey // 4 + c_custkey % 3 AS two FROM customer),
      r AS (SELECT *, [k - (k % 5 = 0)::INT, 1000000 + k - (k % 7 = 0)::INT] AS ids, k % 17 = 0 AS names, k % 23 = 0 AS keys, CASE WHEN k % 2 = 0 THEN one ELSE two END AS winner, CASE WHEN k % 4 = 0 THEN 1000 + k // 4 ELSE two END AS other,
              list_filter([one, two], lambda t: t <> 0) AS own FROM b),
      f(i, held, teams, error) AS (
        SELECT 0::BIGINT, (SELECT map(list(k + CASE WHEN k % 2 = 0 THEN 2 ELSE -2 END ORDER BY k), list(k ORDER BY k)) FROM b WHERE k % 3 = 0), range(1, 11), NULL::VARCHAR
        UNION ALL SELECT i, CASE WHEN error IS NULL THEN map_concat(map_from_entries(list_filter(map_entries(held), lambda e: e.value <> k)), MAP {{ids[1]: k, ids[2]: k}}) ELSE held END,
          CASE WHEN error IS NULL THEN list_distinct(list_concat(teams, own)) ELSE teams END, error
        FROM (SELECT r.i, r.k, r.ids, r.own, f.held, f.teams, CASE WHEN NOT list_contains(list_concat(f.teams, r.own), r.winner) THEN '{ingest.ERRORS[0]}' WHEN r.names THEN '{ingest.ERRORS[1]}'
                WHEN coalesce(f.held[r.ids[1]], r.k) <> r.k OR coalesce(f.held[r.ids[2]], r.k) <> r.k THEN '{ingest.ERRORS[2]}' WHEN r.keys THEN '{ingest.ERRORS[3]}'
                WHEN NOT list_contains(list_concat(f.teams, r.own), r.other) THEN '{ingest.ERRORS[4]}' END AS error FROM f JOIN r ON r.i = f.i + 1)),
      o AS (SELECT r.*, f.error FROM r JOIN f USING (i)) """


@_query(_ONE_BY_ONE + "SELECT k AS match_id, error FROM o")
def ingest_admitted(spark, sf_dir):
    stored = _stored(spark, sf_dir)
    return ingest.admit(_batch(spark, sf_dir), stored["teams"], stored["maps"])


@_query(_ONE_BY_ONE + f"""SELECT k AS match_id, CASE WHEN error IS NULL THEN 'new' WHEN k % 3 = 0 THEN 'old' END AS event_name, '/m/' || k AS source_url, CASE WHEN error IS NULL THEN 'parsed' ELSE 'error' END AS status, error AS ingest_error,
      CASE WHEN error IS NULL AND k % 4 = 0 THEN 'new' WHEN k % 3 = 0 THEN 'h' END AS html_key, CASE WHEN k % 3 = 0 THEN 'd' END AS demo_key, CASE WHEN k % 3 = 0 THEN TIMESTAMP '{_THEN}' ELSE TIMESTAMP '{_NOW}' END AS first_seen_at,
      TIMESTAMP '{_NOW}' AS last_ingested_at, CASE WHEN error IS NULL THEN winner END AS winner_team_id, CASE WHEN error IS NOT NULL AND k % 3 = 0 THEN '0' ELSE '1' END AS parser_version FROM o""")
def constrained_matches(spark, sf_dir):
    columns = ["match_id", "event_name", "source_url", "status", "ingest_error", "html_key", "demo_key", "first_seen_at", "last_ingested_at", "winner_team_id", "parser_version"]
    return _after(spark, sf_dir)[0]["matches"].select(*columns)


@_query(_ONE_BY_ONE + """SELECT k AS match_id, i - 1 AS pos, ids[i] AS map_id, CASE WHEN i = 1 THEN 'A' ELSE 'B' END AS map_name FROM (SELECT k, ids, error, unnest([1, 2]) AS i FROM o) WHERE error IS NULL
      UNION ALL SELECT k, 0, k + CASE WHEN k % 2 = 0 THEN 2 ELSE -2 END, 'old' FROM o WHERE error IS NOT NULL AND k % 3 = 0""")
def constrained_maps(spark, sf_dir):
    return _after(spark, sf_dir)[0]["maps"]


@_query(_ONE_BY_ONE + f"""SELECT DISTINCT t AS team_id, CASE WHEN n.t IS NULL THEN 'old' ELSE 'T' || t END AS name FROM (SELECT unnest(range(1, 11)) AS t) s FULL JOIN (SELECT DISTINCT unnest(own) AS t FROM o WHERE error IS NULL) n USING (t)""")
def constrained_teams(spark, sf_dir):
    return _after(spark, sf_dir)[0]["teams"].select("team_id", "name")

"""Ingest under constraints against taking records in one after the other."""

import random

from pyspark.sql import functions as F

from scorelane.operators import ingest

RECORD = "match_id long, source_url string, team1 struct<team_id: long, name: string>, team2 struct<team_id: long, name: string>, winner_team_id long, maps array<struct<map_id: long, map_name: string>>, player_stats array<struct<player_id: long, map_name: string, team_id: long>>"


def one_by_one(records, teams, maps):
    teams, held, out = set(teams), dict(maps), {}
    for m, _, one, two, winner, games, stats in sorted(records):
        own = {t[0] for t in (one, two) if t and t[0]}
        ids = [g[0] for g in games if g[0] is not None]
        names, keys = [g[1] for g in games], [(s[1], s[0]) for s in stats]
        known = teams | own
        if winner is not None and winner not in known:
            out[m] = ingest.ERRORS[0]
        elif len(set(names)) < len(names):
            out[m] = ingest.ERRORS[1]
        elif len(set(ids)) < len(ids) or any(held.get(i, m) != m for i in ids):
            out[m] = ingest.ERRORS[2]
        elif len(set(keys)) < len(keys):
            out[m] = ingest.ERRORS[3]
        elif any(s[2] is not None and s[2] not in known for s in stats):
            out[m] = ingest.ERRORS[4]
        else:
            out[m] = None
            teams |= own
            held = {i: h for i, h in held.items() if h != m} | dict.fromkeys(ids, m)
    return out


def test_admission_is_that_of_one_after_the_other(spark):
    for seed in (1,):
        rng = random.Random(seed)
        number = lambda n: None if rng.random() < 0.1 else rng.randrange(n)  # noqa: E731, B023
        records = []
        for m in rng.sample(range(200), 120):
            one, two = (rng.randrange(60), "a"), (number(60), "b")
            games = [(number(260), rng.choice("ABCDEFGH")) for _ in range(rng.randrange(3))]
            stats = [(rng.randrange(30), "A", rng.choice([one[0], None, number(60)])) for _ in range(rng.randrange(3))]
            records.append((m, f"/{m}", one, two, rng.choice([None, one[0]]), games, stats))
        teams, maps = range(1, 15), {i: rng.randrange(220) for i in rng.sample(range(260), 60)}
        frame = spark.createDataFrame(records, RECORD)
        got = ingest.admit(frame, spark.createDataFrame([(t,) for t in teams], "team_id long"), spark.createDataFrame([(h, i) for i, h in maps.items()] + [(1, None)], "match_id long, map_id long"))
        want = one_by_one(records, teams, maps)
        assert {r["match_id"]: r["error"] for r in got.collect()} == want and len({*want.values()}) >= 5


def test_admission_of_chains_and_of_nothing(spark):
    team = lambda t: (t, "t")
    chain = [(m, "/", team(m), team(None), m, [(m % 2, "A")], [(1, "A", m - 1)] if m > 1 else []) for m in range(1, 6)]
    chain[2] = (3, "/", team(3), team(None), 99, [], [])  # fails, and with it those that rely on its team
    frame = spark.createDataFrame(chain, RECORD)
    none = spark.createDataFrame([], "team_id long"), spark.createDataFrame([], "match_id long, map_id long")
    got = {r["match_id"]: r["error"] for r in ingest.admit(frame, *none).collect()}
    assert got == one_by_one(chain, [], {}) and got[4] is not None
    assert ingest.admit(frame.where("false"), *none).count() == 0


def test_failed_ingests_leave_what_was_there(spark):
    matches = spark.createDataFrame([(1, "/a", "parsed", "cup", None, "0", None), (2, "/b", "parsed", "cup", None, "0", None)], "match_id long, source_url string, status string, event_name string, ingest_error string, parser_version string, last_ingested_at string")
    matches = matches.withColumn("first_seen_at", F.lit("then"))
    errors = spark.createDataFrame([(2, "/n", "bad"), (3, "/c", "bad")], "match_id long, source_url string, error string")
    got = {r["match_id"]: tuple(r)[1:] for r in ingest.failed(matches, errors, F.lit("now"), "1").select("match_id", "source_url", "status", "event_name", "ingest_error", "parser_version", "last_ingested_at", "first_seen_at").collect()}
    assert got == {1: ("/a", "parsed", "cup", None, "0", None, "then"), 2: ("/n", "error", "cup", "bad", "0", "now", "then"), 3: ("/c", "error", None, "bad", "1", "now", "now")}

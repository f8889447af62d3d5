"""Registered queries of orchestration, requests, rating runs, archived pages and evaluation, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from scorelane.operators import evaluation, legacy, messages, orchestration, pages, ratings, state, store
from scorelane.plans.catalogue import BASE, _query, _read

# discovery runs

_REQUESTS = """WITH r AS (SELECT event_id AS run_id, CASE WHEN event_id % 3 = 0 THEN 'cron:x' ELSE 'manual' END AS source, CASE WHEN event_id % 2 = 0 THEN 'browser-session' ELSE 'http' END AS mode,
      CASE event_id % 5 WHEN 0 THEN NULL WHEN 1 THEN '  ' ELSE 'k' || event_id % 7 END AS skey, event_type <> 'error' AS acquired, event_type = 'signup' AS failed FROM events),
      s AS (SELECT *, source LIKE 'cron%' AS cron, CASE WHEN source LIKE 'cron%' AND NOT acquired THEN 'skipped' WHEN failed THEN 'error' ELSE 'success' END AS status,
        CASE WHEN mode = 'browser-session' AND trim(coalesce(skey, '')) <> '' THEN 'inline' ELSE 'enqueued' END AS way FROM r),
      f AS (SELECT run_id, way, coalesce(nullif(trim(skey), ''), 'default') AS session, 'm/' || run_id || '/' || i AS link FROM s, generate_series(0, 3) t(i) WHERE status = 'success' AND i < run_id % 4) """


def _runs(spark, sf_dir):
    e = _read(spark, sf_dir, "events").select("event_id", "event_type")
    k = F.col("event_id")
    key = F.when(k % 5 == 0, None).when(k % 5 == 1, "  ").otherwise(F.concat(F.lit("k"), (k % 7).cast("string")))
    requests = e.select(
        k.alias("run_id"), F.when(k % 3 == 0, "cron:x").otherwise("manual").alias("source"), F.when(k % 2 == 0, "browser-session").otherwise("http").alias("acquisition_mode"),
        key.alias("browser_session_key"), (F.col("event_type") != "error").alias("acquired"), (F.col("event_type") == "signup").alias("failed"),
    )
    found = e.where(k % 4 > 0).select(k.alias("run_id"), F.explode(F.sequence(F.lit(0).cast("long"), k % 4 - 1)).alias("i"))
    found = found.select("run_id", F.concat(F.lit("m/"), F.col("run_id").cast("string"), F.lit("/"), F.col("i").cast("string")).alias("link"))
    return orchestration.discovery_runs(requests, found)


@_query(_REQUESTS + """SELECT s.run_id, status, cron AND status <> 'skipped' AS released, count(link) FILTER (WHERE f.way = 'inline') AS n_inline, count(link) FILTER (WHERE f.way = 'enqueued') AS n_enqueued
      FROM s LEFT JOIN f USING (run_id) GROUP BY 1, 2, 3""")
def discovery_runs(spark, sf_dir):
    return _runs(spark, sf_dir)[0]


@_query(_REQUESTS + "SELECT run_id, link, way, session FROM f")
def discovery_work(spark, sf_dir):
    return _runs(spark, sf_dir)[1]


@_query("""SELECT ts AS at, '{"type":"discover-results","payload":{"source":"cron:*/15","acquisitionMode":"browser-session","browserSessionKey":"cron-' || (epoch_us(ts) // 1000) || '","maxMatches":20}}' AS body FROM events WHERE event_type = 'signup'""")
def scheduled_messages(spark, sf_dir):
    ticks = _read(spark, sf_dir, "events").where("event_type = 'signup'").select(F.col("ts").alias("at"))
    return orchestration.scheduled_messages(ticks, "*/15")


@_query("""WITH l AS (SELECT o_custkey % 50 AS site, o_orderkey // 1000 * 100 AS "offset", o_orderkey AS pos, CASE WHEN o_orderkey % 997 = 0 THEN NULL ELSE o_custkey % 400 END AS item FROM orders),
      a AS (SELECT site, item, min("offset") AS "offset" FROM l WHERE item IS NOT NULL GROUP BY ALL),
      b AS (SELECT a.*, (SELECT min(pos) FROM l WHERE l.site = a.site AND l.item = a.item AND l."offset" = a."offset") AS pos FROM a),
      p AS (SELECT site, "offset", (SELECT count(*) FROM b WHERE b.site = q.site AND b."offset" = q."offset") AS fresh, row_number() OVER (PARTITION BY site ORDER BY "offset") - 1 AS k FROM (SELECT DISTINCT site, "offset" FROM l) q),
      s AS (SELECT site, min("offset") AS stop FROM p WHERE fresh = 0 OR "offset" <> k * 100 GROUP BY site),
      n AS (SELECT b.site, item, row_number() OVER (PARTITION BY b.site ORDER BY b."offset", pos) - 1 AS place FROM b LEFT JOIN s ON s.site = b.site WHERE stop IS NULL OR b."offset" < stop)
      SELECT site, item, place FROM n WHERE place < 6""")
def paginated_discovery(spark, sf_dir):
    o = _read(spark, sf_dir, "orders")
    item = F.when(F.col("o_orderkey") % 997 != 0, F.col("o_custkey") % 400)
    listed = o.select((F.col("o_custkey") % 50).alias("site"), (F.floor(F.col("o_orderkey") / 1000) * 100).alias("offset"), F.col("o_orderkey").alias("pos"), item.alias("item"))
    return orchestration.paginated(listed, "site", "offset", "pos", "item", 6)


@_query("""SELECT event_id, event_type = 'error' AND event_id % 5 < 3 AS launch, event_id % 4 = 0 AND event_id % 5 < 2 AS snapshot,
      CASE WHEN event_id % 3 = 0 THEN 30.0 ELSE 16.0 * pow(2, event_id % 5 - 1) END AS wait FROM events""")
def retry_plan(spark, sf_dir):
    k = F.col("event_id")
    status = F.when(F.col("event_type") == "error", 429).otherwise(200)
    message = F.when(k % 4 == 0, F.concat(F.lit("x: "), F.lit(orchestration.TRANSIENT[1]), F.lit("."))).otherwise("other")
    wait = orchestration.backoff_seconds(F.when(k % 3 == 0, "proxy").otherwise("http"), k % 5, 30, 16)
    return _read(spark, sf_dir, "events").select("event_id", orchestration.launch_retry(status, k % 5).alias("launch"), orchestration.snapshot_retry(message, k % 5).alias("snapshot"), wait.alias("wait"))


@_query("""SELECT event_id, CASE WHEN event_id % 7 = 0 THEN 400 WHEN event_id % 5 = 0 THEN 503 WHEN event_id % 3 = 0 THEN 500 ELSE 200 END AS status,
      CASE WHEN event_id % 7 = 0 THEN '{"ok":false,"error":"bad body"}' WHEN event_id % 5 = 0 THEN '{"ok":false,"error":"challenge page"}' WHEN event_id % 3 = 0 THEN '{"ok":false,"error":"boom"}' ELSE '{"ok":true}' END AS body,
      array_to_string(list_filter([CASE WHEN event_id % 2 = 0 THEN 'RAW_HTML persistence disabled for this request' END, CASE WHEN event_id % 3 = 1 THEN 'Acquired via browser' END,
        CASE WHEN event_id % 4 = 1 THEN 'Browser final URL differed from requested URL: /b' END], lambda x: x IS NOT NULL), '|') AS notes, CASE WHEN event_id % 2 = 0 THEN '/r' ELSE 'https://stats.example/results' END AS page FROM events""")
def endpoint_answers(spark, sf_dir):
    k = F.col("event_id")
    answer = orchestration.answer(F.when(k % 7 == 0, F.lit("bad body")), k % 5 == 0, F.when(k % 3 == 0, F.lit("boom")))
    notes = orchestration.ingest_notes(k % 2 != 0, F.when(k % 3 == 1, "browser").otherwise("http"), F.lit("/a"), F.when(k % 4 == 1, "/b").otherwise("/a"))
    page = orchestration.results_url(F.when(k % 2 == 0, "/r").otherwise(""), BASE)
    return _read(spark, sf_dir, "events").select("event_id", answer.alias("a"), F.array_join(notes, "|").alias("notes"), page.alias("page")).select("event_id", "a.*", "notes", "page")


@_query("SELECT user_id, count(*) FILTER (WHERE event_type <> 'error') AS success, count(*) FILTER (WHERE event_type = 'error') AS failed FROM events GROUP BY 1")
def run_counters(spark, sf_dir):
    return orchestration.run_counters(_read(spark, sf_dir, "events"), "user_id", F.col("event_type") != "error")


# request bodies


def _requests(spark, sf_dir, kind):
    k = F.col("event_id").cast("string")
    shapes = [
        F.concat(F.lit('{"matchId":'), k, F.lit(',"rawDemoUrl":"/d","demoR2Key":"k","persistHtml":true,"acquisitionMode":"browser","maxMatches":3,"byteSize":"9"}')),
        F.concat(F.lit('{"matchUrl":"/m/'), k, F.lit('","matchId":"7","html":"","acquisitionMode":"ftp","maxMatches":2.5,"pageUrl":"/p"}')),
        F.lit('{"matchUrl":7,"pageUrl":false,"maxMatches":-1}'),
        F.lit("[1]"),
        F.lit('"text"'),
        F.lit('{"matchId":2.5,"rawDemoUrl":"","browserSessionKey":"s"}'),
        F.lit('{"matchId":5,"rawDemoUrl":"/d"}'),
        F.lit("{broken"),
    ]
    body = F.coalesce(*[F.when(F.col("event_id") % 8 == i, s) for i, s in enumerate(shapes)])
    return messages.read_requests(_read(spark, sf_dir, "events").select("event_id", body.alias("body")), kind).select("event_id", "error", "request.*")


@_query("""SELECT event_id, CASE WHEN r IN (4, 7) THEN 'Match ingest body must be an object' WHEN r IN (2, 3) THEN 'Expected either matchUrl or matchId' END AS error, CASE r WHEN 1 THEN '/m/' || event_id END AS "matchUrl",
      CASE r WHEN 0 THEN event_id WHEN 5 THEN 2.5 WHEN 6 THEN 5 END::DOUBLE AS "matchId", NULL::VARCHAR AS html, CASE r WHEN 0 THEN true END AS "persistHtml", CASE r WHEN 0 THEN 'browser' END AS "acquisitionMode",
      CASE r WHEN 5 THEN 's' END AS "browserSessionKey" FROM (SELECT event_id, event_id % 8 AS r FROM events)""")
def ingest_requests(spark, sf_dir):
    return _requests(spark, sf_dir, "ingest")


@_query("""SELECT event_id, CASE WHEN r IN (4, 7) THEN 'Results discovery body must be an object' END AS error, CASE r WHEN 1 THEN '/p' END AS "pageUrl", NULL::VARCHAR AS html, CASE r WHEN 0 THEN 'browser' END AS "acquisitionMode",
      CASE r WHEN 5 THEN 's' END AS "browserSessionKey", CASE r WHEN 0 THEN 3 END::BIGINT AS "maxMatches" FROM (SELECT event_id, event_id % 8 AS r FROM events)""")
def discover_requests(spark, sf_dir):
    return _requests(spark, sf_dir, "discover")


@_query("""SELECT event_id, CASE WHEN r IN (4, 7) THEN 'Demo ingest body must be an object' WHEN r IN (1, 2, 3) THEN 'Demo ingest requires a numeric matchId' WHEN r = 5 THEN 'Demo ingest requires rawDemoUrl' WHEN r = 6 THEN 'Demo ingest requires demoR2Key' END AS error,
      CASE r WHEN 0 THEN event_id END::DOUBLE AS "matchId", CASE r WHEN 0 THEN '/d' END AS "rawDemoUrl", CASE r WHEN 0 THEN 'k' END AS "demoR2Key", NULL::VARCHAR AS "downloadFileName", NULL::VARCHAR AS "contentType", NULL::DOUBLE AS "byteSize"
      FROM (SELECT event_id, event_id % 8 AS r FROM events)""")
def demo_requests(spark, sf_dir):
    return _requests(spark, sf_dir, "demo")


# state


def _demos(spark, sf_dir):
    o = _read(spark, sf_dir, "orders")
    m = o.where("o_orderkey % 3 <> 0").select(F.col("o_orderkey").alias("match_id"), F.lit(None).cast("string").alias("demo_key"), F.lit(None).cast("string").alias("demo_url"), "o_orderpriority")
    a = o.where("o_orderkey % 6 = 1").select(F.col("o_orderkey").alias("match_id"), F.lit("demo").alias("kind"), F.lit("old").alias("object_key"), F.lit(1).cast("long").alias("byte_size"))
    d = o.where("o_orderkey % 2 = 1").select(F.col("o_orderkey").alias("match_id"), F.concat(F.lit("demos/"), F.col("o_orderkey").cast("string")).alias("demo_key"), F.lit("/u").alias("demo_url"), F.col("o_custkey").alias("byte_size"))
    return state.record_demos(m, a, d)


@_query("""SELECT o_orderkey AS match_id, CASE WHEN o_orderkey % 2 = 1 THEN 'demos/' || o_orderkey END AS demo_key, CASE WHEN o_orderkey % 2 = 1 THEN '/u' END AS demo_url, o_orderpriority FROM orders WHERE o_orderkey % 3 <> 0""")
def demo_matches(spark, sf_dir):
    return _demos(spark, sf_dir)[0]


@_query("""SELECT o_orderkey AS match_id, 'demo' AS kind, 'demos/' || o_orderkey AS object_key, o_custkey AS byte_size FROM orders WHERE o_orderkey % 2 = 1 AND o_orderkey % 3 <> 0""")
def demo_artifacts(spark, sf_dir):
    return _demos(spark, sf_dir)[1]


@_query("SELECT o_orderkey AS match_id, 'demos/' || o_orderkey AS demo_key, '/u' AS demo_url, o_custkey AS byte_size FROM orders WHERE o_orderkey % 2 = 1 AND o_orderkey % 3 = 0")
def demo_missing(spark, sf_dir):
    return _demos(spark, sf_dir)[2]


@_query("""WITH n AS (SELECT l_orderkey, min(l_linenumber) AS l_linenumber FROM lineitem GROUP BY 1)
      SELECT o_orderkey AS k, -1 AS v FROM orders WHERE o_orderkey % 2 = 0 UNION ALL SELECT l_orderkey, l_linenumber FROM n WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderkey % 2 = 0)""")
def plain_append(spark, sf_dir):
    old = _read(spark, sf_dir, "orders").where("o_orderkey % 2 = 0").select(F.col("o_orderkey").alias("k"), F.lit(-1).alias("v"))
    new = _read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("v"))
    return state.append_new(old, new, ["k"])[0]


# ratings

_STORED = "(SELECT c_custkey AS player, c_acctbal AS mu, 2.5::DOUBLE AS sigma FROM customer WHERE c_custkey % 2 = 0)"


def _stored(spark, sf_dir):
    return _read(spark, sf_dir, "customer").where("c_custkey % 2 = 0").select(F.col("c_custkey").alias("player"), F.col("c_acctbal").alias("mu"), F.lit(2.5).alias("sigma"))


DEFAULTS = {"mu": ratings.MU, "sigma": 8.5}


@_query(f"SELECT event_id, user_id AS player, coalesce(mu, 25.0) AS mu, coalesce(sigma, 8.5) AS sigma FROM events LEFT JOIN {_STORED} s ON user_id = player")
def rating_lookup(spark, sf_dir):
    players = _read(spark, sf_dir, "events").select("event_id", F.col("user_id").alias("player"))
    return ratings.with_ratings(players, _stored(spark, sf_dir), "player", DEFAULTS).select("event_id", "player", "mu", "sigma")


@_query(f"SELECT * FROM {_STORED} UNION ALL SELECT DISTINCT user_id, 25.0::DOUBLE, 8.5::DOUBLE FROM events WHERE user_id NOT IN (SELECT player FROM {_STORED})")
def rating_new_players(spark, sf_dir):
    players = _read(spark, sf_dir, "events").select(F.col("user_id").alias("player"))
    return ratings.with_new_players(_stored(spark, sf_dir), players, "player", DEFAULTS)


@_query(f"SELECT player, coalesce(m, mu) AS mu, coalesce(s, sigma) AS sigma FROM {_STORED} LEFT JOIN (SELECT user_id, max(value) AS m, min(value) AS s FROM events GROUP BY 1) ON player = user_id")
def rating_write_back(spark, sf_dir):
    fresh = _read(spark, sf_dir, "events").groupBy(F.col("user_id").alias("player")).agg(F.max("value").alias("mu"), F.min("value").alias("sigma"))
    return ratings.write_back(_stored(spark, sf_dir), fresh, "player")


@_query("SELECT event_id, event_id > 700 AS fresh FROM events")
def rating_since_mark(spark, sf_dir):
    fresh, refused = ratings.since(_read(spark, sf_dir, "events").select("event_id"), "event_id", 700)
    return fresh.withColumn("fresh", F.lit(True)).unionByName(refused.withColumn("fresh", F.lit(False)))


@_query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, floor(100 * p)::INT AS fixed, substr(split_part(p::VARCHAR, '.', 2), 1, 2)::INT AS faithful, round_even(p, 2) AS p1, round(1 - round_even(p, 2), 2) AS p2
      FROM (SELECT *, (l_partkey % 64) / 64 AS p FROM lineitem)""")
def percent_forms(spark, sf_dir):
    p = F.col("l_partkey") % 64 / 64
    rows = _read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", ratings.percent_text(p).alias("fixed"), ratings.percent_text(p, True).alias("faithful"), ratings.predicted_pair(p).alias("pair"))
    return rows.select("*", "pair.*").drop("pair")


@_query("""SELECT o_custkey, round(avg(o_totalprice), 2) AS mean, round((sum(o_totalprice) - 1) / 5, 2) AS faithful FROM orders GROUP BY 1""")
def team_means(spark, sf_dir):
    means = ratings.team_means(_read(spark, sf_dir, "orders"), "o_custkey", "o_totalprice")
    return means.select("o_custkey", F.round("mean", 2).alias("mean"), F.round("faithful", 2).alias("faithful"))


# archived pages


def _archive(spark, sf_dir):
    """Archived match pages in parts, written from orders and lines."""
    text = lambda c: F.col(c).cast("string") if isinstance(c, str) else c.cast("string")
    lines = _read(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.min("l_suppkey").alias("s"), F.min("l_partkey").alias("p"))
    one = F.struct(
        "l_linenumber", F.when(F.col("l_linenumber") == 5, " Default ").otherwise(F.concat(F.lit(" Map"), text("l_linenumber"))).alias("name"), (F.col("l_linenumber") != 3).alias("played"),
        text(F.col("s") % 17).alias("score1"), F.when(F.col("p") % 11 == 0, "-").otherwise(text(F.col("p") % 17)).alias("score2"),
    )
    maps = lines.groupBy(F.col("l_orderkey").alias("match_id")).agg(F.array_sort(F.collect_list(one)).alias("maps"))
    o = _read(spark, sf_dir, "orders")
    link = lambda c: F.concat(F.lit("/team/"), text(c), F.lit("/t"))
    day = F.concat(text(F.dayofmonth("o_orderdate")), F.lit("th of "), F.date_format("o_orderdate", "MMMM"), F.lit(" "), text(F.year("o_orderdate")))
    pages = o.select(
        F.col("o_orderkey").alias("match_id"), F.lit("/u").alias("url"), day.alias("day"), F.lit(" 07:05").alias("clock"), F.col("o_orderpriority").alias("event"),
        F.array(F.concat(F.lit(" T"), text("o_custkey")), F.lit("Other ")).alias("names"), F.array(link("o_custkey"), link("o_custkey"), F.lit("/x"), link(F.col("o_custkey") + 1)).alias("team_links"),
    )
    return pages.join(maps, "match_id")


_GAMES = """WITH g AS (SELECT l_orderkey AS match_id, l_linenumber AS n, (min(l_suppkey) % 17)::INT AS score1, CASE WHEN min(l_partkey) % 11 <> 0 THEN (min(l_partkey) % 17)::INT END AS score2 FROM lineitem GROUP BY 1, 2),
      p AS (SELECT *, row_number() OVER (PARTITION BY match_id ORDER BY n) - 1 AS game FROM g WHERE n NOT IN (3, 5)) """


@_query(_GAMES + """SELECT o_orderkey AS match_id, '/u' AS url, date_trunc('day', o_orderdate) + INTERVAL '7 hours 5 minutes' AS scheduled_at, o_orderpriority AS event, o_custkey AS id1, 'T' || o_custkey AS name1, o_custkey + 1 AS id2, 'Other' AS name2,
      count(*) FILTER (WHERE score1 > score2)::INT AS maps1, count(*) FILTER (WHERE score2 > score1)::INT AS maps2, count(game)::INT AS n_maps
      FROM orders JOIN (SELECT DISTINCT match_id FROM g) d ON o_orderkey = d.match_id LEFT JOIN p ON p.match_id = o_orderkey GROUP BY ALL""")
def archived_matches(spark, sf_dir):
    m = legacy.match_records(_archive(spark, sf_dir))
    return m.select("match_id", "url", "scheduled_at", "event", F.col("team1.team_id").alias("id1"), F.col("team1.name").alias("name1"), F.col("team2.team_id").alias("id2"), F.col("team2.name").alias("name2"), "maps1", "maps2", "n_maps")


@_query(_GAMES + """SELECT match_id, game::INT AS game, 'Map' || n AS map, score1, score2, CASE WHEN score1 > score2 THEN 1 WHEN score1 < score2 THEN 2 END AS winner FROM p WHERE match_id IN (SELECT o_orderkey FROM orders)""")
def archived_games(spark, sf_dir):
    return legacy.game_records(_archive(spark, sf_dir))


@_query("""SELECT l_orderkey AS match_id, l_linenumber AS game, 1 AS side, l_partkey AS player_id, 'P' || l_suppkey AS name, (l_suppkey % 40)::INT AS kills, (l_partkey % 30)::INT AS deaths,
      CASE WHEN l_linenumber % 2 = 0 THEN 80.5 ELSE -1.0 END AS adr, CASE WHEN l_linenumber % 2 = 0 THEN 1.25 ELSE -1.0 END AS rating FROM lineitem WHERE l_partkey % 5 <> 0""")
def archived_players(spark, sf_dir):
    text = lambda c: c.cast("string")
    kd = F.concat(text(F.col("l_suppkey") % 40), F.lit("-"), text(F.col("l_partkey") % 30))
    short = [F.concat(F.lit("P"), text(F.col("l_suppkey"))), kd]
    tokens = F.when(F.col("l_linenumber") % 2 == 0, F.array(*short, *[F.lit("x")] * 4, F.lit("80.5"), F.lit("1.25"))).otherwise(F.array(*short, F.lit("x")))
    link = F.when(F.col("l_partkey") % 5 != 0, F.concat(F.lit("/player/"), text(F.col("l_partkey")), F.lit("/p"))).otherwise("/none")
    rows = _read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("match_id"), F.col("l_linenumber").alias("game"), F.lit(1).alias("side"), tokens.alias("tokens"), link.alias("link"))
    return legacy.player_records(rows)


_ODDS = """WITH r AS (SELECT user_id, event_id, CASE WHEN event_id % 4 = 0 THEN NULL ELSE event_type END AS provider, value FROM events WHERE event_id % 7 <> 0),
      l AS (SELECT user_id AS match_id, coalesce(provider, 'Unknown Provider') AS provider, arg_max(value, event_id) AS odds1 FROM r GROUP BY ALL) """


def _odds_rows(spark, sf_dir):
    e = _read(spark, sf_dir, "events")
    cells = F.array(F.lit("T1"), F.when(F.col("event_id") % 7 == 0, "").otherwise(F.col("value").cast("string")), F.lit("-"), F.lit("1.5"))
    return e.select(F.col("user_id").alias("match_id"), F.col("event_id").alias("pos"), F.when(F.col("event_id") % 4 != 0, F.col("event_type")).alias("provider_image"), F.lit(" ").alias("provider_text"), cells.alias("cells"))


@_query(_ODDS + "SELECT match_id, provider, odds1::DOUBLE AS odds1, 1.5::DOUBLE AS odds2 FROM l")
def odds_by_provider(spark, sf_dir):
    return legacy.odds(_odds_rows(spark, sf_dir)).select("match_id", "provider", F.col("odds1").cast("double").alias("odds1"), F.col("odds2").cast("double").alias("odds2"))


@_query(_ODDS + "SELECT c_custkey AS match_id, odds1, CASE WHEN odds1 IS NOT NULL THEN 1.5::DOUBLE END AS odds2 FROM customer LEFT JOIN (SELECT * FROM l WHERE provider = 'view') v ON c_custkey = match_id")
def odds_of_provider(spark, sf_dir):
    return legacy.provider_odds(_odds_rows(spark, sf_dir), _read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("match_id")), "view")


@_query(_ODDS + "SELECT match_id, array_to_string(list(provider ORDER BY provider), ',') AS providers, max(odds1) AS best, max(odds1) FILTER (WHERE provider = 'click') AS click FROM l GROUP BY 1")
def odds_maps(spark, sf_dir):
    m = legacy.odds_map(_odds_rows(spark, sf_dir))
    best = F.array_max(F.transform(F.map_values("odds"), lambda o: o["odds1"]))
    return m.select("match_id", F.array_join(F.array_sort(F.map_keys("odds")), ",").alias("providers"), best.alias("best"), F.try_element_at("odds", F.lit("click"))["odds1"].alias("click"))


@_query(r"""SELECT page_id, 'all,' || page_id AS sections, page_id % 3 + 1 AS n_maps FROM pages""")
def page_sections(spark, sf_dir):
    k = F.col("page_id").cast("string")
    extra = F.concat(F.lit('<div id="all-content"></div><div id="'), k, F.lit('-content"></div>'), F.repeat(F.lit('<div class="mapholder">'), (F.col("page_id") % 3 + 1).cast("int")))
    s = legacy.page_sections(F.concat("html", extra))
    return _read(spark, sf_dir, "pages").select("page_id", F.array_join(s["sections"], ",").alias("sections"), s["n_maps"].cast("long").alias("n_maps"))


# evaluation

_FIRST = """WITH p AS (SELECT c_custkey AS team, c_acctbal > 5000 AS first_favoured FROM customer),
      r AS (SELECT o_custkey AS team, min(o_orderkey) AS k FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1),
      j AS (SELECT team, first_favoured, o_orderkey, o_orderstatus FROM p LEFT JOIN r USING (team) LEFT JOIN orders ON o_orderkey = k) """


def _first_results(spark, sf_dir):
    predictions = _read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("team"), (F.col("c_acctbal") > 5000).alias("first_favoured"))
    results = _read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("team"), "o_orderkey", "o_orderstatus")
    return evaluation.first_results(predictions, results, ["team"], "o_orderkey", F.col("o_orderstatus") != "P")


@_query(_FIRST + "SELECT * FROM j")
def predictions_with_results(spark, sf_dir):
    return _first_results(spark, sf_dir)


@_query(_FIRST + """SELECT count(*) FILTER (WHERE ok) AS good, count(*) FILTER (WHERE NOT ok) AS bad, round(100.0 * count(*) FILTER (WHERE ok) / count(ok), 4) AS percent FROM (SELECT first_favoured = (o_orderstatus = 'F') AS ok FROM j)""")
def overall_accuracy(spark, sf_dir):
    rows = _first_results(spark, sf_dir)
    return evaluation.overall_accuracy(rows, F.col("first_favoured") == (F.col("o_orderstatus") == "F"))


@_query("""SELECT DISTINCT '{"event_type":"' || event_type || '","user_id":' || user_id || '}' AS record FROM events""")
def distinct_records(spark, sf_dir):
    return evaluation.distinct_records(_read(spark, sf_dir, "events"), ["event_type", "user_id"])


@_query("SELECT event_id, user_id, value FROM events ORDER BY event_id DESC LIMIT 25")
def last_predictions(spark, sf_dir):
    return evaluation.last_rows(_read(spark, sf_dir, "events").select("event_id", "user_id", "value"), "event_id", 25)


@_query("""WITH t AS (SELECT s_suppkey AS team, s_acctbal / 1000 AS mu, 20.0 AS var, 5 AS players FROM supplier),
      m AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey AS team1, l_suppkey % 7 + 1 AS team2 FROM lineitem WHERE l_shipdate < DATE '1995-06-01')
      SELECT l_orderkey, l_linenumber, l_partkey, team1, team2, round_even(x, 2) AS p1, round(1 - round_even(x, 2), 2) AS p2 FROM (SELECT m.*, CASE WHEN z >= 0 THEN (2 - e) / 2 ELSE e / 2 END AS x FROM (SELECT m.*, z, (0.254829592 * t + -0.284496736 * t * t + 1.421413741 * t * t * t - 1.453152027 * t * t * t * t + 1.061405429 * t * t * t * t * t) * exp(-z * z / 2) AS e
        FROM (SELECT m.*, z, 1 / (1 + 0.3275911 * abs(z) / sqrt(2.0)) AS t FROM (SELECT m.*, (a.mu - b.mu) / sqrt(10 * (25.0 / 6) * (25.0 / 6) + 40.0) AS z FROM m JOIN t a ON team1 = a.team JOIN t b ON team2 = b.team) m) m) m) m""")
def upcoming_predictions(spark, sf_dir):
    teams = _read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("team"), (F.col("s_acctbal") / 1000).alias("mu"), F.lit(20.0).alias("var"), F.lit(5).alias("players"))
    m = _read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate", F.col("l_suppkey").alias("one"), (F.col("l_suppkey") % 7 + 1).alias("two"))
    done = ratings.upcoming_predictions(m, teams, "one", "two", F.col("l_shipdate") < F.lit("1995-06-01").cast("timestamp_ntz"))
    return done.drop("l_shipdate")


@_query("SELECT user_id, event_type AS provider, arg_max(value, (ts, event_id)) AS odds FROM events GROUP BY 1, 2")
def odds_latest_by_provider(spark, sf_dir):
    return evaluation.latest_value(_read(spark, sf_dir, "events"), ["user_id", F.col("event_type").alias("provider")], "value", ["ts", "event_id"], "odds")


@_query("SELECT event_id, (row_number() OVER (ORDER BY event_id DESC) - 1) % 7 AS slot FROM events")
def dealt_in_turn(spark, sf_dir):
    e = _read(spark, sf_dir, "events").select("event_id", (-F.col("event_id")).alias("back"))
    return pages.round_robin(e, "back", 7).select("event_id", F.col("slot").cast("long").alias("slot"))


# tables of parsed matches: even orders are there already, and those beyond them that 3 divides come in a batch


def _records(orders):
    """Records as the parser gives them, written from orders and their lines; every 30th is a challenge page."""
    text = lambda c: F.col(c).cast("string")
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    challenge = k % 30 == 0
    team = lambda number: F.struct(F.when(~challenge & (number % 10 != 0), number).alias("team_id"), F.concat(F.lit("T"), number.cast("string"), F.lit("/"), (k % 2).cast("string")).alias("name"))
    game = F.struct(k.alias("map_id"), F.concat(F.lit("M"), text("o_orderkey")).alias("map_name"))
    player = F.struct(c.alias("player_id"), F.concat(F.lit("P"), (k % 2).cast("string")).alias("nickname"), F.lit(5).alias("kills"))
    none = lambda kind: F.lit(None).cast(kind)
    nothing = lambda x: F.when(challenge, F.slice(F.array(x), 1, 0)).otherwise(F.array(x))
    return orders.select(
        k.alias("match_id"), none("string").alias("slug"), F.lit("/u").alias("source_url"), F.when(~challenge, F.col("o_orderpriority")).alias("event_name"), none("int").alias("best_of"), none("timestamp_ntz").alias("scheduled_at"),
        none("long").alias("winner_team_id"), team(c).alias("team1"), team(c + 1).alias("team2"), none("int").alias("team1_score"), none("int").alias("team2_score"), F.when(challenge, "challenge").otherwise("parsed").alias("status"),
        none("string").alias("raw_demo_url"), F.lit("1").alias("parser_version"), nothing(game).alias("maps"), nothing(player).alias("player_stats"),
    )


def _ingested(spark, sf_dir, preserve=False):
    o = _read(spark, sf_dir, "orders")
    batch = _records(o.where("o_orderkey % 3 = 0"))
    before = _records(o.where("o_orderkey % 2 = 0")).withColumns({"team1_id": F.col("team1.team_id"), "team2_id": F.col("team2.team_id"), "team1_name": F.col("team1.name"), "team2_name": F.col("team2.name")})
    old, now = F.lit("2024-01-01").cast("timestamp_ntz"), F.lit("2024-02-02").cast("timestamp_ntz")
    before = before.withColumns({"event_name": F.lit("old"), "html_key": F.lit("old.html"), "demo_key": F.lit("d"), "first_seen_at": old, "last_ingested_at": old, "ingest_error": F.lit("e")})
    keys = o.where("o_orderkey % 4 = 0").select(F.col("o_orderkey").alias("match_id"), F.lit("new.html").alias("html_key"))
    c = _read(spark, sf_dir, "customer").where("c_custkey % 2 = 0")
    tables = {
        "teams": c.select(F.col("c_custkey").alias("team_id"), F.lit("old").alias("name"), old.alias("created_at"), old.alias("updated_at")),
        "matches": before.select("match_id", *store.PARSED, "html_key", "demo_key", "first_seen_at", "last_ingested_at", "ingest_error"),
        "maps": o.where("o_orderkey % 2 = 0").select(F.col("o_orderkey").alias("match_id"), F.lit(7).alias("pos"), F.lit(1).cast("long").alias("map_id"), F.lit("old").alias("map_name")),
        "players": c.select(F.col("c_custkey").alias("player_id"), F.lit("old").alias("nickname"), old.alias("created_at"), old.alias("updated_at")),
        "stats": o.where("o_orderkey % 2 = 0").select(F.col("o_orderkey").alias("match_id"), F.lit(1).cast("long").alias("player_id"), F.lit("old").alias("nickname"), F.lit(0).alias("kills")),
    }
    return store.ingested(tables, batch, keys, now, preserve)


_OLD, _NOW = "TIMESTAMP '2024-01-01 00:00:00'", "TIMESTAMP '2024-02-02 00:00:00'"
_BATCH = """WITH b AS (SELECT *, o_orderkey % 30 = 0 AS challenge FROM orders WHERE o_orderkey % 3 = 0),
      s AS (SELECT o_orderkey, o_custkey + i AS id, 'T' || (o_custkey + i) || '/' || o_orderkey % 2 AS name FROM b, (VALUES (0), (1)) v(i) WHERE NOT challenge AND (o_custkey + i) % 10 <> 0),
      c AS (SELECT c_custkey FROM customer WHERE c_custkey % 2 = 0) """


@_query(_BATCH + f"""SELECT coalesce(n.id, c_custkey) AS team_id, coalesce(n.name, 'old') AS name, CASE WHEN c_custkey IS NULL THEN {_NOW} ELSE {_OLD} END AS created_at, CASE WHEN n.id IS NULL THEN {_OLD} ELSE {_NOW} END AS updated_at
      FROM c FULL JOIN (SELECT id, arg_max(name, o_orderkey) AS name FROM s GROUP BY id) n ON id = c_custkey""")
def teams_upserted(spark, sf_dir):
    return _ingested(spark, sf_dir)["teams"]


def _matches_sql(kept: str) -> str:
    fresh = f"(b.o_orderkey IS NOT NULL AND NOT ({kept}))"
    return _BATCH + f"""SELECT o.o_orderkey AS match_id, CASE WHEN {fresh} THEN CASE WHEN NOT challenge THEN o.o_orderpriority END ELSE 'old' END AS event_name, CASE WHEN o.o_orderkey % 30 = 0 THEN 'challenge' ELSE 'parsed' END AS status,
      CASE WHEN {fresh} AND o.o_orderkey % 4 = 0 THEN 'new.html' WHEN o.o_orderkey % 2 = 0 THEN 'old.html' END AS html_key, CASE WHEN o.o_orderkey % 2 = 0 THEN 'd' END AS demo_key,
      CASE WHEN o.o_orderkey % 2 = 0 THEN {_OLD} ELSE {_NOW} END AS first_seen_at, CASE WHEN {fresh} THEN {_NOW} ELSE {_OLD} END AS last_ingested_at, CASE WHEN NOT {fresh} THEN 'e' END AS ingest_error
      FROM orders o LEFT JOIN b ON b.o_orderkey = o.o_orderkey WHERE o.o_orderkey % 2 = 0 OR o.o_orderkey % 3 = 0"""


_MATCH_COLUMNS = ["match_id", "event_name", "status", "html_key", "demo_key", "first_seen_at", "last_ingested_at", "ingest_error"]


@_query(_matches_sql("false"))
def matches_upserted(spark, sf_dir):
    return _ingested(spark, sf_dir)["matches"].select(*_MATCH_COLUMNS)


@_query(_matches_sql("coalesce(challenge, false) AND o.o_orderkey % 2 = 0"))
def matches_preserved(spark, sf_dir):
    return _ingested(spark, sf_dir, True)["matches"].select(*_MATCH_COLUMNS)


@_query(_BATCH + """SELECT o_orderkey AS match_id, 7 AS pos, 1::BIGINT AS map_id, 'old' AS map_name FROM orders WHERE o_orderkey % 2 = 0 AND o_orderkey % 3 <> 0 UNION ALL SELECT o_orderkey, 0, o_orderkey, 'M' || o_orderkey FROM b WHERE NOT challenge""")
def maps_replaced(spark, sf_dir):
    return _ingested(spark, sf_dir)["maps"]


@_query(_BATCH + f"""SELECT coalesce(p.id, c_custkey) AS player_id, coalesce(p.name, 'old') AS nickname, CASE WHEN c_custkey IS NULL THEN {_NOW} ELSE {_OLD} END AS created_at, CASE WHEN p.id IS NULL THEN {_OLD} ELSE {_NOW} END AS updated_at
      FROM c FULL JOIN (SELECT o_custkey AS id, arg_max('P' || o_orderkey % 2, o_orderkey) AS name FROM b WHERE NOT challenge GROUP BY 1) p ON id = c_custkey""")
def players_upserted(spark, sf_dir):
    return _ingested(spark, sf_dir)["players"]


@_query(_BATCH + """SELECT o_orderkey AS match_id, 1::BIGINT AS player_id, 'old' AS nickname, 0 AS kills FROM orders WHERE o_orderkey % 2 = 0 AND (o_orderkey % 3 <> 0 OR o_orderkey % 30 = 0) UNION ALL SELECT o_orderkey, o_custkey, 'P' || o_orderkey % 2, 5 FROM b WHERE NOT challenge""")
def stats_preserved(spark, sf_dir):
    return _ingested(spark, sf_dir, True)["stats"]


@_query("""WITH f AS (SELECT user_id || event_type AS feed, max(ts) AS last_seen, max(user_id) AS user_id FROM events GROUP BY 1)
      SELECT feed, last_seen FROM f WHERE last_seen < TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 24 HOUR AND (user_id % 3 <> 0 OR user_id % 2 = 0)""")
def staleness_alerts(spark, sf_dir):
    """A feed is a user's events of a kind; some had their alert lately."""
    e, now = _read(spark, sf_dir, "events").withColumn("feed", F.concat(F.col("user_id").cast("string"), "event_type")), F.lit("2024-01-31 00:00:00").cast("timestamp_ntz")
    last = e.where("user_id % 3 = 0").select("feed", F.when(F.col("user_id") % 2 == 0, F.lit("2024-01-29 00:00:00")).otherwise("2024-01-30 12:00:00").cast("timestamp_ntz").alias("alerted_at")).distinct()
    return evaluation.alerts(evaluation.stale(e, "feed", "ts", now, 24), last, "feed", now, 24).select("feed", "last_seen")

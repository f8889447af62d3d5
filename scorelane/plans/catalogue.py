"""The registered queries over the test tables and the SQL each is checked against."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from scorelane.functions.html import challenge_markers, decoded, instant_of_epoch, page_title
from scorelane.operators import evaluation, matches, messages, pages, ratings, state

BASE = "https://stats.example"
#: The test pages hold no match links: every link of a page stands in for them.
ANY_LINK = r'href="([^"]+)"'

_QUERIES: dict = {}
_ORACLES: dict = {}


def _query(sql: str | None = None):
    def add(f):
        _QUERIES[f.__name__] = f
        if sql:
            _ORACLES[f.__name__] = sql
        return f

    return add


def _read(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def flagship(spark, sf_dir):
    return discover_links(spark, sf_dir).groupBy("link").agg(F.count("*").alias("n_pages"))


def queries():
    from scorelane.plans import ingests, replays, runs, stores  # noqa: F401 (these register their queries)

    return dict(_QUERIES)


def oracles():
    queries()
    return dict(_ORACLES)


# pages

LINKS_SQL = """WITH h AS (SELECT page_id, unnest(regexp_extract_all(html, 'href="([^"]+)"', 1)) AS href,
                            generate_subscripts(regexp_extract_all(html, 'href="([^"]+)"', 1), 1) AS i FROM pages),
     a AS (SELECT page_id, i, CASE WHEN href LIKE 'http%' THEN href ELSE 'https://stats.example' || href END AS link FROM h),
     f AS (SELECT page_id, link, min(i) AS i FROM a GROUP BY page_id, link),
     l AS (SELECT page_id, row_number() OVER (PARTITION BY page_id ORDER BY i) - 1 AS pos, link FROM f) """


@_query(LINKS_SQL + "SELECT page_id, pos, link FROM l")
def discover_links(spark, sf_dir):
    return pages.discover(_read(spark, sf_dir, "pages"), BASE, ANY_LINK, None)


@_query(LINKS_SQL + "SELECT page_id, pos, link FROM l WHERE pos < 3")
def discover_capped(spark, sf_dir):
    return pages.discover(_read(spark, sf_dir, "pages"), BASE, ANY_LINK, 3)


@_query(LINKS_SQL + "SELECT DISTINCT link FROM l WHERE link NOT IN (SELECT link FROM l WHERE page_id % 2 = 0)")
def discover_frontier(spark, sf_dir):
    found = discover_links(spark, sf_dir)
    return pages.frontier(found, found.where("page_id % 2 = 0"))


@_query("""SELECT page_id, nullif(regexp_extract(u, '/matches/(\\d+)', 1), '')::BIGINT AS match_id, nullif(regexp_extract(u, '/matches/\\d+/([^/?#]+)', 1), '') AS slug
           FROM (SELECT page_id, regexp_replace(url, '^(.*/)(\\d+)(.*)$', '\\1matches/\\2/s-\\2\\3') AS u FROM pages)""")
def url_id_slug(spark, sf_dir):
    url = F.regexp_replace("url", r"^(.*/)(\d+)(.*)$", "$1matches/$2/s-$2$3")
    return _read(spark, sf_dir, "pages").select("page_id", pages.match_id(url).alias("match_id"), pages.match_slug(url).alias("slug"))


@_query("SELECT regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) AS host, count(*) AS n FROM pages GROUP BY 1")
def url_host_counts(spark, sf_dir):
    return _read(spark, sf_dir, "pages").groupBy(F.regexp_extract("url", "^[a-z]+://([^/?#]+)", 1).alias("host")).agg(F.count("*").alias("n"))


@_query("SELECT page_id, nullif(trim(regexp_extract(html, '<title[^>]*>([^<]*)</title>', 1)), '') AS title FROM pages")
def page_title_text(spark, sf_dir):
    return _read(spark, sf_dir, "pages").select("page_id", page_title(F.col("html")).alias("title"))


@_query("""SELECT page_id, array_to_string(list_filter(['Just a moment...', 'Enable JavaScript and cookies to continue', 'Attention Required! | Cloudflare',
             '/cdn-cgi/challenge-platform/', 'cf-browser-verification', 'challenge-platform'], lambda m: contains(h, m)), ',') AS markers
           FROM (SELECT page_id, CASE WHEN page_id % 3 = 0 THEN html || '/cdn-cgi/challenge-platform/x' WHEN page_id % 3 = 1 THEN 'Just a moment...' || html ELSE html END AS h FROM pages)""")
def page_challenge_markers(spark, sf_dir):
    r = F.col("page_id") % 3
    html = F.when(r == 0, F.concat("html", F.lit("/cdn-cgi/challenge-platform/x"))).when(r == 1, F.concat(F.lit("Just a moment..."), "html")).otherwise(F.col("html"))
    return _read(spark, sf_dir, "pages").select("page_id", F.array_join(challenge_markers(html), ",").alias("markers"))


@_query("""SELECT page_id, sha256(replace(replace(replace(replace(replace(html, '&amp;', '&'), '&quot;', '"'), '&#39;', ''''), '&lt;', '<'), '&gt;', '>')) AS decoded_sha256 FROM pages""")
def html_decode(spark, sf_dir):
    return _read(spark, sf_dir, "pages").select("page_id", F.sha2(decoded(F.col("html")), 256).alias("decoded_sha256"))


@_query("""SELECT page_id, 'raw-html/2024/03/05/' || page_id || '_2024-03-05T06-07-08-009Z.html' AS object_key, strlen(html)::BIGINT AS byte_size, sha256(html) AS checksum FROM pages""")
def artifact_manifest(spark, sf_dir):
    at = F.lit("2024-03-05 06:07:08.009").cast("timestamp_ntz")
    return pages.artifacts(_read(spark, sf_dir, "pages"), at)


@_query(LINKS_SQL + """SELECT p.page_id, nullif(trim(regexp_extract(html, '<title[^>]*>([^<]*)</title>', 1)), '') AS title, false AS challenge, coalesce(c.n, 0) AS n_links,
             coalesce(c.s, '') AS sample, length(html) AS html_chars, strlen(html)::BIGINT AS html_bytes
           FROM pages p LEFT JOIN (SELECT page_id, count(*) AS n, string_agg(link, ' ' ORDER BY pos) FILTER (WHERE pos < 10) AS s FROM l GROUP BY page_id) c USING (page_id)""")
def page_summary(spark, sf_dir):
    return pages.summary(_read(spark, sf_dir, "pages"), BASE, ANY_LINK)


@_query("""SELECT doc_id, instr(lower(text), 'licensed') AS at, substr(text, greatest(1, instr(lower(text), 'licensed') - 40), instr(lower(text), 'licensed') + 60 - greatest(1, instr(lower(text), 'licensed') - 40)) AS context
           FROM documents WHERE instr(lower(text), 'licensed') > 0""")
def keyword_context(spark, sf_dir):
    return pages.keyword_context(_read(spark, sf_dir, "documents"), "doc_id", "text", "licensed", 40, 60)


# match pages, written from the relational tables and parsed again

LINES_SQL = """WITH g AS (SELECT l_orderkey, l_linenumber, min(l_suppkey * 1000000 + l_partkey) AS k FROM lineitem GROUP BY ALL),
     m AS (SELECT l_orderkey AS match_id, l_orderkey * 10 + l_linenumber AS map_id, l_linenumber AS line, k // 1000000 AS supp, k % 1000000 AS part FROM g) """


def _match_pages(spark, sf_dir):
    """One page of our own writing per order: teams from customers, maps and players from lines."""
    lines = _read(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.min(F.col("l_suppkey") * 1_000_000 + F.col("l_partkey")).alias("k"))
    text = lambda c: F.col(c).cast("string") if isinstance(c, str) else c.cast("string")
    # numbers are shuffled; the text of a page is written once they are together
    supp, part = lambda x: F.floor(x["k"] / 1_000_000), lambda x: x["k"] % 1_000_000
    number = lambda x: F.col("o_orderkey") * 10 + x["l_linenumber"]
    block = lambda x: F.concat(
        F.lit('<div class="mapholder"><div class="mapname">Map'), text(x["l_linenumber"]), F.lit('</div><a href="/stats/matches/mapstatsid/'), text(number(x)), F.lit('/x">s</a><div class="results-team-score">'),
        text(supp(x) % 17), F.lit('</div><div class="results-team-score"> '), text(part(x) % 17), F.lit(" </div></div>"),
    )
    section = lambda x: F.concat(
        F.lit('<div class="stats-content" id="'), text(number(x)), F.lit('-content"><table class="table totalstats"><tr class="header-row"><td><a href="/team/'), text(supp(x)), F.lit('/t" class="teamName team">T</a></td></tr><tr><td><a href="/player/'),
        text(part(x)), F.lit('/p"><span class="player-nick">p&amp;'), text(part(x)), F.lit('</span></a></td><td class="kd text-center traditional-data">'), text(supp(x) % 40), F.lit(" - "), text(part(x) % 30),
        F.lit('</td><td class="adr text-center traditional-data">'), text((part(x) % 1000) / 10), F.lit('</td><td class="kast text-center traditional-data">'), text(part(x) % 101), F.lit('.0%</td><td class="rating text-center">'), text((supp(x) % 200) / 100), F.lit("</td></tr></table></div>"),
    )
    made = lines.select("l_orderkey", F.struct("l_linenumber", "k").alias("x"))
    made = made.groupBy("l_orderkey").agg(F.array_sort(F.collect_list("x")).alias("xs"))  # the lines of one order
    o = _read(spark, sf_dir, "orders").join(made, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    team = lambda n, key, score: F.concat(F.lit(f'<div class="team{n}-gradient"><a href="/team/'), text(key), F.lit(f'/t"><div class="teamName">Team '), text(key), F.lit('</div></a><div class="score">'), text(score), F.lit("</div></div>"))
    millis = F.unix_millis(F.col("o_orderdate").cast("timestamp"))
    html = F.concat(
        team(1, F.col("o_custkey"), F.col("o_orderkey") % 3), team(2, F.col("o_custkey") + 1, (F.col("o_orderkey") + F.col("o_custkey")) % 3), F.lit('<div class="event text-ellipsis" title="'), "o_orderpriority", F.lit('">e</div>Best of '),
        text(F.col("o_orderkey") % 5 + 1), F.lit('<div data-unix="'), text(millis), F.lit('"></div>'), F.when(F.col("o_orderstatus") == "F", F.concat(F.lit('<a data-demo-link="/download/demo/'), text("o_orderkey"), F.lit('">d</a>'))).otherwise(F.lit("")),
        F.coalesce(F.array_join(F.transform("xs", block), ""), F.lit("")), F.coalesce(F.array_join(F.transform("xs", section), ""), F.lit("")),
    )
    o = o.repartition(spark.sparkContext.defaultParallelism, "o_orderkey")  # parsing is work for all cores, though the rows are small
    return o.select(F.concat(F.lit(f"{BASE}/matches/"), text("o_orderkey"), F.lit("/s-"), text("o_custkey")).alias("match_url"), html.alias("html"))


def _parsed(spark, sf_dir):
    return matches.parse_matches(_match_pages(spark, sf_dir), BASE)


MATCH_SQL = """SELECT o_orderkey AS match_id, 's-' || o_custkey AS slug, o_orderpriority AS event_name, (o_orderkey % 5 + 1)::INT AS best_of, o_orderdate AS scheduled_at,
     o_custkey AS team1_id, 'Team ' || o_custkey AS team1_name, o_custkey + 1 AS team2_id, 'Team ' || (o_custkey + 1) AS team2_name, (o_orderkey % 3)::INT AS team1_score, ((o_orderkey + o_custkey) % 3)::INT AS team2_score,
     CASE WHEN o_orderkey % 3 > (o_orderkey + o_custkey) % 3 THEN o_custkey WHEN o_orderkey % 3 < (o_orderkey + o_custkey) % 3 THEN o_custkey + 1 END AS winner_team_id,
     CASE WHEN o_orderstatus = 'F' THEN 'https://stats.example/download/demo/' || o_orderkey END AS raw_demo_url,
     CASE WHEN o_orderkey IN (SELECT l_orderkey FROM lineitem) THEN 'parsed' ELSE 'partial' END AS status FROM orders"""


@_query(MATCH_SQL)
def parse_matches(spark, sf_dir):
    return _parsed(spark, sf_dir).select(
        "match_id", "slug", "event_name", "best_of", F.col("scheduled_at").cast("timestamp_ntz").alias("scheduled_at"), F.col("team1.team_id").alias("team1_id"), F.col("team1.name").alias("team1_name"),
        F.col("team2.team_id").alias("team2_id"), F.col("team2.name").alias("team2_name"), "team1_score", "team2_score", "winner_team_id", "raw_demo_url", "status",
    )


@_query(LINES_SQL + """SELECT match_id, row_number() OVER (PARTITION BY match_id ORDER BY line) - 1 AS pos, map_id, 'Map' || line AS map_name, 'https://stats.example/stats/matches/mapstatsid/' || map_id || '/x' AS source_url,
     (supp % 17)::INT AS team1_score, (part % 17)::INT AS team2_score FROM m JOIN orders ON match_id = o_orderkey""")
def parse_maps(spark, sf_dir):
    return matches.maps_of(_parsed(spark, sf_dir))


@_query(LINES_SQL + """SELECT match_id, part AS player_id, 'p&' || part AS nickname, supp AS team_id, 'Map' || line AS map_name, (supp % 40)::INT AS kills, (part % 30)::INT AS deaths,
     (part % 1000) / 10 AS adr, (supp % 200) / 100 AS rating, (part % 101)::DOUBLE AS kast, 'https://stats.example/stats/matches/mapstatsid/' || map_id || '/x' AS source_url FROM m JOIN orders ON match_id = o_orderkey""")
def parse_player_stats(spark, sf_dir):
    return matches.player_stats_of(_parsed(spark, sf_dir))


@_query(f"SELECT status, count(*) AS n FROM ({MATCH_SQL}) GROUP BY status")
def match_status_counts(spark, sf_dir):
    return _parsed(spark, sf_dir).groupBy("status").agg(F.count("*").alias("n"))


@_query("""SELECT o_orderkey, CASE WHEN o_orderkey % 7 > o_custkey % 7 THEN 1 WHEN o_orderkey % 7 < o_custkey % 7 THEN 2 END AS winner FROM orders""")
def winner_resolution(spark, sf_dir):
    return _read(spark, sf_dir, "orders").select("o_orderkey", matches.winner(F.col("o_orderkey") % 7, F.col("o_custkey") % 7, F.lit(1), F.lit(2)).alias("winner"))


@_query("SELECT o_orderkey, o_orderdate AS scheduled_at FROM orders")
def epoch_normalise(spark, sf_dir):
    millis = F.unix_millis(F.col("o_orderdate").cast("timestamp"))
    mixed = F.when(F.col("o_orderkey") % 2 == 0, millis).otherwise(F.floor(millis / 1000))
    return _read(spark, sf_dir, "orders").select("o_orderkey", instant_of_epoch(mixed).cast("timestamp_ntz").alias("scheduled_at"))


# keyed state


@_query("SELECT user_id, event_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1")
def upsert_latest(spark, sf_dir):
    e = _read(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "value", "ts")
    order = [F.col("ts").desc(), F.col("event_id").desc()]
    old, new = state.latest(e.where("event_id % 2 = 0"), ["user_id"], order), state.latest(e, ["user_id"], order)
    return state.merge(old, new, ["user_id"]).drop("ts")


@_query("""WITH o AS (SELECT user_id, max(event_id) AS event_id, max(value) AS value FROM events WHERE event_type = 'click' GROUP BY 1),
      n AS (SELECT user_id, max(event_id) AS event_id, CASE WHEN user_id % 2 = 0 THEN max(value) END AS value FROM events WHERE event_type = 'view' GROUP BY 1)
      SELECT coalesce(n.user_id, o.user_id) AS user_id, coalesce(o.event_id, n.event_id) AS event_id, coalesce(n.value, o.value) AS value FROM o FULL JOIN n USING (user_id)""")
def upsert_coalesce(spark, sf_dir):
    e = _read(spark, sf_dir, "events")
    most = lambda kind: e.where(F.col("event_type") == kind).groupBy("user_id").agg(F.max("event_id").alias("event_id"), F.max("value").alias("value"))
    new = most("view").withColumn("value", F.when(F.col("user_id") % 2 == 0, F.col("value")))
    return state.merge(most("click"), new, ["user_id"], keep=("event_id",), fill=("value",))


@_query("""SELECT l_orderkey, l_partkey, l_quantity FROM lineitem WHERE l_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_linenumber = 7)
      UNION ALL SELECT l_orderkey, l_partkey, l_quantity FROM lineitem WHERE l_linenumber = 7""")
def replace_set(spark, sf_dir):
    rows = _read(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_linenumber")
    return state.replace_set(rows, rows.where("l_linenumber = 7"), ["l_orderkey"]).drop("l_linenumber")


@_query("""WITH e AS (SELECT user_id, max(event_id) AS last_error FROM events WHERE event_type = 'error' GROUP BY 1), a AS (SELECT user_id, sum(value) AS total FROM events WHERE event_type = 'purchase' GROUP BY 1)
      SELECT coalesce(a.user_id, e.user_id) AS user_id, round(total, 4) AS total, CASE WHEN e.user_id IS NOT NULL THEN 'error' ELSE 'parsed' END AS status, last_error FROM a FULL JOIN e USING (user_id)""")
def error_overlay(spark, sf_dir):
    e = _read(spark, sf_dir, "events")
    old = e.where("event_type = 'purchase'").groupBy("user_id").agg(F.round(F.sum("value"), 4).alias("total")).withColumns({"status": F.lit("parsed"), "last_error": F.lit(None).cast("long")})
    new = e.where("event_type = 'error'").groupBy("user_id").agg(F.max("event_id").alias("last_error")).withColumn("status", F.lit("error"))
    return state.merge(old, new, ["user_id"])


@_query("""SELECT c_custkey, c_name FROM customer WHERE c_nationkey < 10 UNION ALL
      SELECT c_custkey, 'new' AS c_name FROM customer WHERE c_nationkey BETWEEN 5 AND 15 AND c_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_nationkey < 10)""")
def insert_ignore(spark, sf_dir):
    c = _read(spark, sf_dir, "customer")
    new = c.where("c_nationkey between 5 and 15").select("c_custkey", F.lit("new").alias("c_name"))
    return state.insert_ignore(c.where("c_nationkey < 10").select("c_custkey", "c_name"), new, ["c_custkey"])


@_query("""WITH r AS (SELECT o_custkey, o_orderkey, array_to_string(list_sort(list(DISTINCT l_suppkey % 5)), ';') AS roster FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1, 2),
      p AS (SELECT *, lag(roster) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS previous FROM r)
      SELECT *, previous IS NOT NULL AND previous <> roster AS changed FROM p""")
def roster_changes(spark, sf_dir):
    joined = _read(spark, sf_dir, "orders").join(_read(spark, sf_dir, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey"))
    rosters = joined.groupBy("o_custkey", "o_orderkey").agg(state.roster_key(F.collect_set(F.col("l_suppkey") % 5)).alias("roster"))
    return state.roster_changes(rosters, "o_custkey", "o_orderkey", "roster")


@_query("""SELECT l_orderkey, count(*) AS n FROM lineitem WHERE l_orderkey NOT IN (SELECT l_orderkey FROM lineitem LEFT JOIN (SELECT * FROM supplier WHERE s_acctbal > 0) s ON l_suppkey = s_suppkey WHERE s_suppkey IS NULL) GROUP BY 1""")
def constraint_quarantine(spark, sf_dir):
    good = _read(spark, sf_dir, "supplier").where("s_acctbal > 0").select("s_suppkey")
    rows = _read(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey").join(good, F.col("l_suppkey") == F.col("s_suppkey"), "left")
    return state.quarantine(rows, ["l_orderkey"], F.col("s_suppkey").isNull())[0].groupBy("l_orderkey").agg(F.count("*").alias("n"))


# messages

_KIND = "CASE event_id % 8 WHEN 0 THEN 'a' WHEN 1 THEN 'b' WHEN 2 THEN 'c' WHEN 3 THEN 'd' WHEN 4 THEN 'e' WHEN 5 THEN 'f' WHEN 6 THEN 'g' ELSE 'h' END"


def _bodies(events):
    """JSON bodies of eight shapes, by event id."""
    k = F.col("event_id").cast("string")
    shapes = [
        F.concat(F.lit('{"type":"ingest-match","payload":{"matchId":'), k, F.lit("}}")),
        F.concat(F.lit('{"type":"discover-results","payload":{"pageUrl":"/r/'), k, F.lit('","maxMatches":5}}')),
        F.lit('{"type":"discover-results","payload":{"pageUrl":7}}'),
        F.lit('{"type":"ingest-match","payload":{"html":"x"}}'),
        F.lit('{"type":"other","payload":{}}'),
        F.col("props"),
        F.lit('{"type":"ingest-match","payload":{"matchUrl":"/matches/1/a","matchId":"1"}}'),
        F.lit('{"type":"ingest-match","payload":{"matchUrl":null,"matchId":3}}'),
    ]
    body = F.coalesce(*[F.when(F.col("event_id") % 8 == i, s) for i, s in enumerate(shapes)])
    return events.select("event_id", "event_type", body.alias("body"))


ERROR_SQL = """CASE event_id % 8 WHEN 2 THEN 'Queue discovery job requires a string pageUrl when provided' WHEN 3 THEN 'Queue ingest job requires either matchUrl or matchId'
   WHEN 4 THEN 'Unsupported queue message type' WHEN 5 THEN 'Queue message must contain a type and payload object' WHEN 6 THEN 'Queue ingest job requires matchId to be numeric when provided' END"""
OUTCOME_SQL = f"SELECT event_id, CASE WHEN {ERROR_SQL} IS NOT NULL THEN 'dropped' WHEN event_type = 'error' THEN 'retry' ELSE 'done' END AS outcome FROM events"


@_query(f"SELECT event_id, {ERROR_SQL} AS error FROM events")
def validate_messages(spark, sf_dir):
    return messages.validate(_bodies(_read(spark, sf_dir, "events"))).select("event_id", "error")


@_query(OUTCOME_SQL)
def dead_letter_split(spark, sf_dir):
    checked = messages.validate(_bodies(_read(spark, sf_dir, "events")))
    return messages.dead_letters(checked, F.col("event_type") == "error").select("event_id", "outcome")


@_query(LINKS_SQL + """SELECT link, '{"type":"ingest-match","payload":{"matchUrl":"' || link || '","persistHtml":true,"source":"cron"}}' AS body FROM (SELECT DISTINCT link FROM l)""")
def fan_out_messages(spark, sf_dir):
    urls = discover_links(spark, sf_dir).select("link").distinct()
    return messages.fan_out(urls, "link", {"persistHtml": F.lit(True), "source": F.lit("cron")})


@_query("""WITH RECURSIVE e AS (SELECT event_id, user_id % 10 AS lock, epoch_us(ts) // 1000 AS now, event_type = 'error' AS asks, user_id::VARCHAR AS token,
        row_number() OVER (PARTITION BY user_id % 10 ORDER BY ts, event_id) AS k FROM events WHERE event_type IN ('error', 'click')),
      f(lock, k, holder, until, acquired) AS (SELECT DISTINCT lock, 0::BIGINT, NULL::VARCHAR, 0::BIGINT, NULL::BOOLEAN FROM e
        UNION ALL SELECT e.lock, e.k, CASE WHEN asks AND (holder IS NULL OR until < now) THEN token WHEN NOT asks AND holder = token THEN NULL ELSE holder END,
          CASE WHEN asks AND (holder IS NULL OR until < now) THEN now + 600000 ELSE until END, CASE WHEN asks THEN holder IS NULL OR until < now END
        FROM f JOIN e ON e.lock = f.lock AND e.k = f.k + 1)
      SELECT event_id, lock, now AS "at", CASE WHEN asks THEN 'acquire' ELSE 'release' END AS action, token, acquired FROM e JOIN f USING (lock, k)""")
def lock_timeline(spark, sf_dir):
    """Error events acquire and click events release a lock of their user's group."""
    e = _read(spark, sf_dir, "events").where("event_type in ('error', 'click')")
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    rows = e.select("event_id", (F.col("user_id") % 10).alias("lock"), ms.alias("at"), F.when(F.col("event_type") == "error", "acquire").otherwise("release").alias("action"), F.col("user_id").cast("string").alias("token"))
    return state.lock_timeline(rows, "lock", "at", "action", "token", 600_000, "event_id")


@_query("""SELECT user_id, min(ts) AS created_at, max(ts) AS finished_at, arg_max(event_type, (ts, event_id)) AS status, arg_max(props, (ts, event_id)) AS message FROM events GROUP BY user_id""")
def run_ledger(spark, sf_dir):
    e = _read(spark, sf_dir, "events").select("user_id", "ts", "event_id", F.col("event_type").alias("status"), F.col("props").alias("message"))
    return state.run_ledger(e, "user_id", ["ts", "event_id"], "status", "message")


# games, ratings, odds


@_query("SELECT l_orderkey, l_linenumber, l_quantity, o_custkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_returnflag <> 'R' AND o_orderdate < DATE '1996-01-01'")
def games_before_day(spark, sf_dir):
    games = _read(spark, sf_dir, "lineitem").where("l_returnflag <> 'R'").select("l_orderkey", "l_linenumber", "l_quantity")
    orders = _read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    found = ratings.games_before(games, orders, "l_orderkey", "o_orderkey", F.col("o_orderdate") < F.lit("1996-01-01").cast("timestamp_ntz"))
    return found.drop("o_orderdate")


@_query("SELECT coalesce(max(o_orderkey), 2328088) AS last_id, count(*) AS n FROM orders WHERE o_orderstatus = 'F'")
def resume_point(spark, sf_dir):
    return ratings.resume_mark(_read(spark, sf_dir, "orders").where("o_orderstatus = 'F'"), "o_orderkey", 2328088)


@_query("""SELECT o_orderkey, array_to_string(list_sort(list(l_suppkey) FILTER (WHERE l_linenumber <= 3)), ';') AS players1, array_to_string(list_sort(list(l_suppkey) FILTER (WHERE l_linenumber > 3)), ';') AS players2, count(*) AS n
      FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1 HAVING count(*) FILTER (WHERE l_linenumber <= 3) > 0 AND count(*) FILTER (WHERE l_linenumber > 3) > 0""")
def game_assembly(spark, sf_dir):
    joined = _read(spark, sf_dir, "orders").join(_read(spark, sf_dir, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey"))
    return ratings.assembled_games(joined, "o_orderkey", "l_suppkey", F.col("l_linenumber") <= 3)


@_query("""SELECT event_type, count(*) AS n, round(sum(value), 4) AS total, round(avg(value), 4) AS avg, quantile_disc(value, 0.5) AS median, quantile_disc(value, 0.95) AS p95, min(value) AS least, max(value) AS most FROM events GROUP BY 1""")
def latency_summary(spark, sf_dir):
    return evaluation.sample_summary(_read(spark, sf_dir, "events"), "event_type", "value")


@_query("""SELECT round(sum(value) FILTER (WHERE event_type = 'view') - sum(value) FILTER (WHERE event_type = 'error'), 2) AS delta, round(sum(value) FILTER (WHERE event_type = 'view') / nullif(sum(value) FILTER (WHERE event_type = 'error'), 0), 2) AS ratio FROM events""")
def speedup_ratio(spark, sf_dir):
    return evaluation.speed_up(_read(spark, sf_dir, "events"), "event_type", "value", "view", "error")


@_query("""WITH e AS (SELECT user_id, event_id, event_type = 'click' AS first FROM events WHERE event_type IN ('click', 'view'))
      SELECT user_id, array_to_string(list(CASE WHEN first THEN 1 ELSE 2 END ORDER BY event_id), ',') AS winners FROM e GROUP BY 1""")
def round_winners(spark, sf_dir):
    e = _read(spark, sf_dir, "events").where("event_type in ('click', 'view')")
    w = Window.partitionBy("user_id").orderBy("event_id")
    count = lambda kind: F.sum((F.col("event_type") == kind).cast("int")).over(w).cast("string")
    scores = e.select("user_id", "event_id", F.concat(count("click"), F.lit("-"), count("view")).alias("score"))
    lists = scores.groupBy("user_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("event_id", "score"))), lambda x: x["score"]).alias("scores"))
    return lists.select("user_id", F.array_join(F.transform(ratings.round_winners(F.col("scores")), lambda x: x.cast("string")), ",").alias("winners"))


@_query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN a + b < 15 THEN repeat('0', a) || repeat('1', b) WHEN a > b THEN '0' ELSE '1' END AS rounds
      FROM (SELECT *, (l_quantity % 17)::INT AS a, (l_partkey % 17)::INT AS b FROM lineitem)""")
def series_to_rounds(spark, sf_dir):
    a, b = (F.col("l_quantity") % 17).cast("int"), (F.col("l_partkey") % 17).cast("int")
    rounds = F.array_join(F.transform(ratings.series_to_rounds(a, b), lambda x: x.cast("string")), "")
    return _read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", rounds.alias("rounds"))


@_query("""WITH m AS (SELECT c_nationkey, avg(c_acctbal) AS mean FROM customer GROUP BY 1)
      SELECT c_custkey, round(c_acctbal + 128.0 * ((c_custkey % 2) - 1 / (1 + pow(10.0, (m.mean - c_acctbal) / 400.0))), 4) AS elo FROM customer JOIN m ON m.c_nationkey = (customer.c_nationkey + 1) % 25""")
def elo_round_update(spark, sf_dir):
    c = _read(spark, sf_dir, "customer")
    mean = c.groupBy(F.col("c_nationkey").alias("other")).agg(F.avg("c_acctbal").alias("mean"))
    joined = c.join(mean, F.col("other") == (F.col("c_nationkey") + 1) % 25)
    return joined.select("c_custkey", F.round(ratings.elo_update(F.col("c_acctbal"), F.col("mean"), F.col("c_custkey") % 2), 4).alias("elo"))


def _games(spark, sf_dir):
    e = _read(spark, sf_dir, "events")
    return e.select((F.col("user_id") % 4).alias("league"), F.col("event_id").alias("game_id"), F.col("user_id").alias("a"), (F.col("user_id") + 4 * (1 + F.col("event_id") % 3)).alias("b"), F.col("value").alias("v"))


@_query("""WITH RECURSIVE g AS (SELECT user_id % 4 AS league, user_id AS a, user_id + 4 * (1 + event_id % 3) AS b, (value > 15)::INT AS w, row_number() OVER (PARTITION BY user_id % 4 ORDER BY event_id) AS k FROM events),
      f(league, k, m) AS (SELECT DISTINCT league, 0::BIGINT, MAP {-1::BIGINT: 0.0::DOUBLE} FROM g
        UNION ALL SELECT league, k, map_concat(m, MAP {a: x + 128.0 * (w - ex), b: y + 128.0 * ((1 - w) - (1 - ex))}) FROM (
          SELECT f.league, g.k, f.m, g.a, g.b, g.w, coalesce(f.m[g.a], 1000.0) AS x, coalesce(f.m[g.b], 1000.0) AS y,
                 1 / (1 + pow(10.0, (coalesce(f.m[g.b], 1000.0) - coalesce(f.m[g.a], 1000.0)) / 400.0)) AS ex FROM f JOIN g ON g.league = f.league AND g.k = f.k + 1)),
      l AS (SELECT league, unnest(map_entries(arg_max(m, k))) AS e FROM f GROUP BY league),
      c AS (SELECT league, player, count(*) AS games FROM (SELECT league, a AS player FROM g UNION ALL SELECT league, b FROM g) GROUP BY ALL)
      SELECT league, player, round(e.value, 4) AS elo, games FROM l JOIN c USING (league) WHERE e.key = player""")
def elo_fold(spark, sf_dir):
    won = (F.col("v") > 15).cast("int")
    return ratings.elo_fold(_games(spark, sf_dir).withColumn("a_won", won)).withColumn("elo", F.round("elo", 4))


@_query()
def trueskill_fold(spark, sf_dir):
    team = lambda c: F.array(*[F.col(c) * 10 + k for k in range(5)])
    games = _games(spark, sf_dir).select("league", "game_id", team("a").alias("players1"), team("b").alias("players2"), (F.col("v") > 15).alias("first_won"))
    return ratings.gaussian_fold(games).withColumn("p", F.round("p", 6))


ERF_SQL = "(0.254829592 * t - 0.284496736 * t * t + 1.421413741 * t * t * t - 1.453152027 * t * t * t * t + 1.061405429 * t * t * t * t * t)"


@_query(f"""WITH n AS (SELECT s_nationkey, sum(s_acctbal) / 1000 AS mu, count(*) * 4.0 AS var, count(*) AS k FROM supplier GROUP BY 1),
      p AS (SELECT a.s_nationkey, (a.mu - b.mu) / sqrt((a.k + b.k) * (25.0 / 6) * (25.0 / 6) + a.var + b.var) AS x FROM n a JOIN n b ON b.s_nationkey = (a.s_nationkey + 1) % 25),
      z AS (SELECT *, 1 / (1 + 0.3275911 * abs(x) / sqrt(2.0)) AS t FROM p)
      SELECT s_nationkey, round(CASE WHEN x >= 0 THEN (2 - {ERF_SQL} * exp(-x * x / 2)) / 2 ELSE {ERF_SQL} * exp(-x * x / 2) / 2 END, 5) AS p FROM z""")
def win_probability(spark, sf_dir):
    n = _read(spark, sf_dir, "supplier").groupBy("s_nationkey").agg((F.sum("s_acctbal") / 1000).alias("mu"), (F.count("*") * 4.0).alias("var"), F.count("*").alias("k"))
    b = n.select(F.col("s_nationkey").alias("other"), F.col("mu").alias("mu2"), F.col("var").alias("var2"), F.col("k").alias("k2"))
    joined = n.join(b, F.col("other") == (F.col("s_nationkey") + 1) % 25)
    p = ratings.win_probability(F.col("mu"), F.col("mu2"), F.col("var") + F.col("var2"), F.col("k") + F.col("k2"))
    return joined.select("s_nationkey", F.round(p, 5).alias("p"))


_ODDS = "1 + l_quantity / 10"


@_query(f"SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(((0.2 + l_discount * 5) * ({_ODDS}) - 1) / nullif(({_ODDS}) - 1, 0), 6) AS stake FROM lineitem")
def kelly_stake(spark, sf_dir):
    stake = ratings.kelly(0.2 + F.col("l_discount") * 5, 1 + F.col("l_quantity") / 10)
    return _read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.round(stake, 6).alias("stake"))


@_query(f"SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(1 / ({_ODDS}), 2) AS p1, round(1 - round(1 / ({_ODDS}), 2), 2) AS p2 FROM lineitem")
def implied_odds(spark, sf_dir):
    p = ratings.implied(1 + F.col("l_quantity") / 10)
    return _read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", p.alias("p1"), F.round(1 - p, 2).alias("p2"))


@_query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN l_quantity >= l_partkey % 50 THEN 0 ELSE 1 END AS max_odds_side, CASE WHEN l_quantity <= l_partkey % 50 THEN 0 ELSE 1 END AS favourite_side FROM lineitem""")
def pick_comparison(spark, sf_dir):
    side = evaluation.pick_sides(F.col("l_quantity"), (F.col("l_partkey") % 50).cast("double"))
    return _read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", side.alias("s")).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "s.*")


PREDICTED_SQL = "SELECT o_custkey, o_orderkey, (o_orderkey % 10) / 10 AS p, CASE o_orderstatus WHEN 'F' THEN true WHEN 'O' THEN false END AS first_won FROM orders"


def _predicted(spark, sf_dir):
    won = F.when(F.col("o_orderstatus") == "F", True).when(F.col("o_orderstatus") == "O", False)
    return _read(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", ((F.col("o_orderkey") % 10) / 10).alias("p"), won.alias("first_won"))


@_query(f"""WITH d AS (SELECT *, first_won IS NOT NULL AND p <> 0.5 AS decided FROM ({PREDICTED_SQL})),
      w AS (SELECT *, row_number() OVER s AS place, sum(CASE WHEN decided AND (p > 0.5) = first_won THEN 1 ELSE 0 END) OVER s AS good FROM d WINDOW s AS (PARTITION BY o_custkey ORDER BY o_orderkey))
      SELECT o_custkey, o_orderkey, place, round(good / place, 6) AS accuracy FROM w WHERE decided AND place > 1""")
def running_accuracy(spark, sf_dir):
    return evaluation.running_accuracy(_predicted(spark, sf_dir), "o_custkey", "o_orderkey", F.col("p"), F.col("first_won")).select("o_custkey", "o_orderkey", "place", "accuracy")


@_query(f"""WITH d AS (SELECT (p > 0.5) = first_won AS good FROM ({PREDICTED_SQL}) WHERE first_won IS NOT NULL AND p <> 0.5)
      SELECT count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE NOT good) AS bad, round(100.0 * count(*) FILTER (WHERE good) / count(*), 4) AS percent FROM d""")
def prediction_rate(spark, sf_dir):
    d = _predicted(spark, sf_dir).where("first_won is not null and p <> 0.5")
    return evaluation.overall_accuracy(d, (F.col("p") > 0.5) == F.col("first_won"))


@_query("SELECT user_id, max(ts) AS last_seen, max(ts) < TIMESTAMP '2024-01-20 00:00:00' - INTERVAL 24 HOUR AS stale FROM events GROUP BY 1")
def stale_feeds(spark, sf_dir):
    return evaluation.stale(_read(spark, sf_dir, "events"), "user_id", "ts", F.lit("2024-01-20 00:00:00").cast("timestamp_ntz"), 24)


@_query(OUTCOME_SQL)
def queue_stream(spark, sf_dir):
    """The dead-letter split as a stream: messages are stored as files, read as a stream, and written by outcome."""
    from scorelane.sources.files import shared_folder
    from scorelane.streaming.queue import process_queue, read_queue

    root = shared_folder(spark, "queue")
    _bodies(_read(spark, sf_dir, "events")).repartition(4).write.parquet(f"{root}/in")
    stream = read_queue(spark, f"{root}/in", "event_id long, event_type string, body string")
    process_queue(stream, f"{root}/out", f"{root}/checkpoint", F.col("event_type") == "error")
    return spark.read.parquet(f"{root}/out").select("event_id", "outcome")


@_query()
def page_tables(spark, sf_dir):
    """Cells of the tables of pages written from regions and nations."""
    from scorelane.sources.files import html_tables

    n = _read(spark, sf_dir, "nation").join(_read(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    row = F.concat(F.lit("<tr><td>"), "r_name", F.lit("</td><td>"), "n_name", F.lit("</td></tr>"))
    page = F.concat(F.lit("<table>"), row, F.lit("</table>"))
    return html_tables(n.select("n_nationkey", page.alias("html")), "n_nationkey")


_ORACLES["page_tables"] = """SELECT n_nationkey, 0 AS "table", 0 AS "row", c AS col, CASE c WHEN 0 THEN r_name ELSE n_name END AS cell
    FROM nation JOIN region ON n_regionkey = r_regionkey, (VALUES (0), (1)) v(c)"""


@_query(r"""SELECT user_id, sum(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) AS clicks, round(sum(value) FILTER (WHERE ts >= TIMESTAMP '2024-01-10 00:00:00'), 4) AS late_value, count(DISTINCT event_type) AS kinds FROM events GROUP BY 1""")
def player_features(spark, sf_dir):
    """Per player: counts, value in the last span, kinds of games (the planned feature set in plain aggregates)."""
    since = F.lit("2024-01-10 00:00:00").cast("timestamp_ntz")
    return evaluation.player_features(_read(spark, sf_dir, "events"), "user_id", "event_type", "value", "ts", "click", since)

import datetime as dt

import pytest
from pyspark.sql import functions as F

from scorelane.functions import html as H
from scorelane.operators import evaluation, legacy, matches, messages, orchestration, pages, ratings, state
from scorelane.sources import files
from scorelane.streaming.queue import process_queue, read_queue

BASE = "https://stats.example"


def one(df):
    return df.collect()[0].asDict(recursive=True)


def scalar(spark, column, **values):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()]) if values else spark.range(1)
    return row.select(column).first()[0]


PAGE = """<div class="event text-ellipsis" title="Cup &amp;quot; Co">e</div> Best of 3 <div data-unix="1712345678901"></div>
<div class="team1-gradient"><a href="/team/61/a"><div class="teamName">Alpha</div></a><div class="won">2</div></div>
<div class="team2-gradient"><a href="/team/62/b"><div class="teamName">Beta</div></a><div class="lost">1</div><div class="score">1</div></div>
<div class="mapholder"><div class="mapname">Harbour</div><a href="/stats/matches/mapstatsid/8088/x">s</a><div class="results-team-score">11</div><div class="results-team-score"> </div></div>
<div class="mapholder"><div class="mapname">TBA</div></div>
<div class="mapholder"><div class="mapname">Again</div><a href="/stats/matches/mapstatsid/8088/x">s</a></div>
<div class="stats-content" id="all-content"><table class="table totalstats"><tr><a href="/player/1/x"></a></tr></table></div>
<div class="stats-content" id="8088-content"><table class="table totalstats"><tr class="h"><td><a href="/team/61/a" class="teamName team">Alpha</a></td></tr>
<tr><td><a href="/player/501/p"><span class="player-nick">ivy</span></a></td><td class="kd text-center traditional-data">19 - 14</td><td class="adr text-center traditional-data">91.4</td><td class="kast text-center traditional-data">70.3%</td><td class="rating text-center">1.21</td></tr></table>
<table class="table totalstats"><tr class="h"><td><span class="teamName team">Beta</span></td></tr>
<tr><td><a href="/player/502/p"><span class="statsPlayerName text-ellipsis">oak</span></a></td><td class="kd text-center traditional-data">12-17</td><td class="adr text-center traditional-data">63.2</td><td class="kast text-center traditional-data">58.1%</td><td class="rating text-center">0.86</td></tr><tr><td>none</td></tr></table></div>
<a data-demo-link="/download/demo/31">d</a>"""


def parse(spark, text, **more):
    return one(matches.parse_matches(spark.createDataFrame([(f"{BASE}/matches/4310/alpha-vs-beta?x=1", text)], "match_url string, html string"), BASE, **more))


def test_match_page(spark):
    m = parse(spark, PAGE)
    assert (m["match_id"], m["slug"], m["event_name"], m["best_of"], m["status"], m["winner_team_id"]) == (4310, "alpha-vs-beta", 'Cup " Co', 3, "parsed", 61)
    assert (m["team1"], m["team2"]) == ({"team_id": 61, "name": "Alpha"}, {"team_id": 62, "name": "Beta"}) and (m["team1_score"], m["team2_score"]) == (2, 1)
    assert m["maps"] == [{"map_id": 8088, "map_name": "Harbour", "source_url": BASE + "/stats/matches/mapstatsid/8088/x", "team1_score": 11, "team2_score": 0}]
    stats = [(p["player_id"], p["nickname"], p["team_id"], p["kills"], p["deaths"], p["adr"], p["kast"], p["rating"], p["map_name"]) for p in m["player_stats"]]
    assert stats == [(501, "ivy", 61, 19, 14, 91.4, 70.3, 1.21, "Harbour"), (502, "oak", 62, 12, 17, 63.2, 58.1, 0.86, "Harbour")]
    assert m["raw_demo_url"] == BASE + "/download/demo/31" and m["scheduled_at"] == dt.datetime(2024, 4, 5, 19, 34, 38, 901000)


def test_challenge_and_empty_pages(spark):
    m = parse(spark, PAGE + "Just a moment...")
    assert m["status"] == "challenge" and m["team1"] == {"team_id": None, "name": "Unknown"} and m["maps"] == [] and m["player_stats"] == [] and m["event_name"] is None
    assert parse(spark, "")["status"] == "partial"


def test_scores_leak_only_if_asked_to(spark):
    text = '<div class="team1-gradient"><div class="teamName">A</div></div><div class="team2-gradient"><div class="teamName">B</div></div><div class="won">4</div></div>'
    assert parse(spark, text)["team1_score"] is None and parse(spark, text, faithful_scores=True)["team1_score"] == 4


def test_discovery(spark):
    text = f'<a href="/matches/831/a">x</a><a href="{BASE}/matches/831/a">x</a><a href="/matches/942/b">x</a><a href="/matches/6/">x</a>'
    frame = spark.createDataFrame([(1, text)], "page_id long, html string")
    assert [r["link"] for r in pages.discover(frame, BASE).orderBy("pos").collect()] == [BASE + "/matches/831/a", BASE + "/matches/942/b"]
    assert pages.discover(frame, BASE, cap=1).count() == 1
    items = spark.createDataFrame([(k, f"u{k}") for k in range(6)], "pos long, link string")
    assert pages.take_until_known(items, items.where("pos in (3, 5)"), "pos", "link").count() == 3
    assert pages.frontier(items, items.where("pos < 4")).count() == 2


def test_markers_keys_and_numbers(spark):
    text = F.lit("x cf-browser-verification Just a moment... /cdn-cgi/challenge-platform/")
    assert scalar(spark, H.challenge_markers(text)) == ["Just a moment...", "/cdn-cgi/challenge-platform/", "cf-browser-verification", "challenge-platform"]
    assert scalar(spark, H.decoded(F.lit("&amp;lt;&quot;"))) == '<"'
    assert scalar(spark, pages.html_key(F.lit(7), F.lit("2024-03-05 06:07:08.009").cast("timestamp"))) == "raw-html/2024/03/05/7_2024-03-05T06-07-08-009Z.html"
    assert scalar(spark, pages.demo_key(F.lit(7), F.lit("a/b.dem"))) == "demos/7/b.dem" and scalar(spark, pages.demo_key(F.lit(7), F.lit("a/"))) == "demos/7/7.dem"
    assert scalar(spark, pages.match_url(BASE, F.lit(""), F.lit(5))) == BASE + "/matches/5/_" and scalar(spark, pages.match_url(BASE, F.lit(None).cast("string"), F.lit(0))) is None
    assert scalar(spark, messages.retry_after_ms(F.lit("2"))) == 2000 and scalar(spark, messages.retry_after_ms(F.lit("x"))) == 1000
    assert scalar(spark, messages.session_key(F.lit("  "))) == "default" and scalar(spark, messages.positive_integer(F.lit(2.5))) is None


def test_messages(spark):
    good = ['{"type":"ingest-match","payload":{"matchId":1}}', '{"type":"discover-results","payload":{"pageUrl":null}}']
    bad = {'{"type":"x","payload":{}}': "type", '{"type":"discover-results","payload":{"pageUrl":1}}': "page_url", '{"type":"ingest-match","payload":{}}': "ingest_key", "not json": "shape", "[]": "shape"}
    frame = spark.createDataFrame([(b,) for b in [*good, *bad]] + [(None,)], "body string")
    got = {r["body"]: r["error"] for r in messages.validate(frame).collect()}
    assert all(got[b] is None for b in good) and all(got[b] == messages.ERRORS[e] for b, e in bad.items()) and got[None] == messages.ERRORS["shape"]


def test_merge_is_idempotent_and_keeps(spark):
    old = spark.createDataFrame([(1, "a", "k1", 10), (2, "b", "k2", 20)], "id long, name string, key string, first long")
    new = spark.createDataFrame([(2, "B", None, 99), (3, "c", "k3", 30)], "id long, name string, key string, first long")
    once = state.merge(old, new, ["id"], keep=("first",), fill=("key",))
    twice = state.merge(once, new, ["id"], keep=("first",), fill=("key",))
    want = {(1, "a", "k1", 10), (2, "B", "k2", 20), (3, "c", "k3", 30)}
    assert {tuple(r) for r in once.collect()} == {tuple(r) for r in twice.collect()} == want
    assert {tuple(r) for r in state.replace_set(old, new, ["id"]).collect()} == {(1, "a", "k1", 10), (2, "B", None, 99), (3, "c", "k3", 30)}
    good, held = state.quarantine(new, ["id"], F.col("key").isNull())
    assert [r["id"] for r in good.collect()] == [3] and [r["id"] for r in held.collect()] == [2]


def test_lock_is_held_until_its_time_is_over(spark):
    log = [(1, "l", 0, "acquire", "a"), (2, "l", 10, "acquire", "b"), (3, "l", 100, "acquire", "b"), (4, "l", 101, "acquire", "c"), (5, "l", 102, "release", "b"), (6, "l", 103, "acquire", "d"), (7, "l", 104, "release", "c"), (8, "l", 105, "acquire", "d")]
    frame = spark.createDataFrame(log, "id long, lock string, at long, action string, token string")
    got = {r["id"]: r["acquired"] for r in state.lock_timeline(frame, "lock", "at", "action", "token", 100, "id").collect()}
    assert got == {1: True, 2: False, 3: False, 4: True, 5: None, 6: False, 7: None, 8: True}


def test_ratings(spark):
    assert scalar(spark, ratings.elo_update(F.lit(1000.0), F.lit(1000.0), F.lit(1))) == 1064.0
    assert scalar(spark, ratings.kelly(F.lit(0.6), F.lit(2.0))) == pytest.approx(0.2) and scalar(spark, ratings.kelly(F.lit(0.6), F.lit(1.0))) is None
    assert scalar(spark, ratings.phi(F.lit(1.0))) == pytest.approx(0.8413447, abs=1e-6)
    assert scalar(spark, ratings.round_winners(F.array(*map(F.lit, ["1-0", "1-1", "2-1"])))) == [1, 2, 1]
    assert scalar(spark, ratings.series_to_rounds(F.lit(9), F.lit(16))) == [1] and scalar(spark, ratings.series_to_rounds(F.lit(1), F.lit(2))) == [0, 1, 1]
    (up,), (down,) = ratings.gaussian_update([(25.0, 25 / 3)], [(25.0, 25 / 3)])
    assert up[0] == pytest.approx(29.396, abs=1e-2) and down[0] == pytest.approx(20.604, abs=1e-2) and up[1] == pytest.approx(7.171, abs=1e-2)
    games = spark.createDataFrame([(0, 1, 1, 2, 1), (0, 2, 1, 2, 1)], "league long, game_id long, a long, b long, a_won int")
    elo = {r["player"]: r["elo"] for r in ratings.elo_fold(games).collect()}
    assert elo[1] + elo[2] == pytest.approx(2000) and elo[1] == pytest.approx(1064 + 128 * (1 - 1 / (1 + 10 ** (-128 / 400))))
    teams = spark.createDataFrame([(0, k, [1, 2], [3, 4], True) for k in range(5)], "league long, game_id long, players1 array<long>, players2 array<long>, first_won boolean")
    ps = [r["p"] for r in ratings.gaussian_fold(teams).orderBy("game_id").collect()]
    assert ps[0] == 0.5 and ps == sorted(ps) and [r["p"] for r in ratings.gaussian_fold(teams, inverted=True).orderBy("game_id").collect()][1] < 0.5


def test_evaluation(spark):
    frame = spark.createDataFrame([("a", float(k)) for k in range(1, 21)], "kind string, ms double")
    assert one(evaluation.sample_summary(frame, "kind", "ms")) == {"kind": "a", "n": 20, "total": 210.0, "avg": 10.5, "median": 10.0, "p95": 19.0, "least": 1.0, "most": 20.0}
    rows = spark.createDataFrame([(1, 1, 0.7, True), (1, 2, 0.7, False), (1, 3, 0.5, True), (1, 4, 0.2, False), (1, 5, 0.2, None)], "g long, o long, p double, w boolean")
    got = evaluation.running_accuracy(rows, "g", "o", F.col("p"), F.col("w")).orderBy("o").collect()
    assert [(r["o"], r["accuracy"]) for r in got] == [(2, 0.5), (4, 0.5)]


def test_legacy_extractors(spark):
    assert scalar(spark, legacy.match_date(F.lit("12th of March 2024"), F.lit("18:30"))) == dt.datetime(2024, 3, 12, 18, 30)
    assert scalar(spark, legacy.match_date(F.lit("soon"), F.lit("18:30"))) is None and scalar(spark, legacy.month_number(F.lit("Foo"))) is None
    assert scalar(spark, legacy.round_history(F.array(*map(F.lit, ["2-1", "", "1-0", "1-1"])))) == ["1-0", "1-1", "2-1"]
    assert [scalar(spark, legacy.countdown_bucket(F.lit(t))) for t in ("2h : 3m", "14m", "LIVE")] == [">1h", "14m", "live"]
    rows = spark.createDataFrame([(1, 0, "", "p", ["a", "1.5", "b", "2.5"]), (1, 1, "", "p", ["a", "1.6", "b", "2.4"]), (1, 2, None, None, ["a", "1", "b", "3"]), (1, 3, "q", None, ["a"])], "match_id long, pos long, provider_image string, provider_text string, cells array<string>")
    assert {tuple(r) for r in legacy.odds(rows).collect()} == {(1, "p", "1.6", "2.4"), (1, "Unknown Provider", "1", "3")}
    assert scalar(spark, legacy.line_ups(F.array(*map(F.lit, range(15)))))["team2"] == [10, 11, 12, 13, 14] and scalar(spark, legacy.split_ten(F.array(F.lit(1)))) is None


def test_files_and_stream(spark, tmp_path):
    (tmp_path / "g.csv").write_text("a;1;CT;2;x;y;3;4;16;9;2024-1-1\nbroken;1\n")
    assert files.read_game_rows(spark, str(tmp_path / "g.csv")).count() == 1
    frame = spark.createDataFrame([(1, "<table><tr><th>a</th><td> b </td></tr></table>")], "page_id long, html string")
    assert {(r["col"], r["cell"]) for r in files.html_tables(frame, "page_id").collect()} == {(0, "a"), (1, "b")}
    files.publish({"t": spark.range(3)}, str(tmp_path / "state"), 1)
    files.publish({"t": spark.range(5)}, str(tmp_path / "state"), 2)
    assert files.read_published(spark, str(tmp_path / "state"), "t").count() == 5
    spark.createDataFrame([(k, b) for k, b in enumerate(['{"type":"ingest-match","payload":{"matchId":1}}', "{}"] * 3)], "id long, body string").write.parquet(str(tmp_path / "in"))
    for _ in range(2):  # nothing is processed twice
        process_queue(read_queue(spark, str(tmp_path / "in"), "id long, body string"), str(tmp_path / "out"), str(tmp_path / "cp"), F.col("id") == 0)
    got = {r["outcome"]: r["count"] for r in spark.read.parquet(str(tmp_path / "out")).groupBy("outcome").count().collect()}
    assert got == {"done": 2, "retry": 1, "dropped": 3}


def test_failed_messages_come_back(spark, tmp_path):
    schema = "id long, body string, attempt int"
    spark.createDataFrame([(k, '{"type":"ingest-match","payload":{"matchId":1}}', 0) for k in range(4)], schema).write.parquet(str(tmp_path / "in"))
    for _ in range(5):
        process_queue(read_queue(spark, str(tmp_path / "in"), schema), str(tmp_path / "out"), str(tmp_path / "cp"), F.col("id") == 0, again=str(tmp_path / "in"))
    got = sorted((r["id"], r["attempt"], r["outcome"]) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert got == [(0, 0, "retry"), (0, 1, "retry"), (0, 2, "dead"), (1, 0, "done"), (2, 0, "done"), (3, 0, "done")]


def test_enqueue_and_discovery_runs(spark, tmp_path):
    one_message = spark.createDataFrame([("{}",)], "body string")
    assert not orchestration.enqueue(one_message.where("false"), str(tmp_path / "q")) and orchestration.enqueue(one_message, str(tmp_path / "q"))
    assert orchestration.enqueue(one_message, str(tmp_path / "q")) and spark.read.parquet(str(tmp_path / "q")).count() == 2
    asked = [(1, "cron:a", "browser-session", "k", True, False), (2, "manual", "http", None, None, False), (3, "cron:a", "http", None, False, False), (4, "cron:a", "browser-session", " ", True, True)]
    requests = spark.createDataFrame(asked, "run_id long, source string, acquisition_mode string, browser_session_key string, acquired boolean, failed boolean")
    found = spark.createDataFrame([(r, f"/m/{r}{k}") for r in range(1, 5) for k in range(2)], "run_id long, link string")
    runs, work = orchestration.discovery_runs(requests, found)
    assert {tuple(r) for r in runs.collect()} == {(1, "success", True, 2, 0), (2, "success", False, 0, 2), (3, "skipped", False, 0, 0), (4, "error", True, 0, 0)}
    assert {(r["run_id"], r["way"], r["session"]) for r in work.collect()} == {(1, "inline", "k"), (2, "enqueued", "default")}


def test_lines_and_lookups_of_files(spark, tmp_path):
    (tmp_path / "a.dem").write_bytes(b"12345")
    assert [(r["name"], r["size"]) for r in files.read_demos(spark, str(tmp_path / "a.dem")).collect()] == [("a.dem", 5)]
    (tmp_path / "l.txt").write_text("x\n\ny\n")
    assert files.read_lines(spark, str(tmp_path / "l.txt")).count() == 2
    players = F.array(*[F.struct(F.lit(f" M{k}").alias("name"), F.lit(k != 1).alias("played"), F.lit(str(k)).alias("score1"), F.lit("-").alias("score2")) for k in range(3)])
    assert [(m["map"], m["score1"], m["score2"]) for m in scalar(spark, legacy.played_maps(players))] == [("M0", 0, None), ("M2", 2, None)]
    items = spark.createDataFrame([(1,), (2,)], "k long")
    links = spark.createDataFrame([(1, 0, "a"), (1, 1, "b")], "k long, pos long, url string")
    assert {tuple(r) for r in legacy.last_match(items, links, "k", "pos", "url").collect()} == {(1, "b"), (2, None)}


def test_the_next_mark_is_found_by_a_frame_that_only_grows(spark):
    asks = spark.createDataFrame([("a", t, k) for k, t in enumerate((1, 5, 5, 12, 40))], "lock string, at long, tie long")
    marks = spark.createDataFrame([("a", 5, 1), ("a", 11, 9), ("a", 33, 0), ("b", 99, 0)], "lock string, at long, tie long")
    met = state._next_at(asks, marks, ["lock"], 10)
    assert {r["tie"]: r["then"] and tuple(r["then"]) for r in met.collect()} == {0: (5, 1), 1: (11, 9), 2: (11, 9), 3: (33, 0), 4: None}
    # a frame that ends after all rows is added up anew for each row: the square of a block
    assert "unboundedfollowing" not in met._jdf.queryExecution().analyzed().toString().lower()


def test_pages_are_parsed_where_they_lie(spark):
    frame = spark.createDataFrame([(f"{BASE}/matches/4310/alpha-vs-beta", PAGE)], "match_url string, html string")
    parsed = matches.parse_matches(frame, BASE)
    for found in (parsed, matches.maps_of(parsed), matches.player_stats_of(parsed), parsed.groupBy().count(), parsed.where("status = 'parsed'")):
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        assert "collect_list" not in plan and plan.count("(s)") <= 1 and len(plan) < 60_000  # neither gathered again nor worked out twice
    assert "Exchange" not in matches.player_stats_of(parsed)._jdf.queryExecution().executedPlan().toString()


def test_markup_may_be_of_either_case(spark):
    plain = PAGE.replace('title="Cup &amp;quot; Co"', 'title="Cup Co"')
    spelled = {"div": "DIV", "class=": "Class=", "mapholder": "MapHolder", "href=": "HREF=", "</tr>": "</TR>", "teamName": "teamname", "table": "TABLE", "-content": "-CONTENT", "player-nick": "Player-Nick", "traditional-data": "TRADITIONAL-data"}
    pages = [plain, *[plain.replace(a, b) for a, b in spelled.items()], plain + '<a href="a>/STATS/matches/mapstatsid/5/x<">']
    assert [scalar(spark, F.rlike(F.lit(x), F.lit(matches.PLAIN))) for x in (plain, pages[1], pages[2])] == [True, False, False]
    want = parse(spark, plain)
    assert len(want["player_stats"]) == 2 and all(parse(spark, page) == want for page in pages)

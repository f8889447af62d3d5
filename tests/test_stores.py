"""Sources, sinks, tables by bucket, streams of ratings, features, URL functions."""

import pytest
from pyspark.sql import functions as F

from scorelane.functions import html as H
from scorelane.operators import features, legacy, orchestration, ratings, state
from scorelane.operators.ordering import as_of
from scorelane.sources import files
from scorelane.sources.buckets import BucketedTable
from scorelane.streaming.ratings import rate_stream


def scalar(spark, column):
    return spark.range(1).select(column).first()[0]


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_buckets_leave_the_stored_side_in_place(spark, tmp_path):
    table = BucketedTable(spark, "stored", ["id"], str(tmp_path / "t"), 4)
    table.write(spark.range(100).select("id", (F.col("id") * 2).alias("v"), F.lit("then").alias("seen")))
    batch = spark.range(0, 200, 3).select("id", F.lit(-1).cast("long").alias("v"), F.lit("now").alias("seen"))
    auto = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        merged = table.merged(batch, keep=("seen",))
        assert plan(merged).count("Exchange") == 1 and plan(table.of(batch.select("id"))).count("Exchange") == 1  # of the batch
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", auto)
    want = {k: (-1 if k % 3 == 0 else 2 * k, "then" if k < 100 else "now") for k in range(200) if k < 100 or k % 3 == 0}
    assert {r["id"]: (r["v"], r["seen"]) for r in table.write(merged).collect()} == want
    table.forget()
    found = table.lookup([3, 150, 777])
    assert {r["id"] for r in found.collect()} == {3, 150} and "Exchange" not in plan(found)
    assert table.lookup([3]).select(F.input_file_name()).distinct().count() == 1
    pairs = BucketedTable(spark, "pairs", ["a", "b"], str(tmp_path / "p"), 2)
    pairs.write(spark.createDataFrame([(1, 2), (1, 3)], "a int, b int"))
    assert rows(pairs.lookup([(1, 3), (2, 2)])) == [(1, 3)]


def test_a_version_is_published_once(spark, tmp_path):
    root = str(tmp_path)
    files.publish({"t": spark.range(3)}, root, 1)
    with pytest.raises(Exception, match="(?i)exists"):
        files.publish({"t": spark.range(9)}, root, 1)
    assert files.read_published(spark, root, "t").count() == 3
    files.publish({"t": spark.range(5)}, root, 10)
    files.publish({"t": spark.range(4)}, root, 9)
    assert files.read_published(spark, root, "t").count() == 5


def test_tables_by_jdbc(spark):
    at = {"url": "jdbc:derby:memory:scores;create=true", "driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    spark.range(5).write.format("jdbc").options(**at, dbtable="ids").save()
    assert files.read_table(spark, at, "ids").count() == 5


def test_tables_of_pages(spark):
    text = "<table class=a><thead><tr><TH>h &amp; i</TH><td></td></tr></thead><tr><td> <b>x</b> y </td><td>2</table><table></table><table><tr><td>z"
    got = rows(files.html_tables(spark.createDataFrame([(1, text), (2, None), (3, "none")], "k int, html string"), "k"))
    assert got == [(1, 0, 0, 0, "h & i"), (1, 0, 0, 1, ""), (1, 0, 1, 0, "x y"), (1, 0, 1, 1, "2"), (1, 2, 0, 0, "z")]
    cells = spark.createDataFrame([(1, 1, r, c, x) for r, line in enumerate([["", "u", "v"], ["a", "3:5", "bad"]]) for c, x in enumerate(line)], "k int, table int, row int, col int, cell string")
    assert rows(legacy.kill_matrix(cells, "k")) == [(1, "all", "a", "u", 3, 5), (1, "all", "a", "v", None, None)]


def test_urls(spark):
    assert scalar(spark, H.origin(F.lit("HTTPS://A.b:80/x?y"))) == "https://a.b:80" and scalar(spark, H.origin(F.lit("/x"))) is None
    assert scalar(spark, H.url_path(F.lit("http://a"))) == "/" and scalar(spark, H.url_path(F.lit("http://a/b/c?d#e"))) == "/b/c"
    assert scalar(spark, H.with_query(F.lit("/a?x=1#f"), {"q": F.lit("ü &"), "n": F.lit(None).cast("int")})) == "/a?x=1&q=%C3%BC+%26#f"
    assert scalar(spark, H.with_query(F.lit("/a"), {"n": F.lit(None).cast("int")})) == "/a"


def test_appends_and_artifacts(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(1, "x"), (3, "c"), (3, "b"), (3, "b"), (4, None), (4, None)], "k int, v string")
    after, refused = state.append_new(old, new, ["k"])
    assert rows(after) == rows(spark.createDataFrame([(1, "a"), (2, "b"), (3, "b"), (4, None)], "k int, v string"))
    assert rows(refused) == rows(spark.createDataFrame([(1, "x"), (3, "b"), (3, "c"), (4, None)], "k int, v string"))
    got = orchestration.acquisitions(spark.createDataFrame([(None, "a"), ("browser-session", " "), ("browser-session", "k"), ("odd", None)], "acquisition_mode string, browser_session_key string"))
    assert {tuple(r) for r in got.collect()} == {("http", None, 2), ("browser-session", "default", 1), ("browser-session", "k", 1)}


def test_ratings_as_a_stream_go_on_from_their_state(spark, tmp_path):
    import random

    rng = random.Random(3)
    games = [(str(g % 2), g, rng.sample(range(12), 10), bool(rng.random() < 0.5)) for g in range(60)]
    split = [(lg, g, ps[:5], ps[5 : 10 if g != 7 else 9], w) for lg, g, ps, w in games]
    schema = "league string, game_id long, players1 array<long>, players2 array<long>, first_won boolean"
    whole = {r["game_id"]: r["p"] for r in ratings.gaussian_fold(spark.createDataFrame([g for g in split if g[1] != 7], schema)).collect()}
    at = {k: str(tmp_path / k) for k in ("in", "out", "checkpoint")}
    for part in (split[:25], [*split[25:], split[3], split[20]], []):  # two games come again
        if part:
            spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(at["in"])
        rate_stream(spark.readStream.schema(schema).parquet(at["in"]), at["out"], at["checkpoint"])
    got = spark.read.parquet(at["out"]).collect()
    assert {r["game_id"]: r["p"] for r in got if r["outcome"] == "rated"} == pytest.approx(whole)
    assert sorted((r["game_id"], r["outcome"]) for r in got if r["outcome"] != "rated") == [(3, "refused"), (7, "skipped"), (20, "refused")]


def test_a_batch_of_the_rating_stream_is_replayed_in_slices(spark, tmp_path):
    """Slices of four games and two tasks a league give what one ordered pass gives; ids that come twice in a batch count once."""
    import random

    rng = random.Random(5)
    games = [(None if g % 3 else "a", g, ps[:5], ps[5:], bool(rng.random() < 0.5)) for g in range(40) for ps in [rng.sample(range(14), 10)]]
    schema = "league string, game_id long, players1 array<long>, players2 array<long>, first_won boolean"
    whole = {r["game_id"]: r["p"] for r in ratings.gaussian_fold(spark.createDataFrame(games, schema)).collect()}
    at = {k: str(tmp_path / k) for k in ("in", "out", "checkpoint")}
    for part in ([*games[:20], games[4], games[4]], [*games[20:], (None, None, *games[0][2:]), ("b", 1, None, [1], True), games[2]]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(at["in"])
        rate_stream(spark.readStream.schema(schema).parquet(at["in"]), at["out"], at["checkpoint"], games_a_task=4, players_a_task=7)
    got = spark.read.parquet(at["out"]).collect()
    assert {r["game_id"]: r["p"] for r in got if r["outcome"] == "rated"} == pytest.approx(whole)
    assert sorted((r["league"], r["game_id"], r["outcome"]) for r in got if r["outcome"] != "rated") == [("", 2, "refused"), ("", 4, "refused"), ("", 4, "refused"), ("b", 1, "skipped")]


def test_as_of_takes_the_last_earlier_row(spark):
    left = spark.createDataFrame([(k, k % 3 if k % 7 else None, t) for k in range(40) for t in [k * 5 % 23 if k % 9 else None]], "id int, k int, t int")
    right = spark.createDataFrame([(k % 3 if k % 5 else None, k * 7 % 29 if k % 11 else None, k) for k in range(60)], "k int, at int, v int")
    want = {}
    for i, k, t in left.collect():
        earlier = [(a, v) for rk, a, v in right.collect() if rk == k and a is not None and t is not None and a < t]
        want[i] = max(earlier)[1] if earlier else None
    for size in (20, 1000):
        assert {r["id"]: r["v"] for r in as_of(left, right, "k", "t", "at", ["v"], size).collect()} == want


def test_a_prefix_scan_shuffles_its_rows_once(spark):
    from scorelane.operators.ordering import prefix_scan

    frame = spark.createDataFrame([(k, (None, "a", "b")[k % 3] if k > 10 else "a", k % 5) for k in range(60)], "id long, g string, v long")
    for size in (7, 1000):
        scanned = prefix_scan(frame, [F.col("id")], {"total": F.col("v")}, ["g"], size)
        want, sums = {}, {}
        for k, g, v in frame.collect():
            want[k] = sums[g] = sums.get(g, 0) + v
        assert {r["id"]: r["total"] for r in scanned.collect()} == want
        assert "SortMergeJoin" not in scanned._jdf.queryExecution().executedPlan().toString()


def test_features_do_not_look_ahead(spark):
    import datetime as dt

    day = lambda d: dt.datetime(2024, 1, 1) + dt.timedelta(days=d)
    played = [(0, 0, True, 10, 5), (1, 20, False, 4, 1), (2, 20, True, 8, 8), (3, 100, True, 0, 0), (4, 130, False, 6, 3)]
    frame = spark.createDataFrame([(g, day(d), p, "t", "m", w, k, h, 50) for g, d, w, k, h in played for p in ((1, 2) if g < 3 else (1, 3))], "game_id long, ts timestamp_ntz, player long, team string, map string, won boolean, kills long, headshots long, damage long")
    rated = spark.createDataFrame([(1, day(0), 20.0), (1, day(20), 21.0)], "player long, at timestamp_ntz, mu double")
    for size in (3, 1000):
        got = {r["game_id"]: r for r in features.game_features(frame, rated, 3, 2, size).where("player = 1").collect()}
        assert [got[g]["games"] for g in range(5)] == [0, 1, 1, 2, 1]  # within three months and before the instant
        assert got[0]["win_rate"] is None and got[3]["win_rate"] == 0.5 and got[3]["headshot_ratio"] == 0.75 and got[4]["headshot_ratio"] is None
        assert [got[g]["rating"] for g in range(5)] == [None, 20.0, 20.0, 21.0, 21.0]
        assert [got[g]["map_win_rate"] for g in range(5)] == [None, 1.0, 0.5, 0.5, 1.0]
        assert [got[g]["roster_seconds"] for g in range(5)] == [None, None, None, 0, 30 * 86400]
    assert features.game_features(frame.where("false"), rated).count() == 0


def test_batches_of_messages_are_bounded_and_written_once(spark, tmp_path):
    from scorelane.streaming.queue import process_queue
    from scorelane.streaming.source import read_messages

    schema, body = "id long, body string", '{"type":"ingest-match","payload":{"matchId":1}}'
    at = {k: str(tmp_path / k) for k in ("in", "out", "checkpoint")}
    spark.createDataFrame([(k, body) for k in range(23)], schema).coalesce(2).write.mode("append").parquet(at["in"])
    failing = F.when(F.col("id") == 15, F.raise_error(F.lit("down"))).otherwise(False)
    with pytest.raises(Exception, match="down"):
        process_queue(read_messages(spark, at["in"], schema), at["out"], at["checkpoint"], failing, bounded=True)
    assert spark.read.parquet(at["out"]).count() == 10
    for more in ([], [(100 + k, body) for k in range(4)]):
        if more:
            spark.createDataFrame(more, schema).write.mode("append").parquet(at["in"])
        process_queue(read_messages(spark, at["in"], schema), at["out"], at["checkpoint"], F.lit(False), bounded=True)
    got = spark.read.parquet(at["out"])
    assert sorted(r["id"] for r in got.collect()) == [*range(23), *range(100, 104)]
    assert max(r["count"] for r in got.groupBy("batch").count().collect()) == 10


def test_a_request_gives_one_row_whatever_is_stored(spark):
    from scorelane.sources import files

    asked = spark.createDataFrame([(1, "a", None), (2, "a", "own"), (3, "b", ""), (4, None, None), (5, "a", None)], "page_id long, url string, html string")
    stored = spark.createDataFrame([(1, "a", "a1", "x", "t"), (3, "a", "a3", "y", "t"), (1, "a", "a0", "z", "t")], "page_id long, requested_url string, final_url string, html string, title string")
    got = {r["page_id"]: r["final_url"] for r in files.snapshots_of(asked, stored).collect()}
    assert got == {1: "a3", 2: "a", 3: None, 4: None, 5: "a3"} and files.snapshots_of(asked, stored).count() == 5
    got = {r["page_id"]: r["final_url"] for r in files.snapshots_of(asked, stored, also=("page_id",)).collect()}
    assert got == {1: "a1", 2: "a", 3: None, 4: None, 5: None}


def test_features_of_few_games_are_made_where_a_player_lies(spark, monkeypatch):
    import datetime as dt
    import random

    rng, scans, whole = random.Random(5), [], features.prefix_scan
    monkeypatch.setattr(features, "prefix_scan", lambda *a, **k: scans.append(1) or whole(*a, **k))
    day = lambda d: dt.datetime(2024, 1, 1) + dt.timedelta(days=d)
    games = [(g, day(rng.randrange(300)), f"t{g % 3}", f"m{g % 2}", rng.sample([1, 1, 1, 2, 3, 4, 5], 3)) for g in range(90)]
    rows = [(g, at, p, t, m, rng.random() < 0.5, rng.randrange(9), rng.randrange(4), rng.randrange(90)) for g, at, t, m, ps in games for p in sorted(set(ps))]
    frame = spark.createDataFrame(rows, "game_id long, ts timestamp_ntz, player long, team string, map string, won boolean, kills long, headshots long, damage long")
    rated = spark.createDataFrame([(p, day(d), float(d % 7)) for p in range(1, 5) for d in range(0, 300, 9)], "player long, at timestamp_ntz, mu double")
    made = {size: sorted(map(str, features.game_features(frame, rated, 3, 2, size).collect())) for size in (1000, 70, 4)}
    assert len(made[1000]) == len(rows) and made[1000] == made[70] == made[4]
    scans.clear()
    found = features.game_features(frame, rated)
    assert not scans  # no player's rows are more than a part
    assert found._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning(player") <= 1

"""Replays, scans and selections against sequential versions, whatever the size of tasks."""

import math
import random

import pytest
from pyspark.sql import functions as F

from scorelane.operators import evaluation, ratings
from scorelane.operators.ordering import nearest_ranks, numbered, prefix_scan

SIZES = ({}, {"games_a_task": 40}, {"games_a_task": 60, "players_a_task": 5})


def plain_elo(games):
    elo, seen = {}, {}
    for lg, _, a, b, w in games:
        x, y = elo.get((lg, a), 1000.0), elo.get((lg, b), 1000.0)
        ex = 1 / (1 + 10 ** ((y - x) / 400))
        elo[lg, a], elo[lg, b] = x + 128 * (w - ex), y + 128 * (ex - w)
        for p in (a, b):
            seen[lg, p] = seen.get((lg, p), 0) + 1
    return elo, seen


@pytest.mark.parametrize("order", ["long", "string"])
def test_elo_is_the_sequential_one(spark, order):
    rng = random.Random(4)
    games = [(None if g % 5 == 0 else g % 3, g if order == "long" else f"{g:05}", rng.randrange(6), 6 + rng.randrange(6), int(rng.random() < 0.6)) for g in range(200)]
    shuffled = random.Random(1).sample(games, len(games))
    frame = spark.createDataFrame(shuffled, f"league long, game_id {order}, a long, b long, a_won int")
    elo, seen = plain_elo(games)
    for sizes in SIZES:
        got = {(r["league"], r["player"]): (r["elo"], r["games"]) for r in ratings.elo_fold(frame, **sizes).collect()}
        assert {k: v[0] for k, v in got.items()} == pytest.approx(elo) and {k: v[1] for k, v in got.items()} == seen


def test_games_without_an_order_are_played_first(spark):
    games = [(0, g if g % 4 else None, g % 5, 5 + g % 3, g % 2) for g in range(60)] + [(0, 7, 1, 1, 1), (0, 8, None, 2, 0)]
    frame = spark.createDataFrame(games, "league long, game_id long, a long, b long, a_won int")
    runs = [sorted(map(tuple, ratings.elo_fold(frame, **s).collect()), key=str) for s in ({}, {"games_a_task": 9}, {"games_a_task": 20, "players_a_task": 3})]
    assert runs[0] == runs[1] == runs[2] and {r[1] for r in runs[0]} == {None, *range(8)}
    late = frame.where("game_id is not null")
    alone = {r["player"]: r["games"] for r in ratings.elo_fold(late).collect()}
    assert sum(alone.values()) < sum(r[3] for r in runs[0])  # none was dropped
    assert ratings.elo_fold(frame.where("false")).count() == 0


def test_gaussian_replay_with_rounds_and_from_a_mark(spark):
    rng = random.Random(6)
    games = []
    for g in range(80):
        ps = rng.sample(range(14), 10)
        games.append((0, g, ps[:5], ps[5:] if g != 30 else ps[5:9], bool(rng.random() < 0.5), [rng.choice([1, 2]) for _ in range(3)]))
    schema = "league long, game_id long, players1 array<long>, players2 array<long>, first_won boolean, rounds array<int>"
    frame = spark.createDataFrame(games, schema)
    known, want = {}, {}
    for _, g, one, two, _, rounds in games:
        if len(two) < 5:
            continue
        a, b = ([known.get(p, (25.0, 25 / 3)) for p in side] for side in (one, two))
        spread = (10 * (25 / 6) ** 2 + sum(s * s for _, s in a + b)) ** 0.5
        want[g] = ratings._cdf((sum(m for m, _ in a) - sum(m for m, _ in b)) / spread)
        for w in rounds:
            a, b = ratings.gaussian_update(a, b) if w == 1 else ratings.gaussian_update(b, a)[::-1]
        known.update(zip([*one, *two], [*a, *b], strict=True))
    for sizes in ({}, {"games_a_task": 30, "players_a_task": 5}):
        first, state, skipped, mark = ratings.rating_run(frame.where("game_id < 50"), -1, rounds="rounds", **sizes)
        assert [r["game_id"] for r in skipped.collect()] == [30] and mark.first()[0] == 49
        second, state, _, mark = ratings.rating_run(frame, 49, known=state, rounds="rounds", **sizes)
        got = {r["game_id"]: r["p"] for r in first.unionByName(second).collect()}
        assert got == pytest.approx(want) and mark.first()[0] == 79
        assert {r["player"]: r["mu"] for r in state.collect()} == pytest.approx({p: m for p, (m, _) in known.items()})


def test_elo_rounds_of_ten_row_games(spark):
    one, two = ratings.elo_rounds([1000.0, 1100.0], [900.0, 1000.0], [0], faithful=False)
    assert one[0] == pytest.approx(1000 + 128 * (1 - 1 / (1 + 10 ** ((950 - 1000) / 400)))) and two[1] == pytest.approx(1000 + 128 * (0 - 1 / (1 + 10 ** ((1050 - 1000) / 400))))
    assert ratings.elo_rounds([1.0], [2.0], [-1]) == ([1.0], [2.0])
    rows = [(0, g, p + 10 * (g % 2), 1 if p < 5 else 2, g, 3) for g in range(6) for p in range(10 if g != 4 else 9)]
    frame = spark.createDataFrame(rows, "league int, game_id long, player_id long, side int, score1 int, score2 int")
    final, refused, mark = ratings.elo_dataset(frame, 0)
    assert {r["game_id"]: r["n"] for r in refused.collect()} == {0: 10, 4: 9} and mark.first()[0] == 5
    held = {}
    for g in (1, 2, 3, 5):
        ids = [p + 10 * (g % 2) for p in range(10)]
        a, b = ratings.elo_rounds([held.get(p, 1000.0) for p in ids[:5]], [held.get(p, 1000.0) for p in ids[5:]], [0] * g + [1] * 3)
        held.update(zip(ids, [*a, *b], strict=True))
    assert {r["player"]: r["elo"] for r in final.collect()} == pytest.approx(held)


def test_scans_and_places(spark):
    rng = random.Random(2)
    rows = [(rng.choice(["a", "b", None]), k) for k in range(600)]
    frame = spark.createDataFrame(rows, "g string, id long").repartition(5)
    for size in (50, 10_000):
        got = {r["id"]: (r["s"], r["c"]) for r in prefix_scan(frame, [F.col("id")], {"s": F.col("id") % 7, "c": F.lit(1)}, ["g"], size).collect()}
        sums = {}
        for g, k in rows:
            s, c = sums.get(g, (0, 0))
            sums[g] = (s + k % 7, c + 1)
            assert got[k] == sums[g]
        assert {r["id"]: r["place"] for r in numbered(frame, [F.desc("id")], rows_a_part=size).collect()} == {k: 600 - k for k in range(600)}
    assert numbered(frame.where("false"), [F.col("id")]).count() == 0


def test_prequential_accuracy_ends(spark):
    rows = [(k, 0.5 if k % 11 == 0 else 0.3 + 0.4 * (k % 2), None if k % 13 == 0 else k % 3 == 0) for k in range(300)]
    frame = spark.createDataFrame(rows, "k long, p double, won boolean")
    good, want = 0, {}
    for place, (k, p, won) in enumerate(rows[:201], 1):
        if won is None or p == 0.5:
            continue
        good += (p > 0.5) == won
        if place > 1:
            want[k] = good / place
    for size in (40, 10_000):
        got = evaluation.prequential(frame, [F.col("k")], F.col("p"), F.col("won"), 201, rows_a_part=size)
        assert {r["k"]: r["accuracy"] for r in got.collect()} == pytest.approx(want)


def test_nearest_ranks_are_exact(spark):
    rng = random.Random(3)
    rows = [(rng.choice(["a", "b", None]), rng.choice([1.0, 2.5, None, float("nan"), rng.random() * 1e308, -rng.random() * 1e308, rng.random() * 1e-300])) for _ in range(800)] + [("c", None), ("d", 4.0)]
    frame = spark.createDataFrame(rows, "g string, v double").repartition(3)
    for parts in (16, 4096):
        got = {r["g"]: (r["m"], r["p"]) for r in nearest_ranks(frame, "g", "v", {"m": "0.5", "p": "0.95"}, parts).collect()}
        want = {}
        for g in ("a", "b", None, "d"):
            vs = sorted(v for h, v in rows if h == g and v is not None and not math.isnan(v))
            want[g] = (vs[math.ceil(len(vs) / 2) - 1], vs[math.ceil(len(vs) * 95 / 100) - 1])
        assert got == want
    plan = evaluation.sample_summary(frame, "g", "v")._jdf.queryExecution().toString()
    assert "percentile" not in plan


@pytest.mark.parametrize("sizes", [{}, {"games_a_task": 10, "players_a_task": 5}])
def test_a_league_of_long_chains_takes_few_steps(spark, monkeypatch, sizes):
    from scorelane.operators import replay

    steps, kept = [], replay.checkpointed
    monkeypatch.setattr(replay, "checkpointed", lambda df: steps.append(1) or kept(df))
    rng = random.Random(8)
    games = [(0, g, *rng.sample(range(20), 2), g % 2) for g in range(400)]
    elo, _ = plain_elo(games)
    final = ratings.elo_fold(spark.createDataFrame(games, "league long, game_id long, a long, b long, a_won int"), **sizes)
    assert {(r["league"], r["player"]): r["elo"] for r in final.collect()} == pytest.approx(elo)
    assert len(steps) <= 1 + 3 * replay.MOST_SLICES


def test_refused_games_need_no_replay(spark, monkeypatch):
    monkeypatch.setattr(ratings, "replay", None)
    rows = [(0, g, p, 1 if p < 5 or g == 5 else 2) for g in range(6) for p in range(9 if g == 4 else 10)]
    frame = spark.createDataFrame(rows, "league int, game_id long, player_id long, side int")
    assert {r["game_id"]: r["n"] for r in ratings.elo_dataset_refused(frame, 0).collect()} == {0: 10, 4: 9, 5: 10}


def test_a_run_of_accuracy_replays_no_game_after_its_last(spark, monkeypatch):
    from scorelane.plans import replays

    class Seen(Exception):
        pass

    def seen(games, **_):
        raise Seen(games.count())

    monkeypatch.setattr(ratings, "gaussian_replay", seen)
    with pytest.raises(Seen) as told:
        replays.prequential_accuracy(spark, "/root/testdata/sf0.1")
    assert told.value.args == (5001,)


@pytest.mark.parametrize("sizes", [{}, {"games_a_task": 60}, {"games_a_task": 60, "players_a_task": 5}])
def test_layers_of_games_give_what_the_fold_gives(spark, monkeypatch, sizes):
    rng = random.Random(9)
    games, known, want = [], {}, {}
    for g in range(400):
        lg = g % 2 if g % 9 else None
        one = rng.sample(range(60), rng.choice([5, 5, 5, 2]))
        two = rng.sample([p for p in range(60) if p not in one], rng.choice([5, 5, 5, 3, 0]))
        two = [*two, *one[:1]] if g % 50 == 7 else two
        games.append((lg, g, [None if p == 3 else p for p in one], [None if p == 3 else p for p in two], None if g % 31 == 0 else rng.random() < 0.6))
    for lg, g, one, two, won in games:
        a, b = ([known.get((lg, p), (25.0, 25 / 3)) for p in side] for side in (one, two))
        spread = math.sqrt((len(a) + len(b)) * (25 / 6) ** 2 + sum(s * s for _, s in a + b))
        want[g] = ratings._cdf((sum(m for m, _ in a) - sum(m for m, _ in b)) / spread)
        a, b = ratings.gaussian_update(a, b) if won else ratings.gaussian_update(b, a)[::-1]
        known.update(zip([(lg, p) for p in [*one, *two]], [*a, *b], strict=True))
    frame = spark.createDataFrame(random.Random(1).sample(games, len(games)), "league long, game_id long, players1 array<long>, players2 array<long>, first_won boolean")
    predicted, final = ratings.gaussian_replay(frame, **sizes)
    assert {r["game_id"]: r["p"] for r in predicted.collect()} == pytest.approx(want, abs=1e-11)
    assert {(r["league"], r["player"]): (r["mu"], r["sigma"]) for r in final.collect()} == {k: pytest.approx(v) for k, v in known.items()}


def test_a_task_of_games_plays_them_by_layers():
    import pyarrow as pa

    from scorelane.operators import replay

    calls, n = [], 4000
    layer = ratings.GaussianLayer(False)

    class Counted:
        shape = staticmethod(layer.shape)

        def __call__(self, fields, places, shape, held):
            calls.append(len(places))
            return layer(fields, places, shape, held)

    teams = [[t * 5 + k for k in range(5)] for t in range(400)]
    one, two = [teams[g % 200] for g in range(n)], [teams[200 + (g * 7) % 200] for g in range(n)]
    game = pa.StructArray.from_arrays([pa.array(one), pa.array(two), pa.array([g % 3 == 0 for g in range(n)])], ["players1", "players2", "first_won"])
    state = pa.struct([("mu", pa.float64()), ("sigma", pa.float64())])
    both = pa.array([a + b for a, b in zip(one, two, strict=True)])
    batch = pa.RecordBatch.from_arrays([pa.array([0] * n), game, pa.nulls(n, pa.struct([("p", pa.float64())])), both, pa.nulls(n, pa.list_(state))], ["league", "game", "made", "players", "states"])
    out = list(replay._in_layers(None, Counted(), {"mu": 25.0, "sigma": 25 / 3})([batch]))
    assert sum(calls) == n and len(calls) <= 40  # the fold is not called for single games
    assert sum(b.num_rows for b in out) == n + 2000

"""Ratings and stakes: Elo, TrueSkill-style updates, win probabilities, odds."""

from __future__ import annotations

import math
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorelane.operators.replay import replay

K, START, SPREAD = 128.0, 1000.0, 400.0
#: Published defaults of the two-team Gaussian rating.
MU, SIGMA, BETA, TAU, DRAW = 25.0, 25 / 3, 25 / 6, 25 / 300, 0.10
DRAW_QUANTILE = NormalDist().inv_cdf((DRAW + 1) / 2)


def elo_expected(own: Column, opposing_mean: Column) -> Column:
    return 1 / (1 + F.pow(F.lit(10.0), (opposing_mean - own) / SPREAD))


def elo_update(own: Column, opposing_mean: Column, won: Column, k: float = K) -> Column:
    return own + k * (won.cast("double") - elo_expected(own, opposing_mean))


def phi(x: Column) -> Column:
    """The normal distribution function by Abramowitz and Stegun 7.1.26 (error up to 1.5e-7)."""
    z = F.abs(x) / math.sqrt(2)
    t = 1 / (1 + 0.3275911 * z)
    poly = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429))))
    erf = 1 - poly * F.exp(-z * z)
    return F.when(x >= 0, (1 + erf) / 2).otherwise((1 - erf) / 2)


def win_probability(mu1: Column, mu2: Column, var_sum: Column, players: Column) -> Column:
    """From sums of means and of all variances."""
    return phi((mu1 - mu2) / F.sqrt(players * BETA * BETA + var_sum))


def kelly(p: Column, odds: Column) -> Column:
    """Share of the bank to stake; null at even return, negative where the odds are too low."""
    b = odds - 1
    return (p * odds - 1) / F.nullif(b, F.lit(0.0))


def implied(odds: Column) -> Column:
    return F.round(1 / F.nullif(odds, F.lit(0.0)), 2)


def elo_fold(games: DataFrame, league: str = "league", order: str = "game_id", side_a: str = "a", side_b: str = "b", won: str = "a_won", **sizes) -> DataFrame:
    """Final (league, player, elo, games) of one-against-one games in order; see ``replay`` for ties, nulls and sizes."""

    def fold(game: dict, held: dict) -> None:
        x, y, w = game[side_a], game[side_b], game[won]
        rx, ry = held[x]["elo"], held[y]["elo"]
        ex = 1 / (1 + 10 ** ((ry - rx) / SPREAD))
        held[x] = {"elo": rx + K * (w - ex), "games": held[x]["games"] + 1}
        held[y] = {"elo": ry + K * ((1 - w) - (1 - ex)), "games": held[y]["games"] + 1}

    used = games.select(league, order, side_a, side_b, won)
    final = replay(used, league, order, F.array(side_a, side_b), fold, {"elo": "double", "games": "bigint"}, {"elo": START, "games": 0}, **sizes)[1]
    return final.withColumnRenamed("league", league)


def elo_rounds(one: list[float], two: list[float], rounds: list[int], faithful: bool = True) -> tuple[list[float], list[float]]:
    """Ratings of both teams after rounds won by side 0 or 1; others (unknown) change nothing.

    Each player is measured against the other team's mean. faithful: a mean is of a sum that starts at -1, by the size of
    the first team.
    """
    for w in rounds:
        if w not in (0, 1):
            continue
        less, sizes = (1, (len(one), len(one))) if faithful else (0, (len(one), len(two)))
        m1, m2 = (sum(one) - less) / sizes[0], (sum(two) - less) / sizes[1]
        expected = lambda r, m: 1 / (1 + 10 ** ((m - r) / SPREAD))
        one, two = [r + K * ((w == 0) - expected(r, m2)) for r in one], [r + K * ((w == 1) - expected(r, m1)) for r in two]
    return one, two


def elo_dataset_refused(rows: DataFrame, mark=None, league: str = "league", game: str = "game_id", player: str = "player_id", side: str = "side") -> DataFrame:
    """(league, game, n) of the games that ``elo_dataset`` refuses; nothing is replayed."""
    counts = rows.groupBy(league, game).agg(F.count("*").alias("n"), *[F.count_if(F.coalesce(F.col(side) == k, F.lit(False)) & F.col(player).isNotNull()).alias(f"n{k}") for k in (1, 2)])
    beyond = F.lit(True) if mark is None else F.col(game) > F.lit(mark)
    good = (F.col("n") == 10) & (F.col("n1") > 0) & (F.col("n2") > 0) & F.coalesce(beyond, F.lit(False))
    return counts.where(~good).select(league, game, "n")


def elo_dataset(rows: DataFrame, mark=None, league: str = "league", game: str = "game_id", player: str = "player_id", side: str = "side", score1: str = "score1", score2: str = "score2", faithful: bool = True, known: DataFrame | None = None, **sizes) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(final ratings (league, player, elo), games refused, new mark) of rows of players, ten a game.

    Games above the mark are replayed by game id, each in the rounds that its series of scores gives (see
    ``series_to_rounds``). Games of other than ten rows or without one side are refused, as are those at or below the
    mark; the mark passes all of them. ``side`` is 1 or 2. ``known`` holds ratings of an earlier run.
    """
    team = lambda k: F.collect_list(F.when(F.col(side) == k, F.col(player)))  # noqa: E731 (of one game)
    games = rows.groupBy(league, game).agg(F.array_sort(team(1)).alias("one"), F.array_sort(team(2)).alias("two"), F.max(score1).alias("s1"), F.max(score2).alias("s2"), F.count("*").alias("n"))
    games = games.withColumn("rounds", series_to_rounds(F.col("s1"), F.col("s2"), faithful)).drop("s1", "s2")
    beyond = F.lit(True) if mark is None else F.col(game) > F.lit(mark)
    good = (F.col("n") == 10) & (F.size("one") > 0) & (F.size("two") > 0) & F.coalesce(beyond, F.lit(False))

    def fold(g: dict, held: dict) -> None:
        one, two = elo_rounds([held[p]["elo"] for p in g["one"]], [held[p]["elo"] for p in g["two"]], g["rounds"], faithful)
        for p, r in zip([*g["one"], *g["two"]], [*one, *two], strict=True):
            held[p] = {"elo": r}

    final = replay(games.where(good).drop("n"), league, game, F.concat("one", "two"), fold, {"elo": "double"}, {"elo": START}, known=known, **sizes)[1]
    new = rows.agg(F.greatest(F.max(game), F.lit(mark)).alias("mark"))
    return final.withColumnRenamed("league", league), elo_dataset_refused(rows, mark, league, game, player, side), new


def _cdf(x: float) -> float:
    return 0.5 * math.erfc(-x / math.sqrt(2))


def gaussian_update(winners: list[tuple[float, float]], losers: list[tuple[float, float]]) -> tuple[list, list]:
    """New (mu, sigma) of both sides after one decided round."""
    s2 = [[s * s + TAU * TAU for _, s in side] for side in (winners, losers)]
    n = len(winners) + len(losers)
    c2 = sum(map(sum, s2)) + n * BETA * BETA
    c = math.sqrt(c2)
    eps = DRAW_QUANTILE * math.sqrt(n) * BETA
    x = (sum(m for m, _ in winners) - sum(m for m, _ in losers)) / c - eps / c
    v = math.exp(-x * x / 2) / math.sqrt(2 * math.pi) / max(_cdf(x), 1e-300)
    w = v * (v + x)
    new = lambda side, vs, sign: [(m + sign * q / c * v, math.sqrt(max(q * (1 - q / c2 * w), 1e-12))) for (m, _), q in zip(side, vs, strict=True)]
    return new(winners, s2[0], 1), new(losers, s2[1], -1)


class GaussianLayer:
    """``gaussian_update`` of many games without rounds at once, see ``replay``; alike are those of as many players on the first side."""

    def __init__(self, inverted: bool):
        self.inverted = inverted

    def shape(self, fields: dict, sizes: np.ndarray) -> np.ndarray:
        one, two = (fields[c].value_lengths().fill_null(0).to_numpy(zero_copy_only=False) for c in ("players1", "players2"))
        return np.where((one > 0) & (two > 0) & (one + two == sizes), one, -1)  # a player named twice is left to the fold

    def __call__(self, fields: dict, places: np.ndarray, shape: int, held: dict) -> tuple[dict, dict]:
        mu, sigma = held["mu"], held["sigma"]
        n, cdf = mu.shape[1], lambda x: 0.5 * np.fromiter(map(math.erfc, (-x / math.sqrt(2)).tolist()), np.float64, len(x))
        won = fields["first_won"].take(pa.array(places)).fill_null(False).to_numpy(zero_copy_only=False).astype(bool)
        sign = np.where(won != self.inverted, 1.0, -1.0)
        ahead = mu[:, :shape].sum(axis=1) - mu[:, shape:].sum(axis=1)
        p = cdf(ahead / np.sqrt(n * BETA * BETA + (sigma * sigma).sum(axis=1)))
        s2 = sigma * sigma + TAU * TAU
        c2 = s2.sum(axis=1) + n * BETA * BETA
        c, eps = np.sqrt(c2), DRAW_QUANTILE * math.sqrt(n) * BETA
        x = sign * ahead / c - eps / c
        v = np.exp(-x * x / 2) / math.sqrt(2 * math.pi) / np.maximum(cdf(x), 1e-300)
        w = v * (v + x)
        up = (sign * v / c)[:, None] * np.where(np.arange(n) < shape, 1.0, -1.0)
        return {"p": p}, {"mu": mu + up * s2, "sigma": np.sqrt(np.maximum(s2 * (1 - s2 * (w / c2)[:, None]), 1e-12))}


def gaussian_replay(games: DataFrame, league: str = "league", order: str = "game_id", inverted: bool = False, rounds: str | None = None, known: DataFrame | None = None, **sizes) -> tuple[DataFrame, DataFrame]:
    """(games with p, the chance of the first side before the game; final (league, player, mu, sigma)), replayed in order.

    Games have players1, players2 (arrays) and first_won; with ``rounds``, a column of winners (1 or 2), each round is an
    update of its own. ``inverted`` credits the losing side, as a rank convention the wrong way round would. ``known`` holds
    ratings of an earlier run. See ``replay`` for ties, nulls and sizes.
    """

    def fold(game: dict, held: dict) -> dict:
        one, two = game["players1"], game["players2"]
        a, b = ([(held[p]["mu"], held[p]["sigma"]) for p in side] for side in (one, two))
        spread = math.sqrt((len(a) + len(b)) * BETA * BETA + sum(s * s for _, s in a + b))
        p = _cdf((sum(m for m, _ in a) - sum(m for m, _ in b)) / spread) if spread else 0.5
        for won in [game["first_won"]] if rounds is None else [r == 1 for r in game[rounds] or []]:
            if bool(won) != inverted:
                a, b = gaussian_update(a, b)
            else:
                b, a = gaussian_update(b, a)
        held.update((q, {"mu": m, "sigma": s}) for q, (m, s) in zip([*one, *two], [*a, *b], strict=True))
        return {"p": p}

    used = games.select(league, order, "players1", "players2", "first_won", *([rounds] if rounds else []))
    both = replay(used, league, order, F.concat("players1", "players2"), fold, {"mu": "double", "sigma": "double"}, {"mu": MU, "sigma": SIGMA}, "p double", known, many=None if rounds else GaussianLayer(inverted), **sizes)
    return both[0], both[1].withColumnRenamed("league", league)


def gaussian_fold(games: DataFrame, league: str = "league", order: str = "game_id", inverted: bool = False, **more) -> DataFrame:
    """The games' order, p, first_won and league of ``gaussian_replay``."""
    return gaussian_replay(games, league, order, inverted, **more)[0].select(order, "p", "first_won", league)


def percent_text(p: Column, faithful: bool = False) -> Column:
    """A chance in whole percent: truncated, or, faithful, the first two digits after the point of its text (0.5 gives 5)."""
    text = F.substring(F.element_at(F.split(p.cast("string"), r"\."), 2), 1, 2)
    return text.try_cast("int") if faithful else F.floor(100 * p).cast("int")


def team_mean(ratings: Column, faithful: bool = False, first_size: Column | None = None) -> Column:
    """Mean rating of a team; faithful, a sum that starts at -1, divided by the size of the first team for both."""
    total = F.aggregate(ratings, F.lit(0.0), lambda a, x: a + x)
    if faithful:
        return (total - 1) / (F.size(ratings) if first_size is None else first_size)
    return total / F.nullif(F.size(ratings), F.lit(0))


def team_means(rows: DataFrame, team: str, rating: str, first_size: int = 5) -> DataFrame:
    """(team, mean, faithful) of rows of players, by partial sums: no team's players are gathered. See ``team_mean``."""
    total = F.sum(F.coalesce(F.col(rating).cast("double"), F.lit(0.0)))
    return rows.groupBy(team).agg(F.avg(rating).alias("mean"), ((total - 1) / first_size).alias("faithful"))


def predicted_pair(p: Column) -> Column:
    """Both sides' chances in two digits, the first rounded half to even."""
    first = F.bround(p, 2)
    return F.struct(first.alias("p1"), F.round(1 - first, 2).alias("p2"))


def with_ratings(players: DataFrame, ratings: DataFrame, key: str, defaults: dict[str, float]) -> DataFrame:
    """players with their stored ratings, or the defaults."""
    joined = players.join(ratings.select(key, *defaults), key, "left")
    return joined.withColumns({c: F.coalesce(c, F.lit(v)) for c, v in defaults.items()})


def with_new_players(ratings: DataFrame, players: DataFrame, key: str, defaults: dict[str, float]) -> DataFrame:
    """Stored ratings and a row of defaults for each player without one."""
    fresh = players.select(key).distinct().join(ratings.select(key), key, "left_anti")
    return ratings.select(key, *defaults).unionByName(fresh.withColumns({c: F.lit(v) for c, v in defaults.items()}))


def write_back(ratings: DataFrame, fresh: DataFrame, key: str) -> DataFrame:
    """Stored ratings with those of a run written over, one row a player; players without a row are not added."""
    n = fresh.select(key, *[F.col(c).alias(f"new_{c}") for c in ratings.columns if c != key])
    joined = ratings.join(n, key, "left")
    return joined.select(key, *[F.coalesce(f"new_{c}", c).alias(c) for c in ratings.columns if c != key])


def five_a_side(games: DataFrame, first: str = "players1", second: str = "players2") -> DataFrame:
    """Games with exactly five players on each side."""
    return games.where((F.size(first) == 5) & (F.size(second) == 5))


def since(rows: DataFrame, key: str, mark: int) -> tuple[DataFrame, DataFrame]:
    """(rows beyond the high-water mark, rows at or below it, which a run refuses)."""
    return rows.where(F.col(key) > mark), rows.where(F.col(key) <= mark)


def rating_run(games: DataFrame, mark: int, league: str = "league", order: str = "game_id", known: DataFrame | None = None, **more) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(predictions, final ratings, skipped games, new mark) of the games beyond a mark.

    Games without five a side are skipped, and pass the mark too; those at or below the mark are refused by leaving them
    out. ``known`` holds the ratings that the run before left.
    """
    fresh, _ = since(games, order, mark)
    good = five_a_side(fresh)
    bad = ~((F.size("players1") == 5) & (F.size("players2") == 5))
    skipped = fresh.where(F.coalesce(bad, F.lit(True)))
    predictions, final = gaussian_replay(good, league, order, known=known, **more)
    return predictions, final, skipped, games.agg(F.greatest(F.max(order), F.lit(mark)).alias("mark"))


def resume_mark(rows: DataFrame, key: str, start: int) -> DataFrame:
    """The id to go on from: the largest there is, or a start; and the number of rows."""
    return rows.agg(F.coalesce(F.max(key), F.lit(start)).alias("last_id"), F.count("*").alias("n"))


def games_before(games: DataFrame, matches: DataFrame, game_match: str, match: str, day: Column) -> DataFrame:
    """Games of matches before a day, with the matches' columns; ``day`` is a condition on these."""
    return games.join(matches.where(day), F.col(game_match) == F.col(match)).drop(match)


def assembled_games(rows: DataFrame, game: str, player: str, first: Column) -> DataFrame:
    """Per game: both sides' players as text in numeric order, and the number of rows; games without one side are left out."""
    from scorelane.operators.state import roster_key

    side = lambda c: F.collect_list(F.when(c, F.col(player)))  # noqa: E731 (the players of one game)
    games = rows.groupBy(game).agg(side(first).alias("p1"), side(~first).alias("p2"), F.count("*").alias("n"))
    return games.where("size(p1) > 0 and size(p2) > 0").select(game, roster_key(F.col("p1")).alias("players1"), roster_key(F.col("p2")).alias("players2"), "n")


def upcoming_predictions(matches: DataFrame, ratings: DataFrame, team1: str, team2: str, day: Column) -> DataFrame:
    """Matches of the wanted days with the chances of both sides, from team ratings (team, mu, var, players)."""
    side = lambda k: ratings.select(F.col("team").alias(f"team{k}"), *[F.col(c).alias(f"{c}{k}") for c in ("mu", "var", "players")])
    joined = matches.where(day).withColumnsRenamed({team1: "team1", team2: "team2"}).join(side(1), "team1").join(side(2), "team2")
    p = win_probability(F.col("mu1"), F.col("mu2"), F.col("var1") + F.col("var2"), F.col("players1") + F.col("players2"))
    drop = [f"{c}{k}" for c in ("mu", "var", "players") for k in (1, 2)]
    return joined.withColumn("pair", predicted_pair(p)).select("*", "pair.*").drop("pair", *drop)


def round_winners(scores: Column) -> Column:
    """Winners (1 or 2) of consecutive rounds from running scores such as '3-2'; other steps are dropped."""
    pairs = F.transform(scores, lambda s: F.split(s, "-"))
    first = F.transform(pairs, lambda p: p[0].try_cast("int"))
    second = F.transform(pairs, lambda p: p[1].try_cast("int"))
    before = lambda xs, i: F.when(i == 0, F.lit(0)).otherwise(F.get(xs, i - 1))
    won = F.transform(first, lambda x, i: F.when(x - before(first, i) == 1, 1).when(F.get(second, i) - before(second, i) == 1, 2))
    return F.array_compact(won)


def series_to_rounds(score1: Column, score2: Column, faithful: bool = False) -> Column:
    """Side numbers 0 and 1: one for each point below 15 points in all, else the winner alone; -1 if unknown.

    faithful: the winner of a long game is found by comparing the scores as text ('9' is more than '16').
    """
    few = F.concat(F.array_repeat(F.lit(0), score1), F.array_repeat(F.lit(1), score2))
    first = score1.cast("string") > score2.cast("string") if faithful else score1 > score2
    return F.when(score1.isNull() | score2.isNull(), F.array(F.lit(-1))).when(score1 + score2 < 15, few).otherwise(F.array(F.when(first, 0).otherwise(1)))


def winner_number(score1: Column, score2: Column) -> Column:
    """1 or 2 for the side with more points, 0 for a tie; null if a score is missing."""
    return F.when(score1 > score2, 1).when(score1 < score2, 2).when(score1 == score2, 0)


def page_players(html: Column) -> Column:
    """The unlike player ids of a match page's two tables of players, by table."""
    blocks = F.split(html, 'class="players"')
    ids = lambda k: F.array_distinct(F.transform(F.regexp_extract_all(F.get(blocks, F.lit(k)), F.lit(r"/player/(\d+)/"), F.lit(1)), lambda x: x.cast("long")))
    return F.struct(ids(1).alias("players1"), ids(2).alias("players2"))


def predict_line_ups(line_ups: DataFrame, ratings: DataFrame, key: str) -> DataFrame:
    """(key, p1, p2) of line-ups (key, players1, players2) from ratings (player, mu, sigma); players without one have the start."""
    sides = F.array(F.struct(F.lit(1).alias("side"), F.col("players1").alias("ps")), F.struct(F.lit(-1).alias("side"), F.col("players2").alias("ps")))
    rows = line_ups.select(key, F.explode(sides).alias("s")).select(key, "s.side", F.explode("s.ps").alias("player"))
    rated = with_ratings(rows, ratings, "player", {"mu": MU, "sigma": SIGMA})
    sums = rated.groupBy(key).agg(F.sum(F.col("mu") * F.col("side")).alias("ahead"), F.sum(F.col("sigma") * F.col("sigma")).alias("var"), F.count("*").alias("n"))
    p = win_probability(F.col("ahead"), F.lit(0.0), F.col("var"), F.col("n"))
    return sums.select(key, predicted_pair(p).alias("pair")).select(key, "pair.*")


def predict_pages(pages: DataFrame, ratings: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Predictions of match pages by URL, from the players that the page lists."""
    found = pages.select(url, page_players(F.col(html)).alias("p")).select(url, "p.*").where("size(players1) > 0 and size(players2) > 0")
    return predict_line_ups(found, ratings, url)


def predict_games(games: DataFrame, asked: DataFrame, ratings: DataFrame, game: str = "game_id") -> DataFrame:
    """Predictions of the stored games (game, players1, players2) that are asked for by id."""
    return predict_line_ups(games.join(asked.select(game).distinct(), game, "left_semi"), ratings, game)

"""Extractors for the archived page layout: dates, teams, rosters, odds, countdowns, line-ups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorelane.functions.html import trimmed

#: Months by their first three letters.
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")


def month_number(name: Column) -> Column:
    """1 to 12 by the first three letters in any case; null for anything else."""
    at = F.array_position(F.array(*map(F.lit, MONTHS)), F.lower(F.substring(trimmed(name), 1, 3)))
    return F.nullif(at, F.lit(0)).cast("int")


def match_date(day: Column, clock: Column) -> Column:
    """'12th of March 2024' and 'HH:MM' as a timestamp without zone; null if either is malformed."""
    pattern = r"(?i)^\s*(\d{1,2})(?:st|nd|rd|th)? of ([a-z]+) (\d{4})\s*$"
    part = lambda k: F.regexp_extract(day, pattern, k)
    text = F.format_string("%s-%02d-%02d %s:00", part(3), month_number(part(2)), part(1).try_cast("int"), trimmed(clock))
    return F.when(day.rlike(pattern) & clock.rlike(r"^\s*\d{1,2}:\d{2}\s*$"), text.try_cast("timestamp_ntz"))


def first_seen(items: Column) -> Column:
    return F.array_distinct(items)


def round_history(titles: Column | None) -> Column:
    """Outcome titles such as '3-2' by rounds played; empty ones go, a missing holder gives ['-1']."""
    total = lambda s: F.split(s, "-")[0].try_cast("int") + F.split(s, "-")[1].try_cast("int")
    named = F.transform(F.filter(titles, lambda t: t != ""), lambda t: F.struct(total(t).alias("n"), t.alias("t")))
    return F.when(titles.isNull(), F.array(F.lit("-1"))).otherwise(F.transform(F.array_sort(named), lambda x: x["t"]))


def player_row(tokens: Column, link: Column) -> Column:
    """id, name, kills, deaths, adr and rating of a table row; -1 where a row has too few tokens."""
    pair = F.split(tokens[1], "-")
    long_ = F.size(tokens) > 7
    return F.struct(
        F.regexp_extract(link, r"/player/(\d+)/", 1).try_cast("long").alias("player_id"),
        tokens[0].alias("name"),
        trimmed(pair[0]).try_cast("int").alias("kills"),
        trimmed(F.get(pair, F.lit(1))).try_cast("int").alias("deaths"),
        F.when(long_, F.element_at(tokens, -2).try_cast("double")).otherwise(F.lit(-1.0)).alias("adr"),
        F.when(long_, F.element_at(tokens, -1).try_cast("double")).otherwise(F.lit(-1.0)).alias("rating"),
    )


def odds(rows: DataFrame, match: str = "match_id", pos: str = "pos") -> DataFrame:
    """From table rows (match, pos, provider_image, provider_text, cells): the last odds of each provider."""
    name = F.coalesce(F.nullif(trimmed(F.col("provider_image")), F.lit("")), F.nullif(trimmed(F.col("provider_text")), F.lit("")), F.lit("Unknown Provider"))
    full = rows.where("size(cells) >= 4").select(match, pos, name.alias("provider"), trimmed(F.col("cells")[1]).alias("odds1"), trimmed(F.col("cells")[3]).alias("odds2"))
    pair = F.struct("odds1", "odds2")
    return full.where("odds1 <> '' and odds2 <> ''").groupBy(match, "provider").agg(F.max_by(pair, pos).alias("o")).select(match, "provider", "o.*")


def countdown_bucket(text: Column) -> Column:
    t = F.lower(trimmed(text))
    return F.when(t.contains("h"), ">1h").when(t.rlike(r"\d+\s*m"), F.concat(F.regexp_extract(t, r"(\d+)\s*m", 1), F.lit("m"))).otherwise("live")


def line_ups(players: Column, first: tuple[int, int] = (0, 5), second: tuple[int, int] = (10, 15)) -> Column:
    """Both sides of a page's player cells by place; null unless there are enough cells."""
    side = lambda lo, hi: F.slice(players, lo + 1, hi - lo)
    return F.when(F.size(players) >= second[1], F.struct(side(*first).alias("team1"), side(*second).alias("team2")))


def split_ten(players: Column) -> Column:
    return F.when(F.size(players) == 10, F.struct(F.slice(players, 1, 5).alias("team1"), F.slice(players, 6, 5).alias("team2")))


def last_match(items: DataFrame, links: DataFrame, key: str, pos: str, url: str) -> DataFrame:
    """Each item with its last link, if any."""
    return items.join(links.groupBy(key).agg(F.max_by(url, pos).alias(url)), key, "left")


def teams(names: Column, links: Column) -> Column:
    """(team1, team2) of id and name: the first two names, and the first two unlike ids of the links in page order."""
    ids = F.array_compact(F.transform(links, lambda u: F.nullif(F.regexp_extract(u, r"/team/(\d+)/", 1), F.lit("")).try_cast("long")))
    ids = F.array_distinct(ids)
    side = lambda k: F.struct(F.get(ids, F.lit(k)).alias("team_id"), trimmed(F.get(names, F.lit(k))).alias("name"))
    return F.struct(side(0).alias("team1"), side(1).alias("team2"))


def played_maps(maps: Column) -> Column:
    """The maps of structs (name, played, score1, score2) that were played, without the placeholder named Default.

    Scores are numbers where they are digits alone, else null.
    """
    digits = lambda s: F.when(trimmed(s).rlike(r"^\d+$"), trimmed(s).try_cast("int"))
    kept = F.filter(maps, lambda m: m["played"] & (trimmed(m["name"]) != "Default"))
    return F.transform(kept, lambda m: F.struct(trimmed(m["name"]).alias("map"), digits(m["score1"]).alias("score1"), digits(m["score2"]).alias("score2")))


def match_records(pages: DataFrame) -> DataFrame:
    """Match records of pages with match_id, url, day, clock, event, names, team_links, maps and scores."""
    sides = teams(F.col("names"), F.col("team_links"))
    maps = played_maps(F.col("maps"))
    won = lambda a, b: F.size(F.filter(F.col("played"), lambda m: m[a] > m[b]))
    rows = pages.withColumn("sides", sides).withColumn("played", maps).withColumn("scheduled_at", match_date(F.col("day"), F.col("clock")))
    return rows.select(
        "match_id", "url", "scheduled_at", "event", "sides.team1", "sides.team2", won("score1", "score2").alias("maps1"), won("score2", "score1").alias("maps2"), F.size("played").alias("n_maps")
    )


def game_records(pages: DataFrame) -> DataFrame:
    """One record for each played map: match_id, game (from 0), map, score1, score2, winner (1, 2 or null)."""
    games = pages.select("match_id", F.posexplode(played_maps(F.col("maps"))).alias("game", "m")).select("match_id", "game", "m.*")
    return games.withColumn("winner", F.when(F.col("score1") > F.col("score2"), 1).when(F.col("score1") < F.col("score2"), 2))


def player_records(rows: DataFrame) -> DataFrame:
    """Player records of table rows (match_id, game, side, tokens, link); rows without a player's id are left out."""
    read = rows.select("match_id", "game", "side", player_row(F.col("tokens"), F.col("link")).alias("p")).select("match_id", "game", "side", "p.*")
    return read.where("player_id is not null")


def provider_odds(rows: DataFrame, matches: DataFrame, provider: str = "gg.bet", match: str = "match_id") -> DataFrame:
    """Each match with the decimal odds of one provider, null where it has none; the last row of a provider counts."""
    mine = odds(rows).where(F.col("provider") == provider).select(match, F.col("odds1").try_cast("double").alias("odds1"), F.col("odds2").try_cast("double").alias("odds2"))
    return matches.join(mine, match, "left")


def odds_map(rows: DataFrame, match: str = "match_id") -> DataFrame:
    """One row a match: a map from provider to its odds."""
    pair = F.struct(F.col("odds1").try_cast("double").alias("odds1"), F.col("odds2").try_cast("double").alias("odds2"))
    return odds(rows).groupBy(match).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("provider", pair)))).alias("odds"))


def page_sections(html: Column) -> Column:
    """What a diagnostic lists: ids of statistics sections, ids of the map menu, and the number of map blocks."""
    return F.struct(
        F.regexp_extract_all(html, F.lit(r'id="(\d+|all)-content"'), F.lit(1)).alias("sections"),
        F.regexp_extract_all(html, F.lit(r'id="(\d+|all)"'), F.lit(1)).alias("menu"),
        F.size(F.regexp_extract_all(html, F.lit(r'class="mapholder'), F.lit(0))).alias("n_maps"),
    )


def general_info(html: Column) -> Column:
    """What the oldest scraper reads of a page: both teams and scores, the date's parts, and the scores of played maps.

    A team's id is that of the first, or second unlike, link in a header row of the statistics. A score is that of a block
    with ``won``, ``lost`` or ``tie``; a played map without a winner has no score.
    """
    block = lambda n: F.regexp_extract(html, rf'(?s)class="team{n}-gradient(.*?)(?:class="team{3 - n}-gradient|class="mapholder|\z)', 1)
    score = lambda n: F.nullif(F.regexp_extract(block(n), r'class="(?:won|lost|tie)">\s*(\d+)', 1), F.lit("")).try_cast("int")
    name = lambda n: F.nullif(trimmed(F.regexp_extract(block(n), r'class="teamName">([^<]*)', 1)), F.lit(""))
    ids = F.array_distinct(F.regexp_extract_all(html, F.lit(r'(?s)class="header-row">.*?href="/team/(\d+)/'), F.lit(1)))
    date = F.regexp_extract(html, r'class="date">([^<]*)', 1)
    part = lambda k: F.nullif(F.regexp_extract(date, r"^\s*(\d{1,2})[a-z]{2} of ([A-Za-z]+) (\d{4})\s*$", k), F.lit(""))
    blocks = F.filter(F.slice(F.split(html, 'class="mapholder">'), 2, F.greatest(F.lit(1), F.size(F.split(html, 'class="mapholder">')))), lambda b: F.contains(b, F.lit('class="played"')) & ~F.contains(b, F.lit('class="mapname">Default<')))
    pair = lambda b: F.concat(F.regexp_extract(b, r'class="won">(\d+)', 1), F.lit(":"), F.regexp_extract(b, r'class="lost">(\d+)', 1))
    maps = F.transform(blocks, lambda b: F.struct(F.regexp_extract(b, r'class="mapname">([^<]*)', 1).alias("map"), F.when(F.contains(b, F.lit('class="won"')), pair(b)).alias("score")))
    return F.struct(
        name(1).alias("team1"), name(2).alias("team2"), F.get(ids, F.lit(0)).try_cast("long").alias("team1_id"), F.get(ids, F.lit(1)).try_cast("long").alias("team2_id"),
        score(1).alias("score1"), score(2).alias("score2"), part(1).try_cast("int").alias("day"), month_number(part(2)).alias("month"), part(3).try_cast("int").alias("year"), maps.alias("maps"),
    )


#: The tables of a page that hold kills of each against each, by their place.
KILL_TABLES = {1: "all", 2: "first", 3: "awp"}


def kill_matrix(cells: DataFrame, key: str) -> DataFrame:
    """Rows (key, kind, killer, victim, kills, deaths) of kill tables given as cells (key, table, row, col, cell).

    The first row names the victims, the first cell of each other row the killer, and a cell such as 3:5 has the kills of both.
    """
    of = cells.where(F.col("table").isin(*KILL_TABLES))
    kind = F.element_at(F.create_map(*[F.lit(x) for kv in KILL_TABLES.items() for x in kv]), F.col("table"))
    names = of.where("row = 0").select(key, "table", "col", F.col("cell").alias("victim"))
    killers = of.where("col = 0").select(key, "table", "row", F.col("cell").alias("killer"))
    met = of.where("row > 0 and col > 0").join(names, [key, "table", "col"]).join(killers, [key, "table", "row"])
    pair = F.split("cell", ":")
    return met.select(key, kind.alias("kind"), "killer", "victim", trimmed(pair[0]).try_cast("int").alias("kills"), trimmed(F.get(pair, F.lit(1))).try_cast("int").alias("deaths"))

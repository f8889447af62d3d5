"""Match pages to nested records: teams, scores, maps and player statistics, in one projection."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorelane.functions.html import CHALLENGE_MARKERS, absolute, decoded, instant_of_epoch, non_empty, trimmed

from .pages import match_id, match_slug

#: Of the records that this parser gives.
PARSER_VERSION = "1"
#: The markup of match pages, here and in the patterns below. Letters in markup are of either case, see ``_sought``:
#: what stands after a run that may hold > is marked so on its own, and so is a letter that is usually a capital.
MAP_OPEN, SECTION_OPEN = r'<div class="mapholder">', r'<div class="stats-content" id="[^"\s]+(?i:-content)">'
SECTION_ID = r'<div class="stats-content" id="([^"\s]+)(?i:-content)">'
HEAD_END = r'<div class="(?:mapholder|stats-content)"'
SECTION = r'<div class="stats-content"'
MAP_LINK = r'href="([^"]*(?i:/stats/matches/(?:performance/)?mapstatsid/)(\d+)/[^"]+)"'
TABLE, TABLE_END, ROW, ROW_END = '<table class="table totalstats">', "</table>", "<tr>", "</tr>"
PLAYER = r'href="/player/(\d+)/'
SKIPPED_MAPS = ("Default", "TBA")
#: Characters that stand in most places; a set of single ones is looked up in a table of bits.
_COMMON = "".join(f"\\x{k:02x}" for k in range(128) if not 65 <= k <= 90)
#: Pages whose capitals all stand in text between tags (without quotes or equals signs), in titles, or where the patterns have them.
PLAIN = (
    rf"""\A(?:[{_COMMON}]+|N(?<=class="teamN)ame|[A-Z](?<=>[^<>"=]{{0,40}}[A-Z])[^<>"=]*(?=<|\z)|P(?<=class="statsP)layerName|P(?<=class="smartphone-only statsP)layerName"""
    r"""|[A-Z](?<=(?:title|alt)="[^"<>=]{0,80}[A-Z])[^<>"=]*(?=")|D(?<=<!D)OCTYPE|[^A-Z])*+\z"""
)


def _sought(plain: Column) -> Callable[[str], Column]:
    """A pattern whose letters are of either case. Each literal of it has a quote or bracket in reach, so on a plain page none
    is written otherwise than here, and the pattern is sought as it is written: by skips, many times as fast."""
    return lambda pattern: F.when(plain, F.lit(f"(?s){pattern}")).otherwise(F.lit(f"(?is){pattern}"))


def _group(text: Column, pattern: Column, group: int = 1) -> Column:
    """Group of the first match, empty if there is none."""
    return F.call_function("regexp_extract", text, pattern, F.lit(group))


def _split(text: Column, pattern: Column, limit: int = -1) -> Column:
    return F.call_function("split", text, pattern, F.lit(limit))


def _cast(text: Column, pattern: Column, kind: str, group: int = 1) -> Column:
    """The group as a number; null if there is none (a cast of an empty text would raise and catch)."""
    return F.get(F.call_function("regexp_extract_all", text, pattern, F.lit(group)), F.lit(0)).try_cast(kind)


def _first(texts: tuple, p: Callable, *patterns: str) -> Column:
    """The first pattern with a non-empty group; each is sought in the texts in turn (a part that likely holds it, then the whole)."""
    return F.coalesce(*[non_empty(_group(t, p(x))) for x in patterns for t in texts])


def _number(texts: tuple, p: Callable, *patterns: str) -> Column:
    """As _first, of groups of digits and dots."""
    return F.coalesce(*[_cast(t, p(x), "double") for x in patterns for t in texts])


def _clean(text: Column) -> Column:
    return decoded(trimmed(text))


def _block(head: Column, html: Column, n: int, p: Callable) -> Column:
    block = rf'<div[^>]*class="team{n}-gradient[^"]*".*?</div>'
    return F.coalesce(*[non_empty(_group(t, p(block), 0)) for t in (head, html)], F.lit(""))


def _cut(head: Column, html: Column, n: int, p: Callable) -> Column:
    """A team's own part of the page: a block ends at the first map; the other team's may come first, and the head holds both or the page does."""
    html = F.when(F.contains(head, F.lit(f'class="team{n}-gradient')), head).otherwise(html)
    own = F.get(_split(html, p(f'class="team{n}-gradient'), 2), F.lit(1))
    return F.concat(F.lit(f'class="team{n}-gradient'), F.coalesce(_split(own, p(f'class="team{3 - n}-gradient|<div class="mapholder"'), 2)[0], F.lit("")))


def _score(texts: tuple, n: int, p: Callable) -> Column:
    return _number(texts, p, *[rf'class="team{n}-gradient.*?class="{c}"[^>]*>(\d+)' for c in ("won", "score")]).cast("int")


def _closed(text: Column, begin: Column, end: Column) -> Column:
    """What stands between a beginning and the next end, of each end before which one begins."""
    parts = F.array(_split(text, end))
    return F.transform(parts, lambda ts: F.array_compact(F.transform(F.slice(ts, 1, F.size(ts) - 1), lambda t: F.get(_split(t, begin, 2), F.lit(1)))))[0]


def _game(m: Column, url: Column, base: str) -> Column:
    """A map of what was read of its block; null without a name, or with that of a map not chosen."""
    number = lambda s: F.when(s == "", F.lit(0)).otherwise(s.try_cast("double").cast("int"))
    fields = F.struct(
        m["map_id"].alias("map_id"),
        m["name"].alias("map_name"),
        F.when(m["link"] != "", absolute(m["link"], base)).otherwise(url).alias("source_url"),
        number(m["score1"]).alias("team1_score"),
        number(m["score2"]).alias("team2_score"),
    )
    return F.when((m["name"] != "") & ~m["name"].isin(*SKIPPED_MAPS), fields)


def _maps(blocks: Column, url: Column, base: str, p: Callable) -> Column:
    """The maps of blocks, in order; a lambda names what it uses twice by a struct of the one before."""

    def read(text: Column) -> Column:
        scores = F.call_function("regexp_extract_all", text, p(r'class="results-team-score[^"]*"[^>]*>([^<]+)'), F.lit(1))
        return F.struct(_clean(_group(text, p(r'class="mapname[^"]*"[^>]*>([^<]+)'))).alias("name"), _group(text, p(MAP_LINK)).alias("link"), _cast(text, p(MAP_LINK), "long", 2).alias("map_id"), scores.alias("scores"))

    def scored(m: Column) -> Column:
        return F.struct(m["name"].alias("name"), m["link"].alias("link"), m["map_id"].alias("map_id"), *[trimmed(F.get(m["scores"], F.lit(k))).alias(f"score{k + 1}") for k in (0, 1)])

    return F.array_compact(F.transform(F.transform(F.transform(blocks, read), scored), lambda m: _game(m, url, base)))


def _player(game: Column, team: Column, row: Column, p: Callable) -> Column:
    pair = r'class="kd text-center traditional-data">\s*(\d+)\s*-\s*(\d+)\s*<'
    nicks = [r'class="player-nick">([^<]+)', r'class="smartphone-only stats[Pp]layer[Nn]ame text-ellipsis">([^<]+)', r'class="stats[Pp]layer[Nn]ame text-ellipsis">([^<]+)']
    share = lambda pattern: _cast(row, p(pattern), "double")
    return F.struct(
        _cast(row, p(PLAYER), "long").alias("player_id"),
        F.coalesce(_clean(_first((row,), p, *nicks)), F.lit("Unknown")).alias("nickname"),
        team.alias("team_id"),
        game["map_name"].alias("map_name"),
        _cast(row, p(pair), "int").alias("kills"),
        _cast(row, p(pair), "int", 2).alias("deaths"),
        share(r'class="adr[^"]*(?i:traditional-data)[^>]*>([0-9.]+)').alias("adr"),
        share(r'class="rating[^"]*">([0-9.]+)').alias("rating"),
        share(r'class="kast[^"]*(?i:traditional-data)[^>]*>([0-9.]+)%').alias("kast"),
        game["source_url"].alias("source_url"),
    )


def _tables(section: Column, p: Callable) -> Column:
    return _closed(_split(section, p(SECTION), 2)[0], p(TABLE), p(TABLE_END))


def _any_player(sections: Column, p: Callable) -> Column:
    """Whether the sections have a player; what comes after the first is not read."""
    row = lambda r: _cast(r, p(PLAYER), "long").isNotNull()
    return F.exists(sections, lambda s: F.exists(_tables(s["text"], p), lambda t: F.exists(_closed(t, p(ROW), p(ROW_END)), row)))


def _players(sections: Column, team1: Column, team2: Column, p: Callable) -> Column:
    """The players of sections (game, text), in order, by tables and rows."""
    tables = F.flatten(F.transform(sections, lambda s: F.transform(_tables(s["text"], p), lambda t: F.struct(s["game"].alias("game"), t.alias("text")))))

    def read(t: Column) -> Column:
        linked = _cast(t["text"], p(r'href="/team/(\d+)/[^"]*" class="team[Nn]ame team"'), "long")
        said = trimmed(_group(t["text"], p(r'class="team[Nn]ame team">([^<]+)')))
        return F.struct(t["game"].alias("game"), said.alias("said"), linked.alias("linked"), _closed(t["text"], p(ROW), p(ROW_END)).alias("rows"))

    def rows(t: Column) -> Column:
        team = F.coalesce(t["linked"], F.when(t["said"] == team1["name"], team1["team_id"]).when(t["said"] == team2["name"], team2["team_id"]))
        return F.transform(t["rows"], lambda row: _player(t["game"], team, row, p))

    return F.filter(F.flatten(F.transform(F.transform(tables, read), rows)), lambda x: x["player_id"].isNotNull())


def _once(c: Column) -> Column:
    """The column, worked out in one place: a filter on it is not pushed below, where it would be worked out again."""
    return F.when(F.spark_partition_id() >= 0, c)


def parse_matches(pages: DataFrame, base: str, url: str = "match_url", html: str = "html", faithful_scores: bool = False) -> DataFrame:
    """One nested record per page (columns match_url and html). A challenge page gives an empty record.

    A page is split once into its map blocks and sections, and these into tables and rows, from which fields are read; a page
    is read where it lies, and nothing is shuffled. Pages that are repeated give a record each; a null page counts as empty.
    """
    h = F.coalesce(F.col(html), F.lit(""))
    marked = F.lit(False)
    for marker in CHALLENGE_MARKERS:
        if not any(m != marker and m in marker for m in CHALLENGE_MARKERS):
            marked = marked | F.rlike(h, F.lit("".join(f"[{c}]" if c in ".|" else c for c in marker)))
    # what is used twice is a column of its own: an expression in two places is worked out twice, and one within a lambda for each element
    page = pages.select(F.col(url).alias("source_url"), h.alias("h"), marked.alias("challenge"))
    page = page.withColumn("h", F.when(F.col("challenge"), F.lit("")).otherwise(F.col("h")))
    page = page.withColumn("plain", F.rlike("h", F.lit(PLAIN)))
    p = _sought(F.col("plain"))
    # what is said of the match as a whole stands before its maps and sections: that part is searched first
    page = page.withColumn("head", _split(F.col("h"), p(HEAD_END), 2)[0])
    h, head = F.col("h"), (F.col("head"), F.col("h"))
    page = page.withColumns({f"block{n}": _block(*head, n, p) for n in (1, 2)} | ({} if faithful_scores else {f"cut{n}": _cut(*head, n, p) for n in (1, 2)}))
    page = page.withColumns({f"name{n}": _clean(_group(F.col(f"block{n}"), p(r'class="team[Nn]ame[^"]*"[^>]*>([^<]+)'))) for n in (1, 2)})
    named = lambda n: F.when(F.col(f"name{n}") != "", F.col(f"name{n}")).otherwise("Unknown")
    page = page.withColumns({f"team{n}": F.struct(_cast(F.col(f"block{n}"), F.lit(r"(?i)/team/(\d+)/"), "long").alias("team_id"), named(n).alias("name")) for n in (1, 2)})
    after = lambda pattern: F.slice(_split(h, p(pattern)), 2, 2**30)
    blocks = F.transform(after(MAP_OPEN), lambda t: _split(t, p(SECTION), 2)[0])
    ids = F.call_function("regexp_extract_all", h, p(SECTION_ID), F.lit(1))
    page = page.withColumns({"games": _maps(blocks, F.col("source_url"), base, p), "sections": F.zip_with(ids, after(SECTION_OPEN), lambda k, text: F.struct(k.alias("id"), text.alias("text")))})
    key = lambda m: F.coalesce(F.concat(F.lit("id:"), m["map_id"].cast("string")), F.concat(F.lit("name:"), m["map_name"]))
    page = page.withColumn("keys", F.transform("games", key))
    place = F.transform("keys", lambda k: F.array_position(F.col("keys"), k))
    both = F.filter(F.zip_with("games", place, lambda m, at: F.struct(m.alias("m"), at.alias("at"))), lambda x, i: x["at"] == i + 1)
    page = page.withColumn("maps", F.transform(both, lambda x: x["m"]))  # the first of equal maps
    by_id = F.map_from_entries(F.filter(F.transform("maps", lambda m: F.struct(m["map_id"].cast("string").alias("k"), m)), lambda e: e["k"].isNotNull()))
    page = page.withColumn("by_id", by_id)
    of = F.transform("sections", lambda s: F.struct(F.try_element_at("by_id", s["id"]).alias("game"), s["text"].alias("text")))
    of = F.when(F.size("by_id") > 0, F.filter(of, lambda s: s["game"].isNotNull())).otherwise(F.slice(of, 1, 0))  # of those that have a map
    page = page.withColumn("sections", of)
    page = page.withColumn("player_stats", _players(F.col("sections"), F.col("team1"), F.col("team2"), p))
    score = lambda n: _score(head if faithful_scores else (F.col(f"cut{n}"),), n, p)
    page = page.withColumns({f"team{n}_score": score(n) for n in (1, 2)})
    s1, s2 = F.col("team1_score"), F.col("team2_score")
    status = F.when(F.col("challenge"), "challenge").when((F.size("maps") > 0) & _any_player(F.col("sections"), p), "parsed").otherwise("partial")
    winner = F.when(s1 > s2, F.col("team1.team_id")).when(s2 > s1, F.col("team2.team_id"))
    demo = _first(head, p, r'data-demo-link="([^"]+)"', r'href="([^"]*(?i:/download/demo/)[^"]+)"')
    return page.select(
        match_id(F.col("source_url")).alias("match_id"),
        match_slug(F.col("source_url")).alias("slug"),
        "source_url",
        _clean(_first(head, p, r'class="event text-ellipsis"[^>]*title="([^"]+)', r'class="event"[^>]*>\s*<a[^>]*>([^<]+)')).alias("event_name"),
        _number(head, lambda x: F.lit(f"(?i){x}"), r"Best of (\d+)", r"bo(\d+)").cast("int").alias("best_of"),
        instant_of_epoch(_number(head, p, r'data-unix="(\d{10,13})"')).alias("scheduled_at"),
        "team1", "team2", "team1_score", "team2_score",
        _once(F.col("maps")).alias("maps"),
        _once(F.col("player_stats")).alias("player_stats"),
        absolute(demo, base).alias("raw_demo_url"),
        winner.alias("winner_team_id"),
        _once(status).alias("status"),
        F.lit(PARSER_VERSION).alias("parser_version"),
    )


def maps_of(parsed: DataFrame) -> DataFrame:
    return parsed.select("match_id", F.posexplode("maps").alias("pos", "m")).select("match_id", "pos", "m.*")


def player_stats_of(parsed: DataFrame) -> DataFrame:
    return parsed.select("match_id", F.explode("player_stats").alias("p")).select("match_id", "p.*")


def winner(score1: Column, score2: Column, team1: Column, team2: Column) -> Column:
    """The team with more points; null for a tie or a missing score."""
    return F.when(score1 > score2, team1).when(score2 > score1, team2)

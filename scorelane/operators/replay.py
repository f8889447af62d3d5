"""Replay of games whose outcome changes their players' state: in order for each player, side by side otherwise.

A game depends on the last game of each of its players and on nothing else. A league is cut along its order into slices, each
of which starts from the states that the one before it leaves. A league of few players has thin layers of games that can be
played at once: its slice is played in one task, which takes the games in order as a stream and holds the states of the slice's
players alone. Where a fold has a version for many games at once, the games of a batch are played by layers: a game's layer follows the last
one of its players, and the games of a layer share no player. A league of many is first dealt to tasks by hash of game: every (player, game) row knows the player's next
game, a pass plays all games whose states are in, and states pass on to the next game as messages. Such passes go on while
each can play half of what waits, so they are few; what is left of the slice is then played in order.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scorelane.operators.ordering import BROADCAST_GROUPS, prefix_scan
from scorelane.sources.files import checkpointed, shared_folder

#: A league of more players than this is dealt to a task for each so many, and a slice has so many games a task: states of
#: half a million players are some 200 MB in a task.
PLAYERS_A_TASK, GAMES_A_TASK = 500_000, 50_000
#: The same where states are held in arrays (``many``): a player takes some 130 bytes there (an estimate, not measured).
PLAYERS_IN_ARRAYS = 1_500_000
#: Slices at most: those of a long league are larger, as each costs a step, and its games are streamed.
MOST_SLICES = 16


def _pass(fold: Callable, rows_at_once: int = 5_000):
    """A layer: takes in states, plays the games that are complete in order, and passes states on."""

    def run(batches):
        games, messages, schema = {}, [], None
        for batch in batches:
            schema = batch.schema
            for row in batch.to_pylist():
                if row["message"]:
                    messages.append(row)
                else:
                    games[row["league"], row["seq"]] = row
        if schema is None:
            return

        def enter(game: dict, player, state) -> None:
            for e in game["entries"]:
                if e["player"] == player:
                    e["before"] = state

        for m in messages:
            enter(games[m["league"], m["seq"]], m["entries"][0]["player"], m["entries"][0]["before"])
        out = []
        for game in sorted(games.values(), key=lambda g: g["seq"]):
            if game["done"] or any(e["before"] is None for e in game["entries"]):
                continue
            held = {e["player"]: dict(e["before"]) for e in game["entries"]}
            game["made"] = fold(game["game"], held)
            game["done"] = True
            for e in game["entries"]:
                e["after"] = held[e["player"]]
                if e["next"] is None:
                    continue
                if (at := (game["league"], e["next"])) in games:
                    enter(games[at], e["player"], e["after"])
                else:
                    state = {"player": e["player"], "next": None, "before": e["after"], "after": None}
                    out.append({"league": game["league"], "seq": e["next"], "message": True, "done": False, "game": None, "entries": [state], "made": None})
        out = [*games.values(), *out]
        for at in range(0, len(out), rows_at_once):
            yield pa.RecordBatch.from_pylist(out[at : at + rows_at_once], schema=schema)

    return run


def _values(array: pa.Array) -> list:
    """Python values of an Arrow array; numbers and lists of them go by way of numpy."""
    if pa.types.is_list(array.type):
        flat, at, out = _values(array.flatten()), 0, []
        for n in array.value_lengths().to_pylist():
            out.append(None if n is None else flat[at : at + n])
            at += n or 0
        return out
    if not array.null_count and (pa.types.is_integer(array.type) or pa.types.is_floating(array.type)):
        return array.to_numpy(zero_copy_only=False).tolist()
    return array.to_pylist()


def _in_order(fold: Callable, start: dict, rows_at_once: int = 20_000):
    """Rows (league, game, made, players, states), by league and in order, to the games played, then each player's last state.

    A row's states are entered before its game; a row without a game holds states alone. A row that comes out has a game
    and what was made of it, or one player and state.
    """

    def run(batches):
        league, states, schema = None, {}, None

        def played(batch, lines, made):
            if lines:
                some = batch.select(["league", "game"]).take(pa.array(lines, pa.int64())).columns
                none = [pa.nulls(len(lines), schema.field(k).type) for k in (3, 4)]
                yield pa.RecordBatch.from_arrays([*some, pa.array(made, schema.field(2).type), *none], schema=schema)

        def last():
            players = list(states)
            for at in range(0, len(players), rows_at_once):
                some = players[at : at + rows_at_once]
                columns = [[league] * len(some), [None] * len(some), [None] * len(some), [[p] for p in some], [[states[p]] for p in some]]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

        for whole in batches:
            schema = whole.schema
            for at in range(0, whole.num_rows, rows_at_once):
                batch = whole.slice(at, rows_at_once)
                game = batch.column("game")
                names = [game.type.field(k).name for k in range(game.type.num_fields)]
                fields = [_values(x) for x in game.flatten()]
                there = game.is_valid().to_pylist()
                leagues, players, given = (_values(batch.column(c)) for c in ("league", "players", "states"))
                lines, made = [], []
                for k, (of, ps, before) in enumerate(zip(leagues, players, given, strict=True)):
                    if of != league:
                        yield from played(batch, lines, made)
                        yield from last()
                        league, states, lines, made = of, {}, [], []
                    if before is not None:
                        states.update((p, s) for p, s in zip(ps, before, strict=True) if s is not None)
                    if there[k]:
                        held = {p: dict(states.get(p) or start) for p in ps}
                        made.append(fold({n: f[k] for n, f in zip(names, fields, strict=True)}, held))
                        states.update(held)
                        lines.append(k)
                yield from played(batch, lines, made)
        if schema is not None:
            yield from last()

    return run


class _States:
    """The states of a task's players, a row each of one array a column; players are numbered as they come."""

    def __init__(self, start: dict):
        self.start, self.place = start, {}
        self.columns = {c: np.full(1024, v, np.float64) for c, v in start.items()}

    def places(self, players: list) -> list:
        place = self.place
        out = [place.setdefault(p, len(place)) for p in players]
        for c, old in self.columns.items():
            if len(place) > len(old):
                self.columns[c] = np.full(2 * len(place), self.start[c], np.float64)
                self.columns[c][: len(old)] = old
        return out

    def held(self, places: list) -> list[dict]:
        return [{c: float(v[k]) for c, v in self.columns.items()} for k in places]


def _in_layers(fold: Callable, many: Callable, start: dict, rows_at_once: int = 20_000):
    """As _in_order, by layers. Only for folds whose states are doubles and that make doubles of every game."""

    def run(batches):
        league, states, schema = None, _States(start), None

        def last():
            players = list(states.place)
            for at in range(0, len(players), rows_at_once):
                some = players[at : at + rows_at_once]
                each, kind = pa.array(np.arange(len(some) + 1, dtype=np.int32)), schema.field("states").type.value_type
                made = pa.StructArray.from_arrays([pa.array(states.columns[kind.field(k).name][at : at + len(some)]) for k in range(kind.num_fields)], fields=list(kind))
                lists = [pa.ListArray.from_arrays(each, v).cast(schema.field(c).type) for c, v in (("players", pa.array(some, schema.field("players").type.value_type)), ("states", made))]
                yield pa.RecordBatch.from_arrays([pa.array([league] * len(some), schema.field(0).type), *[pa.nulls(len(some), schema.field(k).type) for k in (1, 2)], *lists], schema=schema)

        def play(part):
            """The games of rows of one league, each row's states entered first."""
            sizes = part.column("players").value_lengths().to_numpy(zero_copy_only=False)
            flat = states.places(_values(part.column("players").flatten()))
            place, ends = np.array(flat, np.int64), np.cumsum(sizes)
            given = part.column("states")
            told = np.repeat(given.is_valid().to_numpy(zero_copy_only=False), sizes)
            if told.any():  # a player's state is told once, at the next game
                now = given.flatten()
                there = now.is_valid().to_numpy(zero_copy_only=False)
                for c, v in states.columns.items():
                    v[place[told][there]] = now.field(c).to_numpy(zero_copy_only=False)[there]
            rows = np.flatnonzero(part.column("game").is_valid().to_numpy(zero_copy_only=False))
            if not len(rows):
                return
            game = part.column("game").take(pa.array(rows))
            fields = {game.type.field(k).name: x for k, x in enumerate(game.flatten())}
            starts = (ends - sizes)[rows]
            layer, reached = [], [0] * len(states.place)
            for a, b in zip(starts.tolist(), ends[rows].tolist(), strict=True):
                own = flat[a:b]
                next_ = max([reached[k] for k in own], default=0) + 1
                layer.append(next_)
                for k in own:
                    reached[k] = next_
            shape = many.shape(fields, sizes[rows])
            order = np.lexsort((shape, sizes[rows], np.array(layer)))
            keys = np.stack([np.array(layer)[order], sizes[rows][order], shape[order]])
            cuts = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1).tolist(), len(order)]
            made_type = schema.field("made").type
            made = {made_type.field(k).name: np.empty(len(rows)) for k in range(made_type.num_fields)}
            names = part.column("players")
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                some = order[a:b]
                if b - a > 1 and shape[some[0]] >= 0:
                    at = place[starts[some][:, None] + np.arange(sizes[rows[some[0]]])]
                    held = {c: v[at] for c, v in states.columns.items()}
                    out, held = many(fields, some, int(shape[some[0]]), held)
                    for c, v in held.items():
                        states.columns[c][at] = v
                    for c, v in out.items():
                        made[c][some] = v
                    continue
                for k in some.tolist():
                    own = flat[starts[k] : ends[rows[k]]]
                    ids = names[int(rows[k])].as_py()
                    held = dict(zip(ids, states.held(own), strict=True))
                    out = fold({n: x[k].as_py() for n, x in fields.items()}, held)
                    for i, q in zip(own, ids, strict=True):
                        for c, v in states.columns.items():
                            v[i] = held[q][c]
                    for c, v in out.items():
                        made[c][k] = v
            result = pa.StructArray.from_arrays([pa.array(v) for v in made.values()], fields=list(made_type))
            none = [pa.nulls(len(rows), schema.field(k).type) for k in (3, 4)]
            yield pa.RecordBatch.from_arrays([part.column("league").take(pa.array(rows)), game, result, *none], schema=schema)

        for whole in batches:
            schema = whole.schema
            for at in range(0, whole.num_rows, rows_at_once):
                batch = whole.slice(at, rows_at_once)
                leagues = _values(batch.column("league"))
                begins = [0, *[k for k in range(1, len(leagues)) if leagues[k] != leagues[k - 1]], len(leagues)]
                for a, b in zip(begins[:-1], begins[1:], strict=True):
                    if leagues[a] != league:
                        yield from last()
                        league, states = leagues[a], _States(start)
                    yield from play(batch.slice(a, b - a))
        if schema is not None:
            yield from last()

    return run


def replay(
    games: DataFrame, league: str, order: str, players: Column, fold: Callable, state: dict[str, str], start: dict, made: str = "none int",
    known: DataFrame | None = None, games_a_task: int = GAMES_A_TASK, players_a_task: int | None = None, many: Callable | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(the games with what ``fold`` makes of them, final states (league, player, state columns)).

    fold(game, held) takes a game as a dict and the states of its players, a dict from player to a dict of the state
    columns; it changes these states and returns what it makes, a dict with the columns of ``made`` or None. ``known`` holds
    states from before; other players begin with ``start``. The order may be of any type. Games of a null order come
    first; games of one order go by a hash of their columns, which is the same in every run. A null league is one
    league, a null player one player of it; a player named twice counts once. An empty table gives no rows.

    ``many`` plays games without a common player at once, where all states and what is made are doubles: many.shape(fields,
    sizes) tells from Arrow arrays of the games' columns and the numbers of their players which are alike, by a number a game, or
    -1 for the fold; many(fields, places, shape, held) takes the places of alike ones and a matrix a state column, a row a game and
    a column a player, and gives what is made, by column, and the new matrices.
    """
    players_a_task = players_a_task or (PLAYERS_IN_ARRAYS if many else PLAYERS_A_TASK)
    spark = games.sparkSession
    cores = spark.sparkContext.defaultParallelism
    kind = dict(games.dtypes)
    none = F.array().cast(f"array<{games.select(players.alias('p')).schema['p'].dataType.elementType.simpleString()}>")
    of = games.select(F.struct("*").alias("game"), F.col(league).alias("league"), F.coalesce(F.array_distinct(players), none).alias("players"), F.col(order).alias("order"))
    fields = ", ".join(f"{c}: {t}" for c, t in state.items())
    player = of.schema["players"].dataType.elementType.simpleString()
    entry = f"struct<player: {player}, next: bigint, before: struct<{fields}>, after: struct<{fields}>>"
    game_type, made_type = of.schema["game"].dataType.simpleString(), f"struct<{', '.join(f'{x.split()[0]}: {x.split()[1]}' for x in made.split(', '))}>"
    schema = f"league {kind[league]}, seq bigint, message boolean, done boolean, game {game_type}, entries array<{entry}>, made {made_type}"
    stream = f"league {kind[league]}, game {game_type}, made {made_type}, players array<{player}>, states array<struct<{fields}>>"
    same = F.col("league").eqNullSafe(F.col("l")) & F.col("player").eqNullSafe(F.col("p"))
    sizes = of.select("league", F.posexplode_outer("players").alias("pos", "player")).groupBy("league", "player", F.col("pos").isNull().alias("alone")).agg(F.count_if(F.coalesce(F.col("pos"), F.lit(0)) == 0).alias("games"))
    sizes = sizes.groupBy("league").agg(F.count_if(~F.col("alone")).alias("n"), F.sum("games").alias("games"))
    parts = F.greatest(F.lit(1), F.ceil(F.col("n") / players_a_task)).cast("int")
    # a slice has so many games a task, or more if the league would take too many slices
    sizes = checkpointed(sizes.select(F.col("league").alias("l"), "games", parts.alias("parts"), F.greatest(games_a_task * parts, F.ceil(F.col("games") / MOST_SLICES)).alias("wide")))
    leagues, dealt_parts, most = sizes.agg(F.count("*"), F.sum(F.when(F.col("parts") > 1, F.col("parts"))), F.max(F.least("wide", "games"))).first()
    at_once = max(1, min(leagues, 4 * cores))
    if leagues <= BROADCAST_GROUPS:  # the largest leagues go to tasks of their own
        slot = F.row_number().over(Window.orderBy(F.desc("games"))) - 1
        sizes = F.broadcast(sizes.select("l", "parts", "wide", (slot % at_once).cast("int").alias("slot")))
    else:
        sizes = sizes.select("l", "parts", "wide", F.pmod(F.xxhash64("l"), F.lit(at_once)).cast("int").alias("slot"))
    rows = prefix_scan(of, [F.col("order"), F.xxhash64("game")], {"seq": F.lit(1).cast("long")}, ["league"]).drop("order")
    rows = rows.join(sizes, F.col("league").eqNullSafe(F.col("l"))).select("league", "seq", "game", "players", "parts", "slot", F.floor((F.col("seq") - 1) / F.col("wide")).cast("int").alias("slice"))
    root = shared_folder(spark, "slices")
    rows.write.partitionBy("slice").parquet(root)
    rows = spark.read.schema(rows.schema).parquet(root)
    slices = (rows.agg(F.max("slice")).first()[0] or 0) + 1
    tasks = max(cores, min(dealt_parts or 1, 4 * cores), -(-(most or 0) // games_a_task))
    no_state = F.lit(None).cast(f"array<struct<{fields}>>")
    no_game, no_made = F.lit(None).cast(game_type), F.lit(None).cast(made_type)
    known = None if known is None else known.select("league", "player", *state)
    ends = []
    for number in range(slices):
        part = rows.where(F.col("slice") == number)
        told = part.where("parts = 1").select("slot", "league", "seq", F.lit(False).alias("message"), "game", "players", no_state.alias("states"))
        before = None
        if known is not None:
            before = known.join(part.select(F.col("league").alias("l"), F.explode("players").alias("p")).distinct(), same, "left_semi")
            slots = part.where("parts = 1").groupBy(F.col("league").alias("l")).agg(F.first("slot").alias("slot"))
            slots = F.broadcast(slots) if leagues <= BROADCAST_GROUPS else slots
            held = before.join(slots, F.col("league").eqNullSafe(F.col("l"))).select("slot", "league", F.lit(0).cast("long").alias("seq"), F.lit(True).alias("message"), no_game.alias("game"), F.array("player").alias("players"), F.array(F.struct(*state)).alias("states"))
            told = told.unionByName(held)
        played, last = [], []
        if dealt_parts:
            live = _entries(part.where("parts > 1"), before, state, start, entry, made_type)
            slots = rows.where("parts > 1").groupBy(F.col("league").alias("l")).agg(F.first("slot").alias("slot"))
            waiting = None
            while True:  # until nothing waits, or a pass plays less than half
                dealt = live.repartition(tasks, "league", F.pmod(F.xxhash64("seq"), F.lit(tasks)))
                live = checkpointed(dealt.mapInArrow(_pass(fold), schema))
                done, games_left = live.agg(F.count_if("done"), F.count_if(F.expr("not done and not message"))).first()
                played.append(live.where("done").select("game", "made"))
                last.append(live.where("done").select("league", F.explode("entries").alias("e")).where("e.next is null").select("league", "e.player", "e.after.*"))
                live = live.where("not done")
                if not games_left or done < games_left:
                    break
            if games_left:
                rest = live.join(F.broadcast(slots) if leagues <= BROADCAST_GROUPS else slots, F.col("league").eqNullSafe(F.col("l")))
                told = told.unionByName(rest.select("slot", "league", "seq", "message", "game", F.col("entries.player").alias("players"), F.col("entries.before").alias("states")))
        told = told.repartitionById(at_once, F.col("slot")).sortWithinPartitions("league", "seq", F.desc("message"))
        told = checkpointed(told.select("league", "game", no_made.alias("made"), "players", "states").mapInArrow(_in_layers(fold, many, start) if many else _in_order(fold, start), stream))
        played.append(told.where("game is not null").select("game", "made"))
        last.append(told.where("game is null").select("league", F.col("players")[0].alias("player"), F.col("states")[0].alias("s")).select("league", "player", "s.*"))
        ends.extend(played)
        fresh = _all(last)
        if known is not None:
            fresh = fresh.unionByName(known.join(fresh.select(F.col("league").alias("l"), F.col("player").alias("p")), same, "left_anti"))
        known = checkpointed(fresh) if slices > 1 else fresh
    return _all(ends).select("game.*", "made.*"), known


def _all(tables: list[DataFrame]) -> DataFrame:
    out = tables[0]
    for more in tables[1:]:
        out = out.unionByName(more)
    return out


def _entries(part: DataFrame, known: DataFrame | None, state: dict[str, str], start: dict, entry: str, made_type: str) -> DataFrame:
    """The games of a slice with an entry a player: their next game in the slice, and the state before it if it is their first."""
    part = part.withColumn("key", F.struct("league", "seq"))
    entries = part.select("key", "seq", "league", F.posexplode("players").alias("pos", "player"))
    own = Window.partitionBy("league", "player").orderBy("seq")
    entries = entries.withColumns({"next": F.lead("seq").over(own), "first": F.lag("seq").over(own).isNull()})
    fresh = F.struct(*[F.lit(start[c]).cast(t).alias(c) for c, t in state.items()])
    if known is None:
        entries = entries.withColumn("stored", fresh)
    else:
        mine = known.select(F.col("league").alias("l"), F.col("player").alias("p"), F.struct(*state).alias("stored"))
        entries = entries.join(mine, F.col("league").eqNullSafe(F.col("l")) & F.col("player").eqNullSafe(F.col("p")), "left")
    before = F.when(F.col("first"), F.coalesce("stored", fresh))
    after = F.lit(None).cast(fresh_type := f"struct<{', '.join(f'{c}: {t}' for c, t in state.items())}>")
    entries = entries.select("key", F.struct("pos", F.struct("player", "next", before.cast(fresh_type).alias("before"), after.alias("after")).alias("e")).alias("e"))
    entries = entries.groupBy("key").agg(F.array_sort(F.collect_list("e")).alias("es")).select("key", F.transform("es", lambda e: e["e"]).alias("entries"))
    none = F.array().cast(f"array<{entry}>")
    live = part.join(entries, "key", "left")  # a game may have no players
    return live.select("league", "seq", F.lit(False).alias("message"), F.lit(False).alias("done"), "game", F.coalesce("entries", none).alias("entries"), F.lit(None).cast(made_type).alias("made"))

"""Divergence audit of sources by their words: distances between all sources of a language, and each one's telling terms.

Counts are gathered in whole Arrow batches and summed by Spark. A distance is a sum over all kept terms; what terms that
neither source has add is one product, so only terms that one of both has are looked at. These are split: a term that
many sources have (heavy) goes into dense numpy tiles, sources by terms; the postings of rare ones (light) are corrected
sparsely, alone against the other source's floor by sorted prefix sums, and in pairs where both have the term. A tile takes
a block of sources against another for one block of terms; its partial sums, whole numbers, are added up by Spark.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import checkpointed, hot_join

#: Fixed by the contract: documents that a kept term has in its language, the unit of shares, the prior count, telling terms.
LEAST_DOCS, UNIT, PRIOR, TOP = 30, 1_000_000_000, 5, 50
#: A term is heavy if it is in more than this share of its language's sources.
HEAVY_SHARE = 1 / 8
#: Sources and kept terms, about, in a tile's blocks.
BLOCK_SOURCES, BLOCK_TERMS = 32, 4096
#: Entries of a worker's counters, after which they are passed on.
ENTRIES = 300_000

#: Fixed by the contract: bytes of terms (letters, and all of other characters), A-Z as small letters; others part terms.
TERMS = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


def _counted(batches):
    """Arrow batches of (lang, source, text) to rows (lang, source, term, n, docs): partial counts, and one of term null a group."""
    counts: dict[tuple[str, str], Counter] = {}
    docs: dict[tuple[str, str], Counter] = {}
    entries = 0

    def flushed():
        for group, terms in counts.items():
            own, n = docs[group], len(terms)
            names = pa.array([None, *terms], pa.binary()).cast(pa.string())
            sums = pa.array([0, *terms.values()], pa.int64())
            in_docs = pa.array([0, *(own[t] for t in terms)], pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array([group[0]] * (n + 1), pa.string()), pa.array([group[1]] * (n + 1), pa.string()), names, sums, in_docs], names=["lang", "source", "term", "n", "docs"])

    for batch in batches:
        for lang, source, text in zip(*(batch.column(c) for c in ("lang", "source", "text")), strict=True):
            group = (lang.as_py(), source.as_py())
            if group not in counts:
                counts[group], docs[group] = Counter(), Counter()
            buffer = text.as_buffer()
            words = Counter((b"" if buffer is None else buffer.to_pybytes()).translate(TERMS).split())
            before = len(counts[group])
            counts[group].update(words)
            docs[group].update(words.keys())
            entries += len(counts[group]) - before + 1
            if entries > ENTRIES:
                yield from flushed()
                counts.clear()
                docs.clear()
                entries = 0
    yield from flushed()


def share(count: Column, total: Column) -> Column:
    """1 + floor(UNIT * count / total) for count <= total: by three digits a step, so that no product overflows."""
    value, rest = F.lit(0).cast("long"), count.cast("long")
    for _ in range(3):
        rest = rest * 1000
        value = value * 1000 + F.call_function("div", rest, total)
        rest = rest % total
    return value + 1


def term_counts(docs: DataFrame, lang_col: str, source_col: str, text_col: str) -> DataFrame:
    """Rows (lang, source, term, n, docs), with a row of term null for each group."""
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    rows = docs.select(text(lang_col).alias("lang"), text(source_col).alias("source"), text(text_col).alias("text"))
    parts = rows.mapInArrow(_counted, "lang string, source string, term string, n long, docs long")
    return parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def audit_tables(docs: DataFrame, lang_col: str, source_col: str, text_col: str, least_docs: int) -> tuple[DataFrame, DataFrame]:
    """(groups, kept), both written: rows (g, lang, source, total, n_terms, lang_total, n_sources) and, for each kept term that
    a group has, (g, term, n, lang_n, n_has)."""
    counts = checkpointed(term_counts(docs, lang_col, source_col, text_col))
    terms = counts.where("n > 0").groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("in_docs"), F.count("*").alias("n_has"))
    terms = checkpointed(terms.where(F.col("in_docs") >= least_docs).drop("in_docs"))
    kept = counts.where("n > 0").drop("docs").join(terms, ["lang", "term"])
    kept = checkpointed(kept.select(F.struct("lang", "source").alias("g"), "term", "n", "lang_n", "n_has"))
    totals = kept.groupBy("g").agg(F.sum("n").alias("total"))
    langs = terms.groupBy("lang").agg(F.sum("lang_n").alias("lang_total"), F.count("*").alias("n_terms"))
    groups = counts.where("term is null").select("lang", "source", F.struct("lang", "source").alias("g"))
    sources = groups.groupBy("lang").agg(F.count("*").alias("n_sources"))
    groups = groups.join(totals, "g", "left").join(sources.join(langs, "lang", "left"), "lang")
    zero = F.lit(0).cast("long")
    groups = groups.select("g", "lang", "source", *[F.coalesce(c, zero).alias(c) for c in ("total", "n_terms", "lang_total")], "n_sources")
    return checkpointed(groups), kept


def _corrections(first: pd.DataFrame, second: pd.DataFrame, floors: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """For each source of one block against each of another, the sum over one block of terms of |p - q| less |floor - floor|.

    Frames have columns at (source number), term (a number), p and heavy; floors are the shares of absent terms.
    """
    low, high = floors
    apart = np.abs(low[:, None] - high[None, :])
    out = np.zeros(apart.shape, np.int64)
    heavy = [f[f["heavy"]] for f in (first, second)]
    names = np.unique(np.concatenate([h["term"].to_numpy() for h in heavy]))
    step = max(1, (1 << 22) // max(1, apart.size))
    for at in range(0, len(names), step):  # dense tiles
        tile = names[at : at + step]
        dense = []
        for rows, floor in zip(heavy, floors, strict=True):
            p = np.repeat(floor[:, None], len(tile), axis=1)
            place = np.searchsorted(tile, rows["term"].to_numpy())
            here = (place < len(tile)) & (tile[np.minimum(place, len(tile) - 1)] == rows["term"].to_numpy())
            p[rows["at"].to_numpy()[here], place[here]] = rows["p"].to_numpy()[here]
            dense.append(p)
        out += np.abs(dense[0][:, None, :] - dense[1][None, :, :]).sum(2) - apart * len(tile)
    light = [f[~f["heavy"]] for f in (first, second)]
    for side, (rows, others) in enumerate(zip(light, floors[::-1], strict=True)):  # each posting against the other's floor
        ats, ps = rows["at"].to_numpy(), rows["p"].to_numpy()
        order = np.lexsort((ps, ats))
        ats, ps = ats[order], ps[order]
        bounds = np.searchsorted(ats, np.arange(len(floors[side]) + 1))
        for a in np.unique(ats):
            mine = ps[bounds[a] : bounds[a + 1]]
            sums = np.concatenate([[0], np.cumsum(mine)])
            k = np.searchsorted(mine, others)
            total = others * k - sums[k] + (sums[-1] - sums[k]) - others * (len(mine) - k)
            if side == 0:
                out[a] += total - apart[a] * len(mine)
            else:
                out[:, a] += total - apart[:, a] * len(mine)
    one, two = (f.sort_values("term", kind="stable") for f in light)
    t1, t2 = one["term"].to_numpy(), two["term"].to_numpy()
    lo, hi = np.searchsorted(t2, t1, "left"), np.searchsorted(t2, t1, "right")
    a1, p1, a2, p2 = one["at"].to_numpy(), one["p"].to_numpy(), two["at"].to_numpy(), two["p"].to_numpy()
    many = hi - lo
    cuts = np.searchsorted(np.cumsum(many), np.arange(0, many.sum() + 1, 1 << 20), "left")
    for at, upto in zip(cuts, np.append(cuts[1:], len(many)), strict=True):  # postings that both have, portion by portion
        n = many[at:upto]
        i = np.repeat(np.arange(at, upto), n)
        j = np.repeat(lo[at:upto] - np.cumsum(n) + n, n) + np.arange(n.sum())
        a, b, p, q = a1[i], a2[j], p1[i], p2[j]
        np.add.at(out, (a, b), np.abs(p - q) - np.abs(p - high[b]) - np.abs(low[a] - q) + apart[a, b])
    return out


def _tile(rows: pd.DataFrame) -> pd.DataFrame:
    """A tile's rows (side, source, term, p, heavy, floor, n_terms) to (source, item, part_sum); rows without a term are the sources."""
    lang, i, j, block = rows[["lang", "i", "j", "block"]].iloc[0]
    sides, floors, names = [], [], []
    codes, _ = pd.factorize(rows["term"])
    rows = rows.assign(code=codes)
    for side in (0, 1 if i != j else 0):
        mine = rows[rows["side"] == side]
        sources = mine[mine["term"].isna()].sort_values("source")
        has = mine[mine["term"].notna()]
        at = pd.Index(sources["source"]).get_indexer(has["source"])
        sides.append(pd.DataFrame({"at": at, "term": has["code"].to_numpy(), "p": has["p"].to_numpy(np.int64), "heavy": has["heavy"].to_numpy(bool)}))
        floors.append(sources["floor"].to_numpy(np.int64))
        names.append(sources["source"].to_numpy())
    sums = _corrections(*sides, tuple(floors))
    if block == 0:  # terms that neither has, once
        n_terms = rows["n_terms"].max()
        sums += np.abs(floors[0][:, None] - floors[1][None, :]) * int(n_terms)
    a, b = (x.ravel() for x in np.meshgrid(names[0], names[1], indexing="ij"))
    pairs = pd.DataFrame({"lang": lang, "source": a, "item": b, "value": sums.ravel()})
    pairs = pairs[pairs["source"] != pairs["item"]]
    return pairs if i == j else pd.concat([pairs, pairs.rename(columns={"source": "item", "item": "source"})[pairs.columns]])


def pair_distances(groups: DataFrame, shares: DataFrame, block_sources: int = BLOCK_SOURCES, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """Rows (lang, source, item, value): the distance of every two sources of a language, both ways.

    ``groups`` (lang, source, floor, n_terms, n_sources), ``shares`` (lang, source, term, p, floor, n_terms, n_sources, heavy).
    """
    blocks = F.ceil(F.col("n_sources") / block_sources)
    term_blocks = F.greatest(F.lit(1).cast("long"), F.ceil(F.col("n_terms") / block_terms))
    own = F.pmod(F.xxhash64("source"), blocks)
    columns = ["lang", "source", "term", "p", "floor", "n_terms", "heavy", "block", "own", "blocks"]
    postings = shares.withColumns({"block": F.pmod(F.xxhash64("term"), term_blocks), "own": own, "blocks": blocks}).select(*columns)
    heads = groups.withColumns({"own": own, "blocks": blocks, "block": F.explode(F.sequence(F.lit(0).cast("long"), term_blocks - 1))})
    heads = heads.withColumns({"term": F.lit(None).cast("string"), "p": F.lit(None).cast("long"), "heavy": F.lit(False)}).select(*columns)
    rows = postings.unionByName(heads).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    rows = rows.withColumns({"i": F.least("own", "other"), "j": F.greatest("own", "other"), "side": F.when(F.col("own") <= F.col("other"), 0).otherwise(1)})
    tiles = rows.drop("own", "other", "blocks").groupBy("lang", "i", "j", "block").applyInPandas(_tile, "lang string, source string, item string, value long")
    return tiles.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def divergence_audit(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text", least_docs: int = LEAST_DOCS, top: int = TOP) -> DataFrame:
    """Rows (lang, source, part, item, value, rank) of all groups: distances (``pair``) and telling terms (``term``).

    Null text, language and source count as empty text. A group without kept terms has the floor for each, a language without
    kept terms distances of 0; a language of one source has no pairs. Ties go by the item's bytes. Very long texts are read
    whole; repeated rows count each. Columns of other names are not read, and an empty table gives no rows. Shares are exact
    for up to 9 * 10^15 words of a group.
    """
    groups, kept = audit_tables(docs, lang_col, source_col, text_col, least_docs)
    wide = PRIOR * F.col("n_terms")
    some = F.col("n_terms") > 0
    floor = F.when(some, share(F.lit(PRIOR), F.col("total") + wide)).otherwise(F.lit(0).cast("long"))
    groups = groups.withColumn("floor", floor)
    many = checkpointed(kept.groupBy("g").agg(F.count("*").alias("many")).join(groups, "g"))
    rows = hot_join(kept, many, "g").withColumns({"p": share(F.col("n") + PRIOR, F.col("total") + wide), "q": share(F.col("lang_n") + PRIOR, F.col("lang_total") + wide)})
    rows = checkpointed(rows.withColumn("heavy", F.col("n_has") > F.greatest(F.lit(1.0), HEAVY_SHARE * F.col("n_sources"))))
    pairs = pair_distances(groups, rows).withColumn("part", F.lit("pair"))
    telling = rows.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    w = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    telling = telling.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top)
    return pairs.withColumn("rank", F.row_number().over(w)).select(*telling.columns).unionByName(telling).select("lang", "source", "part", "item", "value", "rank")

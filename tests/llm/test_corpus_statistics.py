"""Sharding, resampling and divergence: against plain versions and in edge cases."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from scorelane.llm import divergence, resampling
from scorelane.llm.divergence import divergence_audit
from scorelane.llm.resampling import importance_resample, ranked
from scorelane.llm.sharding import shard_documents, shares

SCHEMA = "doc_id long, text string, lang string, source string, row string, sha string, hub string, term string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, *["x"] * (8 - len(r))) for r in rows], SCHEMA)


def words(rng, n, of=200):
    return " ".join(f"w{int(of * rng.random() ** 2)}" for _ in range(n))


# sharding


def check_shards(docs, got, law, shards):
    want = Counter((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t, *_ in docs)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == want
    assert all(r["law"] == law and r["grown_shard"] is None for r in got)
    by = defaultdict(list)
    for r in got:
        by[r["shard"]].append(r)
    assert set(by) <= set(range(shards))
    for rows in by.values():
        assert sorted(r["slot"] for r in rows) == list(range(len(rows)))
    return [sum(r["size"] for r in by[k]) for k in range(shards)], [len(by[k]) for k in range(shards)]


def corpus():
    rng = random.Random(3)
    texts = [words(rng, rng.choice([3, 20, 90])) for _ in range(300)]
    docs = [(k, t) for k, t in enumerate(texts)]
    for g in range(25):  # groups of copies, one of them with over a third of all rows
        docs += [(len(docs) + i, texts[g]) for i in range(400 if g == 0 else rng.randrange(1, 6))]
    rng.shuffle(docs)
    return docs + [(5000, None), (5001, ""), (None, "no id"), (7, docs[0][1]), (7, docs[0][1])]


@pytest.mark.parametrize("law", ["bytes", "rows"])
def test_shards_are_even_and_copies_stay_together(spark, law):
    docs = corpus()
    got = shard_documents(frame(spark, docs), law=law).collect()
    sizes, counts = check_shards(docs, got, law, 8)
    if law == "rows":
        assert max(counts) - min(counts) <= 1
    else:
        assert max(sizes) - min(sizes) <= 0.01 * sum(sizes)
    text = dict(docs)
    groups = defaultdict(Counter)
    for r in got:
        groups[text.get(r["doc_id"])][r["shard"]] += 1
    many = {t: sum(c.values()) for t, c in groups.items() if sum(c.values()) > 1}
    cut = [t for t in many if len(groups[t]) > 1]
    assert len(cut) <= 4  # the large group has to be cut, and few others where it ends
    large = max(many, key=many.get)
    weight = many[large] * (len(large.encode()) + 1 if law == "bytes" else 1)
    assert len(groups[large]) <= math.ceil(weight / (sum(sizes if law == "bytes" else counts) / 8)) + 2


def test_propagation_lowers_the_cut_of_given_links(spark):
    rng = random.Random(5)
    docs = [(k, f"text {k}") for k in range(240)]
    links = [(k, f"c{k // 12}") for k in range(240)] + [(k, f"x{k % 7}") for k in range(240) if rng.random() < 0.1]
    links += [(3, "c0"), (None, "c0"), (4, None), (999, "c1")]
    hubs = spark.createDataFrame(links, "doc_id long, hub string")

    def outside(shard):
        return sum(12 - max(Counter(shard[k] for k in range(12 * c, 12 * c + 12)).values()) for c in range(20))

    got = shard_documents(frame(spark, docs), hubs, law="rows").collect()
    _, counts = check_shards(docs, got, "rows", 8)
    assert max(counts) - min(counts) <= 1
    assert outside({r["doc_id"]: r["shard"] for r in got}) < 0.4 * outside([rng.randrange(8) for _ in docs])


def test_shards_of_few_and_no_rows(spark):
    assert shard_documents(frame(spark, [])).count() == 0
    for docs in ([(1, "a")], [(k, "same") for k in range(20)], [(k, "x" * 10**k) for k in range(6)]):
        for law in ("bytes", "rows"):
            sizes, counts = check_shards(docs, shard_documents(frame(spark, docs), law=law).collect(), law, 8)
            if law == "rows":
                assert max(counts) - min(counts) <= 1
            elif len(docs) == 20:
                assert max(sizes) - min(sizes) <= 5
    with pytest.raises(ValueError):
        shard_documents(frame(spark, []), law="none")


def test_shares_keep_capacity():
    rng = random.Random(1)
    for _ in range(50):
        loads = [rng.randrange(50, 100) for _ in range(5)]
        flows = {(a, b): rng.randrange(1, 30) for a in range(5) for b in range(5) if a != b}
        let = shares(loads, flows, [100.0] * 5)
        after = list(loads)
        for (a, b), w in flows.items():
            after[a] -= let[b] * w
            after[b] += let[b] * w
        assert max(after) <= 100.5 and all(0 <= x <= 1 for x in let)
    assert shares([50, 50], {(0, 1): 10, (1, 0): 10}, [50, 50]) == [1.0, 1.0]  # a fair exchange needs no room


# resampling


def runs(text, buckets=10_000):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    return len(w), [zlib.crc32(" ".join(w[i : i + k]).encode()) % buckets for k in (1, 2, 3) for i in range(len(w) - k + 1)]


def plain_resample(docs, target):
    feats = [(d, *runs(t)) for d, t, *_ in docs]
    s, t = Counter(), Counter()
    for _, _, f in feats:
        s.update(f)
    for x in target:
        t.update(runs(x)[1])
    gain = [math.floor(1000 * math.log((t[k] + 1) * (s.total() + 10_000) / ((s[k] + 1) * (t.total() + 10_000)))) for k in range(10_000)]
    rows = []
    for d, n, f in feats:
        h = int(hashlib.sha256(f"42:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        w = sum(gain[k] for k in f)
        rows.append((d, n, len(f), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    good = sorted((r for r in rows if r[1] >= 20), key=lambda r: (-r[4], r[0] is None, r[0]))
    rank = {id(r): k for k, r in enumerate(good[: 5 * len(good) // 100], 1)}
    return Counter((d, m, w, s, rank.get(id(r))) for r in rows for d, _, m, w, s in [r])


def test_resampling_equals_the_plain_version(spark, monkeypatch):
    rng = random.Random(8)
    texts = [words(rng, rng.randrange(0, 60)) for _ in range(200)]
    docs = [(k, t) for k, t in enumerate(texts)] + [(1000 + k, texts[0] if k % 3 else texts[7]) for k in range(120)]
    docs += [(2000, None), (2001, ""), (2002, "Ünï Ä́b \U0001f600x Iİ 9A"), (2003, "a" * 70 + " " + "B" * 5000 + " c"), (2004, "..."), (2005, words(rng, 5000)), (None, words(rng, 30))]
    target = [words(rng, 40, 30), None, "w1 w2 w3"]
    goal = spark.createDataFrame([(t,) for t in target], "text string")
    got = Counter(tuple(r) for r in importance_resample(frame(spark, docs), goal).collect())
    assert got == plain_resample(docs, target)
    assert importance_resample(frame(spark, []), goal).count() == 0
    none = importance_resample(frame(spark, docs[:30]), goal.where("false")).collect()
    assert Counter(tuple(r) for r in none) == plain_resample(docs[:30], [])


def test_features_do_not_depend_on_portions(monkeypatch):
    rng = random.Random(9)
    texts = [words(rng, n) for n in (0, 400, 3, 90)] + [None, "Aa1", "é" * 80 + " x"]
    batch = pa.RecordBatch.from_arrays([pa.array([b"%d" % k for k in range(len(texts))]), pa.array([1, 2, 1, 1, 1, 3, 1]), pa.array(texts)], names=["sha", "many", "text"])
    want = Counter()
    for t, m in zip(texts, (1, 2, 1, 1, 1, 3, 1), strict=True):
        for b in runs(t)[1]:
            want[b] += m
    for at_once, portion in ((4 << 20, 1 << 19), (100, 37), (1, 1)):
        monkeypatch.setattr(resampling, "TEXT_AT_ONCE", at_once)
        monkeypatch.setattr(resampling, "WORDS_AT_ONCE", portion)
        rows = pa.Table.from_batches(resampling._features(10_000)([batch])).to_pylist()
        assert {r["bucket"]: r["n"] for r in rows if r["bucket"] is not None} == want
        for k, t in enumerate(texts):
            mine = [r for r in rows if r["sha"] == b"%d" % k]
            assert sum(r["n_words"] for r in mine) == runs(t)[0]
            assert Counter(b for r in mine for b in np.cumsum(np.frombuffer(r["steps"], "<u2"))) == Counter(runs(t)[1])


def test_crc_of_strings_put_together():
    rng = random.Random(2)
    crc = resampling.Crc()
    a = [bytes(rng.randrange(256) for _ in range(rng.choice([0, 1, 5, 64, 65, 3000]))) for _ in range(60)]
    b = [bytes(rng.randrange(256) for _ in range(rng.choice([0, 1, 5, 64, 65, 3000]))) for _ in range(60)]
    sums = lambda xs: np.array([zlib.crc32(x) for x in xs], np.uint32)
    assert (crc.followed(sums(a), sums(b), np.array([len(x) for x in b])) == sums([x + y for x, y in zip(a, b, strict=True)])).all()
    whole = np.frombuffer(b"".join(a), np.uint8)
    ends = np.cumsum([len(x) for x in a])
    assert (crc.of(whole, ends - [len(x) for x in a], ends) == sums(a)).all()


def test_ranks_are_global(spark):
    rows = spark.range(0, 1000, 1, 7).select("id", (F.col("id") % 13).alias("score"))
    got = {r["id"]: r["rank"] for r in ranked(rows, [F.desc("score"), F.asc("id")], 5).collect()}
    assert got == {k: i for i, k in enumerate(sorted(range(1000), key=lambda k: (-(k % 13), k)), 1)}


# divergence


def plain_audit(docs, least=30, top=50):
    counts, in_docs = defaultdict(Counter), defaultdict(Counter)
    for _, text, lang, source in docs:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low)
        counts[lang or "", source or ""].update(terms)
        in_docs[lang or ""].update(set(terms))
    rows = []
    for lang in {g[0] for g in counts}:
        kept = [t for t, n in in_docs[lang].items() if n >= least]
        groups = [g for g in counts if g[0] == lang]
        whole = Counter()
        for g in groups:
            whole.update(counts[g])

        def p(c, kept=kept):
            total = sum(c[t] for t in kept) + 5 * len(kept)
            return {t: 1 + math.floor(Fraction(10**9 * (c[t] + 5), total)) for t in kept}

        q, of = p(whole), {g: p(counts[g]) for g in groups}
        for g in groups:
            pairs = [(h[1], sum(abs(of[g][t] - of[h][t]) for t in kept)) for h in groups if h != g]
            terms = [(t, of[g][t] - q[t]) for t in kept if counts[g][t] and of[g][t] > q[t]]
            for part, found, most in (("pair", pairs, len(pairs)), ("term", terms, top)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                rows += [(*g, part, item, value, k) for k, (item, value) in enumerate(found[:most], 1)]
    return sorted(rows)


def sources(rng, many, docs=400):
    out = []
    for k in range(docs):
        s = 0 if rng.random() < 0.35 else rng.randrange(many)
        out.append((k, " ".join(rng.choice(["The", "of", "été", "日本"]) if rng.random() < 0.3 else "q" + chr(97 + (s * 3 + rng.randrange(9)) % 26) + chr(97 + rng.randrange(4)) for _ in range(40)), rng.choice(["en", "fr"]), f"s{s}"))
    return out


@pytest.mark.parametrize("blocks", [(32, 4096), (3, 5)])
def test_divergence_equals_the_plain_version(spark, monkeypatch, blocks):
    docs = sources(random.Random(4), 23)
    docs += [(900, None, "en", "s1"), (901, "the of", None, None), (902, "", "xx", "only"), (903, "12 34", "en", "no terms"), (900, "The", "en", "s1"), (None, "the", "en", "s2")]
    monkeypatch.setattr(divergence.pair_distances, "__defaults__", blocks)
    for least in (5, 30):
        got = divergence_audit(frame(spark, docs), least_docs=least).collect()
        assert sorted(map(tuple, got)) == plain_audit(docs, least)


def test_divergence_of_nothing(spark):
    assert divergence_audit(frame(spark, [])).count() == 0
    docs = [(1, "a b", "en", "x"), (2, "b c", "en", "y"), (3, "c", "de", "z")]
    assert sorted(map(tuple, divergence_audit(frame(spark, docs)).collect())) == [("en", "x", "pair", "y", 0, 1), ("en", "y", "pair", "x", 0, 1)]


def test_counters_pass_on_what_they_hold(monkeypatch):
    monkeypatch.setattr(divergence, "ENTRIES", 3)
    docs = sources(random.Random(6), 3, 20)
    batch = pa.RecordBatch.from_arrays([pa.array([d[k] for d in docs]) for k in (2, 3, 1)], names=["lang", "source", "text"])
    got, want = Counter(), Counter()
    for r in pa.Table.from_batches(divergence._counted([batch])).to_pylist():
        got[r["lang"], r["source"], r["term"]] += r["n"]
    for _, text, lang, source in docs:
        want[lang, source, None] += 0
        for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text):
            want[lang, source, t.lower() if t.isascii() else t] += 1
    assert got == want


def test_resampling_counts_in_a_row_a_task(spark):
    from scorelane.llm import resampling

    rows = [(bytes([k]), 1 + k % 3, " ".join(f"w{(k * j) % 40}" for j in range(30))) for k in range(60)]
    texts = spark.createDataFrame(rows, "sha binary, many long, text string").repartition(12)
    stored = resampling._stored_features(texts, 100)
    assert stored.where("counts is not null").count() <= 12 and stored.where("sha is not null").count() == 60
    want = sum(r["many"] * r["n_features"] for r in stored.join(texts.select("sha", "many"), "sha").collect())
    counts = resampling.bucket_counts(stored, 100)
    assert counts.count() <= 100 * resampling.ADDERS and counts.agg({"n": "sum"}).first()[0] == want

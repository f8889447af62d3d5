"""The pipeline's stages on the smallest tables, each against what it must keep."""

import os
import random
import re
import sys
import zlib
from collections import defaultdict

import __spark_entry__ as entry
import corpus_pipeline
import duckdb
import public_tokenizers
import pytest
import tokenizers
from pyspark.sql import functions as F

from scorelane.llm import quality, secrets

sys.path.insert(0, os.path.dirname(__file__))
from test_operators import jaccard_roots, plain_quality

FOLDER = "/root/testdata/sf0.001"


def test_stages_keep_columns_and_act(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, sizes = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs
        docs = spark.createDataFrame(stage(spark, docs, FOLDER).toPandas(), before.schema)
        assert docs.columns == columns, name
        sizes.append(docs.count())
    assert sizes[0] > sizes[1] > sizes[2] >= sizes[3] == sizes[4]
    assert docs.where(F.col("text").rlike("[0-9a-f]{24}")).isEmpty()
    norm = F.regexp_replace("text", r"[\x20\x09-\x0D]+", " ")
    assert docs.select(norm).distinct().count() == docs.count()
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER)
    assert packed.select("doc_id").distinct().count() == docs.count()


@pytest.mark.parametrize("name", ["op3_exact_dedup"])
def test_sql(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{FOLDER}/documents.parquet'")
    want = con.execute(entry.oracle_sql()[name]).fetch_df()
    got = entry.queries()[name](spark, FOLDER).toPandas()[list(want.columns)]
    by = list(want.columns)
    assert got.sort_values(by).astype(str).values.tolist() == want.sort_values(by).astype(str).values.tolist()


def test_oracles_are_sql_of_registered_queries():
    found = entry.oracle_sql()
    assert set(found) <= set(entry.queries())
    assert all(isinstance(sql, str) for sql in found.values())


def planted_corpus(rng):
    """Documents of invented words: good and bad ones, copies with other white space, near copies, secrets."""
    word = lambda: "".join(rng.choice("aeioubdglmnrst") for _ in range(rng.randint(2, 8)))
    vocabulary = [word() for _ in range(400)]
    prose = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n)).capitalize() + "."
    texts = [prose(rng.randint(20, 150)) for _ in range(60)] + ["#@1 %%9 " * rng.randint(5, 30) + str(k) for k in range(25)]
    texts += [texts[k].replace(" ", "\t ", 2) for k in range(8)] + [texts[k] for k in range(5)]
    for k in range(10, 20):  # one word of many replaced, or every third
        words = texts[k].split(" ")
        words[len(words) // 2] = "Replaced"
        texts.append(" ".join(words))
        texts.append(" ".join(w if i % 3 else "other" for i, w in enumerate(texts[k].split(" "))))
    texts += [prose(40) + ' token = "' + "".join(rng.choice("0123456789abcdef") for _ in range(40)) + '" ' + prose(9), prose(30) + " AKIA" + "B7" * 10 + " " + prose(3), None, ""]
    texts.append(prose(3000))
    return [(k, t, "en", f"src{k % 3}", len(t or "")) for k, t in enumerate(texts)]


def test_pipeline_equals_a_plain_version(spark, tmp_path):
    """Every stage over what the one before it kept, with sums, sets and loops over lists."""
    rows = planted_corpus(random.Random(12))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(k, int(not 60 <= k < 85), 0) for k in range(0, 85, 2)], "doc_id long, quality int, toxic int")
    docs.repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()

    model = quality.fit(docs, labels)
    score = plain_quality([(k, t, s, lang) for k, t, lang, s, _ in rows], model)
    kept = [(k, t or "") for k, t, *_ in rows if score[k][3] >= quality.CUT]
    assert 50 < len(kept) < len(rows)
    first = {}
    for k, t in kept:
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t), (k, t))
    kept = sorted(first.values())
    roots = jaccard_roots([t for _, t in kept], 0.8)
    near = [kept[i] for i, root in enumerate(roots) if root == i]
    assert len(rows) > len(kept) > len(near)
    done = {}
    for k, t in near:
        spans = sorted((m.start(), m.end()) for _, pattern, group, least in secrets.KINDS for m in re.finditer(pattern, t) if len(m[group]) >= least)
        out, at = [], 0
        for lo, hi in spans:
            if lo >= at:
                out += [t[at:lo], "[SECRET]"]
            at = max(at, hi)
        done[k] = "".join([*out, t[at:]]) if spans else t
    assert sum("[SECRET]" in t for t in done.values()) == 2
    encode = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {}
    for k, t in done.items():
        ids = [*encode.encode(t, add_special_tokens=False).ids, 0]
        lengths = ([len(ids) % 2048] if len(ids) % 2048 else []) + [2048] * (len(ids) // 2048)
        at = 0
        for piece, n in enumerate(lengths):
            part = b"".join(i.to_bytes(4, "little") for i in ids[at : at + n])
            want[k, piece] = (at, n, zlib.crc32(part))
            at += n
    assert {(r["doc_id"], r["piece"]): (r["start"], r["length"], r["ids_crc32"]) for r in got} == want and len(got) == len(want)
    bins = defaultdict(list)
    for r in got:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in bins.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= 2048
    free = []  # first fit of falling lengths
    for n in sorted((n for _, n, _ in want.values()), reverse=True):
        k = next((k for k, room in enumerate(free) if room >= n), None)
        if k is None:
            free.append(2048 - n)
        else:
            free[k] -= n
    assert len(bins) <= len(free)

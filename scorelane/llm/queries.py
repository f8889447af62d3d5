"""The queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from .bpe import bpe_encode
from .chat import format_conversations
from .embeddings import embedding_dedup
from .divergence import divergence_audit
from .exact_dedup import exact_dedup
from .langid import identify, sentencepiece_vocabulary
from .licenses import scan_licenses
from .packing import best_fit_pack
from .quality import score_quality
from .resampling import importance_resample
from .secrets import scan_report
from .shared import table
from .sharding import shard_documents
from .simhash import simhash_dedup


def op1_bpe(spark, sf_dir):
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe_encode(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN, with_ids=False)


def op9_secrets(spark, sf_dir):
    return scan_report(table(spark, sf_dir, "documents"))


def op10_best_fit_packing(spark, sf_dir):
    path = public_tokenizers.path("byte_bpe_50k.json")
    return best_fit_pack(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


def op2_licenses(spark, sf_dir):
    return scan_licenses(table(spark, sf_dir, "documents"))


def op3_exact_dedup(spark, sf_dir):
    return exact_dedup(table(spark, sf_dir, "documents"))


def op4_language_id(spark, sf_dir):
    pieces = sentencepiece_vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    return identify(table(spark, sf_dir, "documents"), pieces)


def op5_embedding_dedup(spark, sf_dir):
    return embedding_dedup(table(spark, sf_dir, "embeddings"))


def op6_quality(spark, sf_dir):
    """Documents carry no URL: their source is the host and their language the section below it."""
    docs = table(spark, sf_dir, "documents")
    return score_quality(docs, table(spark, sf_dir, "labels"), F.col("source"), F.col("lang"))


def op7_chat(spark, sf_dir):
    return format_conversations(table(spark, sf_dir, "conversations"))


def op8_simhash(spark, sf_dir):
    return simhash_dedup(table(spark, sf_dir, "documents"))


def op11_sharding(spark, sf_dir):
    return shard_documents(table(spark, sf_dir, "documents"))


def op12_resampling(spark, sf_dir):
    return importance_resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_divergence(spark, sf_dir):
    return divergence_audit(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_bpe": op1_bpe,
    "op2_licenses": op2_licenses,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_language_id": op4_language_id,
    "op5_embedding_dedup": op5_embedding_dedup,
    "op6_quality": op6_quality,
    "op7_chat": op7_chat,
    "op8_simhash": op8_simhash,
    "op9_secrets": op9_secrets,
    "op10_best_fit_packing": op10_best_fit_packing,
    "op11_sharding": op11_sharding,
    "op12_resampling": op12_resampling,
    "op13_divergence": op13_divergence,
}

ORACLES = {
    "op3_exact_dedup": r"""
        WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
        SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = min(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
        FROM d WINDOW w AS (PARTITION BY norm)""",
    "op13_divergence": r"""
        WITH d AS (SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                     regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS words FROM documents),
             w AS (SELECT doc_id, lang, source, unnest(words) AS term FROM d),
             k AS (SELECT lang, term, count(*) AS n FROM w GROUP BY ALL HAVING count(DISTINCT doc_id) >= 30),
             v AS (SELECT lang, count(*) AS v, sum(n) AS total FROM k GROUP BY lang),
             g AS (SELECT DISTINCT lang, source FROM d),
             c AS (SELECT lang, source, term, count(*) AS n FROM w SEMI JOIN k USING (lang, term) GROUP BY ALL),
             s AS (SELECT lang, source, sum(n) AS total FROM c GROUP BY ALL),
             p AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
                     (1 + 1000000000::HUGEINT * (coalesce(c.n, 0) + 5) // (coalesce(s.total, 0) + 5 * v.v))::BIGINT AS p,
                     (1 + 1000000000::HUGEINT * (k.n + 5) // (v.total + 5 * v.v))::BIGINT AS q
                   FROM g JOIN k USING (lang) JOIN v USING (lang) LEFT JOIN s ON s.lang = g.lang AND s.source = g.source
                     LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
             f AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
             r AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0)::BIGINT AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
                     LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
                   UNION ALL SELECT lang, source, 'term' AS part, term AS item, p - q AS value FROM p WHERE n > 0 AND p > q),
             o AS (SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INT AS rank FROM r)
        SELECT lang, source, part, item, value, rank FROM o WHERE part = 'pair' OR rank <= 50""",
}

"""A corpus pipeline of five stages: quality, exact copies, near copies, secrets, packing.

Each stage takes (spark, docs, sf_dir) and returns the documents it keeps, with the columns of ``documents``; the
last returns the packed pieces. ``run`` writes each stage's result as Parquet in the shared folder and reads it
again for the next, so a lost executor costs one stage at most.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from scorelane.llm.exact_dedup import drop_exact_copies
from scorelane.llm.packing import best_fit_pack
from scorelane.llm.quality import keep_good
from scorelane.llm.secrets import redact_secrets
from scorelane.llm.shared import scratch_path, table
from scorelane.llm.simhash import drop_near_copies


def quality(spark, docs, sf_dir):
    """Rejects documents that the quality classifier rates below its cut."""
    return keep_good(docs, table(spark, sf_dir, "labels"), F.col("source"), F.col("lang"))


def exact_copies(spark, docs, sf_dir):
    """Keeps the first of equal texts."""
    return drop_exact_copies(docs)


def near_copies(spark, docs, sf_dir):
    """Keeps the first of each group of near copies."""
    return drop_near_copies(docs)


def secrets(spark, docs, sf_dir):
    """Replaces secrets in the texts; every document stays."""
    return redact_secrets(docs)


def packing(spark, docs, sf_dir):
    """Packs what is left into training sequences."""
    return best_fit_pack(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)


STAGES = [("quality", quality), ("exact_dedup", exact_copies), ("simhash_dedup", near_copies), ("secrets", secrets), ("packing", packing)]

#: SQL expresses neither SimHash nor packing; the tests hold the pipeline against a plain version.
ORACLE_SQL = None


def _remove(spark, path):
    """Deletes a folder of the shared file system."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def run(spark, sf_dir):
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before is not None:  # the stage after it is whole, so nothing reads it again
            _remove(spark, before)
        before = path
    return docs

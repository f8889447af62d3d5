"""Exact dedup by a log-structured merge index, in DataFrame operations alone.

Scan tasks are memtables: each flushes one run of (digest, id), sorted by digest. The runs come in generations. A
generation is merged within itself and probed against the filter of all older ones, a bitmap over hashed digests;
only digests that pass are looked up in the older runs. What is new there becomes a run of the index, what is not
goes to the log of hits; then the filter takes the new digests in. Compaction merges log and runs and keeps the
smallest identifier and the count of each digest. Texts of hits are read again and compared byte by byte (as
grouping keys), so rows whose texts differ despite one digest part again.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import checkpointed, hot_join, scratch_path

#: Fixed by the contract: space, tab, line feed, vertical tab, form feed, carriage return.
WHITE_SPACE = r"[\x20\x09-\x0D]+"
#: Flushed runs are taken into the index in so many generations, one after the other.
GENERATIONS = 3
#: Bits of the filter for each row: one in so many digests that are new passes by chance.
FILTER_BITS = 16
#: Rows up to which a list of ids to drop is broadcast, some 40 MB; a longer list is joined by shuffle.
BROADCAST_ROWS = 300_000


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), WHITE_SPACE, " ")


def sha256_digest(sha: Column, text: Column) -> Column:
    """The first 16 bytes of the SHA-256 of a normalised text."""
    return F.substring(sha, 1, 16)


def flush_runs(docs: DataFrame, id_col: str, text_col: str, digest=sha256_digest) -> DataFrame:
    """Rows (id, digest, sha, generation): each scan task's rows sorted by digest, as a run of one generation."""
    rows = docs.select(F.col(id_col).alias("id"), normalised(F.col(text_col)).alias("norm"))
    rows = rows.withColumn("sha", F.unhex(F.sha2("norm", 256)))
    rows = rows.select("id", digest(F.col("sha"), F.col("norm")).alias("digest"), "sha", (F.spark_partition_id() % GENERATIONS).alias("generation"))
    path = scratch_path(docs.sparkSession, "lsm-flushed")
    # the write asks for an order by generation, and keeps one that begins with it
    rows.sortWithinPartitions("generation", "digest", "id").write.partitionBy("generation").parquet(path)
    return docs.sparkSession.read.schema("id " + docs.schema[id_col].dataType.simpleString() + ", digest binary, sha binary, generation int").parquet(path)


def _hashed(rows: DataFrame, size: int) -> DataFrame:
    """rows with the place of their digest in a filter of ``size`` bits: the number of a bitmap and a bit in it."""
    place = F.pmod(F.xxhash64("digest"), F.lit(size))
    return rows.withColumns({"bitmap": F.bitmap_bucket_number(place), "bit": F.bitmap_bit_position(place)})


def filter_of(rows: DataFrame, size: int) -> DataFrame:
    """Rows (bitmap, bits): the bitmaps in which the digests' bits are set."""
    placed = _hashed(rows.select("digest"), size).select("bitmap", "bit").repartition("bitmap")
    return placed.groupBy("bitmap").agg(F.bitmap_construct_agg("bit").alias("bits"))


def probe(rows: DataFrame, filters: DataFrame, size: int) -> DataFrame:
    """rows with ``passed``: whether the filter holds the bit of their digest."""
    placed = _hashed(rows, size).join(filters, "bitmap", "left")
    byte = F.conv(F.hex(F.substring("bits", (F.col("bit") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    held = F.expr("shiftright(byte, cast(bit % 8 as int))").bitwiseAND(F.lit(1)) == 1
    placed = placed.withColumn("byte", F.coalesce(byte, F.lit(0)))
    return placed.withColumn("passed", held).drop("bitmap", "bit", "bits", "byte")


def merged(rows: DataFrame, many: Column) -> DataFrame:
    """The smallest identifier and the number of rows of each digest."""
    return rows.groupBy("digest").agg(F.min("id").alias("id"), F.sum(many).alias("n"))


def index_runs(flushed: DataFrame) -> DataFrame:
    """The compacted index, rows (digest, id, n): the smallest identifier and the number of rows of each digest of two rows or more."""
    size = max(1, FILTER_BITS * flushed.count())
    runs, log, filters = [], [], None
    for generation in range(GENERATIONS):
        new = merged(flushed.where(F.col("generation") == generation), F.lit(1))
        if runs:
            new = checkpointed(probe(new, filters, size))
            maybe = new.where("passed").select("digest")
            older = reduce(DataFrame.unionByName, runs)
            known = checkpointed(older.join(maybe, "digest", "left_semi").select("digest"))  # filters err to one side
            log.append(new.where("passed").join(known, "digest", "left_semi").drop("passed"))
            new = new.where("not passed").unionByName(new.where("passed").join(known, "digest", "left_anti")).drop("passed")
        run = checkpointed(new)
        runs.append(run)
        if generation + 1 < GENERATIONS:
            own = filter_of(run, size)
            both = own if filters is None else filters.unionByName(own).groupBy("bitmap").agg(F.bitmap_or_agg("bits").alias("bits"))
            filters = checkpointed(both)
    hits = checkpointed(reduce(DataFrame.unionByName, log))
    every = reduce(DataFrame.unionByName, runs)
    first = every.join(hits.select("digest").distinct(), "digest", "left_semi")
    return merged(first.unionByName(hits).unionByName(every.where("n > 1").join(hits.select("digest").distinct(), "digest", "left_anti")), F.col("n"))


def _verified(docs: DataFrame, id_col: str, text_col: str, digest) -> tuple[DataFrame, DataFrame]:
    """Flushed rows, and (sha, keep_id, n) of the texts that more than one row has, compared byte by byte."""
    flushed = flush_runs(docs, id_col, text_col, digest)
    hits = checkpointed(index_runs(flushed).select("digest", F.col("n").alias("many")))
    # one id may have several texts, so ids of hits are but candidates, and the digest decides
    rows = hot_join(flushed.select("digest", "id"), hits, "digest").select("id").distinct()
    rows = checkpointed(rows)
    texts = docs.select(F.col(id_col).alias("id"), normalised(F.col(text_col)).alias("norm"))
    few = rows.count() <= BROADCAST_ROWS
    wanted = rows.select(F.col("id").alias("hit"))
    texts = texts.join(F.broadcast(wanted) if few else wanted, F.col("id").eqNullSafe(F.col("hit")), "left_semi")
    exact = texts.groupBy("norm").agg(F.min("id").alias("keep_id"), F.count("*").alias("n")).where("n > 1")
    return flushed, checkpointed(exact.select(F.unhex(F.sha2("norm", 256)).alias("sha"), "keep_id", "n"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest=sha256_digest) -> DataFrame:
    """One row per row of docs: id_col, keep_id, group_size, kept, text_sha256.

    Null text counts as empty, and very long texts are read whole. A row is kept if its id is the smallest of its
    group. Rows with a null id never win against others; a group of null ids alone has keep_id null and kept true.
    Rows that repeat an id are counted and returned each; of those, all that carry the winning id are kept
    (``drop_exact_copies`` keeps one). Other columns of docs are not read, whatever their names. An empty table gives
    no rows. ``digest`` may be any binary expression of the normalised text and its SHA-256: byte verification makes
    weak ones right as well.
    """
    flushed, verified = _verified(docs, id_col, text_col, digest)
    out = hot_join(flushed.select("id", "sha"), verified.withColumn("many", F.col("n")), "sha", how="left")
    alone = F.col("n").isNull()
    return out.select(
        F.col("id").alias(id_col),
        F.when(alone, F.col("id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        F.when(alone, F.lit(True)).otherwise(F.col("id").eqNullSafe(F.col("keep_id"))).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that stay, one per group of equal texts, with their columns as they came.

    Null text counts as empty, and null ids come after all others. Rows that repeat both id and text count as copies
    too: one of them stays. Very long texts count whole, columns may have any names, and an empty table gives no rows.
    """
    flushed, verified = _verified(docs, id_col, text_col, sha256_digest)
    met = checkpointed(hot_join(flushed.select("id", "sha"), verified.withColumnRenamed("n", "many"), "sha"))
    # what is done to the rows of an id and a text: all go, or all but one
    many = met.groupBy("id", "sha").agg(F.count("*").alias("rows"), F.first("keep_id").alias("keep_id"))
    gone = many.select("id", F.struct("sha", F.col("id").eqNullSafe(F.col("keep_id")).alias("one")).alias("what"), "rows").where("rows > 1 or not what.one")
    gone = checkpointed(gone.groupBy(F.col("id").alias("gone")).agg(F.collect_list("what").alias("what")))  # as many as the texts of one id
    rows = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    list_ = F.broadcast(gone) if gone.count() <= BROADCAST_ROWS else gone
    rows = rows.join(list_, F.col("id").eqNullSafe(F.col("gone")), "left")
    # only texts of the listed ids are hashed again
    sha = F.when(F.col("what").isNotNull(), F.unhex(F.sha2(normalised(F.col("text")), 256)))
    rows = rows.withColumn("sha", sha).withColumn("mine", F.filter("what", lambda w: w["sha"] == F.col("sha")))
    listed = F.coalesce(F.size("mine") > 0, F.lit(False))
    stays = rows.where(~listed).select("row.*")
    if many.where("rows > 1 and id <=> keep_id").isEmpty():
        return stays
    one = rows.where(listed & F.col("mine")[0]["one"]).dropDuplicates(["id", "sha"])
    return stays.unionByName(one.select("row.*"))

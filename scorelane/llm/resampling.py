"""Importance resampling towards a target distribution over hashed word runs.

Identical texts are collapsed first: digests tell which texts occur once, and only texts of shared digests are grouped in
full. Each unlike text is then read off once, in numpy on whole Arrow batches: its feature buckets are stored, sorted
and as differences, and counted times the number of its copies. Gains of buckets follow from both corpora; the weight of
a text is the sum of its gains, and is joined back to all its copies before each takes its own noise.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import checkpointed, hot_join, scratch_path

#: Fixed by the contract: buckets, words in a run, share drawn in percent, least words, seed of the noise.
BUCKETS, RUN, PERCENT, LEAST_WORDS, SEED = 10_000, 3, 5, 20, "42"
#: Rows up to which the digests of repeated texts are broadcast, some 40 MB; a longer list is joined by shuffle.
BROADCAST_ROWS = 300_000
#: Bytes of text and words that a Python worker takes at once; longer texts are taken in portions of words.
TEXT_AT_ONCE, WORDS_AT_ONCE = 4 << 20, 1 << 19

# CRC-32 by its linearity: the sum of two strings put together follows from both sums and the length of the second


def _crc_table() -> np.ndarray:
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, np.uint32(0xEDB88320) ^ (c >> 1), c >> 1)
    return c


def _apply(table: np.ndarray, x: np.ndarray) -> np.ndarray:
    """A linear map of 32 bits, held as one table for each of four bytes."""
    return table[0][x & 255] ^ table[1][x >> 8 & 255] ^ table[2][x >> 16 & 255] ^ table[3][x >> 24]


class Crc:
    """CRC-32 of many substrings of a buffer at once, and of strings put together."""

    NEAR = 64

    def __init__(self) -> None:
        self.table = _crc_table()
        shift = np.stack([np.arange(256, dtype=np.uint32) << np.uint32(8 * k) for k in range(4)])
        steps = [shift]
        for _ in range(self.NEAR):
            shift = self.table[shift & 255] ^ (shift >> 8)
            steps.append(shift)
        self.shifts = np.stack(steps)  # by number of bytes that follow
        self.powers = [self.shifts[1]]
        for _ in range(40):
            last = self.powers[-1]
            self.powers.append(_apply(last, last))

    def followed(self, crc: np.ndarray, other: np.ndarray, length: np.ndarray) -> np.ndarray:
        """The sums of strings with sum ``crc``, each followed by one of sum ``other`` and so many bytes."""
        near = length <= self.NEAR
        n = np.where(near, length, 0)
        s = self.shifts
        moved = s[n, 0, crc & 255] ^ s[n, 1, crc >> 8 & 255] ^ s[n, 2, crc >> 16 & 255] ^ s[n, 3, crc >> 24]
        if not near.all():
            far = np.flatnonzero(~near)
            x, n = crc[far], length[far]
            for k, table in enumerate(self.powers):
                x = np.where(n >> k & 1, _apply(table, x), x)
            moved[far] = x
        return moved ^ other

    def of(self, buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        crc = np.full(len(starts), 0xFFFFFFFF, np.uint32)
        order = np.argsort(starts - ends, kind="stable")  # the longest first, so that those not done yet stand together
        first, length = starts[order], (ends - starts)[order]
        far = int(np.searchsorted(-length, -self.NEAR, "left"))
        part = crc[far:]
        for k in range(int(length[far]) if far < len(length) else 0):
            many = int(np.searchsorted(-length[far:], -k, "left"))
            if not many:
                break
            part[:many] = self.table[(part[:many] ^ buffer[first[far : far + many] + k]) & 255] ^ (part[:many] >> 8)
        part ^= np.uint32(0xFFFFFFFF)
        for k in range(far):
            crc[k] = zlib.crc32(buffer[first[k] : first[k] + length[k]].tobytes())
        out = np.empty_like(crc)
        out[order] = crc
        return out


#: Fixed by the contract: bytes that words are made of (digits, letters, all of other characters), A-Z as small letters.
WORD = np.zeros(256, bool)
WORD[0x30:0x3A] = WORD[0x41:0x5B] = WORD[0x61:0x7B] = WORD[0x80:] = True
SMALL = np.arange(256, dtype=np.uint8)
SMALL[0x41:0x5B] += 32


def text_buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow column of texts; a null has no bytes."""
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    return (np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)), offsets


def word_bounds(data: np.ndarray, offsets: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, text numbers) of the runs of word bytes; texts follow each other without a gap."""
    inside = word[data]
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    first = [0] if len(inside) and inside[0] else []
    starts = np.concatenate([first, edge[~inside[edge - 1]]]).astype(np.int64)
    ends = np.concatenate([edge[inside[edge - 1]], [len(inside)] if len(inside) and inside[-1] else []]).astype(np.int64)
    cuts = np.unique(offsets[1:-1])
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    cuts = cuts[inside[cuts] & inside[cuts - 1]] if len(cuts) else cuts  # a word may not run on into the next text
    starts, ends = np.sort(np.concatenate([starts, cuts])), np.sort(np.concatenate([ends, cuts]))
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def run_buckets(crc: Crc, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, text: np.ndarray, buckets: int, own: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, text) of all runs of 1 to RUN words that start at the first ``own`` words (all by default)."""
    own = len(starts) if own is None else own
    words, length = crc.of(data, starts, ends), ends - starts
    spaced = crc.followed(np.full(len(words), zlib.crc32(b" "), np.uint32), words, length)
    now, found, texts = words[:own], [], []
    for k in range(RUN):
        if k:
            many = max(0, min(own, len(words) - k))
            now = crc.followed(now[:many], spaced[k : k + many], length[k : k + many] + 1)
        same = text[k : k + len(now)] == text[: len(now)]
        found.append((now[same] % np.uint32(buckets)).astype(np.int64))
        texts.append(text[: len(now)][same])
    return np.concatenate(found), np.concatenate(texts)


def _features(buckets: int):
    """Arrow batches of (sha, many, text) to stored features of texts, and to counters of the whole task at its end."""

    def run(batches):
        crc = Crc()
        counts = np.zeros(buckets, np.int64)

        def stored(shas, n_words, bucket, text, at: int, many) -> pa.RecordBatch:
            order = np.argsort(text * buckets + bucket, kind="stable")
            bucket, text = bucket[order], text[order]
            bounds = np.searchsorted(text, np.arange(at, at + len(shas) + 1))
            steps = np.diff(bucket, prepend=0)
            heads = bounds[:-1][bounds[:-1] < bounds[1:]]
            steps[heads] = bucket[heads]
            wide = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(shas), [None, pa.py_buffer((bounds * 2).astype(np.int64)), pa.py_buffer(steps.astype("<u2").tobytes())])
            np.add.at(counts, bucket, many[text])
            n = pa.array(np.diff(bounds), pa.int64())
            nulls = pa.nulls(len(shas), pa.int64())
            return pa.RecordBatch.from_arrays([shas, wide.cast(pa.binary()), pa.array(n_words, pa.int64()), n, nulls, nulls], names=NAMES)

        for batch in batches:
            data, offsets = text_buffer(batch.column("text"))
            many_of = batch.column("many").to_numpy()
            cut = [0]
            while cut[-1] < len(offsets) - 1:  # portions of rows, one at least
                cut.append(max(cut[-1] + 1, int(np.searchsorted(offsets, offsets[cut[-1]] + TEXT_AT_ONCE, "right")) - 1))
            for lo, hi in zip(cut, cut[1:], strict=False):
                part = SMALL[data[offsets[lo] : offsets[hi]]]
                starts, ends, text = word_bounds(part, offsets[lo : hi + 1] - offsets[lo], WORD)
                shas = batch.column("sha").slice(lo, hi - lo)
                for at in range(0, max(1, len(starts)), WORDS_AT_ONCE):
                    upto = min(len(starts), at + WORDS_AT_ONCE)
                    reach = slice(at, upto + RUN - 1)
                    bucket, of = run_buckets(crc, part, starts[reach], ends[reach], text[reach], buckets, upto - at)
                    first, last = (text[at], text[upto - 1] + 1) if upto > at else (0, 0)
                    if at == 0:
                        first = 0  # texts without words get a row too
                    if upto == len(starts):
                        last = hi - lo
                    n_words = np.bincount(text[at:upto] - first, minlength=last - first)
                    yield stored(shas.slice(first, last - first), n_words, bucket, of, int(first), many_of[lo:hi])
        at = np.flatnonzero(counts)
        nulls = pa.nulls(len(at), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.nulls(len(at), pa.binary()), pa.nulls(len(at), pa.binary()), nulls, nulls, pa.array(at), pa.array(counts[at])], names=NAMES)

    return run


NAMES = ["sha", "steps", "n_words", "n_features", "bucket", "n"]
#: Partitions in which the counters of tasks are added up.
ADDERS = 4


def _packed_features(buckets: int):
    """As ``_features``, but with a task's counters in one row (counts), whatever it read."""

    def run(batches):
        for batch in _features(buckets)(batches):
            if len(batch) and batch.column("bucket").null_count == 0:
                counts = np.zeros(buckets, "<i8")
                counts[batch.column("bucket").to_numpy()] = batch.column("n").to_numpy()
                columns = [*[pa.nulls(1, batch.schema.field(c).type) for c in NAMES[:4]], pa.array([counts.tobytes()], pa.binary())]
            else:
                columns = [*batch.columns[:4], pa.nulls(len(batch), pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=[*NAMES[:4], "counts"])

    return run


def _stored_features(texts: DataFrame, buckets: int) -> DataFrame:
    path = scratch_path(texts.sparkSession, "features")
    schema = "sha binary, steps binary, n_words long, n_features long, counts binary"
    texts.select("sha", "many", "text").mapInArrow(_packed_features(buckets), schema).write.option("compression", "zstd").parquet(path)
    return texts.sparkSession.read.parquet(path)


def _added(buckets: int):
    """Rows of counters to one row (bucket, n) a bucket that is not empty."""

    def run(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for row in batch.column("counts"):
                total += np.frombuffer(row.as_buffer(), "<i8")
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["bucket", "n"])

    return run


def bucket_counts(stored: DataFrame, buckets: int) -> DataFrame:
    """(bucket, n) of stored features, in ADDERS parts: as many rows as buckets in each, however many tasks counted."""
    return stored.where("counts is not null").select("counts").coalesce(ADDERS).mapInArrow(_added(buckets), "bucket long, n long")


def unlike_texts(docs: DataFrame, text_col: str) -> tuple[DataFrame, DataFrame]:
    """(keys, texts): the digest of each row in the order of ``docs``'s first column, and rows (sha, many, text) of unlike texts.

    A text whose digest no other row has is unlike all others as it stands; the rest is grouped by full text.
    """
    key = docs.columns[0]
    rows = docs.select(F.col(key).alias("id"), F.coalesce(text_col, F.lit("")).alias("text")).withColumn("sha", F.unhex(F.sha2("text", 256)))
    keys = checkpointed(rows.select("id", "sha"))
    repeated = checkpointed(keys.groupBy("sha").agg(F.count("*").alias("many")).where("many > 1"))
    few = F.broadcast(repeated) if repeated.count() <= BROADCAST_ROWS else repeated
    marked = rows.select("sha", "text").join(few, "sha", "left")
    grouped = marked.where("many is not null").groupBy("text").agg(F.count("*").alias("many"))
    grouped = grouped.select(F.unhex(F.sha2("text", 256)).alias("sha"), "many", "text")
    alone = marked.where("many is null").select("sha", F.lit(1).cast("long").alias("many"), "text")
    return keys, alone.unionByName(grouped)


def bucket_gains(raw: DataFrame, target: DataFrame, buckets: int) -> np.ndarray:
    """The gain of each bucket; ``raw`` and ``target`` have rows (bucket, n). As many numbers as buckets reach the driver."""
    s, t = np.zeros(buckets), np.zeros(buckets)
    for into, counts in ((s, raw), (t, target)):
        for r in counts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
            into[r["bucket"]] = r["n"]
    return np.floor(1000 * np.log((t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets)))).astype(np.int64)


def ranked(rows: DataFrame, order: list, parts: int) -> DataFrame:
    """rows with ``rank`` from 1 in a global order: range partitions are numbered within and offset by those before."""
    cut = checkpointed(rows.repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id()))
    sizes = cut.groupBy("part").agg(F.count("*").alias("size"))  # a row a partition
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("before"))
    inner = F.row_number().over(Window.partitionBy("part").orderBy(*order))
    return cut.withColumn("rank", inner.cast("long")).join(sizes, "part").withColumn("rank", F.col("rank") + F.col("before")).drop("part", "before")


def _weights(gains: np.ndarray):
    def run(batches):
        for batch in batches:
            steps = batch.column("steps").cast(pa.large_binary())
            bounds = np.frombuffer(steps.buffers()[1], np.int64)[steps.offset : steps.offset + len(steps) + 1] // 2
            data = steps.buffers()[2]
            flat = np.frombuffer(data, "<u2")[bounds[0] : bounds[-1]].astype(np.int64) if data is not None else np.zeros(0, np.int64)
            bounds = bounds - bounds[0]
            total = np.concatenate([[0], np.cumsum(flat)])
            bucket = total[1:] - np.repeat(total[bounds[:-1]], np.diff(bounds))  # a text's own sums
            sums = np.concatenate([[0], np.cumsum(gains[bucket])])
            weight = sums[bounds[1:]] - sums[bounds[:-1]]
            yield pa.RecordBatch.from_arrays([batch.column("sha"), batch.column("n_words"), batch.column("n_features"), pa.array(weight)], names=["sha", "n_words", "n_features", "weight"])

    return run


def importance_resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_text: str = "text", percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: str = SEED, buckets: int = BUCKETS) -> DataFrame:
    """One row per row of docs: id_col, n_features, weight, score, rank (null where it is not drawn), all long.

    Of the documents of ``least_words`` words or more, ``percent`` in a hundred (rounded down) with the highest scores are drawn,
    ties to the smaller id; null ids come last among ties, and their noise is that of an empty id. Rows that repeat an id
    are told apart by text digest alone, and draw the same noise. Null and empty texts have no features and weight 0; very
    long texts are read whole, in portions. Without target texts all target counts are 0. Columns of other names are not
    read; an empty table gives no rows. Buckets are at most 65,536.
    """
    spark = docs.sparkSession
    keys, texts = unlike_texts(docs.select(id_col, text_col), text_col)
    stored = _stored_features(texts, buckets)
    _, goal = unlike_texts(target.select(F.lit(0).cast("long").alias("id"), F.col(target_text).alias("text")), "text")
    gains = bucket_gains(bucket_counts(stored, buckets), bucket_counts(_stored_features(goal, buckets), buckets), buckets)
    of = stored.where("sha is not null").select("sha", "n_words", "n_features", "steps")
    weights = of.mapInArrow(_weights(gains), "sha binary, n_words long, n_features long, weight long")
    weights = weights.groupBy("sha").agg(F.sum("n_words").alias("n_words"), F.sum("n_features").alias("n_features"), F.sum("weight").alias("weight"))
    copies = keys.groupBy("sha").agg(F.count("*").alias("many"))
    weights = checkpointed(weights.join(copies, "sha"))
    out = hot_join(keys, weights, "sha")
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("long")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")
    out = checkpointed(out.select("id", "n_words", "n_features", "weight", (F.col("weight") + noise).alias("score")))
    most = percent * out.where(F.col("n_words") >= least_words).count() // 100
    parts = max(spark.sparkContext.defaultParallelism, -(-out.count() // 1_000_000))
    order = [F.desc("score"), F.asc_nulls_last("id")]
    good = ranked(out.where(F.col("n_words") >= least_words), order, parts).withColumn("rank", F.when(F.col("rank") <= most, F.col("rank")))
    rest = out.where(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long"))
    return good.unionByName(rest).select(F.col("id").alias(id_col), "n_features", "weight", "score", "rank")

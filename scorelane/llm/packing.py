"""Best-fit packing of token sequences with swap-based local search.

Lengths lie between 1 and the capacity, so the whole corpus is summed up by a histogram of at most ``capacity``
counters, gathered exactly. The driver packs the histogram: bins that hold the same lengths are one pattern
with a count. Pieces are then dealt to the places of these patterns by their rank within their length.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right, insort
from collections import Counter, defaultdict
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bpe import cached, slices
from .shared import checkpointed

CAPACITY = 2048
#: A length is ranked in so many parts at least, and in parts of about so many rows of the whole.
SALTS, SALT_ROWS = 64, 100_000
#: Places up to which their list is broadcast, some 8 MB; a longer list is joined by shuffle on the length.
BROADCAST_PLACES = 200_000


class Bins:
    """Equal bins counted together: groups[fill][pattern] = number of bins; a pattern is a sorted tuple."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.groups: dict[int, Counter] = defaultdict(Counter)
        self.fills: list[int] = []

    def add(self, pattern: tuple, count: int) -> None:
        fill = sum(pattern)
        if fill not in self.groups:
            insort(self.fills, fill)
        self.groups[fill][pattern] += count

    def take(self, pattern: tuple, count: int) -> None:
        fill = sum(pattern)
        group = self.groups[fill]
        group[pattern] -= count
        if not group[pattern]:
            del group[pattern]
        if not group:
            del self.groups[fill]
            self.fills.pop(bisect_left(self.fills, fill))

    def fullest_with_room(self, size: int):
        """A pattern of the fullest bins that ``size`` fits in (best fit)."""
        k = bisect_left(self.fills, self.capacity - size + 1) - 1
        return None if k < 0 else next(iter(self.groups[self.fills[k]]))

    def total(self) -> int:
        return sum(sum(g.values()) for g in self.groups.values())


def best_fit(histogram: dict[int, int], capacity: int) -> Bins:
    """Best fit by decreasing length over counted lengths."""
    bins = Bins(capacity)
    for size in sorted(histogram, reverse=True):
        left = histogram[size]
        while left:
            pattern = bins.fullest_with_room(size)
            if pattern is None:
                per = capacity // size
                if left >= per:
                    bins.add((size,) * per, left // per)
                    left %= per
                else:
                    bins.add((size,) * left, 1)
                    left = 0
                continue
            have, per = bins.groups[sum(pattern)][pattern], (capacity - sum(pattern)) // size
            if left >= per:
                k = min(have, left // per)
                grown, used = tuple(sorted((*pattern, *(size,) * per))), k * per
            else:
                k, grown, used = 1, tuple(sorted((*pattern, *(size,) * left))), left
            bins.take(pattern, k)
            bins.add(grown, k)
            left -= used
    return bins


@lru_cache(maxsize=200_000)
def _given(pattern: tuple) -> tuple[list[tuple], list[tuple], list[int]]:
    """What a bin may give away: single documents, then pairs, largest first; both together, with their negated sums, sorted by these."""
    have = sorted(set(pattern), reverse=True)
    pairs = [(y, z) for k, y in enumerate(have) for z in have[k:] if y != z or pattern.count(y) > 1]
    both = sorted([*((y,) for y in have), *pairs], key=sum, reverse=True)
    return [*((y,) for y in have), *sorted(pairs, key=sum, reverse=True)], both, [-sum(x) for x in both]


def _exchange(donor: tuple, target: tuple, room: int) -> tuple[tuple, tuple] | None:
    """New contents of donor and target after an exchange of one document for one, one for two, or two for one that
    fills the target up as far as any for the same documents of the donor does; None if there is none."""
    _, takes, sums = _given(target)
    for give in _given(donor)[0]:
        own = sum(give)
        # the smallest sum that is no less than own - room fills up most
        for at in range(bisect_right(sums, room - own) - 1, -1, -1):
            take = takes[at]
            if sums[at] + own <= 0:
                break
            if len(give) + len(take) < 4:
                rest, grown = list(donor), list(target)
                for x in give:
                    rest.remove(x)
                for y in take:
                    grown.remove(y)
                return tuple(sorted((*rest, *take))), tuple(sorted((*grown, *give)))
    return None


def _improve(bins: Bins, donor: tuple, most: int, refused: set) -> tuple[tuple, int] | None:
    """One exchange that raises the squared fill, for as many of ``most`` equal donor bins as there are equal targets.

    The donor bins' next content and their number, or None if there is no exchange. First each document of the donor,
    largest first, is to move into the fullest bin with room; then one or two of them are exchanged with a bin that is no
    less full than the donor, the fullest first. ``refused`` remembers pairs of patterns without an exchange, for it
    depends on the patterns alone.
    """
    own = sum(donor)
    for x in sorted(set(donor), reverse=True):
        rest = list(donor)
        rest.remove(x)
        target = bins.fullest_with_room(x)
        if target is not None and sum(target) + x > own:
            k = min(most, bins.groups[sum(target)][target])
            bins.take(target, k)
            bins.add(tuple(sorted((*target, x))), k)
            return tuple(rest), k
    for fill in reversed(bins.fills):
        if fill == bins.capacity:
            continue
        if fill < own:
            break
        for target in list(bins.groups[fill]):
            if (donor, target) in refused:
                continue
            after = _exchange(donor, target, bins.capacity - fill)
            if after is None:
                refused.add((donor, target))
                continue
            k = min(most, bins.groups[fill][target])
            bins.take(target, k)
            bins.add(after[1], k)
            return after[0], k
    return None


def local_search(bins: Bins) -> Bins:
    """Empty the least filled bins by moves and exchanges, until the bound is met or no pattern has an exchange left.

    Every step raises the sum of squared fills, so the search ends. A step takes half of the equal bins of a pattern
    (the other half are targets), so the work depends on the patterns and, by a logarithm, on their counts. Stuck
    bins are put back as targets and tried again after a pass that changed any.
    """
    volume = sum(f * sum(g.values()) for f, g in bins.groups.items())
    bound, refused = -(-volume // bins.capacity), set()
    count, changed = bins.total(), True
    while changed and count > bound:
        changed, stuck = False, []
        while count > bound and bins.fills and bins.fills[0] < bins.capacity:
            donor = next(iter(bins.groups[bins.fills[0]]))
            many = -(-bins.groups[bins.fills[0]][donor] // 2)
            many = min(many, count - bound)
            bins.take(donor, many)
            while donor:
                step = _improve(bins, donor, many, refused)
                if step is None:
                    break
                changed = True
                if step[1] < many:
                    bins.add(donor, many - step[1])
                donor, many = step
            if donor:
                stuck.append((donor, many))
            else:
                count -= many
        for donor, many in stuck:
            bins.add(donor, many)
    return bins


def pack_lengths(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Places (length, first rank, last rank, first sequence id, offset) that take in all counted lengths."""
    bins = local_search(best_fit(histogram, capacity))
    used: Counter = Counter()
    places, sequence = [], 0
    for fill in reversed(bins.fills):
        for pattern, count in sorted(bins.groups[fill].items()):
            offset = 0
            for size in pattern:
                places.append((size, used[size], used[size] + count - 1, sequence, offset))
                used[size] += count
                offset += size
            sequence += count
    return places


def byte_alphabet() -> dict[str, int]:
    """The characters that stand for bytes in a byte-level vocabulary: printable Latin-1 ones for themselves, the
    others for consecutive characters from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + k): b for k, b in enumerate(rest)}


def _tokenizer_encoder(definition: str, pattern: str):
    """A function of texts to id bytes, as the tokenizers library gives them for a JSON definition as it is loaded.

    Of a plain byte-level tokenizer whose merges come in the order of their ids, ids are ranks, and tiktoken, which splits by the
    same pattern, gives the same ids of whole texts in less time: added tokens are cut out of a text first. For all
    other definitions the library encodes the texts.
    """
    import json
    import re
    from array import array

    whole = json.loads(definition)
    model, split = whole["model"], whole.get("pre_tokenizer") or {}
    vocabulary = model["vocab"]
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model.get("merges", [])]
    ids = [vocabulary.get("".join(pair), -1) for pair in pairs]
    added = whole.get("added_tokens") or []
    plain = model["type"] == "BPE" and not model.get("dropout") and not whole.get("normalizer")
    plain = plain and split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space")
    plain = plain and len(vocabulary) == 256 + len(ids) and ids == list(range(256, 256 + len(ids)))
    if plain and all(t["content"] and not (t["single_word"] or t["lstrip"] or t["rstrip"]) for t in added):
        import tiktoken

        byte = byte_alphabet()
        ranks = {bytes(byte[c] for c in token): k for token, k in vocabulary.items()}
        encode = tiktoken.Encoding("words", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        special = {t["content"]: [t["id"]] for t in added}
        cut = re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")").split

        def ids(text: str) -> list[int]:
            if not any(s in text for s in special):
                return encode(text)
            return [i for k, part in enumerate(cut(text)) for i in (special[part] if k % 2 else encode(part))]

        return lambda texts: [array("I", ids(t)).tobytes() for t in texts]

    from tokenizers import Tokenizer

    t = Tokenizer.from_str(definition)
    t.no_padding()
    t.no_truncation()
    return lambda texts: [np.array(e.ids, "<u4").tobytes() for e in t.encode_batch(texts, add_special_tokens=False)]


def tokenized_pieces(docs: DataFrame, tokenizer_path: str, pattern: str, capacity: int, id_col: str, text_col: str) -> DataFrame:
    """Rows (doc_id, piece, start, length, ids_crc32, ids): each document's ids and a closing id 0, cut if longer than capacity."""
    with open(tokenizer_path, encoding="utf-8") as f:
        vocabulary = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encode = cached((tokenizer_path, pattern, "encoder"), lambda: _tokenizer_encoder(vocabulary.value, pattern))
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for lo, hi in slices(texts):
                row, piece, start, length, crc = [], [], [], [], []
                for k, packed in enumerate(encode(texts[lo:hi])):
                    packed += b"\0\0\0\0"
                    total, at, number = len(packed) // 4, 0, 0
                    while at < total:
                        size = (total % capacity or capacity) if not at else capacity
                        row.append(lo + k)
                        piece.append(number)
                        start.append(at)
                        length.append(size)
                        crc.append(zlib.crc32(packed[4 * at : 4 * (at + size)]))
                        at, number = at + size, number + 1
                ids = batch.column(0).take(pa.array(row, pa.int64()))
                arrays = [ids, pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc))]
                yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "piece", "start", "length", "ids_crc32"])

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long"
    return docs.select(F.col(id_col).alias("doc_id"), text_col).mapInArrow(run, schema)


def assign(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds sequence_id and offset to rows with a length between 1 and capacity."""
    spark = pieces.sparkSession
    pieces = checkpointed(pieces.withColumn("__hash", F.xxhash64("doc_id", "piece")))
    salts = max(SALTS, -(-pieces.count() // SALT_ROWS))
    pieces = pieces.withColumn("__salt", F.pmod("__hash", F.lit(salts))).drop("__hash")
    counts = pieces.groupBy("length", "__salt").count()
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("count").alias("n")).collect()}
    # a rank within each length: a rank within the salt and the sizes of the salts before it
    before = Window.partitionBy("length").orderBy("__salt").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("length", "__salt", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__base"))
    within = Window.partitionBy("length", "__salt").orderBy("doc_id", "piece", "start", "ids_crc32")
    ranked = pieces.withColumn("__rank", F.row_number().over(within) - 1)
    ranked = ranked.join(base, ["length", "__salt"]).withColumn("__rank", F.col("__rank") + F.col("__base"))
    dealt = pack_lengths(histogram, capacity)
    places = spark.createDataFrame(dealt or [(0, 0, -1, 0, 0)], "length long, first long, last long, sequence long, offset long")
    # places of a length meet its pieces by blocks of ranks
    blocks = F.sequence(F.floor(F.col("first") / SALT_ROWS), F.floor(F.col("last") / SALT_ROWS))
    places = places.where("last >= first").withColumn("block", F.explode(blocks))
    places = F.broadcast(places) if len(dealt) <= BROADCAST_PLACES else places
    ranked = ranked.withColumn("block", F.floor(F.col("__rank") / SALT_ROWS))
    inside = (ranked["length"] == places["length"]) & (ranked["block"] == places["block"]) & ranked["__rank"].between(F.col("first"), F.col("last"))
    placed = ranked.join(places, inside).withColumn("sequence_id", F.col("sequence") + F.col("__rank") - F.col("first"))
    return placed.select("doc_id", "piece", "start", ranked["length"], "ids_crc32", "sequence_id", "offset")


def best_fit_pack(
    docs: DataFrame,
    tokenizer_path: str,
    pattern: str,
    capacity: int = CAPACITY,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Null and empty texts are the closing id alone. Rows with null or repeated ids are packed like others. Only
    documents longer than ``capacity`` are cut; the first piece takes the remainder. Each sequence is gapless
    from offset 0. An empty table gives no rows. Columns besides id_col and text_col are not read.
    """
    return assign(tokenized_pieces(docs, tokenizer_path, pattern, capacity, id_col, text_col), capacity)

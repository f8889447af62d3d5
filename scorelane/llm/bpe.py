"""Byte-level BPE encoding and decoding by corpus-level merge replay.

A task takes the distinct words of its share of the corpus as one symbol array, builds an inverted index from
mergeable pair to word positions, and applies the merges in rank order; a merge touches only the positions
under its pair and re-indexes their neighbours. Documents are then put together from their words' ids.
"""

from __future__ import annotations

import base64
import hashlib
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words that a Python worker remembers between batches and tasks; others are replayed in each batch.
MEMORY_WORDS = 400_000
#: Texts are taken in slices of about so many characters, which bounds the memory of a task.
SLICE_CHARS = 8_000_000


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


class MergeReplay:
    """Encodes distinct words by replaying all merges over all of them at once."""

    def __init__(self, ranks: dict[bytes, int]):
        self.tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.byte_id = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        size = len(self.tokens)
        self.size = size
        #: (left id * size + right id) -> id of the merged token, for every cut of every token
        self.merged: dict[int, int] = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    self.merged[left * size + right] = rank
        table = np.full((256, 256), -1, np.int64)
        for a in range(256):
            for b in range(256):
                table[a, b] = self.merged.get(int(self.byte_id[a]) * size + int(self.byte_id[b]), -1)
        self.byte_pairs = table

    def encode(self, words: list[bytes]) -> list[bytes]:
        """The ids of each word as little-endian unsigned 32-bit integers."""
        if not words:
            return []
        raw = np.frombuffer(b"".join(words), np.uint8)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(lengths)
        starts = ends - lengths
        n = len(raw)
        symbol = self.byte_id[raw].tolist()
        last = np.zeros(n + 1, bool)
        last[ends[lengths > 0] - 1] = True
        right = np.arange(1, n + 1)
        right[last[:n]] = -1
        first = np.zeros(n + 1, bool)
        first[starts[lengths > 0]] = True
        left = np.arange(-1, n - 1)
        left[first[:n]] = -1
        rank = np.where(last[: n - 1], -1, self.byte_pairs[raw[:-1], raw[1:]]) if n > 1 else np.zeros(0, np.int64)
        at = np.flatnonzero(rank >= 0)
        at = at[np.argsort(rank[at], kind="stable")]
        present, cuts = np.unique(rank[at], return_index=True)
        index = {int(r): p.tolist() for r, p in zip(present, np.split(at, cuts[1:]), strict=True)} if len(at) else {}
        right, left = right.tolist(), left.tolist()
        size, merged = self.size, self.merged.get
        heap = list(index)
        heapify(heap)
        while heap:
            r = heappop(heap)
            positions = index.pop(r, None)
            if positions is None:
                continue
            positions.sort()
            for k, i in enumerate(positions):
                a = symbol[i]
                if a < 0:
                    continue
                j = right[i]
                if j < 0 or merged(a * size + symbol[j]) != r:
                    continue
                symbol[i], symbol[j] = r, -1
                after = right[i] = right[j]
                lowest = size
                if after >= 0:
                    left[after] = i
                    new = merged(r * size + symbol[after])
                    if new is not None:
                        lowest = new
                        if new in index:
                            index[new].append(i)
                        else:
                            index[new] = [i]
                            heappush(heap, new)
                before = left[i]
                if before >= 0:
                    new = merged(symbol[before] * size + r)
                    if new is not None:
                        lowest = min(lowest, new)
                        if new in index:
                            index[new].append(before)
                        else:
                            index[new] = [before]
                            heappush(heap, new)
                if lowest < r:  # an earlier merge has become possible: it goes first
                    index.setdefault(r, []).extend(positions[k + 1 :])
                    heappush(heap, r)
                    break
        ids = np.array(symbol, np.int64)
        kept = ids >= 0
        flat = ids[kept].astype("<u4").tobytes()
        cut = np.concatenate([[0], np.cumsum(kept)])
        return [flat[4 * a : 4 * b] for a, b in zip(cut[starts].tolist(), cut[ends].tolist(), strict=True)]


class Numbers(dict):
    """Numbers keys in the order in which they are first asked for."""

    def __missing__(self, key):
        self[key] = number = len(self)
        return number


class WordEncoder:
    """Texts to id bytes, by a splitting pattern and an encoder of distinct words; remembers common words.

    Strings of ``special`` (to id bytes) are cut out of a text first, and what is between them is split by itself.
    """

    def __init__(self, pattern: str, encode_words, special: dict[str, bytes] | None = None):
        self.findall = regex.compile(pattern).findall
        self.encode_words = encode_words
        self.special = special or {}
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")").split
        self.known: dict[str | tuple, bytes] = {(s,): ids for s, ids in self.special.items()}

    def words(self, text: str) -> list:
        if not any(s in text for s in self.special):
            return self.findall(text)
        out = []
        for k, part in enumerate(self.cut(text)):
            out.extend([(part,)] if k % 2 else self.findall(part))
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        known = self.known
        numbers = Numbers()
        rows = []
        for text in texts:
            words = self.words(text)
            rows.append(np.fromiter(map(numbers.__getitem__, words), np.int32, len(words)))
        new = [w for w in numbers if w not in known]
        fresh = dict(zip(new, self.encode_words(new), strict=True))
        table = [known.get(w) or fresh.get(w, b"") for w in numbers]
        if len(known) < MEMORY_WORDS:
            known.update(fresh)
        get = table.__getitem__
        return [b"".join(map(get, row.tolist())) for row in rows]


_ENCODERS: dict[tuple, object] = {}


def cached(key: tuple, make):
    """One object per key in a worker process."""
    if key not in _ENCODERS:
        _ENCODERS[key] = make()
    return _ENCODERS[key]


def slices(texts: list[str], most: int = SLICE_CHARS):
    """Ranges of consecutive texts of about ``most`` characters; a longer text is a range of its own."""
    lo = total = 0
    for hi, text in enumerate(texts):
        if hi > lo and total + len(text) > most:
            yield lo, hi
            lo, total = hi, 0
        total += len(text)
    if lo < len(texts):
        yield lo, len(texts)


def bpe_encode(
    docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True
) -> DataFrame:
    """Per row of docs: doc_id, n_tokens, ids_sha256, decoded_sha256 and, if asked for, ids as array<int>.

    Ids are those of a rank file's byte-level BPE without special tokens, each match of ``pattern`` by itself;
    decoded_sha256 is of the bytes that decoding these ids gives. Null and empty texts have no tokens. Rows with
    a null or repeated id are encoded like others; columns besides id_col and text_col are not read. Very long
    texts are encoded whole. An empty table gives no rows. The rank file is read by the driver alone.
    """
    ranks = docs.sparkSession.sparkContext.broadcast(load_ranks(ranks_path))  # as large as the vocabulary

    def run(batches):
        def make():
            replay = MergeReplay(ranks.value)
            encoder = WordEncoder(pattern, lambda words: replay.encode([w.encode("utf-8", "surrogatepass") for w in words]))
            return replay, encoder

        replay, encoder = cached((ranks_path, pattern), make)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for lo, hi in slices(texts):
                packed = encoder.encode(texts[lo:hi])
                tokens = replay.tokens.__getitem__
                decoded = [b"".join(map(tokens, np.frombuffer(p, "<u4").tolist())) for p in packed]
                columns = {
                    "doc_id": batch.column(0).slice(lo, hi - lo),
                    "n_tokens": pa.array([len(p) // 4 for p in packed], pa.int64()),
                    "ids_sha256": pa.array([hashlib.sha256(p).hexdigest() for p in packed]),
                    "decoded_sha256": pa.array([hashlib.sha256(b).hexdigest() for b in decoded]),
                }
                if with_ids:
                    columns["ids"] = pa.array([np.frombuffer(p, "<u4").astype(np.int32) for p in packed], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    return docs.select(F.col(id_col).alias("doc_id"), text_col).mapInArrow(run, schema)


def bpe_decode(encoded: DataFrame, ranks_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Per row: id_col and text, the bytes of the ids as UTF-8 (what is not valid UTF-8 is replaced)."""
    ranks = encoded.sparkSession.sparkContext.broadcast(load_ranks(ranks_path))

    def run(batches):
        tokens = {rank: token for token, rank in ranks.value.items()}
        for batch in batches:
            texts = [b"".join(map(tokens.__getitem__, ids or [])).decode("utf-8", "replace") for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=[id_col, "text"])

    kind = encoded.schema[id_col].dataType.simpleString()
    return encoded.select(id_col, ids_col).mapInArrow(run, f"`{id_col}` {kind}, text string")

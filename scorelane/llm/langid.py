"""Language ID by segmentation-marginalised unigrams.

A fixed public vocabulary of pieces gets one probability per piece and language, fitted by expectation
maximisation. The probability of a word is the sum over all its segmentations into pieces, by the forward
algorithm; a text is the product over its words. Words are runs of letters, cut after ``RUN`` letters.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bpe import Numbers, cached, slices
from .shared import checkpointed, drawn

RUN = 32
WORD = rf"\p{{L}}{{1,{RUN}}}"
#: The model is fitted on about so many documents of each language; the bound keeps its cost from growing.
TRAIN_DOCS_PER_LANGUAGE = 2_000
ROUNDS = 3
#: Probability of a letter that no piece covers, and a factor per letter that keeps sums away from underflow.
UNKNOWN, SCALE = 1e-7, 64.0
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
MEMORY_WORDS = 400_000


def word_pieces(pieces: list[str], mark: str = "▁") -> list[str]:
    """The pieces of letters, with or without the mark that stands before a word's first letter."""
    letters = regex.compile(rf"{mark}?\p{{L}}*").fullmatch
    return [p for p in pieces if p and letters(p) and len(p) <= RUN + 1]


def _hash_columns(codes: np.ndarray) -> np.ndarray:
    h = np.zeros((len(codes), codes.shape[1] + 1), np.uint64)
    for k in range(codes.shape[1]):
        h[:, k + 1] = h[:, k] * BASE + codes[:, k].astype(np.uint64) + np.uint64(1)
    return h


def _codes(words: list[str], width: int) -> np.ndarray:
    packed = "".join(w.ljust(width, "\0") for w in words).encode("utf-32-le", "surrogatepass")
    return np.frombuffer(packed, "<u4").reshape(len(words), width)


class Lattice:
    """Piece lookups for many words at once, and the sums over their segmentations."""

    def __init__(self, pieces: list[str]):
        self.size = len(pieces)
        by_length: dict[int, list[tuple[int, int]]] = {}
        for number, piece in enumerate(pieces):
            value = _hash_columns(_codes([piece], len(piece)))[0, -1]
            by_length.setdefault(len(piece), []).append((int(value), number))
        self.tables = {}
        for length, rows in sorted(by_length.items()):
            rows.sort()
            self.tables[length] = (np.array([h for h, _ in rows], np.uint64), np.array([k for _, k in rows], np.int64))

    def edges(self, words: list[str], width: int):
        """(length, ids) for each piece length: ids[w, i] is the piece of that length at i, or self.size."""
        h = _hash_columns(_codes(words, width))
        out = []
        for length, (known, number) in self.tables.items():
            if length > width:
                break
            factor = np.uint64(pow(int(BASE), length, 1 << 64))
            value = h[:, length:] - h[:, : width - length + 1] * factor
            at = np.minimum(np.searchsorted(known, value), len(known) - 1)
            out.append((length, np.where(known[at] == value, number[at], self.size)))
        return out

    def forward(self, edges, n: int, width: int, p: np.ndarray) -> np.ndarray:
        """alpha[t]: scaled sums over segmentations of the first t characters; p has a last row of zeros."""
        alpha = np.zeros((width + 1, n, p.shape[1]))
        alpha[0] = 1.0
        for t in range(1, width + 1):
            step = alpha[t - 1] * UNKNOWN
            for length, ids in edges:
                if length > t:
                    break
                step += alpha[t - length] * p[ids[:, t - length]] * SCALE ** (length - 1)
            alpha[t] = step * SCALE
        return alpha

    def groups(self, words: list[str], most: int = 20_000):
        """Index arrays of words of about equal length."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        order = np.argsort(lengths, kind="stable")
        for width in (4, 6, 8, 10, 12, 16, 20, RUN + 1):
            part = order[(lengths[order] <= width)]
            order = order[len(part) :]
            for at in range(0, len(part), most):
                yield part[at : at + most], lengths[part[at : at + most]], width

    def log_likelihood(self, words: list[str], p: np.ndarray) -> np.ndarray:
        out = np.zeros((len(words), p.shape[1]))
        for part, lengths, width in self.groups(words):
            alpha = self.forward(self.edges([words[k] for k in part], width), len(part), width, p)
            out[part] = np.log(alpha[lengths, np.arange(len(part))]) - (lengths * np.log(SCALE))[:, None]
        return out

    def expected(self, words: list[str], counts: np.ndarray, p: np.ndarray) -> np.ndarray:
        """Expected number of uses of each piece, for one language (p has one column)."""
        total = np.zeros(self.size + 1)
        for part, lengths, width in self.groups(words):
            edges = self.edges([words[k] for k in part], width)
            n, rows = len(part), np.arange(len(part))
            alpha = self.forward(edges, n, width, p)[:, :, 0]
            beta = np.zeros((width + 1, n))
            beta[lengths, rows] = 1.0
            weight = counts[part] / alpha[lengths, rows]
            for t in range(width - 1, -1, -1):
                step = beta[t + 1] * UNKNOWN * SCALE
                for length, ids in edges:
                    if t + length > width:
                        break
                    use = p[ids[:, t], 0] * SCALE**length * beta[t + length]
                    step = step + use
                    np.add.at(total, ids[:, t], alpha[t] * use * weight)
                beta[t] = np.where(lengths == t, 1.0, step)
        return total[:-1]


def remainder(id_col: str) -> Column:
    """crc32 of the id as text, modulo 3; rows with remainder 1, or without an id, are never learned from."""
    return F.crc32(F.col(id_col).cast("string")) % 3


class Model:
    """Languages, pieces, and a (pieces x languages) table of probabilities; as large as the vocabulary."""

    def __init__(self, languages: list[str], pieces: list[str], p: np.ndarray, key: str):
        self.languages, self.pieces, self.p, self.key = languages, pieces, p, key


def fit(
    docs: DataFrame,
    vocabulary: list[str],
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    per_language: int = TRAIN_DOCS_PER_LANGUAGE,
    rounds: int = ROUNDS,
) -> Model:
    """Fit on a sample of ``per_language`` documents a language, drawn by hash from those that may be learned from."""
    spark = docs.sparkSession
    pieces = word_pieces(vocabulary)
    may = docs.where((remainder(id_col) != 1) & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    sizes = {r[0]: r[1] for r in may.groupBy(lang_col).count().collect()}  # one row a language
    languages = sorted(sizes)
    if not languages:
        return Model([], pieces, np.zeros((len(pieces) + 1, 0)), "none")
    hashed = F.xxhash64(F.col(id_col), F.lit("sample"))
    sample = may.where(F.coalesce(*[F.when(F.col(lang_col) == k, drawn(hashed, per_language, n)) for k, n in sizes.items()]))
    words = sample.select(F.col(lang_col).alias("lang"), F.explode(F.regexp_extract_all(F.lower(text_col), F.lit(WORD), F.lit(0))).alias("word"))
    counts = checkpointed(words.groupBy("lang", "word").count().repartition("word"))
    mark = "▁"
    lattice_key = ("lattice", len(pieces), hash(tuple(pieces)))

    def round_of(p: np.ndarray, smooth: float) -> np.ndarray:
        table = spark.sparkContext.broadcast(p)

        def run(batches):
            lattice = cached(lattice_key, lambda: Lattice(pieces))
            total = np.zeros((len(pieces), len(languages)))
            for pdf in batches:
                for k, language in enumerate(languages):
                    own = pdf[pdf["lang"] == language]
                    if len(own):
                        spelled = [mark + w.lower()[:RUN] for w in own["word"]]
                        total[:, k] += lattice.expected(spelled, own["count"].to_numpy(float), np.ascontiguousarray(table.value[:, k : k + 1]))
            i, k = np.nonzero(total)
            yield pd.DataFrame({"piece": i, "language": k, "uses": total[i, k]})

        got = counts.mapInPandas(run, "piece long, language long, uses double").groupBy("piece", "language").agg(F.sum("uses").alias("uses")).toPandas()
        fresh = np.zeros((len(pieces) + 1, len(languages)))
        fresh[got["piece"], got["language"]] = got["uses"]
        fresh[:-1] += smooth
        return fresh / fresh[:-1].sum(0)

    # longer pieces are likelier than their letters together from the start
    first = np.array([[2.0 ** -len(x)] for x in pieces] + [[0.0]])
    p = np.repeat(first / first.sum(), len(languages), axis=1)
    for _ in range(rounds):
        p = round_of(p, 0.1)
    return Model(languages, pieces, p, f"{hash(p.tobytes())}")


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of docs: id_col, held_out, lang_pred, score; see ``identify``."""
    shared = docs.sparkSession.sparkContext.broadcast((model.languages, model.pieces, model.p, model.key))

    def run(batches):
        languages, pieces, p, key = shared.value
        lattice = cached(("lattice", len(pieces), hash(tuple(pieces))), lambda: Lattice(pieces))
        known: dict[str, int] = cached(("langid", key), dict)
        memory = cached(("langid rows", key), lambda: np.zeros((MEMORY_WORDS, len(languages))))
        findall = regex.compile(WORD).findall
        mark = "▁"
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            names, scores = [], []
            for lo, hi in slices(texts):
                numbers = Numbers()
                rows = []
                for text in texts[lo:hi]:
                    words = findall(text.lower())
                    rows.append(np.fromiter(map(numbers.__getitem__, words), np.int32, len(words)))
                if not languages or not numbers:
                    table = np.zeros((0, 0))
                else:
                    at = np.fromiter((known.get(w, -1) for w in numbers), np.int64, len(numbers))
                    new = np.flatnonzero(at < 0)
                    words = list(numbers)
                    fresh = [words[k] for k in new]
                    table = memory[at]
                    table[new] = lattice.log_likelihood([mark + w for w in fresh], p)
                    room = fresh[: MEMORY_WORDS - len(known)]
                    memory[len(known) : len(known) + len(room)] = table[new[: len(room)]]
                    known.update(zip(room, range(len(known), len(known) + len(room)), strict=True))
                for row in rows:
                    if not len(row) or not languages:
                        names.append("und")
                        scores.append(0.0)
                        continue
                    total = np.bincount(row, minlength=len(table)) @ table if len(row) > len(table) else table[row].sum(0)
                    odds = np.exp(total - total.max())
                    best = int(odds.argmax())
                    names.append(languages[best])
                    scores.append(float(odds[best] / odds.sum()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=["doc_id", "held_out", "lang_pred", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.coalesce(remainder(id_col) == 1, F.lit(True)).alias("held_out"))
    return rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, lang_pred string, score double").withColumnRenamed("doc_id", id_col)


def identify(docs: DataFrame, vocabulary: list[str], id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Fit on the rows that may be learned from, then predict every row: id_col, held_out, lang_pred, score.

    The score is the share of the predicted language in the likelihoods of all. Null texts and texts without a
    letter are ``und`` with score 0, as is every row if no row may be learned from. Ties go to the first
    language in alphabetical order. Rows with a null id are predicted and count as held out. Repeated rows are
    predicted alike; long texts are scored whole; columns besides the three named are not read.
    """
    return predict(docs, fit(docs, vocabulary, id_col, text_col, lang_col), id_col, text_col)


def sentencepiece_vocabulary(path: str) -> list[str]:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [model.id_to_piece(k) for k in range(model.get_piece_size()) if not (model.is_control(k) or model.is_byte(k) or model.is_unknown(k))]

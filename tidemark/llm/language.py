"""Language identification: multinomial naive Bayes over hashed character n-grams.

Counts by language and bucket are summed over all documents that may teach; the
matrix of log-probabilities, whose size is that of languages times buckets
whatever the input, is broadcast; batches of texts are scored in numpy.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import tidy

#: Buckets of n-grams (a power of two), and the orders counted.
BITS, ORDERS = 15, (1, 2, 3)
#: Characters that numpy works on at once; a longer text is a chunk of its own.
CHUNK_CHARS = 1 << 20
#: Odd multipliers of the hash, one for each place and a last one.
_PLACES, _LAST = (0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35), 0x27D4EB2F
UNKNOWN = "und"


def ngrams(texts: list[str]) -> tuple[np.ndarray, Iterator[np.ndarray]]:
    """Start of each text in one array, and for each order the buckets of its n-grams.

    Two NULs open each text and follow the last, so n-grams never span texts.
    """
    code = np.frombuffer(("".join(f"\0\0{t.lower()}" for t in texts) + "\0\0").encode("utf-32-le"), np.uint32)
    n = len(code) - 2
    lengths = np.fromiter((len(t.lower()) + 2 for t in texts), np.int64, len(texts))

    def orders() -> Iterator[np.ndarray]:
        mixed = np.zeros(n, np.uint32)
        for k in range(max(ORDERS)):
            mixed = mixed + (code[k : n + k] + np.uint32(1)) * np.uint32(_PLACES[k])
            if k + 1 in ORDERS:
                salted = (mixed ^ (mixed >> np.uint32(15)) ^ np.uint32(k)) * np.uint32(_LAST)
                yield (salted >> np.uint32(32 - BITS)).astype(np.int32)

    return np.cumsum(lengths) - lengths, orders()


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def _chunks(texts: list[str]) -> Iterator[slice]:
    at, size = 0, 0
    for k, t in enumerate(texts):
        if k > at and size + len(t) > CHUNK_CHARS:
            yield slice(at, k)
            at, size = k, 0
        size += len(t) + 2
    if texts:
        yield slice(at, len(texts))


def held_out(id_col: str, folds: int = 3, fold: int = 1) -> Column:
    """Whether crc32 of the id as text leaves this remainder; null ids are held out."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(folds)) == fold, F.lit(True))


@dataclass
class Model:
    """Languages in order, log priors, and log-probabilities by language and bucket."""

    langs: list[str]
    prior: np.ndarray
    matrix: np.ndarray

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        names, best = [], np.zeros(len(texts))
        for part in _chunks(texts):
            own = texts[part]
            starts, orders = ngrams(own)
            score = np.repeat(self.prior[:, None], len(own), axis=1)
            for buckets in orders:
                for k, row in enumerate(self.matrix):
                    score[k] += np.add.reduceat(row[buckets], starts, dtype=np.float64)
            if len(self.langs):
                top = score.argmax(axis=0)
                share = 1 / np.exp(score - score.max(axis=0)).sum(axis=0)
            known = np.array([bool(self.langs) and has_letter(t) for t in own])
            names += [self.langs[top[k]] if known[k] else UNKNOWN for k in range(len(own))]
            if known.any():
                best[part][known] = share[known]
        return names, best


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", smoothing: float = 0.5) -> Model:
    """Learn from every row with text and language that is not held out."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sums of this task, at most one row for each language and bucket; bucket -1 has documents."""
        size = 1 << BITS
        index: dict[str, int] = {}
        sums = np.zeros((0, size), np.int64)
        n_docs: list[int] = []
        for batch in batches:
            texts, langs = batch.column("text").to_pylist(), batch.column("lang").to_pylist()
            for x in langs:
                if x not in index:
                    index[x] = len(index)
                    n_docs.append(0)
                n_docs[index[x]] += 1
            if len(index) > len(sums):
                sums = np.concatenate([sums, np.zeros((len(index) - len(sums), size), np.int64)])
            for part in _chunks(texts):
                starts, orders = ngrams(texts[part])
                lang = np.array([index[x] for x in langs[part]])
                # Texts of a language lie together, so each has one count of its buckets.
                for buckets in orders:
                    of = np.repeat(lang, np.diff(starts, append=len(buckets)))
                    sums += np.bincount(of * size + buckets, minlength=len(index) * size).reshape(-1, size)
        for x, k in index.items():
            some = np.flatnonzero(sums[k])
            yield pa.record_batch([pa.array([x] * (len(some) + 1)), pa.array(np.append(some, -1).astype(np.int32)), pa.array(np.append(sums[k][some], n_docs[k]))], ["lang", "bucket", "n"])

    given = docs.where(~held_out(id_col) & F.col(text_col).isNotNull() & F.col(lang_col).isNotNull())
    given = given.select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    counts = given.mapInArrow(tidy(count), "lang string, bucket int, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    table = counts.toArrow()  # languages times buckets, at most
    langs = sorted(set(table.column("lang").to_pylist()))
    at = {x: k for k, x in enumerate(langs)}
    matrix, n_docs = np.zeros((len(langs), 1 << BITS)), np.zeros(len(langs))
    for x, bucket, n in zip(*(table.column(c).to_pylist() for c in ("lang", "bucket", "n")), strict=True):
        if bucket < 0:
            n_docs[at[x]] = n
        else:
            matrix[at[x], bucket] = n
    matrix += smoothing
    matrix = np.log(matrix / matrix.sum(axis=1, keepdims=True)).astype(np.float32)
    return Model(langs, np.log(n_docs / n_docs.sum()) if langs else n_docs, matrix)


def predicted(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, held_out, lang_pred, score): the likeliest language of each whole text.

    score is its posterior probability. Null texts and texts without a letter,
    and all texts if nothing was learned, are ``und`` with score 0. Rows are
    kept as they are, repeated ones and null ids too; other columns are left
    out. An empty table gives an empty one.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, best = sent.value.predict([t or "" for t in batch.column("text").to_pylist()])
            yield pa.record_batch([batch.column("id"), pa.array(names, pa.string()), pa.array(best, pa.float64())], ["id", "lang_pred", "score"])

    given = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    got = given.mapInArrow(tidy(run), f"id {kind}, lang_pred string, score double").withColumnRenamed("id", id_col)
    return got.select(id_col, held_out(id_col).alias("held_out"), "lang_pred", "score")
